"""The command line of the jobs."""

import pytest

import jobs
from footfall.operators.protect import decrypt_column
from footfall.plans import coupon_attribution


def test_options_follow_the_run_functions():
    parsed = jobs.parser().parse_args(
        ["event-detail", "--log", "ods.log", "--dictionary", "dim.area", "--ip-ranges", "dim.ip", "--scores", "dws.scores",
         "--store", "dws.store_1", "--next-store", "dws.store_2", "--detail", "dwd.detail", "--log-day", "2021-02-01", "--append"]
    )
    assert (parsed.job, parsed.log_day, parsed.append, parsed.bind_day) == ("event-detail", "2021-02-01", True, None)
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["device-binding", "--log", "x"])
    touch = jobs.parser().parse_args(
        ["attribution", "--detail", "a", "--weights", "b", "--day", "d", "--touchpoints", "x", "y"]
    )
    assert touch.touchpoints == ["x", "y"] and touch.converted_only is None
    assert coupon_attribution.run is jobs.JOBS["attribution"]


def test_a_job_runs_from_the_command_line(spark, folder):
    with open(f"{folder}/key", "w") as file:
        file.write("unit-test-key-16\n")
    spark.createDataFrame([("n", "123")], "name string, id_number string").write.parquet(f"{folder}/people")
    jobs.main(["--partitions", "4", "protect-column", "--people", f"{folder}/people", "--sealed", f"{folder}/sealed", "--key-file", f"{folder}/key"])
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "4"
    stored = spark.read.parquet(f"{folder}/sealed")
    assert decrypt_column(stored, "encrypted_id", "unit-test-key-16", "plain").first()["plain"] == "123"
