import os

import pytest
from pyspark.sql import functions as F

from footfall.sources.scans import id_splits
from footfall.sources import Staging, append_days, overwrite_days, read_areas_jdbc, read_csv, read_days, read_table, replace_table, staging_root
from helpers import plan, rows


def day_rows(spark, *data):
    return spark.createDataFrame(data, "v int, dt string")


def stored(spark, location):
    return rows(read_table(spark, location).select("v", F.col("dt").cast("string")))


@pytest.mark.parametrize("kind", ["path", "table"])
@pytest.mark.parametrize("rebalance", [False, True])
def test_overwrite_replaces_only_its_days(spark, folder, kind, rebalance):
    target = f"{folder}/days" if kind == "path" else f"overwritten_{rebalance}".lower()
    overwrite_days(day_rows(spark, (1, "2024-01-01"), (2, "2024-01-02")), target, rebalance=rebalance)
    for _ in range(2):
        overwrite_days(day_rows(spark, (3, "2024-01-02"), (4, "2024-01-02")), target, rebalance=rebalance)
    assert stored(spark, target) == [(1, "2024-01-01"), (3, "2024-01-02"), (4, "2024-01-02")]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_append_adds_again(spark, folder, kind):
    target = f"{folder}/days" if kind == "path" else "appended"
    for _ in range(2):
        append_days(day_rows(spark, (1, "2024-01-01")), target)
    assert stored(spark, target) == [(1, "2024-01-01")] * 2


def test_table_columns_are_matched_by_name(spark):
    overwrite_days(day_rows(spark, (1, "2024-01-01")).withColumn("w", F.lit(5)), "by_name")
    overwrite_days(spark.createDataFrame([(7, "2024-01-02", 2)], "w int, dt string, v int"), "by_name")
    assert rows(spark.table("by_name"), "v", "w") == [(1, 5), (2, 7)]


def test_day_reads_prune_partitions(spark, folder):
    overwrite_days(day_rows(spark, *((i, f"2024-01-0{i}") for i in range(1, 6))), f"{folder}/days")
    assert rows(read_days(spark, f"{folder}/days", "2024-01-02"), "v") == [(2,)]
    several = read_days(spark, f"{folder}/days", "2024-01-02", "2024-01-04")
    assert rows(several, "v") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(dt" in plan(several)


def test_replace_table(spark, folder):
    for target in (f"{folder}/t", "replaced"):
        for v in (1, 2):
            replace_table(spark.createDataFrame([(v,)], "v int"), target)
        assert rows(read_table(spark, target)) == [(2,)]


def test_csv_has_a_given_schema(spark, folder):
    with open(f"{folder}/v.csv", "w") as file:
        file.write("guid,ip,sesid,pgid,jpout,acc_tml,deviceType,province,isnew\n7,a,b,c,N,5,M,west,1\n")
    views = read_csv(spark, folder)
    assert views.first()["guid"] == 7 and dict(views.dtypes)["acc_tml"] == "int"


def test_jdbc_read_is_parted_by_the_ids_that_are_there(spark):
    """No database is started here: only the requests that Spark would get are looked at."""
    asked = []

    class Reader:
        def jdbc(self, url, table, **options):
            asked.append((url, table, options))
            # A thousand ids close together and a few far away.
            return spark.range(1000).union(spark.range(10**9, 10**9 + 8)) if len(asked) == 1 else "rows"

    class Session:
        read = Reader()

    assert read_areas_jdbc(Session(), "jdbc:x", "area_tree", {"user": "u"}, 4, sample_every=10) == "rows"
    sample, whole = asked
    assert sample == ("jdbc:x", "(select id from area_tree where mod(id, 10) = 0) ids", {"properties": {"user": "u"}})
    assert whole[:2] == ("jdbc:x", "area_tree") and whole[2]["properties"] == {"user": "u"}
    assert len(whole[2]["predicates"]) == 4


def test_pieces_of_ids_are_even_and_whole(spark):
    ids = spark.range(2000).selectExpr("case when id = 7 then null when id % 2 = 0 then id div 2 else 10000000 + id * 977 end as id")
    conditions = id_splits(ids.where("id % 3 = 0"), 8)
    sizes = [ids.where(c).count() for c in conditions]
    assert len(sizes) == 8 and sum(sizes) == 2000 and max(sizes) < 2 * 2000 / 8
    assert id_splits(ids.limit(0), 8) == ["1 = 1"] == id_splits(ids, 1)


def test_staging_uses_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging_root(spark) == root
    stage = Staging(spark, "run-1")
    df = stage(spark.range(3), "ids")
    assert stage.location("ids") == f"{root}/footfall/run-1/ids" and df.count() == 3
    assert f"{root}/footfall/run-1/ids/" in df.inputFiles()[0]


def test_staged_tables_are_removed_by_run(spark):
    one, two = Staging(spark, "run-a"), Staging(spark, "run-b")
    kept = two(spark.range(2), "ids")
    one(spark.range(3), "ids")
    one.remove()
    one.remove()
    assert not os.path.exists(one.path) and kept.count() == 2


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_root(Cluster())
