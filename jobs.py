"""Run one job: ``spark-submit jobs.py <job> --option value ...``; ``jobs.py <job> --help`` lists its options.

Options are the parameters of the job's ``run`` function.  Locations with a slash are paths of files,
others catalog tables.
"""

from __future__ import annotations

import argparse
import inspect
from collections.abc import Callable, Sequence

from pyspark import SparkConf
from pyspark.sql import SparkSession

from footfall.plans import (
    area_dictionary,
    column_protection,
    coupon_attribution,
    device_binding,
    event_detail,
    visitor_cube,
)
from footfall.settings import SPARK_CONF

JOBS: dict[str, Callable] = {
    "area-dictionary": area_dictionary.run,
    "device-binding": device_binding.run,
    "device-binding-bucketed": device_binding.run_bucketed,
    "event-detail": event_detail.run,
    "event-detail-published": event_detail.run_published,
    "attribution": coupon_attribution.run,
    "visitor-cube": visitor_cube.run,
    "protect-column": column_protection.run,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--hive", action="store_true", help="use the Hive catalog")
    top.add_argument(
        "--partitions", default="20000",
        help="partitions a shuffle starts with; small ones are merged at run time, large even ones cannot be split (default: %(default)s)",
    )
    jobs = top.add_subparsers(dest="job", required=True)
    for name, run in JOBS.items():
        job = jobs.add_parser(name, description=run.__doc__)
        for option in list(inspect.signature(run).parameters.values())[1:]:
            flag = "--" + option.name.replace("_", "-")
            if option.name == "key":
                # A file keeps the key out of the command line and its logs.
                job.add_argument("--key-file", required=True)
            elif isinstance(option.default, bool):
                job.add_argument(flag, action="store_true", default=None)
            elif isinstance(option.default, tuple):
                job.add_argument(flag, nargs="+")
            else:
                job.add_argument(flag, required=option.default is inspect.Parameter.empty)
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    options = {k: v for k, v in vars(parser().parse_args(arguments)).items() if v is not None}
    job, hive, key_file = options.pop("job"), options.pop("hive"), options.pop("key_file", None)
    settings = {**SPARK_CONF, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": options.pop("partitions")}
    if key_file:
        with open(key_file) as file:
            options["key"] = file.read().strip()
    builder, submitted = SparkSession.builder.appName(f"footfall {job}"), SparkConf()
    for key, value in settings.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    JOBS[job]((builder.enableHiveSupport() if hive else builder).getOrCreate(), **options)


if __name__ == "__main__":
    main()
