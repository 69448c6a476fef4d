"""Intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without: it gets a fresh temporary folder, once per session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="footfall-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


class Staging:
    """Writes intermediate results of one run as parquet and reads them back.

    This cuts lineage, so a lost executor re-reads files instead of repeating shuffles, and later steps
    get column pruning and real sizes.  The same ``run_id`` writes the same paths again.  A job that has
    written its outputs calls ``remove``; whoever hands on a DataFrame cannot, it is still to be read.
    """

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark = spark
        self.path = f"{staging_root(spark)}/footfall/{run_id or uuid.uuid4().hex}"

    def location(self, name: str) -> str:
        return f"{self.path}/{name}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.location(name))
        return self.spark.read.schema(df.schema).parquet(self.location(name))

    def remove(self) -> None:
        """Delete all that this run has staged; nothing staged is no error."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
