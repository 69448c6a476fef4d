"""Versions of several tables that become visible together.

Outputs are written to locations of their own, which no reader looks at.  What readers see is the newest manifest, a small
file that names the location of every part; it is put in place last, in one step.  A run that fails before leaves
the former manifest, so readers go on with tables that fit each other, and its rerun writes anew.

Manifests are numbered.  Of two runs that start from one manifest only one can publish the next, the other fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Ledger:
    """The manifests below ``path``, a folder that all readers and writers share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_manifests")
        return folder.getFileSystem(context._jsc.hadoopConfiguration()), context._jvm.org.apache.hadoop.fs.Path, folder

    def newest(self) -> int:
        """The number of the newest manifest, 0 without any."""
        files, _, folder = self._files()
        if not files.exists(folder):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def read(self, number: int | None = None) -> dict:
        """The parts of a manifest, of the newest one unless another is named; empty without any, and for number 0."""
        number = self.newest() if number is None else number
        if not number:
            return {}
        lines = self.spark.read.text(f"{self.path}/_manifests/{number:09d}.json", wholetext=True)
        return json.loads(lines.first()[0])

    def location(self, name: str) -> str:
        """A place for a new version of a part, which nothing else is written to."""
        return f"{self.path}/{name}/{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, writer: Callable[[DataFrame, str], None] | None = None) -> str:
        """Write ``df`` as a new version of a part, not visible yet; its location."""
        place = self.location(name)
        df.write.parquet(place) if writer is None else writer(df, place)
        return place

    def publish(self, parts: dict, after: int) -> int:
        """Make ``parts`` the manifest that follows number ``after``; fails if there is one already."""
        files, path, folder = self._files()
        files.mkdirs(folder)
        made, kept = path(f"{self.path}/_manifests/.{uuid.uuid4().hex}"), path(f"{self.path}/_manifests/{after + 1:09d}.json")
        out = files.create(made, False)
        try:
            out.write(bytearray(json.dumps(parts, indent=1).encode()))
        finally:
            out.close()
        # A rename puts the whole file in place or nothing; it never replaces another one.
        if files.exists(kept) or not files.rename(made, kept):
            files.delete(made, False)
            raise RuntimeError(f"manifest {after + 1} of {self.path} has been published by another run")
        return after + 1
