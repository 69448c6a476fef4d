"""A keyed store in buckets, with a delta for each day.

Keys are hashed into buckets.  A day adds a delta: the rows it changes, new values and removals alike, so a day costs as much as it
changes, not as much as the store holds.  Reading merges: of the base and the deltas of a key the last day's row
holds.  Compaction folds deltas into the buckets they touch and leaves all others where they are.

The :class:`~footfall.sources.ledger.Ledger` of the store names the location of every bucket and delta, so each
change becomes visible at once; files that no manifest names any more are for the caller to remove.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.sources.ledger import Ledger

BUCKET, REMOVED = "_bucket", "_removed"
_AGE = "_age"


class KeyedStore:
    """Rows of ``schema`` (a DDL text) with one row per ``keys``, below ``path``.

    The number of buckets is fixed when the first base is written.  Keys may be any types that can be hashed; null is a key like any other.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.keys, self.buckets = spark, tuple(keys), buckets
        self.ledger = Ledger(spark, path)
        self.schema = StructType.fromDDL(schema)

    def parts(self, at: int | None = None) -> dict:
        """The manifest ``at`` that number, else the newest: ``buckets``, ``base`` (bucket to location) and ``deltas`` (day, location, buckets), oldest first."""
        return self.ledger.read(at) or {"buckets": self.buckets, "base": {}, "deltas": []}

    def _in_order(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def _write_buckets(self, rows: DataFrame, buckets: int) -> tuple[str, list[int]]:
        """Rows in folders by bucket, one file each unless a bucket is large; the location and the buckets there."""
        place = self.ledger.location("rows")
        dealt = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int"))
        dealt.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(place)
        # At most as many rows as the store has buckets.
        found = self.spark.read.schema(dealt.schema).parquet(place).select(BUCKET).distinct().collect()
        return place, sorted(r[0] for r in found)

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows``, one per key, the whole store; the number of the new manifest."""
        newest, buckets = self.ledger.newest(), self.parts()["buckets"]
        place, found = self._write_buckets(self._in_order(rows), buckets)
        return self.ledger.publish({"buckets": buckets, "base": {str(b): f"{place}/{BUCKET}={b}" for b in found}, "deltas": []}, newest)

    def write_day(self, day: str, changes: DataFrame, at: int | None = None) -> int:
        """Add the delta of a day: rows of the store, and ``REMOVED`` true for keys that go.  One row per key.

        The day's former delta is replaced, so a rerun gives the same store.  Days come in order: a day before the last
        one, or one that a compaction has taken in, is an error.  The result is the number of the new manifest, which
        follows from the one ``at`` that number if a run goes back to it.
        """
        newest, parts = self.ledger.newest(), self.parts(at)
        days = [d["day"] for d in parts["deltas"]]
        if (days and day < days[-1]) or day <= parts.get("compacted", ""):
            raise ValueError(f"day {day} is not the last one of the store")
        rows = changes.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields], F.coalesce(REMOVED, F.lit(False)).alias(REMOVED))
        place, found = self._write_buckets(rows, parts["buckets"])
        deltas = [d for d in parts["deltas"] if d["day"] != day] + [{"day": day, "at": place, "buckets": found}]
        return self.ledger.publish({**parts, "deltas": deltas}, newest)

    def _layers(self, parts: dict, wanted: set[int] | None = None) -> DataFrame:
        """The rows of base and deltas with ``_AGE`` (0, 1, ...), of all buckets or some."""
        empty = self.spark.createDataFrame([], StructType([*self.schema.fields])).withColumns({REMOVED: F.lit(False), _AGE: F.lit(0)})
        layers = empty
        places = [at for b, at in parts["base"].items() if wanted is None or int(b) in wanted]
        if places:
            layers = layers.unionByName(self.spark.read.schema(self.schema).parquet(*places).withColumns({REMOVED: F.lit(False), _AGE: F.lit(0)}))
        changed = StructType([*self.schema.fields]).add(REMOVED, "boolean")
        for age, delta in enumerate(parts["deltas"], 1):
            places = [f"{delta['at']}/{BUCKET}={b}" for b in delta["buckets"] if wanted is None or b in wanted]
            if places:
                layers = layers.unionByName(self.spark.read.schema(changed).parquet(*places).withColumn(_AGE, F.lit(age)))
        return layers

    def _merged(self, layers: DataFrame) -> DataFrame:
        """The last row of each key, combined before the shuffle."""
        values = [f.name for f in self.schema.fields if f.name not in self.keys]
        last = F.max_by(F.struct(*values, REMOVED), _AGE).alias("_last")
        merged = layers.groupBy(*self.keys).agg(last).where(~F.col(f"_last.{REMOVED}"))
        return merged.select(*[F.col(f.name) if f.name in self.keys else F.col(f"_last.{f.name}").alias(f.name) for f in self.schema.fields])

    def read(self, before: str | None = None, at: int | None = None) -> DataFrame:
        """The store; with ``before`` as it was before the delta of that day, which is what a rerun of the day reads."""
        parts = self.parts(at)
        if before is not None:
            if before <= parts.get("compacted", ""):
                raise ValueError(f"a compaction has taken day {before} in")
            parts = {**parts, "deltas": [d for d in parts["deltas"] if d["day"] < before]}
        layers = self._layers(parts)
        return self._in_order(layers) if not parts["deltas"] else self._merged(layers)

    def compact(self) -> int:
        """Fold all deltas into the base and rewrite no bucket that none of them touches; the number of the newest manifest."""
        newest, parts = self.ledger.newest(), self.parts()
        touched = {b for d in parts["deltas"] for b in d["buckets"]}
        if not parts["deltas"]:
            return newest
        place, found = self._write_buckets(self._merged(self._layers(parts, touched)), parts["buckets"])
        base = {b: at for b, at in parts["base"].items() if int(b) not in touched} | {str(b): f"{place}/{BUCKET}={b}" for b in found}
        return self.ledger.publish({**parts, "base": base, "deltas": [], "compacted": parts["deltas"][-1]["day"]}, newest)
