"""Stored cuboids of one cube, and the smallest one that answers a report.

A cuboid over some dimensions holds all there is to know for any subset of them.  So a report need not go back to the base,
and never to the log: of the stored cuboids that have its dimensions the one with the fewest rows is rolled up.  New
cuboids are made the same way, each from the smallest stored one that has its dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.visitors import roll_up, visitor_counts

CATALOG_SCHEMA = "dims array<string>, n_rows bigint, place string"


def smallest_ancestor(sizes: Mapping[frozenset[str], int], dims: Iterable[str]) -> frozenset[str]:
    """Of the dimension sets in ``sizes`` that contain ``dims`` the one with the fewest rows, then dimensions, then by name."""
    wanted = frozenset(dims)
    fitting = [stored for stored in sizes if wanted <= stored]
    if not fitting:
        raise KeyError(f"no stored cuboid has the dimensions {sorted(wanted)}")
    return min(fitting, key=lambda s: (sizes[s], len(s), sorted(s)))


class Lattice:
    """Cuboids below ``path``, each in a folder named by its dimensions, and a small table of their sizes.

    Bitmaps and measures are as in ``visitors``.  The table of sizes is written after the cuboids, so it names complete ones only.
    """

    def __init__(self, spark: SparkSession, path: str, measures: Sequence[str] = (), bitmap: str = "uv_bitmap"):
        self.spark, self.path, self.measures, self.bitmap = spark, path.rstrip("/"), tuple(measures), bitmap

    def _place(self, dims: Iterable[str]) -> str:
        return f"{self.path}/cuboids/{'-'.join(sorted(dims)) or 'all'}"

    def sizes(self) -> dict[frozenset[str], int]:
        """Rows of each stored cuboid; a row a cuboid, so this is small."""
        rows = self.spark.read.schema(CATALOG_SCHEMA).parquet(f"{self.path}/sizes").collect()
        return {frozenset(r["dims"]): r["n_rows"] for r in rows}

    def cuboid(self, dims: Iterable[str]) -> DataFrame:
        """A stored cuboid over exactly ``dims``."""
        return self.spark.read.parquet(self._place(dims))

    def store(self, base: DataFrame, dims: Sequence[str], others: Iterable[Sequence[str]] = ()) -> None:
        """Write the base cuboid over ``dims`` and roll-ups over each of ``others``, larger ones first."""
        base.write.mode("overwrite").parquet(self._place(dims))
        sizes = {frozenset(dims): self.cuboid(dims).count()}
        for less in sorted({frozenset(o) for o in others} - set(sizes), key=lambda s: (-len(s), sorted(s))):
            source = self.cuboid(smallest_ancestor(sizes, less))
            roll_up(source, sorted(less), self.measures, self.bitmap).write.mode("overwrite").parquet(self._place(less))
            sizes[less] = self.cuboid(less).count()
        rows = [(sorted(d), n, self._place(d)) for d, n in sizes.items()]
        self.spark.createDataFrame(rows, CATALOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/sizes")

    def report(self, dims: Sequence[str], out: str = "uv") -> DataFrame:
        """Distinct visitors ``out`` and measures over ``dims``, from the smallest stored cuboid that has them."""
        source = smallest_ancestor(self.sizes(), dims)
        stored = self.cuboid(source)
        rolled = stored if source == frozenset(dims) else roll_up(stored, dims, self.measures, self.bitmap)
        counted = visitor_counts(rolled, dims, self.measures, self.bitmap, out)
        return counted.select(*[F.col(d) for d in dims], out, *self.measures)
