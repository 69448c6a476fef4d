"""Counting along an ordered key when one key may hold a large share of all rows.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task.  The operators here cut a
key into time cells: rows are numbered inside (key, cell), the cells of a key are summed up in order,
and the running total of the earlier cells is joined back.  A key is then spread over as many tasks
as it has cells, and only one summary row per cell, at most 86,400 a day, ever meets the others of its
key.  For spans of years the totals can be summed up in blocks of cells first, and then over the blocks.

A burst may still put a large share of the rows into one cell, even into one millisecond of one key.  A sketch finds
such cells, and a small sample of their rows gives splitters over all ``order`` columns; each piece between two
splitters is then counted like a cell of its own.  Cells and pieces are pure functions of the row, so a
lost executor recomputes the same ones; rows that are equal in all of ``order`` stay in one piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators.lookup import hot_keys, may_crowd

#: A cell is a second, so a burst is split too; a block is an hour of cells.
CELL_MS = 1_000
CELLS_PER_BLOCK = 3_600
CELL = "_cell"
_BLOCK = "_block"
_LOCAL = "_local"
_EARLIER = "_earlier"
_PIECE = "_piece"
#: A crowded cell is cut into pieces of about one in so many of all rows, by every so manieth row of a sample.
PIECES, SAMPLED = 256, 16


def _floor_div(column: str, size: int) -> Column:
    # div alone rounds towards zero, which would make the cell around 0 twice as wide
    return F.expr(f"(`{column}` - pmod(`{column}`, {size})) div {size}")


def with_cell(df: DataFrame, ts: str, cell_ms: int = CELL_MS) -> DataFrame:
    """Add ``CELL``, the number of the time cell of ``ts``."""
    return df.withColumn(CELL, _floor_div(ts, cell_ms))


def _before(column: str, window: W) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def crowded_cells(cells: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the few (key, cell) with a large share of the rows: the ascending splitters that cut them into pieces.

    A sketch finds them; of their rows about ``PIECES * SAMPLED`` are sampled by digest, whatever the size of the table.
    """
    digest = F.xxhash64(*keys, CELL)
    crowded = hot_keys(cells.select(*keys, CELL), digest)
    chance = F.shiftrightunsigned(F.xxhash64(*order, F.lit("sample")), 11) * F.lit(2.0**-53)
    drawn = cells.select(*keys, CELL, F.struct(*order).alias("_at"), digest.alias("item"), chance.alias("_chance")).join(F.broadcast(crowded), "item")
    sample = drawn.where(F.col("_chance") < F.lit(float(PIECES * SAMPLED)) / F.col("total")).select(*keys, CELL, "_at").distinct()
    every = F.filter(F.sort_array(F.collect_list("_at")), lambda _, i: i % SAMPLED == SAMPLED - 1)
    return sample.groupBy(*keys, CELL).agg(every.alias("_splitters")).where(F.size("_splitters") > 0)


def _with_piece(cells: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``cells`` with ``_PIECE``, the number of splitters of its cell up to the row; 0 in cells that are not crowded."""
    # Fewer cells than lookup.HOT_SHARE, and about PIECES splitters in all.
    splitters = F.broadcast(crowded_cells(cells, keys, order))
    at = F.struct(*order)
    passed = F.size(F.filter("_splitters", lambda s: s <= at))
    return cells.join(splitters, [*keys, CELL], "left").withColumn(_PIECE, F.when(F.col("_splitters").isNull(), 0).otherwise(passed)).drop("_splitters")


def _earlier_totals(cells: DataFrame, keys: Sequence[str], flag: Column, cells_per_block: int | None) -> DataFrame:
    """``_earlier`` of each (key, cell, piece): the rows with ``flag`` in the cells and pieces of the key before it."""
    at = [CELL, _PIECE]
    per_cell = cells.groupBy(*keys, *at).agg(F.count_if(flag).alias(_LOCAL))
    if cells_per_block is None:
        return per_cell.select(*keys, *at, _before(_LOCAL, W.partitionBy(*keys).orderBy(*at)).alias(_EARLIER))
    per_cell = per_cell.withColumn(_BLOCK, _floor_div(CELL, cells_per_block))
    per_block = (
        per_cell.groupBy(*keys, _BLOCK)
        .agg(F.sum(_LOCAL).alias("_in_block"))
        .select(*keys, _BLOCK, _before("_in_block", W.partitionBy(*keys).orderBy(_BLOCK)).alias("_before_block"))
    )
    return (
        per_cell.withColumn("_before_cell", _before(_LOCAL, W.partitionBy(*keys, _BLOCK).orderBy(*at)))
        .join(per_block, [*keys, _BLOCK])
        .select(*keys, *at, (F.col("_before_cell") + F.col("_before_block")).alias(_EARLIER))
    )


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: Column,
    out: str,
    inclusive: bool = False,
    cell_ms: int = CELL_MS,
    cells_per_block: int | None = None,
    bursts: bool | None = None,
) -> DataFrame:
    """Add ``out``: how many rows with ``flag`` come before the row (or up to it) within ``keys``.

    ``order`` starts with a timestamp in milliseconds and should order the rows of a key totally.
    Keys and timestamps must not be null.  Without keys all rows are one sequence.  ``cells_per_block`` adds
    the level of blocks, at the price of two more shuffles of summary rows.  ``bursts=False`` spares the two
    passes over keys and order that look for crowded cells, where no cell can hold a large share of the rows; unless
    told, they are spared where the rows are few.
    """
    cells = with_cell(df, order[0], cell_ms)
    bursts = may_crowd(cells.select(*keys, *order)) if bursts is None else bursts
    cells = _with_piece(cells, keys, order) if bursts else cells.withColumn(_PIECE, F.lit(0))
    at = [*keys, CELL, _PIECE]
    here = W.partitionBy(*at).orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    inside = F.coalesce(F.sum(flag.cast("bigint")).over(here), F.lit(0))
    return (
        cells.withColumn(_LOCAL, inside)
        .join(_earlier_totals(cells, keys, flag, cells_per_block), at, "left")
        .withColumn(out, F.col(_LOCAL) + F.coalesce(_EARLIER, F.lit(0)))
        .drop(CELL, _PIECE, _LOCAL, _EARLIER)
    )


def row_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, cell_ms: int = CELL_MS
) -> DataFrame:
    """Add ``out``: position 1..n of the row within ``keys``, like ``row_number``."""
    return running_count(df, keys, order, F.lit(True), out, inclusive=True, cell_ms=cell_ms)


def dense_numbers(
    df: DataFrame,
    order: Sequence[str],
    out: str,
    base: int | Column = 0,
    flag: Column | None = None,
    cell_ms: int = CELL_MS,
    cells_per_block: int = CELLS_PER_BLOCK,
) -> DataFrame:
    """Add ``out``: ``base + 1, base + 2, ...`` over all rows with ``flag``, in ``order``, without gaps.

    Rows without the flag repeat the last number before them.  With the defaults the last level of totals
    holds a row per hour, 24 for a day, 88,000 for ten years, however many rows are numbered.
    """
    flag = F.lit(True) if flag is None else flag
    counted = running_count(df, [], order, flag, out, inclusive=True, cell_ms=cell_ms, cells_per_block=cells_per_block)
    return counted.withColumn(out, F.col(out) + base)
