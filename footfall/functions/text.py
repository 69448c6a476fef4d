"""Blank tests on text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_not_blank(column: Column | str) -> Column:
    """True when the text holds a non-whitespace character; null, '' and all-whitespace are blank.

    The class is Java's whitespace, so tabs and the ideographic space count; ``trim`` would only
    take plain spaces.
    """
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.rlike(r"\P{javaWhitespace}"), F.lit(False))


def blank_to_null(column: Column | str) -> Column:
    """'' becomes null; other text, spaces included, stays."""
    return F.nullif(F.col(column) if isinstance(column, str) else column, F.lit(""))
