"""Column expressions the native operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values: \x20 and \x09-\x0D, which part words.
BLANKS = " \t\n\x0b\f\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def words(text: Column) -> Column:
    """The runs of anything but the blanks; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _BLANK_RUN), lambda w: w != "")


def without_signs(text: Column, signs: str) -> Column:
    """The text without any of ``signs``; one plain search a sign, which is faster than looking every character up."""
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text
