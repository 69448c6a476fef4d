"""Column expressions; all of them are built-in Spark expressions."""

from footfall.functions.days import day_start_ms, next_day, previous_day
from footfall.functions.places import geohash6, ipv4_to_long
from footfall.functions.text import blank_to_null, is_not_blank

__all__ = [
    "blank_to_null",
    "day_start_ms",
    "geohash6",
    "ipv4_to_long",
    "is_not_blank",
    "next_day",
    "previous_day",
]
