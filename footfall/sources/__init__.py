"""Where data comes from and goes to."""

from footfall.sources.keyed_store import KeyedStore
from footfall.sources.ledger import Ledger
from footfall.sources.scans import read_areas_jdbc, read_csv, read_days, read_table
from footfall.sources.sinks import append_days, overwrite_day, overwrite_days, replace_table, write_bucketed
from footfall.sources.staging import Staging, staging_root

__all__ = [
    "KeyedStore",
    "Ledger",
    "Staging",
    "append_days",
    "overwrite_day",
    "overwrite_days",
    "read_areas_jdbc",
    "read_csv",
    "read_days",
    "read_table",
    "replace_table",
    "staging_root",
    "write_bucketed",
]
