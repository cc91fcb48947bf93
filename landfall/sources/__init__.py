"""Readers: text dictionaries, staged CSV/Parquet files, raw arrivals and the date-partitioned lake."""

from landfall.sources.arrivals import ROW_TAG, read_day, read_days, scan_arrivals, tag_rows
from landfall.sources.dictionary import read_dictionaries
from landfall.sources.staging import CORRUPT, cast_losses, cast_staged, stage

__all__ = ["CORRUPT", "ROW_TAG", "cast_losses", "cast_staged", "read_day", "read_days", "read_dictionaries",
           "scan_arrivals", "stage", "tag_rows"]
