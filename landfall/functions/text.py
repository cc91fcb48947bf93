"""Text clean-up used by the code dictionaries and the region codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\v"


def strip(text: Column) -> Column:
    """Trim spaces, tabs and line breaks at both ends (plain ``trim`` removes spaces only)."""
    return F.trim(text, F.lit(BLANKS))


def unquote(text: Column) -> Column:
    """Remove every single quote."""
    return F.replace(text, F.lit("'"), F.lit(""))


def region_state(region: Column) -> Column:
    """State part of a ``country-state`` region code; empty when there is no dash."""
    return F.split_part(region, F.lit("-"), F.lit(2))
