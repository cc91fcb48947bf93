"""Code lists out of dictionary texts.

A dictionary holds blocks ``value <name> ... ;`` whose lines read ``code = 'label'``. Input everywhere is a frame
with ``source`` and ``text``, one row per dictionary; a block is located, split and cleaned inside one plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import strip, unquote

COUNTRY_BLOCK, PORT_BLOCK, STATE_BLOCK = "i94cntyl", "i94prtl", "i94addrl"


def block_text(text: Column, key: str) -> Column:
    """Text after the first ``key`` up to the next ``;``; null when there is no such block."""
    found = F.regexp_extract_all(text, F.lit(re.escape(key) + "([^;]*);"), F.lit(1))
    return F.try_element_at(found, F.lit(1))


def extract_block(dictionaries: DataFrame, key: str) -> DataFrame:
    """``source``, ``block`` for the dictionaries that hold the block."""
    return (dictionaries.select("source", block_text(F.col("text"), key).alias("block"))
            .where(F.col("block").isNotNull()))


def block_rows(blocks: DataFrame) -> DataFrame:
    """One row per assignment line: ``source``, ``pos`` (line number, from 1), ``code_part``, ``label_part``.

    The rest of the block's opening line is position 0 and no assignment; neither is a closing line without ``=``.
    """
    parts = F.split("line", "=")
    return (blocks.select("source", F.posexplode(F.split("block", "\n")).alias("pos", "line"))
            .where((F.col("pos") > 0) & F.contains(F.col("line"), F.lit("=")))
            .select("source", "pos", parts.getItem(0).alias("code_part"), parts.getItem(1).alias("label_part")))


def _code(tidy: bool) -> Column:
    """A quoted code; blanks inside its quotes stay unless ``tidy``."""
    code = unquote(strip(F.col("code_part")))
    return strip(code) if tidy else code


def extract_states(dictionaries: DataFrame, key: str = STATE_BLOCK) -> DataFrame:
    """``source``, ``pos``, ``state_code``, ``state_name``; stripped first, then quotes removed."""
    return block_rows(extract_block(dictionaries, key)).select(
        "source", "pos",
        _code(tidy=False).alias("state_code"),
        unquote(strip(F.col("label_part"))).alias("state_name"))


def extract_countries(dictionaries: DataFrame, key: str = COUNTRY_BLOCK, tidy: bool = False) -> DataFrame:
    """``source``, ``pos``, ``country_code``, ``country_name``; the first row's name is its first word only.

    Blanks inside a name's quotes stay, as stripping precedes the removal of quotes; ``tidy`` drops them too.
    """
    name = unquote(strip(F.col("label_part")))
    name = strip(name) if tidy else name
    return block_rows(extract_block(dictionaries, key)).select(
        "source", "pos",
        strip(F.col("code_part")).alias("country_code"),
        F.when(F.col("pos") == 1, F.substring_index(name, " ", 1)).otherwise(name).alias("country_name"))


def extract_ports(dictionaries: DataFrame, key: str = PORT_BLOCK, last_comma: bool = False,
                  tidy: bool = False) -> DataFrame:
    """``source``, ``pos``, ``port_code``, ``port_name``, ``state_code``.

    The label reads ``name, state``. The name ends at the first comma and the state is the first word after it, or
    empty without a comma. With ``last_comma`` the label is cut at its last comma instead, which keeps the state
    of names that hold commas themselves. ``tidy`` drops blanks inside a code's quotes.
    """
    label = F.col("label_part")
    if last_comma:
        name_piece = F.regexp_replace(label, ",[^,]*$", "")
        state_piece = F.when(F.contains(label, F.lit(",")), F.substring_index(label, ",", -1))
    else:
        name_piece = F.substring_index(label, ",", 1)
        state_piece = F.try_element_at(F.split(label, ","), F.lit(2))
    state = F.substring_index(unquote(strip(state_piece)), " ", 1)
    return block_rows(extract_block(dictionaries, key)).select(
        "source", "pos",
        _code(tidy).alias("port_code"),
        strip(unquote(strip(name_piece))).alias("port_name"),
        F.coalesce(strip(state), F.lit("")).alias("state_code"))


def extract_labels(dictionaries: DataFrame) -> DataFrame:
    """Every ``value <name>`` block at once: ``source``, ``format_name``, ``pos``, ``code``, ``label``."""
    opening = r"(?m)^\s*value\s+\$?(\w+)([^;]*);"
    blocks = dictionaries.select("source", F.explode(F.arrays_zip(
        F.regexp_extract_all("text", F.lit(opening), F.lit(1)).alias("name"),
        F.regexp_extract_all("text", F.lit(opening), F.lit(2)).alias("block"))).alias("b"))
    rows = block_rows(blocks.select(F.struct("source", "b.name").alias("source"), "b.block"))
    return rows.select(
        "source.source", F.col("source.name").alias("format_name"), "pos",
        unquote(strip(F.col("code_part"))).alias("code"), unquote(strip(F.col("label_part"))).alias("label"))
