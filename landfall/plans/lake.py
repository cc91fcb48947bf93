"""From delivered files to inputs: code lists out of dictionaries, raw arrivals into the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.operators.clean import clean_arrivals
from landfall.operators.labels import extract_countries, extract_ports, extract_states
from landfall.sinks import write_code_list, write_lake


def one_per_code(entries: DataFrame, code: str) -> DataFrame:
    """Of the entries of a code the first of the last dictionary by name: later editions are named later."""
    others = [c for c in entries.columns if c not in ("source", "pos", code)]
    content = F.struct(*others).alias("e")
    latest = F.max_by(content, F.struct("source", -F.col("pos")))
    return entries.groupBy(code).agg(latest.alias("e")).select(code, *[f"e.{c}" for c in others])


def repeated_codes(entries: DataFrame, code: str) -> DataFrame:
    """Codes with more than one entry, and how many of them :func:`one_per_code` leaves out."""
    return entries.groupBy(code).agg((F.count(F.lit(1)) - 1).alias("left_out")).where("left_out > 0")


def code_lists(dictionaries: DataFrame) -> dict[str, DataFrame]:
    """The three staged code lists of a set of dictionaries, each code once."""
    return {
        "countries": one_per_code(extract_countries(dictionaries), "country_code"),
        "states": one_per_code(extract_states(dictionaries), "state_code"),
        "ports": one_per_code(extract_ports(dictionaries), "port_code"),
    }


def extract_code_lists(dictionaries: DataFrame, folder: str) -> dict[str, str]:
    """Write the code lists as CSV below ``folder`` and return their paths."""
    paths = {}
    for name, rows in code_lists(dictionaries).items():
        paths[name] = f"{folder}/{name}"
        write_code_list(rows, paths[name])
    return paths


def load_lake(raw: DataFrame, lake: str, delivery: str) -> None:
    """Clean raw arrivals and add them to the lake as ``delivery``, in place of what that delivery held before."""
    write_lake(clean_arrivals(raw), lake, delivery)
