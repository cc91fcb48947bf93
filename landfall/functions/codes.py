"""Decoding of coded categories and safe narrowing of numeric codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code lists of the arrival records.
VISA_LABELS = {1: "Business", 2: "Pleasure", 3: "Student"}
VISA_OTHER = "Others"
MODE_LABELS = {1: "Air", 2: "Sea", 3: "Land"}
MODE_OTHER = "Not reported"


def _decode(code: Column, labels: dict[int, str], other: str) -> Column:
    chain = reduce(lambda acc, kv: acc.when(code == kv[0], kv[1]), labels.items(), F)
    return chain.otherwise(other)


def decode_visa(code: Column) -> Column:
    return _decode(code, VISA_LABELS, VISA_OTHER)


def decode_mode(code: Column) -> Column:
    return _decode(code, MODE_LABELS, MODE_OTHER)


def to_int(number: Column) -> Column:
    """Truncate toward zero; null instead of an error for NaN and values that do not fit."""
    return number.try_cast("int")
