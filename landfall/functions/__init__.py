"""Scalar column functions; all of them are Spark built-ins, so they stay inside generated code."""

from landfall.functions.codes import MODE_LABELS, VISA_LABELS, decode_mode, decode_visa, to_int
from landfall.functions.dates import day_number, sas_date, sas_day
from landfall.functions.text import region_state, strip, unquote

__all__ = ["MODE_LABELS", "VISA_LABELS", "day_number", "decode_mode", "decode_visa", "region_state", "sas_date",
           "sas_day", "strip", "to_int", "unquote"]
