"""Raw arrivals -> cleaned arrivals: one projection of built-in expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import decode_mode, decode_visa, sas_date, sas_day, to_int
from landfall.schemas import LAKE_ARRIVALS


def clean_arrivals(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 20 lake columns in order, then any ``keep`` columns of the input unchanged.

    Rows without a usable arrival day get null dates and a null ``arrival_day``; they are kept.
    """
    made = {
        "year": to_int(F.col("i94yr")),
        "month": to_int(F.col("i94mon")),
        "arrival_day": sas_day(F.col("arrdate")),
        "arrival_date": sas_date(F.col("arrdate")),
        "departure_date": sas_date(F.col("depdate")),
        "i94cit": to_int(F.col("i94cit")),
        "i94res": to_int(F.col("i94res")),
        "i94bir": to_int(F.col("i94bir")),
        "biryear": to_int(F.col("biryear")),
        "travel_mode": decode_mode(F.col("i94mode")),
        "visa_category": decode_visa(F.col("i94visa")),
    }
    return raw.select(*[made.get(c, F.col(c)).alias(c) for c in LAKE_ARRIVALS.names], *keep)
