from __future__ import annotations

import datetime
import math

from pyspark.sql import functions as F

from landfall.functions import (day_number, decode_mode, decode_visa, region_state, sas_date, sas_day, strip, to_int,
                                unquote)

D = datetime.date


def values(spark, kind, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_sas_date(spark):
    days = [0.0, 20454.0, 20454.7, -0.5, -1.0, None, math.nan, 1e12, -1e12, 2936549.0]
    assert values(spark, "double", days, sas_date(F.col("x"))) == [
        D(1960, 1, 1), D(2016, 1, 1), D(2016, 1, 1), D(1959, 12, 31), D(1959, 12, 31), None, None, None, None,
        D(9999, 12, 31)]


def test_sas_date_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, "double", [20454.0], sas_date(F.col("x"))) == [D(2016, 1, 1)]
        assert values(spark, "double", [20454.0], sas_day(F.col("x"))) == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sas_day_of_a_missing_day_is_null(spark):
    assert values(spark, "double", [20483.9, None, math.nan], sas_day(F.col("x"))) == [30, None, None]


def test_day_number_inverts_sas_date(spark):
    days = [0.0, 1.0, -400.0, 20454.0]
    assert values(spark, "double", days, day_number(sas_date(F.col("x")))) == [0, 1, -400, 20454]


def test_decodes(spark):
    codes = [1.0, 2.0, 3.0, 9.0, 1.5, None, math.nan]
    assert values(spark, "double", codes, decode_mode(F.col("x"))) == [
        "Air", "Sea", "Land", "Not reported", "Not reported", "Not reported", "Not reported"]
    assert values(spark, "double", codes, decode_visa(F.col("x"))) == [
        "Business", "Pleasure", "Student", "Others", "Others", "Others", "Others"]


def test_to_int_truncates_and_never_raises(spark):
    assert values(spark, "double", [37.9, -37.9, None, math.nan, 3e9], to_int(F.col("x"))) == [
        37, -37, None, None, None]


def test_text(spark):
    assert values(spark, "string", ["\t 'CP ' \r\n", None], strip(F.col("x"))) == ["'CP '", None]
    assert values(spark, "string", ["'INT''L'", ""], unquote(F.col("x"))) == ["INTL", ""]
    assert values(spark, "string", ["US-CA", "US-XX-1", "USCA", None], region_state(F.col("x"))) == [
        "CA", "XX", "", None]
