"""Counting questions over the arrival facts.

All of them group the facts by foreign key first and join the (now few) groups to their dimensions afterwards;
dimension keys are unique, so the result is the same and the joins see groups instead of arrivals.

``rows`` names the dimensions whose sizes the caller knows (``time``, ``modes``, ``visas``); others are counted first.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import sas_date
from landfall.sizing import small_side


def _month_start(year: int, month: int) -> datetime.date:
    return datetime.date(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)


Sizes = Mapping[str, int]


def in_period(facts: DataFrame, time: DataFrame, year: int, months: Sequence[int], rows: Sizes = {}) -> DataFrame:
    """Facts that arrived on a listed day of the given months.

    The month bounds are also stated on ``arrival_date`` itself. That adds nothing to the result, but it lets the
    scan skip the partitions of other days before the join.
    """
    if not months:
        raise ValueError("name at least one month")
    bounds = [(F.col("arrival_date") >= F.lit(_month_start(year, m)))
              & (F.col("arrival_date") < F.lit(_month_start(year, m + 1))) for m in months]
    inside: Column = bounds[0]
    for bound in bounds[1:]:
        inside = inside | bound
    days = (time.where((F.col("year") == year) & F.col("month").isin(*months))
            .select(sas_date(F.col("ts")).alias("arrival_date")))
    return facts.where(inside).join(small_side(days, rows.get("time")), "arrival_date")


def _ranked(counted: DataFrame, measure: str, ties: Sequence[str], limit: int | None) -> DataFrame:
    ordered = counted.orderBy(F.desc(measure), *ties)
    return ordered if limit is None else ordered.limit(limit)


def by_port_and_state(facts: DataFrame, time: DataFrame, ports: DataFrame, states: DataFrame, year: int,
                      months: Sequence[int], limit: int | None = None, rows: Sizes = {}) -> DataFrame:
    """Arrivals per port and state; ports without a state are not listed."""
    counted = (in_period(facts, time, year, months, rows).groupBy("port_id")
               .agg(F.count(F.lit(1)).alias("immigrant_count")))
    named = (counted.join(ports.select("port_id", "state_id", "port_name"), "port_id")
             .join(states.select("state_id", "state_name"), "state_id"))
    return _ranked(named.select("port_name", "state_name", "immigrant_count", "port_id"), "immigrant_count",
                   ["port_name", "port_id"], limit).drop("port_id")


def by_country(facts: DataFrame, time: DataFrame, country: DataFrame, year: int, months: Sequence[int],
               limit: int | None = None, rows: Sizes = {}) -> DataFrame:
    """Arrivals per country of residence."""
    counted = (in_period(facts, time, year, months, rows).groupBy("residence_country_id")
               .agg(F.count(F.lit(1)).alias("count")))
    named = counted.join(country.select(F.col("country_id").alias("residence_country_id"), "country_name"),
                         "residence_country_id")
    return _ranked(named, "count", ["country_name", "residence_country_id"], limit).select("country_name", "count")


def by_purpose(facts: DataFrame, time: DataFrame, visas: DataFrame, year: int, months: Sequence[int],
               limit: int | None = None, rows: Sizes = {}) -> DataFrame:
    """Arrivals per visa category."""
    counted = (in_period(facts, time, year, months, rows).groupBy("visa_category_id")
               .agg(F.count(F.lit(1)).alias("count")))
    named = counted.join(small_side(visas, rows.get("visas")), "visa_category_id")
    return _ranked(named.select("name", "count"), "count", ["name"], limit)


def beside_population(facts: DataFrame, time: DataFrame, ports: DataFrame, demographics: DataFrame, year: int,
                      months: Sequence[int], limit: int | None = None, rows: Sizes = {}) -> DataFrame:
    """Arrivals beside total population, per port and population figure.

    ``immigrant_count`` counts every pairing of an arrival with a demographics row of its port (a city has one row
    per race); ``arrivals`` counts each arrival once. Both sides are counted before they meet, so the pairs
    themselves are never built.
    """
    arrived = (in_period(facts, time, year, months, rows).groupBy("port_id")
               .agg(F.count(F.lit(1)).alias("arrivals")))
    figures = (demographics.groupBy(F.col("city_id").alias("port_id"), "total_population")
               .agg(F.count(F.lit(1)).alias("figures")))
    paired = (arrived.join(figures, "port_id").join(ports.select("port_id", "port_name"), "port_id")
              .withColumn("immigrant_count", F.col("arrivals") * F.col("figures")))
    return _ranked(paired.select("port_name", "total_population", "immigrant_count", "arrivals", "port_id"),
                   "immigrant_count", ["port_name", "port_id", "total_population"], limit).drop("port_id")


def count_by(facts: DataFrame, by: Sequence[str], *, country: DataFrame | None = None,
             ports: DataFrame | None = None, states: DataFrame | None = None, modes: DataFrame | None = None,
             visas: DataFrame | None = None, rows: Sizes = {}) -> DataFrame:
    """Arrivals by any of ``year, month, citizenship, residence, port, state, mode, visa`` (column ``arrivals``).

    Arrivals whose port has no state count under a null state.
    """
    def need(frame: DataFrame | None, what: str) -> DataFrame:
        if frame is None:
            raise ValueError(f"counting by {what} needs its dimension")
        return frame

    keys = {"citizenship": "citizenship_country_id", "residence": "residence_country_id", "port": "port_id",
            "state": "port_id", "mode": "travel_mode_id", "visa": "visa_category_id"}
    unknown = [b for b in by if b not in keys and b not in ("year", "month")]
    if unknown:
        raise ValueError(f"cannot count by {', '.join(unknown)}")
    parts = {"year": F.year("arrival_date").alias("year"), "month": F.month("arrival_date").alias("month")}
    group = list(dict.fromkeys(keys.get(b, b) for b in by))
    out = (facts.select(*[parts.get(g, F.col(g)) for g in group]).groupBy(*group)
           .agg(F.count(F.lit(1)).alias("arrivals")))

    for b in by:
        if b in ("citizenship", "residence"):
            out = out.join(need(country, b).select(F.col("country_id").alias(keys[b]), F.col("country_name").alias(b)),
                           keys[b])
        elif b == "mode":
            out = out.join(small_side(need(modes, b).select("travel_mode_id", "mode"), rows.get("modes")),
                           "travel_mode_id")
        elif b == "visa":
            out = out.join(small_side(need(visas, b).select("visa_category_id", F.col("name").alias("visa")), rows.get("visas")),
                           "visa_category_id")
    if "port" in by or "state" in by:
        out = out.join(need(ports, "port").select("port_id", "state_id", F.col("port_name").alias("port")), "port_id")
    if "state" in by:
        out = out.join(need(states, "state").select("state_id", F.col("state_name").alias("state")), "state_id",
                       "left")
    # Names need not be unique: groups keep their keys apart until the counts are summed.
    grain = [k for b, k in (("citizenship", "citizenship_country_id"), ("residence", "residence_country_id"),
                            ("port", "port_id"), ("state", "state_id")) if b in by]
    return (out.groupBy(*by, *grain).agg(F.sum("arrivals").alias("arrivals")).select(*by, "arrivals"))
