"""Dimensions, facts, counts and checks on small inputs."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from landfall import sizing
from landfall.operators import counts, dims, facts, quality
from landfall.operators.clean import clean_arrivals
from landfall.schemas import FACT_ARRIVALS, STAGED_AIRPORTS, TABLES
from tests import samples
from tests.samples import arrival, raw


@pytest.fixture(scope="module")
def model(spark):
    arrivals = clean_arrivals(raw(
        spark,
        arrival(cicid=1.0), arrival(cicid=2.0, i94port="BBB", i94visa=1.0),
        arrival(cicid=3.0, i94port="CCC", arrdate=20485.0, i94mode=None),
        arrival(cicid=4.0, i94port="ZZZ"), arrival(cicid=5.0, i94cit=999.0, i94res=None),
        arrival(cicid=6.0, i94port="DDD", i94res=101.0), arrival(cicid=7.0, i94port="DDD", arrdate=20600.0))).cache()
    country, states = dims.dim_country(samples.countries(spark)), dims.dim_states(samples.states(spark))
    ports = dims.dim_ports(samples.ports(spark), states)
    modes, visas = dims.dim_modes(arrivals), dims.dim_visas(arrivals)
    lookups = facts.Lookups(country, ports, modes, visas)
    fact = facts.key_facts(facts.fact_rows(arrivals, lookups))
    return {"arrivals": arrivals, "country": country, "states": states, "ports": ports, "modes": modes,
            "visas": visas, "time": dims.dim_time(arrivals), "lookups": lookups, "fact": fact,
            "demographics": facts.fact_demographics(samples.demographics(spark), ports)}


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def test_ports_keep_their_state_or_none(model):
    assert tuples(model["ports"]) == [
        (1, 1, "AAA", "PORTLAND"), (2, 2, "BBB", "PORTLAND"), (3, None, "CCC", "LONDON"), (4, 2, "DDD", "SALEM")]


def test_label_dimensions(model):
    assert tuples(model["modes"]) == [(1, "Air"), (2, "Not reported")]
    assert tuples(model["visas"]) == [(1, "Business"), (2, "Pleasure")]


def test_new_labels_and_days_come_after_known_ones(spark, model):
    later = clean_arrivals(raw(spark, arrival(i94mode=2.0, arrdate=20454.0, depdate=20700.0), arrival(i94mode=1.0)))
    assert tuples(dims.dim_modes(later, model["modes"])) == [(1, "Air"), (2, "Not reported"), (3, "Sea")]
    days = dims.dim_time(later, model["time"])
    assert days.count() == model["time"].count() + 1 == days.select("ts").distinct().count()


def test_time_covers_arrivals_and_departures(model):
    assert tuples(model["time"]) == [(20454, 2016, 1, 1), (20460, 2016, 1, 7), (20485, 2016, 2, 1),
                                     (20600, 2016, 5, 26)]


def test_airports(spark):
    rows = [("1", "large", "A", 10, "NA", "US", "US-ME", "m", "g", "i", "l", "1, 2"),
            ("2", "small", "B", None, "NA", "US", "US-XX", "m", "g", "i", "l", "1, 2"),
            ("3", "small", "C", 10, "NA", "CA", "US-ME", "m", "g", "i", "l", "1, 2"),
            ("4", "small", "D", 10, "NA", "US", "USME", "m", "g", "i", "l", "1, 2"),
            ("5", None, "E", 10, "NA", "US", "US-OR", "m", "g", "i", "l", "1, 2"),
            ("6", "small", "F", 10, "NA", "US", None, "m", "g", "i", "l", "1, 2")]
    from decimal import Decimal
    staged = spark.createDataFrame(
        [(*r[:3], None if r[3] is None else Decimal(r[3]), *r[4:]) for r in rows], STAGED_AIRPORTS)
    states = dims.dim_states(samples.states(spark))
    types = dims.dim_airport_types(staged)
    assert types.count() == 3
    found = dims.dim_airports(staged, types, states)
    assert tuples(found, "airport_id", "airport_name", "state_id", "elevation_ft") == [(1, "A", 1, 10)]
    assert found.dtypes == [(f.name, f.dataType.simpleString()) for f in TABLES["dim_airports"]]


def test_facts_and_rejects_account_for_every_arrival(model):
    assert model["fact"].columns == list(FACT_ARRIVALS)
    assert tuples(model["fact"], "immigration_id", "cicid") == [(1, 1.0), (2, 2.0), (3, 6.0), (4, 3.0), (5, 7.0)]
    rejects = facts.fact_rejects(model["arrivals"], model["lookups"])
    assert tuples(rejects, "missing", "arrivals") == [("citizenship,residence", 1), ("port", 1)]


def test_resolution_is_the_same_without_broadcasts(model, monkeypatch):
    spark = model["arrivals"].sparkSession
    ports = spark.createDataFrame(model["ports"].collect(), TABLES["dim_ports"])
    lookups = facts.Lookups(model["country"], ports, model["modes"], model["visas"])
    with_hints = facts.fact_rows(model["arrivals"], lookups)
    assert with_hints._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 5
    monkeypatch.setattr(sizing, "SMALL_ROWS", 4)
    monkeypatch.setattr(facts, "small_side", lambda df, rows=None: sizing.small_side(df, 10 ** 9 if rows is None
                                                                                     else rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        without = facts.fact_rows(model["arrivals"], lookups)
        plan = without._jdf.queryExecution().executedPlan().toString()
        # The label dimensions stay broadcast: no input can give them more than four rows.
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 3
        assert tuples(without, "cicid") == tuples(with_hints, "cicid")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_demographics_meet_all_namesakes_unless_told_otherwise(spark, model):
    assert tuples(model["demographics"], "city_id", "race") == [
        (1, "Asian"), (1, "White"), (2, "Asian"), (2, "White"), (4, "White")]
    strict = facts.fact_demographics(samples.demographics(spark), model["ports"], model["states"])
    assert tuples(strict, "city_id", "race") == [(2, "Asian"), (2, "White"), (4, "White")]


def test_counting_questions(model):
    fact, time = model["fact"], model["time"]
    q = counts.by_port_and_state(fact, time, model["ports"], model["states"], 2016, (1, 2, 3))
    assert [tuple(r) for r in q.collect()] == [("PORTLAND", "MAINE", 1), ("PORTLAND", "OREGON", 1),
                                               ("SALEM", "OREGON", 1)]
    q = counts.by_country(fact, time, model["country"], 2016, (1, 2, 3))
    assert [tuple(r) for r in q.collect()] == [("ANDORRA", 3), ("ALBANIA", 1)]
    assert counts.by_country(fact, time, model["country"], 2016, (1, 2, 3), limit=1).count() == 1
    q = counts.by_purpose(fact, time, model["visas"], 2016, (1,))
    assert [tuple(r) for r in q.collect()] == [("Pleasure", 2), ("Business", 1)]
    q = counts.beside_population(fact, time, model["ports"], model["demographics"], 2016, (1, 2, 3))
    assert [tuple(r) for r in q.collect()] == [("PORTLAND", 600, 2, 1), ("PORTLAND", 600, 2, 1), ("SALEM", 160, 1, 1)]


def test_pair_counts_equal_the_plain_join(model):
    fact, demographics = model["fact"], model["demographics"]
    plain = (fact.join(demographics, F.col("port_id") == F.col("city_id")).groupBy("port_id", "total_population")
             .count())
    ours = counts.beside_population(fact, model["time"], model["ports"], demographics, 2016, range(1, 13))
    assert sorted(r["count"] for r in plain.collect()) == sorted(r["immigrant_count"] for r in ours.collect())


@pytest.mark.parametrize("by", [["year", "month"], ["citizenship", "visa"], ["residence"], ["state"], ["port", "mode"],
                                ["state", "port", "year"]])
def test_counts_by_any_slice_add_up(model, by):
    found = counts.count_by(model["fact"], by, country=model["country"], ports=model["ports"], states=model["states"],
                            modes=model["modes"], visas=model["visas"])
    assert found.columns == [*by, "arrivals"]
    assert found.agg(F.sum("arrivals")).first()[0] == model["fact"].count()


def test_count_by_rejects_unknown_slices(model):
    with pytest.raises(ValueError):
        counts.count_by(model["fact"], ["airline"])
    with pytest.raises(ValueError):
        counts.count_by(model["fact"], ["mode"])


def quality_tables(model):
    return {"dim_country": model["country"], "dim_states": model["states"], "dim_ports": model["ports"],
            "dim_travelmodes": model["modes"], "dim_visacategories": model["visas"], "dim_time": model["time"],
            "fact_demographics": model["demographics"], "fact_immigration": model["fact"]}


def test_checks_run_to_the_end_then_raise(spark, model):
    tables = {**quality_tables(model), "dim_airports": spark.createDataFrame([], TABLES["dim_airports"]),
              "dim_airporttypes": spark.createDataFrame([(1, None)], TABLES["dim_airporttypes"])}
    checks = quality.dimension_checks() + quality.fact_checks(datetime.date(2016, 1, 1))
    assert len(checks) == 13
    report = quality.evaluate(checks, tables)
    failed = {r["check"]: r["message"] for r in report.where("NOT passed").collect()}
    assert failed == {
        "Check airports table row count": "Check airports table row count check failed. Expected > 0, actual 0",
        "Check airport types null count": "Check airport types null count check failed. Expected == 0, actual 1"}
    with pytest.raises(quality.QualityError, match="(?s)airports table row count.*airport types null count"):
        quality.enforce(report)
    quality.enforce(report.where("passed"))


def test_unique_report_lists_repeats(model):
    found = {(r["table_name"], r["column_name"]): (r["repeated_values"], r["repeated_rows"])
             for r in quality.unique_report(quality_tables(model)).collect()}
    assert found.pop(("dim_ports", "port_name")) == (1, 2)
    assert set(found.values()) == {(0, 0)} and ("fact_immigration", "immigration_id") in found


KEYS = [*range(1, 70_000), *range(10**12, 10**12 + 500)]


@pytest.mark.parametrize("few", [1000, 1])
def test_repeated_keys_are_found_by_their_buckets(spark, monkeypatch, few):
    monkeypatch.setattr(quality, "FEW_BUCKETS", few)
    repeated = [5, 5, 6, 32_768, 32_769, 10**12, -3, -3, None, None]
    facts = spark.createDataFrame([(k,) for k in KEYS + repeated], "immigration_id bigint")
    assert quality.numbered_key("fact_immigration") == "immigration_id"
    assert quality.crowded(facts, "immigration_id").count() == 4
    found = quality.unique_report({"fact_immigration": facts}).collect()
    # 5 is there three times, and 6, 32768, 32769, the large one and -3 twice.
    assert [tuple(r) for r in found] == [("fact_immigration", "immigration_id", 6, 13)]
    empty = quality.unique_report({"fact_immigration": facts.limit(0)}).first()
    assert empty["repeated_values"] == 0 and empty["repeated_rows"] == 0


def test_keys_that_do_not_repeat_are_not_grouped(spark):
    facts = spark.createDataFrame([(k,) for k in KEYS], "immigration_id bigint")
    report = quality.unique_report({"fact_immigration": facts})
    assert tuple(report.first())[2:] == (0, 0)
    # The facts are gone from the plan: what is left is grouped over no rows.
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "LogicalRDD" not in plan
    assert [table for table in TABLES if quality.numbered_key(table) is None] == ["dim_time"]


@pytest.mark.parametrize("small", [True, False])
def test_orphan_report(model, monkeypatch, small):
    if not small:
        monkeypatch.setattr(sizing, "SMALL_ROWS", 0)
    tables = quality_tables(model)
    assert {r["orphans"] for r in quality.orphan_report(tables).collect()} == {0}
    tables["dim_ports"] = model["ports"].where("port_code <> 'AAA'")
    found = {(r["table_name"], r["column_name"]): r["orphans"] for r in quality.orphan_report(tables).collect()}
    assert found[("fact_immigration", "port_id")] == 1 and found[("fact_demographics", "city_id")] == 2


def test_null_and_length_report(spark, model):
    tables = {"dim_states": spark.createDataFrame([(1, "ABC", None)], TABLES["dim_states"])}
    found = {(r["column_name"], r["rule"]): r["violations"] for r in quality.null_and_length_report(tables).collect()}
    assert found == {("state_code", "not null"): 0, ("state_name", "not null"): 1, ("state_code", "length <= 2"): 1,
                     ("state_name", "length <= 100"): 0}
