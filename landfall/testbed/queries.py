"""One query per operator over the test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schemas
from landfall.functions import decode_mode, decode_visa, region_state, sas_date, sas_day, to_int
from landfall.operators import counts, dims, facts, keys, labels, quality
from landfall.operators.clean import clean_arrivals
from landfall.plans import dimensions, lake, views
from landfall.plans import facts as fact_plans
from landfall.session import work_path
from landfall.sinks import lake as deliveries
from landfall.sinks import read_snapshot, write_code_list, write_lake, write_snapshot
from landfall.sources import cast_losses, cast_staged, read_day, read_dictionaries, scan_arrivals, stage
from landfall.sources.arrivals import read_lake
from landfall.sources.staging import text_schema
from landfall.testbed.adapter import Testbed
from landfall.testbed.star import COUNTED, star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

YEAR, MONTHS = 1995, (1, 2, 3)
FIRST_EVENT_DAY, LAST_EVENT_DAY = datetime.date(2024, 1, 1), datetime.date(2024, 1, 30)
SECOND_EVENT_DAY = datetime.date(2024, 1, 2)
ARRIVAL_DAY = datetime.date(1995, 3, 1)


def query(name: str | Query) -> Query | Callable[[Query], Query]:
    """Register a query under its function's name, or under ``name`` where that is an operator's."""
    if callable(name):
        QUERIES[name.__name__] = name
        return name

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function
    return register


# ---- sources ----

@query
def src_labels_text(spark, sf_dir):
    """Dictionaries written as text files, one per dictionary, and read back whole."""
    path = work_path(spark, "dictionaries")
    Testbed(spark, sf_dir).dictionaries().repartition("source").write.partitionBy("source").text(path)
    return read_dictionaries(spark, f"{path}/*").select("text")


@query
def src_arrivals_scan(spark, sf_dir):
    """Raw arrivals delivered as several files and read in one scan."""
    path = work_path(spark, "raw")
    Testbed(spark, sf_dir).raw_arrivals().write.parquet(path)
    return scan_arrivals(spark, path)


@query
def stage_csv(spark, sf_dir):
    path = work_path(spark, "airports")
    write_code_list(Testbed(spark, sf_dir).airports(), path)
    return stage(spark, path, schemas.STAGED_AIRPORTS)


@query
def stage_csv_delim(spark, sf_dir):
    path = work_path(spark, "demographics")
    write_code_list(Testbed(spark, sf_dir).demographics(), path, sep=";")
    return stage(spark, path, schemas.STAGED_DEMOGRAPHICS, sep=";")


@query
def stage_csv_multiline(spark, sf_dir):
    """Quoted names that go over two lines."""
    path = work_path(spark, "airports-multiline")
    airports = Testbed(spark, sf_dir).airports()
    write_code_list(airports.withColumn("name", F.concat("name", F.lit("\n"), "ident")), path)
    return stage(spark, path, schemas.STAGED_AIRPORTS, multiline=True)


def _untyped_demographics(bed: Testbed) -> DataFrame:
    """Demographics as text in which some numbers are missing, misspelt or too large for their type."""
    rows = bed.demographics()
    odd = (F.when(F.col("male_population") % 17 == 0, "n/a").when(F.col("male_population") % 19 == 0, "99999999999")
           .otherwise(F.col("male_population").cast("string")))
    return rows.select(*[(odd if c == "male_population" else F.col(c).cast("string")).alias(c) for c in rows.columns])


@query
def stage_cast(spark, sf_dir):
    return cast_staged(_untyped_demographics(Testbed(spark, sf_dir)), schemas.STAGED_DEMOGRAPHICS)


@query
def stage_cast_losses(spark, sf_dir):
    return cast_losses(_untyped_demographics(Testbed(spark, sf_dir)), schemas.STAGED_DEMOGRAPHICS)


@query
def stage_text_columns(spark, sf_dir):
    """All-text staging keeps what typed staging would turn into null."""
    path = work_path(spark, "demographics-text")
    write_code_list(_untyped_demographics(Testbed(spark, sf_dir)), path, sep=";")
    return stage(spark, path, text_schema(schemas.STAGED_DEMOGRAPHICS), sep=";")


_LAKES: dict[tuple[str, str], str] = {}


def _event_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake of the events, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        path = work_path(spark, "lake")
        lake.load_lake(Testbed(spark, sf_dir).event_arrivals(), path, "events")
        _LAKES[key] = path
    return _LAKES[key]


@query
def stage_day_partition(spark, sf_dir):
    return read_day(spark, _event_lake(spark, sf_dir), SECOND_EVENT_DAY)


# ---- sinks ----

@query
def sink_csv_roundtrip(spark, sf_dir):
    """Code lists with inner blanks and empty fields survive the file."""
    path = work_path(spark, "ports")
    write_code_list(lake.code_lists(Testbed(spark, sf_dir).dictionaries())["ports"], path)
    return dimensions.staged_ports(stage(spark, path, schemas.STAGED_PORTS))


@query
def sink_partitioned(spark, sf_dir):
    """The lake written twice: the second write replaces the days of the first."""
    path, cleaned = work_path(spark, "lake"), clean_arrivals(Testbed(spark, sf_dir).event_arrivals())
    for _ in range(2):
        write_lake(cleaned, path, "events")
    return read_lake(spark, path)


@query
def sink_two_deliveries(spark, sf_dir):
    """Two deliveries that each bring half of every day's arrivals, the second one twice."""
    path, cleaned = work_path(spark, "lake"), clean_arrivals(Testbed(spark, sf_dir).event_arrivals())
    odd = F.col("cicid") % 2 == 1
    for name, half in (("even", ~odd), ("odd", odd), ("odd", odd)):
        write_lake(cleaned.where(half), path, name)
    return read_lake(spark, path)


@query
def sink_merged_deliveries(spark, sf_dir):
    """Three deliveries of every day, one of them wrong at first, merged, and the wrong one brought again."""
    path, cleaned = work_path(spark, "lake"), clean_arrivals(Testbed(spark, sf_dir).event_arrivals())
    third = F.pmod(F.col("cicid"), F.lit(3))
    for name, part in (("a", 0), ("b", 0), ("c", 2)):
        write_lake(cleaned.where(third == part), path, name)
    deliveries.compact(spark, path)
    deliveries.retire(spark, path)
    write_lake(cleaned.where(third == 1), path, "b")
    return read_lake(spark, path)


@query
def load_full_refresh(spark, sf_dir):
    """A country table refreshed with a longer list: known members keep their keys."""
    bed, path = Testbed(spark, sf_dir), work_path(spark, "refresh")
    schema = schemas.TABLES["dim_country"]
    listed = bed.countries()
    write_snapshot(dims.dim_country(listed), path)
    regions = bed.states().select(F.concat(F.lit("R"), "state_code").alias("country_code"),
                                  F.col("state_name").alias("country_name"))
    write_snapshot(dims.dim_country(listed.unionByName(regions), read_snapshot(spark, path, schema)), path)
    return read_snapshot(spark, path, schema)


def _event_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse with its static dimensions loaded through the dimension job."""
    bed, root = Testbed(spark, sf_dir), work_path(spark, "warehouse")
    files = dimensions.DimensionFiles(*[f"{root}/files/{name}" for name in (
        "countries", "states", "ports", "airports", "demographics")])
    for rows, path in ((bed.countries(), files.countries), (bed.states(), files.states),
                       (bed.ports(), files.ports), (bed.airports(), files.airports)):
        write_code_list(rows, path)
    write_code_list(bed.demographics(), files.demographics, sep=";")
    dimensions.build_dimensions(spark, files, root)
    return root


@query
def load_append_day(spark, sf_dir):
    """Two daily loads, the first repeated: the repeat changes nothing. A day's facts are numbered in order."""
    path, warehouse = _event_lake(spark, sf_dir), _event_warehouse(spark, sf_dir)
    for day in (FIRST_EVENT_DAY, SECOND_EVENT_DAY, FIRST_EVENT_DAY):
        fact_plans.run_day(spark, path, warehouse, day, ordered=True)
    return fact_plans.read_facts(spark, warehouse)


@query
def load_backfill(spark, sf_dir):
    """Every day of the lake, in one job for all days that follow each other. A day's facts are numbered in order."""
    path, warehouse = _event_lake(spark, sf_dir), _event_warehouse(spark, sf_dir)
    for first, last in fact_plans.stretches(spark, path):
        fact_plans.run_range(spark, path, warehouse, first, last, ordered=True)
    return fact_plans.read_facts(spark, warehouse)


# ---- dictionaries ----

@query
def labels_block(spark, sf_dir):
    return labels.extract_block(Testbed(spark, sf_dir).dictionaries(), labels.PORT_BLOCK)


@query
def labels_rows(spark, sf_dir):
    return labels.block_rows(labels.extract_block(Testbed(spark, sf_dir).dictionaries(), labels.COUNTRY_BLOCK))


@query
def labels_states(spark, sf_dir):
    return labels.extract_states(Testbed(spark, sf_dir).dictionaries())


@query
def labels_ports(spark, sf_dir):
    return labels.extract_ports(Testbed(spark, sf_dir).dictionaries())


@query
def labels_ports_last_comma(spark, sf_dir):
    return labels.extract_ports(Testbed(spark, sf_dir).dictionaries(), last_comma=True)


@query
def labels_countries(spark, sf_dir):
    return labels.extract_countries(Testbed(spark, sf_dir).dictionaries())


@query
def labels_all_formats(spark, sf_dir):
    return labels.extract_labels(Testbed(spark, sf_dir).dictionaries())


# ---- scalar functions and cleaning ----

@query("sas_date")
def sas_dates(spark, sf_dir):
    """Whole, fractional, negative and missing day numbers."""
    days = (F.col("l_linenumber") * 1000 - F.col("l_quantity") * 100 + F.col("l_discount") * 10)
    return Testbed(spark, sf_dir).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        sas_date(F.when(F.col("l_returnflag") != "N", days)).alias("day_date"))


@query("sas_day")
def sas_days(spark, sf_dir):
    raw = Testbed(spark, sf_dir).raw_arrivals(["cicid", "arrdate", "depdate"])
    return raw.select("cicid", sas_day(F.col("arrdate")).alias("arrival_day"),
                      sas_day(F.col("depdate")).alias("departure_day"))


@query
def cast_codes(spark, sf_dir):
    """Fractions truncate toward zero; NaN and values out of range become null."""
    balance = F.col("c_acctbal")
    return Testbed(spark, sf_dir).table("customer").select(
        "c_custkey", to_int(balance).alias("whole"),
        to_int(F.when(F.col("c_custkey") % 3 == 0, float("nan")).otherwise(balance)).alias("no_nan"),
        to_int(balance * 1e6).alias("in_range"))


@query("decode_visa")
def decode_visas(spark, sf_dir):
    raw = Testbed(spark, sf_dir).raw_arrivals(["i94visa"])
    return raw.groupBy("i94visa", decode_visa(F.col("i94visa")).alias("visa_category")).agg(
        F.count(F.lit(1)).alias("arrivals"))


@query("decode_mode")
def decode_modes(spark, sf_dir):
    raw = Testbed(spark, sf_dir).raw_arrivals(["i94mode"])
    return raw.groupBy("i94mode", decode_mode(F.col("i94mode")).alias("travel_mode")).agg(
        F.count(F.lit(1)).alias("arrivals"))


@query("clean_arrivals")
def clean_arrival_rows(spark, sf_dir):
    return clean_arrivals(Testbed(spark, sf_dir).raw_arrivals())


@query
def split_region(spark, sf_dir):
    return Testbed(spark, sf_dir).airports().select("ident", region_state(F.col("iso_region")).alias("state_code"))


# ---- keys and dimensions ----

@query
def key_dim(spark, sf_dir):
    """Suppliers numbered by name, the way chosen by the table's size."""
    suppliers = Testbed(spark, sf_dir).table("supplier").select("s_suppkey", "s_name")
    return keys.assign_keys(suppliers, ["s_name", "s_suppkey"], "supplier_id")


@query
def key_fact(spark, sf_dir):
    """Line items numbered without a task that sees them all."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return keys.number_large(Testbed(spark, sf_dir).table("lineitem").select(*order), order, "line_id")


@query
def dim_country(spark, sf_dir):
    return dims.dim_country(Testbed(spark, sf_dir).countries())


@query
def dim_states(spark, sf_dir):
    return dims.dim_states(Testbed(spark, sf_dir).states())


@query
def dim_ports(spark, sf_dir):
    return dims.dim_ports(Testbed(spark, sf_dir).ports(), star(spark, sf_dir).states)


@query
def dim_modes(spark, sf_dir):
    return dims.dim_modes(star(spark, sf_dir).cleaned(["i94mode"]))


@query
def dim_visas(spark, sf_dir):
    return dims.dim_visas(star(spark, sf_dir).cleaned(["i94visa"]))


@query
def dim_airport_types(spark, sf_dir):
    return dims.dim_airport_types(Testbed(spark, sf_dir).airports())


@query
def dim_time(spark, sf_dir):
    return dims.dim_time(star(spark, sf_dir).cleaned(["arrdate", "depdate"]))


@query
def dim_airports(spark, sf_dir):
    s = star(spark, sf_dir)
    return dims.dim_airports(s.bed.airports(tagged=True), s.types, s.states,
                             type_rows=s.rows["types"], state_rows=s.rows["states"])


@query
def dim_new_members(spark, sf_dir):
    """Modes, visas and days of the events, then of the line items: who was there keeps the key."""
    s = star(spark, sf_dir)
    first, then = clean_arrivals(s.bed.event_arrivals()), s.cleaned(["i94mode", "i94visa", "arrdate", "depdate"])
    parts = []
    for name, load, label, key in (
            ("mode", dims.dim_modes, "mode", "travel_mode_id"), ("visa", dims.dim_visas, "name", "visa_category_id")):
        members = load(then, load(first))
        parts.append(members.select(F.lit(name).alias("dimension"), F.col(label).alias("member"),
                                    F.col(key).cast("bigint").alias("member_id")))
    days = dims.dim_time(then, dims.dim_time(first))
    parts.append(days.select(F.lit("time").alias("dimension"),
                             F.concat_ws("-", "year", "month", "day").alias("member"),
                             F.col("ts").cast("bigint").alias("member_id")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- facts ----

@query
def fact_arrivals(spark, sf_dir):
    return facts.key_facts(star(spark, sf_dir).fact(tagged=True))


@query
def fact_rejects(spark, sf_dir):
    s = star(spark, sf_dir)
    return facts.fact_rejects(s.cleaned(COUNTED), s.lookups)


@query
def fact_demographics(spark, sf_dir):
    s = star(spark, sf_dir)
    return facts.fact_demographics(s.bed.demographics(tagged=True), s.ports, port_rows=s.rows["ports"])


@query
def fact_demographics_by_state(spark, sf_dir):
    """The same with the port's state required to be the city's."""
    s = star(spark, sf_dir)
    return facts.fact_demographics(s.bed.demographics(tagged=True), s.ports, s.states, s.rows["ports"])


# ---- counting questions ----

@query
def q_port_state(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.by_port_and_state(s.fact(COUNTED), s.time, s.ports, s.states, YEAR, MONTHS, rows=s.rows)


@query
def q_country(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.by_country(s.fact(COUNTED), s.time, s.country, YEAR, MONTHS, rows=s.rows)


@query
def q_purpose(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.by_purpose(s.fact(COUNTED), s.time, s.visas, YEAR, MONTHS, rows=s.rows)


@query
def q_population(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.beside_population(s.fact(COUNTED), s.time, s.ports, s.demographics(), YEAR, MONTHS, rows=s.rows)


@query
def q_top_countries(spark, sf_dir):
    """The ten countries most arrivals come from."""
    s = star(spark, sf_dir)
    return counts.by_country(s.fact(COUNTED), s.time, s.country, YEAR, MONTHS, limit=10, rows=s.rows)


@query
def count_by_dims(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.count_by(s.fact(COUNTED), ["year", "month", "mode", "visa"], modes=s.modes, visas=s.visas,
                           rows=s.rows)


@query
def count_by_places(spark, sf_dir):
    s = star(spark, sf_dir)
    return counts.count_by(s.fact(COUNTED), ["residence", "state", "port"], country=s.country, ports=s.ports,
                           states=s.states)


@query
def sql_port_state(spark, sf_dir):
    """The same questions asked in SQL over views of the model."""
    views.register(_model(spark, sf_dir))
    return views.ask(spark, "port_and_state", YEAR, list(MONTHS))


@query
def sql_country(spark, sf_dir):
    views.register(_model(spark, sf_dir))
    return views.ask(spark, "country", YEAR, list(MONTHS))


@query
def sql_purpose(spark, sf_dir):
    views.register(_model(spark, sf_dir))
    return views.ask(spark, "purpose", YEAR, list(MONTHS))


@query
def sql_population(spark, sf_dir):
    views.register(_model(spark, sf_dir))
    return views.ask(spark, "population", YEAR, list(MONTHS))


_LOADED: dict[tuple[str, str], str] = {}


def _loaded_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """The warehouse with every day of the event lake loaded, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        root = _event_warehouse(spark, sf_dir)
        fact_plans.run_range(spark, _event_lake(spark, sf_dir), root, FIRST_EVENT_DAY, LAST_EVENT_DAY)
        _LOADED[key] = root
    return _LOADED[key]


def _asked(spark: SparkSession, sf_dir: str, question: str) -> DataFrame:
    views.register_warehouse(spark, _loaded_warehouse(spark, sf_dir))
    return views.ask(spark, question, FIRST_EVENT_DAY.year, [FIRST_EVENT_DAY.month])


@query
def stored_port_state(spark, sf_dir):
    """The questions asked of the facts as they are stored: the period picks the folders that are read."""
    return _asked(spark, sf_dir, "port_and_state")


@query
def stored_country(spark, sf_dir):
    return _asked(spark, sf_dir, "country")


@query
def stored_purpose(spark, sf_dir):
    return _asked(spark, sf_dir, "purpose")


@query
def stored_population(spark, sf_dir):
    return _asked(spark, sf_dir, "population")


# ---- quality ----

def _model(spark: SparkSession, sf_dir: str, columns=COUNTED) -> dict[str, DataFrame]:
    """Model tables for the quality queries; the facts come unkeyed, as no check here reads their keys."""
    s = star(spark, sf_dir)
    return {"dim_country": s.country, "dim_states": s.states, "dim_ports": s.ports, "dim_travelmodes": s.modes,
            "dim_visacategories": s.visas, "dim_airporttypes": s.types, "dim_time": s.time,
            "dim_airports": dims.us_airports(s.bed.airports(), s.types, s.states, s.rows["types"], s.rows["states"]),
            "fact_demographics": s.demographics(), "fact_immigration": s.fact(columns)}


@query
def dq_day_rowcount(spark, sf_dir):
    return quality.evaluate([quality.day_row_count(ARRIVAL_DAY)], _model(spark, sf_dir))


@query
def dq_rowcounts(spark, sf_dir):
    checks = [c for c in quality.dimension_checks() if c.condition == "> 0"]
    return quality.evaluate(checks, _model(spark, sf_dir))


@query
def dq_nulls(spark, sf_dir):
    checks = [c for c in quality.dimension_checks() + quality.fact_checks(ARRIVAL_DAY) if c.condition == "== 0"]
    return quality.evaluate(checks, _model(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    """All thirteen checks and one that must fail: some arrivals have no departure."""
    failing = quality.null_count("Check departure", "fact_immigration", "depdate")
    checks = [*quality.dimension_checks(), *quality.fact_checks(ARRIVAL_DAY), failing]
    return quality.evaluate(checks, _model(spark, sf_dir, (*COUNTED, "depdate")))


@query
def dq_unique(spark, sf_dir):
    """All declared-unique columns, of the tables with their keys."""
    keyed = {"dim_airports": dim_airports, "fact_demographics": fact_demographics, "fact_immigration": fact_arrivals}
    return quality.unique_report(_model(spark, sf_dir) | {t: make(spark, sf_dir) for t, make in keyed.items()})


@query
def stored_unique(spark, sf_dir):
    """The same of the warehouse with all event days loaded."""
    return fact_plans.stored_unique(spark, _loaded_warehouse(spark, sf_dir))


@query
def dq_orphans(spark, sf_dir):
    """References checked against dimensions of the events' travel modes only, so orphans do occur."""
    tables = _model(spark, sf_dir)
    tables["dim_travelmodes"] = dims.dim_modes(clean_arrivals(star(spark, sf_dir).bed.event_arrivals()))
    return quality.orphan_report(tables)


@query
def dq_not_null_len(spark, sf_dir):
    return quality.null_and_length_report(_model(spark, sf_dir, schemas.RAW_ARRIVALS.names))


# ---- whole jobs ----

@query
def job_code_lists(spark, sf_dir):
    """Dictionaries to CSV files to staged lists, whole."""
    folder = work_path(spark, "code-lists")
    paths = lake.extract_code_lists(Testbed(spark, sf_dir).dictionaries(), folder)
    wanted = {"countries": schemas.STAGED_COUNTRIES, "states": schemas.STAGED_STATES, "ports": schemas.STAGED_PORTS}
    lists = []
    for name, schema in wanted.items():
        columns = [F.col(c) for c in schema.names] + [F.lit(None).cast("string")] * (3 - len(schema.names))
        lists.append(stage(spark, paths[name], schema).select(F.lit(name).alias("list_name"), *[
            c.alias(as_name) for c, as_name in zip(columns, ("code", "name", "state_code"))]))
    return lists[0].unionByName(lists[1]).unionByName(lists[2])


@query
def job_dimensions(spark, sf_dir):
    """The dimension job's own check report."""
    bed, root = Testbed(spark, sf_dir), work_path(spark, "dimension-job")
    files = dimensions.DimensionFiles(*[f"{root}/files/{name}" for name in (
        "countries", "states", "ports", "airports", "demographics")])
    paths = lake.extract_code_lists(bed.dictionaries(), f"{root}/files")
    write_code_list(bed.airports(), files.airports)
    write_code_list(bed.demographics(), files.demographics, sep=";")
    assert paths["ports"] == files.ports
    return dimensions.build_dimensions(spark, files, root)


@query
def load_corrected_day(spark, sf_dir):
    """A day loaded with the next day's arrivals misfiled under it, corrected in the lake, and loaded again."""
    path, root = work_path(spark, "lake"), _event_warehouse(spark, sf_dir)
    events = clean_arrivals(Testbed(spark, sf_dir).event_arrivals()).where(
        F.col("arrival_date").isin(FIRST_EVENT_DAY, SECOND_EVENT_DAY))
    write_lake(events.withColumn("arrival_day", F.lit(FIRST_EVENT_DAY.day)), path, "events")
    fact_plans.run_day(spark, path, root, FIRST_EVENT_DAY)
    write_lake(events, path, "events")
    fact_plans.run_day(spark, path, root, FIRST_EVENT_DAY)
    return fact_plans.read_facts(spark, root).drop("immigration_id")


@query
def load_refresh_repeated(spark, sf_dir):
    """A code list that names every code twice, refreshed three times: its members and their keys stay."""
    path, ports = work_path(spark, "refresh"), Testbed(spark, sf_dir).countries()
    twice = ports.unionByName(ports.withColumn("country_name", F.concat("country_name", F.lit("~"))))
    for _ in range(3):
        write_snapshot(dims.dim_country(twice, read_snapshot(spark, path, schemas.TABLES["dim_country"])), path)
    return read_snapshot(spark, path, schemas.TABLES["dim_country"])


@query
def job_day(spark, sf_dir):
    """The daily job's own check report."""
    return fact_plans.run_day(spark, _event_lake(spark, sf_dir), _event_warehouse(spark, sf_dir), FIRST_EVENT_DAY)
