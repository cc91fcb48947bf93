"""Whole jobs: repeated, ranged, and the plans they leave for later queries."""

from __future__ import annotations

import dataclasses
import datetime
import pathlib
import re
import shutil

import duckdb
import pytest

from landfall.operators import counts, facts, quality
from landfall.plans import facts as fact_plans
from landfall.plans import views
from landfall.plans.dimensions import DimensionFiles, build_dimensions, read_table, staging_report
from landfall.plans.lake import load_lake
from landfall.schemas import FACT_ARRIVALS, STAGED_DEMOGRAPHICS, TABLES
from landfall.session import shared_dir
from landfall.sinks import lake as deliveries
from landfall.sinks import loads, write_code_list
from landfall.sources.arrivals import file_offsets
from landfall.testbed import oracles, queries
from tests import samples
from tests.compare import difference
from tests.samples import arrival, raw

FIRST, LAST = datetime.date(2016, 1, 1), datetime.date(2016, 1, 3)


def airports(spark):
    return spark.createDataFrame(
        [("1", "large", "A", "10", "NA", "US", "US-ME", "m", "g", "i", "l", "1, 2")],
        "ident string, type string, name string, elevation_ft string, continent string, iso_country string, "
        "iso_region string, municipality string, gps_code string, iata_code string, local_code string, "
        "coordinates string")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "arrivals")
    rows = [arrival(cicid=float(i), arrdate=20454.0 + i % 3, i94port="ABCD"[i % 4] * 3, i94mode=float(1 + i % 3))
            for i in range(24)]
    # Filed under the first of January although it arrived on the third, and copies of one row.
    rows += [arrival(cicid=100.0, arrdate=20486.0, i94mon=1.0)] + [arrival(cicid=7.5)] * 3
    load_lake(raw(spark, *rows), path, "first")
    return path


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("built")
    files = DimensionFiles(*[str(folder / n) for n in ("countries", "states", "ports", "airports", "demographics")])
    write_code_list(samples.countries(spark), files.countries)
    write_code_list(samples.states(spark), files.states)
    write_code_list(samples.ports(spark), files.ports)
    write_code_list(airports(spark), files.airports)
    write_code_list(samples.demographics(spark), files.demographics, sep=";")
    report = build_dimensions(spark, files, str(folder / "warehouse"))
    assert report.count() == 9
    return folder


@pytest.fixture
def warehouse(built, tmp_path):
    """A copy of the built dimensions and their files, for one test to change."""
    shutil.copytree(built, tmp_path / "copy")
    names = ("countries", "states", "ports", "airports", "demographics")
    return str(tmp_path / "copy" / "warehouse"), DimensionFiles(*[str(tmp_path / "copy" / n) for n in names])


@pytest.fixture(scope="module")
def loaded(spark, built, lake, tmp_path_factory):
    """A warehouse with all three days loaded as one range."""
    root = str(tmp_path_factory.mktemp("loaded") / "warehouse")
    shutil.copytree(built / "warehouse", root)
    report = fact_plans.run_range(spark, lake, root, FIRST, LAST)
    assert report.count() == 15 and report.where("NOT passed").isEmpty()
    # Facts, rejected and undated arrivals are all of the lake.
    left_out = {r["check"]: r["value"] for r in report.where("check RLIKE '^Arrivals (rejected|filed)'").collect()}
    assert sum(left_out.values()) + fact_plans.read_facts(spark, root).count() == spark.read.parquet(lake).count()
    return root


def content(spark, root):
    return sorted(map(str, fact_plans.read_facts(spark, root).collect()))


def test_repeating_a_day_changes_nothing(spark, lake, warehouse):
    root, _ = warehouse
    report = fact_plans.run_day(spark, lake, root, FIRST)
    assert report.count() == 13 and report.where("NOT passed").isEmpty()
    once = content(spark, root)
    # Eight arrivals on the day, three copies; the record filed on the second day is not among them.
    assert len(once) == 11
    fact_plans.run_day(spark, lake, root, FIRST)
    assert content(spark, root) == once
    assert {r["gender"] for r in fact_plans.read_facts(spark, root).collect()} == {"F"}
    # Nothing is left behind in the shared folder.
    left = pathlib.Path(shared_dir(spark), "landfall")
    assert not [p for p in left.iterdir() if p.name.startswith("scratch-")]


def test_a_range_is_the_union_of_its_days_in_any_order(spark, lake, loaded, warehouse):
    other, _ = warehouse
    for day in (LAST, FIRST, FIRST + datetime.timedelta(days=1)):
        fact_plans.run_day(spark, lake, other, day)
    keyless = ("immigration_id", "cicid", "port_id", "arrival_date")
    ranged, daily = (fact_plans.read_facts(spark, w).select(*keyless) for w in (loaded, other))
    assert sorted(ranged.collect()) == sorted(daily.collect())
    assert ranged.select("immigration_id").distinct().count() == ranged.count() == 28


def test_a_misfiled_record_does_not_displace_the_day_it_names(spark, lake, loaded, tmp_path):
    root = str(tmp_path / "copy")
    shutil.copytree(loaded, root)
    before = content(spark, root)
    assert sum("20486.0" in row for row in before) == 1
    fact_plans.run_day(spark, lake, root, FIRST + datetime.timedelta(days=1))
    assert content(spark, root) == before


def test_an_empty_day_fails_its_check(spark, lake, warehouse):
    root, _ = warehouse
    with pytest.raises(quality.QualityError, match="row count 2016-01-04 check failed"):
        fact_plans.run_range(spark, lake, root, FIRST, LAST + datetime.timedelta(days=1))
    assert len(content(spark, root)) == 28


def test_facts_need_their_dimensions(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="dim_country is not loaded yet"):
        fact_plans.run_day(spark, lake, str(tmp_path / "nothing"), FIRST)


def test_records_that_do_not_parse_are_counted(spark, warehouse):
    root, files = warehouse
    with open(files.demographics + ".csv", "w") as f:
        f.write(";".join(STAGED_DEMOGRAPHICS.names) + "\n" + "A;B;33.1;n/a;2;3;4;5;2.5;OR;White;7\nA;B;33.1;1;2\n")
        f.write("A;B;33.1;1;2;3;4;5;2.5;OR;White;7\n")
    changed = dataclasses.replace(files, demographics=files.demographics + ".csv")
    found = {r["check"]: (r["value"], r["passed"]) for r in staging_report(spark, changed).collect()}
    assert found == {"Records of airports that do not parse": (0, True),
                     "Records of demographics that do not parse": (2, True)}


def test_refreshing_dimensions_keeps_the_keys_facts_use(spark, lake, warehouse):
    root, files = warehouse
    fact_plans.run_day(spark, lake, root, FIRST)
    before = {r["port_code"]: r["port_id"] for r in read_table(spark, root, "dim_ports").collect()}
    added = spark.createDataFrame([("000", "EARLIER", "OR")], "port_code string, port_name string, state_code string")
    write_code_list(samples.ports(spark).unionByName(added), files.ports)
    build_dimensions(spark, files, root)
    after = {r["port_code"]: r["port_id"] for r in read_table(spark, root, "dim_ports").collect()}
    assert {k: after[k] for k in before} == before and after["000"] == max(before.values()) + 1
    tables = {name: read_table(spark, root, name) for name in TABLES if name != "fact_immigration"}
    tables["fact_immigration"] = fact_plans.read_facts(spark, root)
    assert {r["orphans"] for r in quality.orphan_report(tables).collect()} == {0}


def test_questions_read_only_the_partitions_of_their_period(spark, loaded):
    root = loaded
    facts, time = fact_plans.read_facts(spark, root), read_table(spark, root, "dim_time")
    q = counts.by_purpose(facts, time, read_table(spark, root, "dim_visacategories"), 2016, (1,))
    plan = q._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "fact_immigration" in line)
    filters = scan.split("PartitionFilters: ")[1]
    assert "arrival_date" in filters and "dynamicpruning" in filters
    assert "BatchEvalPython" not in plan and "ReadSchema: struct<visa_category_id:bigint>" in scan
    assert q.agg({"count": "sum"}).first()[0] == 27


def test_questions_in_sql_equal_the_functions(spark, loaded):
    root = loaded
    views.register_warehouse(spark, root)
    assert {t.name for t in spark.catalog.listTables()} >= set(TABLES)
    facts = fact_plans.read_facts(spark, root)
    time, ports = read_table(spark, root, "dim_time"), read_table(spark, root, "dim_ports")
    by_port = counts.by_port_and_state(facts, time, ports, read_table(spark, root, "dim_states"), 2016, (1,))
    assert views.ask(spark, "port_and_state", 2016, [1]).collect() == by_port.collect()
    asked = views.ask(spark, "purpose", 2016, [1])
    assert [tuple(r) for r in asked.collect()] == [("Pleasure", 27)]
    assert "dynamicpruning" in asked._jdf.queryExecution().executedPlan().toString()


def test_a_registered_question_reads_only_the_folders_of_its_period(spark):
    plan = queries.QUERIES["stored_purpose"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "fact_immigration" in line)
    assert "dynamicpruning" in scan.split("PartitionFilters: ")[1] and "ReadSchema: struct<visa_category_id:bigint>" in scan


def executions(spark) -> list[str]:
    """Descriptions of the plans that this session ran."""
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [ran.apply(i).physicalPlanDescription() for i in range(ran.size())]


def test_a_load_scans_its_days_three_times_and_moves_no_fact(spark, lake, warehouse):
    root, _ = warehouse
    before = len(executions(spark))
    fact_plans.run_range(spark, lake, root, FIRST, LAST)
    scans = [p for p in executions(spark)[before:] if lake in p]
    # Rows per file, members of the small dimensions, the write; and the folders that name no date, of which there is none.
    assert len(scans) == 4
    writes = [p for p in scans if "InsertIntoHadoopFsRelationCommand" in p and "fact_immigration" in p]
    assert len(writes) == 1 and "CollectMetrics" in writes[0]
    # What is exchanged is the codes of the countries, of which one member each is looked up.
    assert set(re.findall(r"Arguments: (?:hash|range)partitioning\((\w+)#", writes[0])) == {"code"}


def test_keys_are_places_in_the_lake(spark, lake, loaded):
    staged = fact_plans.staged_days(spark, lake, FIRST, LAST)
    offsets = {(r["load_date"], r["file"]): r["offset"] for r in file_offsets(staged, "load_date").collect()}
    rows = staged.selectExpr("load_date", "_metadata.file_path AS f", "_metadata.row_index AS i", "cicid").collect()
    base = {d: (d - datetime.date(1960, 1, 1)).days * facts.DAY_KEYS for d in {r["load_date"] for r in rows}}
    places = {base[r["load_date"]] + offsets[r["load_date"], r["f"]] + r["i"] + 1: r["cicid"] for r in rows}
    assert len(places) == len(rows)  # no two rows have one place, and a day's places are its numbers from 1
    for d, b in base.items():
        day = sorted(k - b for k in places if b < k <= b + len(rows))
        assert day == list(range(1, len(day) + 1))
    found = {r["immigration_id"]: r["cicid"] for r in fact_plans.read_facts(spark, loaded).collect()}
    assert len(found) == 28 and found.items() <= places.items()


def test_keys_of_a_loaded_warehouse_are_unique(spark, loaded):
    found = {(r["table_name"], r["column_name"]): r["repeated_rows"] for r in fact_plans.stored_unique(spark, loaded).collect()}
    assert found.pop(("dim_ports", "port_name")) == 2
    assert len(found) == 15 and set(found.values()) == {0}


def test_days_load_alike_after_a_merge_of_the_lake(spark, lake, loaded, warehouse, tmp_path):
    """The rows are the same; their keys are those of their new places, and unique."""
    root, _ = warehouse
    merged = str(tmp_path / "lake")
    shutil.copytree(lake, merged)
    load_lake(raw(spark, arrival(cicid=500.0), arrival(cicid=501.0)), merged, "second")
    deliveries.compact(spark, merged)
    deliveries.retire(spark, merged)
    fact_plans.run_range(spark, merged, root, FIRST, LAST)
    facts_of = [fact_plans.read_facts(spark, w).drop("immigration_id") for w in (root, loaded)]
    added = facts_of[0].exceptAll(facts_of[1])
    assert sorted(r["cicid"] for r in added.collect()) == [500.0, 501.0] and facts_of[1].exceptAll(facts_of[0]).isEmpty()
    report = fact_plans.stored_unique(spark, root).where("table_name = 'fact_immigration'")
    assert report.first()["repeated_rows"] == 0


@pytest.mark.parametrize("stop", ["write_parts", "publish"])
def test_a_load_that_stops_leaves_what_was_there(spark, lake, warehouse, monkeypatch, stop):
    root, _ = warehouse
    fact_plans.run_range(spark, lake, root, FIRST, LAST)
    before, read = content(spark, root), fact_plans.read_facts(spark, root)

    def crash(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(fact_plans.loads if stop == "publish" else fact_plans, stop, crash)
    with pytest.raises(KeyboardInterrupt):
        fact_plans.run_day(spark, lake, root, FIRST)
    assert content(spark, root) == before
    monkeypatch.undo()
    fact_plans.run_day(spark, lake, root, FIRST)
    assert content(spark, root) == before
    # A reader that began before the load still finds the files it chose.
    assert sorted(map(str, read.collect())) == before
    target = f"{root}/fact_immigration"
    gone = loads.retire(spark, target, "load_date")
    assert "load=1/load_date=2016-01-01" in gone and content(spark, root) == before
    assert loads.retire(spark, target, "load_date") == []


def test_a_days_rows_that_are_gone_from_the_lake_go_from_the_facts(spark, lake, warehouse, tmp_path):
    root, _ = warehouse
    fact_plans.run_range(spark, lake, root, FIRST, LAST)
    fewer = str(tmp_path / "lake")
    load_lake(raw(spark, arrival(cicid=1.0)), fewer, "first")
    with pytest.raises(quality.QualityError, match="row count 2016-01-02 check failed"):
        fact_plans.run_range(spark, fewer, root, FIRST, LAST)
    assert [r["cicid"] for r in fact_plans.read_facts(spark, root).collect()] == [1.0]


def test_observed_numbers_that_do_not_fit_the_files_are_counted_anew(spark, lake, warehouse, monkeypatch):
    """A task that ran twice adds up twice; the files do not."""
    root, _ = warehouse
    plain = {r["check"]: r["value"] for r in fact_plans.run_range(spark, lake, root, FIRST, LAST).collect()}
    monkeypatch.setattr(fact_plans.Observation, "get", property(
        lambda self: {"arrived": 99, "rejected_any": 9, "undated_facts": 9, **{f"rejected_{r}": 9 for r in facts.ROLES}}))
    again = {r["check"]: r["value"] for r in fact_plans.run_range(spark, lake, root, FIRST, LAST).collect()}
    assert again == plain and plain["Arrivals of unknown port"] == 0


def test_rejects_are_told_by_dimension(spark, built, tmp_path):
    root, path = str(tmp_path / "warehouse"), str(tmp_path / "lake")
    shutil.copytree(built / "warehouse", root)
    load_lake(raw(spark, arrival(cicid=1.0), arrival(cicid=2.0, i94port="ZZZ"), arrival(cicid=3.0, i94port="ZZZ", i94cit=999.0),
                  arrival(cicid=4.0, i94res=None)), path, "first")
    found = {r["check"]: r["value"] for r in fact_plans.run_day(spark, path, root, FIRST).collect()}
    assert {k: v for k, v in found.items() if k.startswith("Arrivals")} == {
        "Arrivals rejected by a dimension": 3, "Arrivals of unknown citizenship": 1, "Arrivals of unknown residence": 1,
        "Arrivals of unknown port": 2, "Arrivals of unknown mode": 0, "Arrivals of unknown visa": 0,
        "Arrivals filed under no date": 0}
    assert fact_plans.read_facts(spark, root).columns == list(FACT_ARRIVALS)


def test_commits_of_loads_side_by_side(spark, tmp_path):
    path, day = str(tmp_path / "t"), datetime.date
    assert [loads.claim(spark, path) for _ in range(3)] == [1, 2, 3]
    # The later number is published first; the earlier one still counts for the days that it alone covers.
    loads.publish(spark, path, loads.Commit(3, day(2024, 1, 2), day(2024, 1, 4), {"2024-01-02": {"2024-01-02": 5}}))
    loads.publish(spark, path, loads.Commit(2, day(2024, 1, 1), day(2024, 1, 3), {d: {d: 1} for d in ("2024-01-01", "2024-01-03")}))
    found = loads.commits(spark, path)
    assert [c.number for c in found] == [3, 2] and found[0].total() == 5
    assert loads.live(found) == [(3, "2024-01-02"), (2, "2024-01-01")]
    assert loads.claim(spark, path) == 4


def ordered_keys(rows):
    """By load day, the keys that a load in order gives: numbers from 1 in order of the facts' columns, nulls first."""
    by_day: dict[int, list] = {}
    for r in rows:
        by_day.setdefault(r["immigration_id"] // facts.DAY_KEYS, []).append(r)
    for day, found in by_day.items():
        found.sort(key=lambda r: r["immigration_id"])
        assert [r["immigration_id"] - day * facts.DAY_KEYS for r in found] == list(range(1, len(found) + 1))
        columns = [[(r[c] is not None, r[c]) for c in FACT_ARRIVALS[1:]] for r in found]
        assert columns == sorted(columns)
    return {day: len(found) for day, found in by_day.items()}


def test_a_load_in_order_numbers_each_days_facts(spark, built, tmp_path, monkeypatch):
    path, one, daily = (str(tmp_path / n) for n in ("lake", "one", "daily"))
    for root in (one, daily):
        shutil.copytree(built / "warehouse", root)
    # Larger ids come first, some are missing, one row is there forty times, and some arrivals are rejected.
    rows = [arrival(cicid=float(50 - i), arrdate=20454.0 + i % 2, depdate=None if i % 5 == 0 else 20460.0,
                    i94port="ZZZ" if i % 7 == 0 else "AAA") for i in range(50)]
    rows += [arrival(cicid=7.5)] * 40 + [arrival(cicid=None, fltno=str(i)) for i in range(3)]
    load_lake(raw(spark, *rows[::2]), path, "first")
    load_lake(raw(spark, *rows[1::2]), path, "second")
    first, second = FIRST, FIRST + datetime.timedelta(days=1)
    plain = {r["check"]: r["value"] for r in fact_plans.run_range(spark, path, one, first, second).collect()}
    assert plain["Arrivals rejected by a dimension"] == 8
    in_order = {r["check"]: r["value"] for r in fact_plans.run_range(spark, path, one, first, second, ordered=True).collect()}
    assert in_order == plain
    found = fact_plans.read_facts(spark, one).collect()
    day = (first - datetime.date(1960, 1, 1)).days
    assert ordered_keys(found) == {day: 64, day + 1: 21}
    # Days loaded one by one, in another order, or anew after a merge of the lake: the same facts under the same keys.
    deliveries.compact(spark, path)
    for d in (second, first, second):
        fact_plans.run_day(spark, path, daily, d, ordered=True)
    assert content(spark, daily) == sorted(map(str, found))
    left = pathlib.Path(shared_dir(spark), "landfall")
    assert not [p for p in left.iterdir() if p.name.startswith("scratch-")]


def event_tables(spark, path, events):
    """Tables that the queries over events read, with ``(event_id, ts, user_id)`` as events."""
    tables = {
        "region": ([(0, "AFRICA"), (1, "AMERICA")], "r_regionkey long, r_name string"),
        "nation": ([(i, f"N{i}", i % 2) for i in range(25)], "n_nationkey long, n_name string, n_regionkey long"),
        "supplier": ([(i, f"S{i}", i % 25) for i in range(120)], "s_suppkey long, s_name string, s_nationkey long"),
        "part": ([(i, "large", f"P{i}", 1 + i, "B1") for i in range(9)],
                 "p_partkey long, p_type string, p_name string, p_size long, p_brand string"),
        "customer": ([(i, 10.0 * i, "AUTO", i) for i in range(24)],
                     "c_custkey long, c_acctbal double, c_mktsegment string, c_nationkey long"),
        "events": ([(e, ts, user, "view", 1.5) for e, ts, user in events],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return con


def test_appended_days_are_numbered_as_their_sql_says(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1, 5)
    events = [(e, start + datetime.timedelta(hours=13 * (e % 5)), e * 7) for e in range(80, 0, -1)] + [(27, start, 189)] * 6
    con = event_tables(spark, str(tmp_path), events)
    got = queries.QUERIES["load_append_day"](spark, str(tmp_path))
    assert difference(got, con, oracles.oracle_sql()["load_append_day"]) is None
    assert len(ordered_keys(got.collect())) == 2


def test_a_backfill_loads_all_days_of_the_lake_and_numbers_their_facts(spark, tmp_path):
    """Days before and after January, with gaps between them and a fact that is there seven times."""
    days = [datetime.datetime(2023, 12, 31, 23), datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2, 7),
            datetime.datetime(2024, 1, 30), datetime.datetime(2024, 2, 29, 12)]
    events = [(e, days[e % 5], e * 7) for e in range(80, 0, -1)] + [(27, days[2], 189)] * 6
    con = event_tables(spark, str(tmp_path), events)
    got = queries.QUERIES["load_backfill"](spark, str(tmp_path))
    assert difference(got, con, oracles.oracle_sql()["load_backfill"]) is None
    assert len(ordered_keys(got.collect())) == 5


def test_stretches_are_unbroken_days(spark, lake, tmp_path):
    assert fact_plans.stretches(spark, lake) == [(FIRST, LAST)]
    path = str(tmp_path / "lake")
    load_lake(raw(spark, *[arrival(arrdate=float(20454 + d), i94yr=2016.0, i94mon=1.0) for d in (0, 1, 1, 4)],
                  arrival(arrdate=None)), path, "first")
    assert fact_plans.stretches(spark, path) == [
        (FIRST, FIRST + datetime.timedelta(days=1)), (FIRST + datetime.timedelta(days=4),) * 2]
