from __future__ import annotations

import datetime

import pytest
from decimal import Decimal

from landfall.operators.clean import clean_arrivals
from landfall.schemas import (LAKE_ARRIVALS, RAW_ARRIVALS, STAGED_AIRPORTS, STAGED_DEMOGRAPHICS, STAGED_PORTS,
                              STAGED_TEMPERATURES)
from landfall.operators.dims import dim_country
from landfall.plans.lake import one_per_code, repeated_codes
from landfall.sinks import lake, read_snapshot, retire, snapshots, write_code_list, write_lake, write_snapshot
from landfall.sources import (CORRUPT, cast_losses, cast_staged, read_day, read_days, scan_arrivals, stage, tag_rows)
from landfall.sources.arrivals import ROW_TAG, read_lake
from landfall.sources.staging import text_schema
from tests.samples import arrival, raw


def test_csv_lands_by_position_and_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "d.csv").write_text(
        "City;State;Median Age;Male;Female;Total;Veterans;Foreign;Household;Code;Race;Count\n"
        "Portland;Oregon;36.7;1;2;3;4;5;2.43;OR;White;10\n"
        '"Semi;colon";X;;1;2;3;4;5;2.5;XX;Asian;11\n'
        "Broken;X;1.0;many;2;3;4;5;2.5;XX;Asian;12\n")
    df = stage(spark, str(tmp_path / "d.csv"), STAGED_DEMOGRAPHICS, sep=";", keep_corrupt=True)
    found = {r["city"]: r for r in df.collect()}
    assert found["Portland"]["median_age"] == Decimal("36.70") and found["Portland"][CORRUPT] is None
    assert found["Semi;colon"]["median_age"] is None and found["Semi;colon"][CORRUPT] is None
    assert found["Broken"]["male_population"] is None and found["Broken"]["count"] == 12
    assert found["Broken"][CORRUPT].startswith("Broken;X;1.0;many")
    assert stage(spark, str(tmp_path / "d.csv"), STAGED_DEMOGRAPHICS, sep=";").count() == 3


def test_csv_keeps_blanks_quotes_and_empty_fields(spark, tmp_path):
    rows = [("CP ", ' a "quoted", name ', ""), ("\tX", "O'HARE", "IL")]
    df = spark.createDataFrame(rows, STAGED_PORTS)
    write_code_list(df, str(tmp_path / "ports"))
    back = stage(spark, str(tmp_path / "ports"), STAGED_PORTS).fillna("").collect()
    assert sorted(tuple(r) for r in back) == sorted(rows)


def test_casting_reports_what_it_loses(spark):
    raw_text = spark.createDataFrame(
        [("2000-01-01", "1.5", "x", None, "c", "1", "2"), ("2000-01-02", None, "0.25", "t", "c", "1", "2")],
        text_schema(STAGED_TEMPERATURES))
    typed = cast_staged(raw_text, STAGED_TEMPERATURES)
    assert typed.schema == STAGED_TEMPERATURES
    lost = {r["column_name"]: r["lost"] for r in cast_losses(raw_text, STAGED_TEMPERATURES).collect()}
    assert lost["average_temperature_uncertainty"] == 1 and sum(lost.values()) == 1


def test_staging_temperatures_and_airports(spark, tmp_path):
    (tmp_path / "t.csv").write_text("dt,t,u,City,Country,Lat,Lon\n1900-01-01,6.068,1.737,Aarhus,Denmark,57N,10E\n")
    row = stage(spark, str(tmp_path / "t.csv"), STAGED_TEMPERATURES).first()
    assert row["average_temperature"] == Decimal("6.068") and row["longitude"] == "10E"
    (tmp_path / "a.csv").write_text(
        "ident,type,name,elevation_ft,continent,iso_country,iso_region,municipality,gps_code,iata_code,local_code,"
        'coordinates\n00A,heliport,Total,11,NA,US,US-PA,Town,00A,,00A,"-74.9, 40.0"\n')
    row = stage(spark, str(tmp_path / "a.csv"), STAGED_AIRPORTS).first()
    assert row["coordinates"] == "-74.9, 40.0" and row["iata_code"] is None and row["elevation_ft"] == 11


def test_scan_reads_every_file_of_a_folder(spark, tmp_path):
    for i in range(3):
        raw(spark, arrival(cicid=float(i))).write.parquet(str(tmp_path / f"month{i}"))
    assert scan_arrivals(spark, str(tmp_path / "*")).count() == 3
    raw(spark, arrival()).write.option("header", True).csv(str(tmp_path / "csv"))
    assert scan_arrivals(spark, str(tmp_path / "csv"), "csv").schema == RAW_ARRIVALS


def test_cleaning_edge_rows(spark):
    df = clean_arrivals(raw(
        spark, arrival(cicid=1.0, arrdate=20454.7, i94bir=37.9, i94mode=9.0, i94visa=4.0),
        arrival(cicid=2.0, arrdate=None, i94yr=float("nan")), arrival(cicid=3.0, arrdate=-0.5, depdate=None)))
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in LAKE_ARRIVALS]
    first, second, third = df.orderBy("cicid").collect()
    assert (first["arrival_date"], first["arrival_day"]) == (datetime.date(2016, 1, 1), 1)
    assert (first["i94bir"], first["travel_mode"], first["visa_category"]) == (37, "Not reported", "Others")
    assert second["arrival_date"] is None and second["arrival_day"] is None and second["year"] is None
    assert third["arrival_date"] == datetime.date(1959, 12, 31) and third["departure_date"] is None


def test_lake_deliveries_add_up_and_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "lake")
    days = [arrival(cicid=float(i), arrdate=20454.0 + i % 3) for i in range(30)]
    write_lake(clean_arrivals(raw(spark, *days)), path, "a")
    write_lake(clean_arrivals(raw(spark, *days)), path, "a")
    assert read_lake(spark, path).count() == 30
    write_lake(clean_arrivals(raw(spark, arrival(arrdate=20455.0))), path, "b")
    assert read_lake(spark, path).count() == 31  # a day's second delivery adds to the first
    second = read_day(spark, path, datetime.date(2016, 1, 2))
    assert second.count() == 11 and second.columns == LAKE_ARRIVALS.names
    assert read_days(spark, path, datetime.date(2016, 1, 2), datetime.date(2016, 2, 1)).count() == 21
    write_lake(clean_arrivals(raw(spark, *days[::3])), path, "a")
    assert read_lake(spark, path).count() == 11  # a delivery written again replaces all it brought
    with pytest.raises(ValueError):
        write_lake(clean_arrivals(raw(spark, *days)), path, "a/b")
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "arrival_day" in plan.split("PartitionFilters")[1]


def test_row_without_a_day_is_kept_apart(spark, tmp_path):
    write_lake(clean_arrivals(raw(spark, arrival(arrdate=None), arrival())), str(tmp_path / "lake"), "a")
    found = read_lake(spark, str(tmp_path / "lake"))
    assert found.count() == 2 and found.where("arrival_day IS NULL").count() == 1


def test_snapshots(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "k bigint, v string")
    assert read_snapshot(spark, path, df.schema) is None
    write_snapshot(df, path)
    current = read_snapshot(spark, path, df.schema)
    write_snapshot(current.unionByName(current), path)  # the new content is computed from the old
    assert read_snapshot(spark, path, df.schema).count() == 2
    write_snapshot(df.limit(0), path)
    assert read_snapshot(spark, path, df.schema).count() == 0
    write_snapshot(df, path)
    assert read_snapshot(spark, path, df.schema).count() == 1


def test_row_tags_differ(spark, tmp_path):
    spark.range(1000).repartition(5).write.parquet(str(tmp_path / "t"))
    assert tag_rows(spark.read.parquet(str(tmp_path / "t"))).select(ROW_TAG).distinct().count() == 1000


def test_unfinished_snapshot_does_not_count_and_old_ones_retire(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "k bigint, v string")
    for _ in range(4):
        write_snapshot(df, path)
    df.unionByName(df).write.parquet(f"{path}/snapshot=5")
    (tmp_path / "t" / "snapshot=5" / "_SUCCESS").unlink()
    assert read_snapshot(spark, path, df.schema).count() == 1
    assert retire(spark, path, keep=2) == [2, 1]
    write_snapshot(df.limit(0), path)
    assert read_snapshot(spark, path, df.schema).count() == 0
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == [f"snapshot={n}" for n in (3, 4, 5, 6)]


def test_quoted_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("A", "one\ntwo")], "code string, name string")
    write_code_list(df, str(tmp_path / "c"))
    assert [tuple(r) for r in stage(spark, str(tmp_path / "c"), df.schema, multiline=True).collect()] == [("A", "one\ntwo")]


def test_one_entry_per_code_of_the_last_dictionary(spark):
    rows = [("d1", 1, "A", "old"), ("d2", 1, "A", "new"), ("d2", 2, "A", "newer"), ("d1", 2, "B", "b")]
    entries = spark.createDataFrame(rows, "source string, pos int, country_code string, country_name string")
    assert sorted(map(tuple, one_per_code(entries, "country_code").collect())) == [("A", "new"), ("B", "b")]
    assert [tuple(r) for r in repeated_codes(entries, "country_code").collect()] == [("A", 2)]


def test_refresh_with_repeated_codes_keeps_members(spark, tmp_path):
    staged = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "country_code string, country_name string")
    first = dim_country(staged)
    assert sorted(map(tuple, first.collect())) == [(1, "a", "x"), (2, "b", "z")]
    assert sorted(map(tuple, dim_country(staged, dim_country(staged, first)).collect())) == [(1, "a", "x"), (2, "b", "z")]


def test_writers_at_one_time_take_different_numbers(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), spark.range(3)
    monkeypatch.setattr(snapshots, "_numbers", lambda *a: [])  # both see the table as it was before either
    write_snapshot(df, path), write_snapshot(df.limit(1), path)
    monkeypatch.undo()
    assert spark.read.parquet(f"{path}/snapshot=1").count() == 3
    assert read_snapshot(spark, path, df.schema).count() == 1


def lake_files(spark, path):
    return len(read_lake(spark, path).inputFiles())


def lake_rows(spark, path):
    return sorted(map(str, read_lake(spark, path).collect()))


@pytest.fixture
def delivered(spark, tmp_path):
    """A lake of five small deliveries of three days, with copies and a row without a day."""
    path = str(tmp_path / "lake")
    for k in range(5):
        rows = [arrival(cicid=float(i // 2), arrdate=20454.0 + i % 3, fltno=str(k)) for i in range(12)]
        write_lake(clean_arrivals(raw(spark, *rows, arrival(arrdate=None))), path, f"d{k}")
    return path


def test_merged_deliveries_have_few_files_and_the_same_rows(spark, delivered):
    before = lake_rows(spark, delivered)
    assert lake_files(spark, delivered) >= 20 and len(before) == 65
    assert lake.compact(spark, delivered) == "merged-1"
    assert lake_rows(spark, delivered) == before and lake_files(spark, delivered) == 4
    day = read_day(spark, delivered, datetime.date(2016, 1, 2))
    assert day.count() == 20 and day.select("_metadata.file_name").distinct().count() == 1 and day.columns == LAKE_ARRIVALS.names
    assert lake.compact(spark, delivered) is None
    # A later delivery adds up, and goes into a merge of merges.
    write_lake(clean_arrivals(raw(spark, arrival(arrdate=20455.0))), delivered, "late")
    assert len(lake_rows(spark, delivered)) == 66
    assert lake.compact(spark, delivered, ["late", "merged-1"]) == "merged-2"
    assert len(lake_rows(spark, delivered)) == 66 and lake_files(spark, delivered) == 4
    gone = lake.retire(spark, delivered)
    assert gone == ["d0", "d1", "d2", "d3", "d4", "late", "merged-1"]
    assert len(lake_rows(spark, delivered)) == 66 and lake.visible(spark, delivered) == ["merged-2"]


def test_a_merged_delivery_that_is_written_again_replaces_what_it_brought(spark, delivered):
    lake.compact(spark, delivered, ["d0", "d1", "d2"])
    lake.retire(spark, delivered)
    write_lake(clean_arrivals(raw(spark, arrival(fltno="new"))), delivered, "d1")
    flights = [r["fltno"] for r in read_lake(spark, delivered).collect()]
    assert sorted(set(flights)) == ["0", "001", "2", "3", "4", "new"] and flights.count("1") == 0 and len(flights) == 53
    for name in ("d0", "d2"):
        write_lake(clean_arrivals(raw(spark, arrival(fltno="x"))), delivered, name)
    # Nothing is left of the merge, and no merge counts.
    assert lake.state(spark, delivered).merges == {} and len(lake_rows(spark, delivered)) == 29
    with pytest.raises(ValueError, match="no such deliveries"):
        lake.compact(spark, delivered, ["d0", "merged-1"])
    with pytest.raises(ValueError, match="name is letters"):
        write_lake(clean_arrivals(raw(spark, arrival())), delivered, "merged-9")


def test_an_unfinished_merge_is_not_read(spark, delivered, monkeypatch):
    before = lake_rows(spark, delivered)
    with monkeypatch.context() as patched:
        patched.setattr(lake, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.compact(spark, delivered)
    assert lake_rows(spark, delivered) == before and len(lake.visible(spark, delivered)) == 5
    assert lake.retire(spark, delivered) == []
    # The next merge takes a number of its own; one that another has overtaken gives up.
    overtaken = lake.state(spark, delivered)
    assert lake.compact(spark, delivered) == "merged-2" and lake_rows(spark, delivered) == before
    with pytest.raises(RuntimeError, match="repeat"):
        lake._publish(spark, delivered, overtaken, lake.State(9, {}))
    assert "merged-1" in lake.retire(spark, delivered) and lake_rows(spark, delivered) == before


def test_merging_a_lake_that_is_not_there(spark, tmp_path):
    assert lake.compact(spark, str(tmp_path / "none")) is None
    assert lake.retire(spark, str(tmp_path / "none")) == []
