from __future__ import annotations

import pytest

from landfall.operators.labels import (block_rows, extract_block, extract_countries, extract_labels, extract_ports,
                                       extract_states)
from landfall.plans.lake import extract_code_lists
from landfall.plans.dimensions import staged_ports
from landfall.schemas import STAGED_COUNTRIES, STAGED_PORTS, STAGED_STATES
from landfall.sources import read_dictionaries, stage

# A dictionary of our own with the irregularities hand-kept dictionaries show.
TEXT = """libname library 'somewhere' ;
proc format library=library ;

/* countries */
  value i94cntyl
   901 =  'FARLAND Air Sea, and Not Reported (no land arrivals)'
   236 =  'NEARLAND'
   687 =  'TRAILING '
   245 =  'ISLES, OUTER'
   0 =  'INVALID: STATELESS'
   705 =  'INVALID: STATELESS' ;

/* ports */
  value $i94prtl
   'ALC'\t=\t'ALPHA, AK             '
   'MAP'\t=\t'MARKET AZ           '
   'BLT'\t=\t'POINT, HWY. STATION, CA '
   'ASE'\t=\t'ASH, CO ' 
   'INT'\t=\t'INT''L FALLS, MN'
   'PDN'\t=\t'PASS,TX'
   'LIA'\t=\t'LITTLE CITY, AR (BPS)'
   'CP '\t=\t'No PORT Code (CP)'
;

value i94model
\t1 = 'Air'
\t9 = 'Not reported' ;

value i94addrl
\t'AL'='ALABAMA'
\t'AG'\t\t='TWO TABS'
\t'WY'='WYOMING' 
\t'99'='All Other Codes' ;

/* VISA - three categories:
   1 = Business
*/
run ;
"""


@pytest.fixture(scope="module")
def dictionaries(spark):
    return spark.createDataFrame([("a", TEXT), ("b", "no blocks here; none")], "source string, text string")


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("source", "pos").select(*columns).collect()]


def test_block_runs_to_the_first_semicolon(dictionaries):
    block = extract_block(dictionaries, "i94model").collect()
    assert [tuple(r) for r in block] == [("a", "\n\t1 = 'Air'\n\t9 = 'Not reported' ")]
    assert extract_block(dictionaries, "missing").count() == 0


def test_first_of_two_blocks_counts(spark):
    twice = spark.createDataFrame([("s", "key a; key b;")], "source string, text string")
    assert [r["block"] for r in extract_block(twice, "key").collect()] == [" a"]


def test_block_rows_keep_raw_parts(dictionaries):
    found = rows(block_rows(extract_block(dictionaries, "i94addrl")), "pos", "code_part", "label_part")
    assert found[0] == (1, "\t'AL'", "'ALABAMA'")
    assert found[-1] == (4, "\t'99'", "'All Other Codes' ")


def test_countries(dictionaries):
    assert rows(extract_countries(dictionaries), "country_code", "country_name") == [
        ("901", "FARLAND"), ("236", "NEARLAND"), ("687", "TRAILING "), ("245", "ISLES, OUTER"),
        ("0", "INVALID: STATELESS"), ("705", "INVALID: STATELESS")]


def test_states(dictionaries):
    assert rows(extract_states(dictionaries), "state_code", "state_name") == [
        ("AL", "ALABAMA"), ("AG", "TWO TABS"), ("WY", "WYOMING"), ("99", "All Other Codes")]


def test_ports(dictionaries):
    assert rows(extract_ports(dictionaries), "port_code", "port_name", "state_code") == [
        ("ALC", "ALPHA", "AK"), ("MAP", "MARKET AZ", ""), ("BLT", "POINT", "HWY."), ("ASE", "ASH", "CO"),
        ("INT", "INTL FALLS", "MN"), ("PDN", "PASS", "TX"), ("LIA", "LITTLE CITY", "AR"),
        ("CP ", "No PORT Code (CP)", "")]


def test_ports_cut_at_the_last_comma(dictionaries):
    found = rows(extract_ports(dictionaries, last_comma=True), "port_code", "port_name", "state_code")
    assert found[1:3] == [("MAP", "MARKET AZ", ""), ("BLT", "POINT, HWY. STATION", "CA")]


def test_tidy_drops_blanks_inside_quotes(dictionaries):
    assert rows(extract_ports(dictionaries, tidy=True), "port_code")[-1] == ("CP",)
    assert rows(extract_countries(dictionaries, tidy=True), "country_name")[2] == ("TRAILING",)


def test_all_formats(dictionaries):
    found = extract_labels(dictionaries)
    counted = {r["format_name"]: r["count"] for r in found.groupBy("format_name").count().collect()}
    assert counted == {"i94cntyl": 6, "i94prtl": 8, "i94model": 2, "i94addrl": 4}
    modes = rows(found.where("format_name = 'i94model'"), "code", "label")
    assert modes == [("1", "Air"), ("9", "Not reported")]


def test_files_to_csv_and_back(spark, tmp_path):
    (tmp_path / "codes.txt").write_text(TEXT)
    paths = extract_code_lists(read_dictionaries(spark, str(tmp_path / "codes.txt")), str(tmp_path / "lists"))
    ports = staged_ports(stage(spark, paths["ports"], STAGED_PORTS)).collect()
    assert {tuple(r) for r in ports} >= {("CP ", "No PORT Code (CP)", ""), ("BLT", "POINT", "HWY.")}
    countries = {tuple(r) for r in stage(spark, paths["countries"], STAGED_COUNTRIES).collect()}
    assert countries >= {("687", "TRAILING "), ("245", "ISLES, OUTER")}
    assert stage(spark, paths["states"], STAGED_STATES).count() == 4


def test_many_files_are_many_rows(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"d{i}.txt").write_text(TEXT)
    assert read_dictionaries(spark, str(tmp_path)).count() == 3
