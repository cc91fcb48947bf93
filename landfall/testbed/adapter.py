"""The test tables in the shape of arrival data.

Orders and line items stand for arrivals, nations for countries, regions for states, suppliers for ports, parts for
airports, customers for city demographics, and events for a second, day-by-day source of arrivals. Some values are
spelled so that the edge cases of real inputs occur: unlisted and non-numeric codes, namesakes, missing states.
No table is cut: every row of the input is used.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import day_number
from landfall.schemas import RAW_ARRIVALS, STAGED_AIRPORTS, STAGED_DEMOGRAPHICS
from landfall.sources import tag_rows
from landfall.sources.arrivals import ROW_TAG


_TABLES: dict[tuple[str, str], DataFrame] = {}


class Testbed:
    """Inputs of the library, built from the tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """The table's scan; listing its files and reading its schema happens once per session."""
        path = f"{self.sf_dir}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _TABLES:
            _TABLES[key] = self.spark.read.parquet(path)
        return _TABLES[key]

    def raw_arrivals(self, columns: Iterable[str] = RAW_ARRIVALS.names, tagged: bool = False) -> DataFrame:
        """One arrival per line item. Columns not requested are null, and the tables behind them are not joined."""
        need = set(columns)
        line = self.table("lineitem")
        if tagged:
            line = tag_rows(line)
        made: dict[str, Column] = {
            "cicid": (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("double"),
            "i94yr": F.year("o_orderdate").cast("double"),
            "i94mon": F.month("o_orderdate").cast("double"),
            "i94cit": F.col("c_nationkey").cast("double"),
            "i94res": F.col("s_nationkey").cast("double"),
            "i94port": F.col("l_suppkey").cast("string"),
            "arrdate": day_number(F.col("o_orderdate")).cast("double"),
            "i94mode": F.col("l_linenumber").cast("double"),
            "i94addr": F.col("n_regionkey").cast("string"),
            "depdate": F.when(F.col("l_returnflag") != "N", day_number(F.col("l_shipdate")).cast("double")),
            "i94bir": F.col("l_quantity"),
            "i94visa": (1 + F.col("l_partkey") % 4).cast("double"),
            "biryear": F.year("o_orderdate") - F.col("l_quantity"),
            "gender": F.col("l_linestatus"),
            "airline": F.col("p_brand"),
            "fltno": F.col("l_partkey").cast("string"),
            "visatype": F.substring("o_orderpriority", 1, 1),
        }
        if need & {"i94yr", "i94mon", "i94cit", "arrdate", "i94addr", "biryear", "visatype"}:
            line = line.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        if need & {"i94cit", "i94addr"}:
            line = line.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        if "i94addr" in need:
            line = line.join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        if "i94res" in need:
            line = line.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        if "airline" in need:
            line = line.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return line.select(*[(made[f.name] if f.name in need else F.lit(None).cast(f.dataType)).alias(f.name)
                             for f in RAW_ARRIVALS], *([ROW_TAG] if tagged else []))

    def event_arrivals(self) -> DataFrame:
        """One arrival per event: thirty days with travel by air and sea only."""
        day = day_number(F.col("ts"))
        user, event = F.col("user_id"), F.col("event_id")
        made: dict[str, Column] = {
            "cicid": event.cast("double"),
            "i94yr": F.year("ts").cast("double"),
            "i94mon": F.month("ts").cast("double"),
            "i94cit": (user % 25).cast("double"),
            "i94res": (event % 27).cast("double"),
            "i94port": (user % 120).cast("string"),
            "arrdate": day.cast("double"),
            "i94mode": (1 + event % 2).cast("double"),
            "i94addr": (user % 5).cast("string"),
            "depdate": F.when(F.col("event_type") != "error", (day + user % 20).cast("double")),
            "i94bir": F.floor("value").cast("double"),
            "i94visa": (1 + event % 3).cast("double"),
            "biryear": (F.year("ts") - F.floor("value")).cast("double"),
            "gender": F.upper(F.substring("event_type", 1, 1)),
            "airline": F.concat(F.lit("A"), (event % 7).cast("string")),
            "fltno": user.cast("string"),
            "visatype": F.substring("event_type", 1, 2),
        }
        return self.table("events").select(*[made[c].alias(c) for c in RAW_ARRIVALS.names])

    def countries(self) -> DataFrame:
        """Some codes are no numbers, so arrivals from there are rejected."""
        key = F.col("n_nationkey").cast("string")
        return self.table("nation").select(
            F.when(F.col("n_nationkey") % 10 == 9, F.concat(F.lit("X"), key)).otherwise(key).alias("country_code"),
            F.col("n_name").alias("country_name"))

    def states(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("string").alias("state_code"), F.col("r_name").alias("state_name"))

    def ports(self) -> DataFrame:
        """Two ports in ten share a name; one in seven has no state."""
        key = F.col("s_suppkey")
        named = F.when(key % 10 == 1, key - 1).otherwise(key)
        located = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return located.select(
            key.cast("string").alias("port_code"),
            F.concat(F.lit("SUPPLIER#"), F.lpad(named.cast("string"), 9, "0")).alias("port_name"),
            F.when(key % 7 == 0, "").otherwise(F.col("n_regionkey").cast("string")).alias("state_code"))

    def airports(self, tagged: bool = False) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        part = tag_rows(self.table("part")) if tagged else self.table("part")
        made: dict[str, Column] = {
            "ident": key.cast("string"),
            "type": F.col("p_type"),
            "name": F.col("p_name"),
            "elevation_ft": (size * 10).cast("decimal(18,0)"),
            "continent": F.lit("NA"),
            "iso_country": F.when(size % 3 == 0, "CA").otherwise("US"),
            "iso_region": F.concat(F.when(size % 11 == 0, "US").otherwise("US-"), (size % 6).cast("string")),
            "municipality": F.col("p_brand"),
            "gps_code": F.concat(F.lit("K"), key.cast("string")),
            "iata_code": F.when(size % 4 != 0, F.concat(F.lit("I"), (key % 1000).cast("string"))),
            "local_code": (key % 100).cast("string"),
            "coordinates": F.concat(size.cast("string"), F.lit(", "), (key % 90).cast("string")),
        }
        return part.select(*[made[c].alias(c) for c in STAGED_AIRPORTS.names], *([ROW_TAG] if tagged else []))

    def demographics(self, tagged: bool = False) -> DataFrame:
        """A dozen customers per city; the last cities have no port."""
        key = F.col("c_custkey")
        customer = tag_rows(self.table("customer")) if tagged else self.table("customer")
        made: dict[str, Column] = {
            "city": F.concat(F.lit("Supplier#"), F.lpad(F.floor(key / 12).cast("string"), 9, "0")),
            "state": F.concat(F.lit("State "), (key % 5).cast("string")),
            "median_age": ((key % 500 + 200) / F.lit(10)).cast("decimal(5,2)"),
            "male_population": (key % 1000).cast("int"),
            "female_population": (key % 777).cast("int"),
            "total_population": F.col("c_acctbal").cast("int"),
            "veterans": (key % 50).cast("int"),
            "foreign_born": (key % 91).cast("int"),
            "avg_household_size": ((key % 300 + 100) / F.lit(100)).cast("decimal(5,2)"),
            "state_code": (key % 5).cast("string"),
            "race": F.col("c_mktsegment"),
            "count": (F.col("c_nationkey") * 10).cast("int"),
        }
        return customer.select(*[made[c].alias(c) for c in STAGED_DEMOGRAPHICS.names],
                               *([ROW_TAG] if tagged else []))

    def dictionaries(self) -> DataFrame:
        """Code dictionaries rendered as text, ``source`` and ``text``.

        A dictionary lists at most ``DICTIONARY_LINES`` codes, so their number grows with the data and their size
        does not. Lines show what hand-kept dictionaries show: padding, tabs, doubled quotes, codes with an inner
        blank, labels with several commas or none, and a long-winded first country.
        """
        n, s, r = F.col("n_nationkey"), F.col("s_suppkey"), F.col("r_regionkey")
        country_label = F.when(n % DICTIONARY_LINES == 0, F.concat("n_name", F.lit(" Air Sea, and Not Reported"))) \
            .otherwise(F.concat("n_name", F.lit(" ("), F.col("n_regionkey").cast("string"), F.lit(")")))
        countries = self.table("nation").select(
            n.alias("key"), F.lit("countries").alias("kind"),
            F.concat(F.lit("   "), n.cast("string"), F.lit(" =  '"), country_label, F.lit("'")).alias("line"))
        states = self.table("region").select(
            r.alias("key"), F.lit("states").alias("kind"),
            F.concat(F.lit("\t'"), r.cast("string"), F.lit("'\t="), F.lit("'"), F.col("r_name"),
                     F.lit(" '")).alias("line"))
        located = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == n)
        region = F.col("n_regionkey").cast("string")
        label = (F.when(s % 11 == 0, F.concat(F.lit("PACIFIC, HWY. "), "s_name", F.lit(", "), region))
                 .when(s % 7 == 0, F.concat(F.col("s_name"), F.lit(" AREA  ")))
                 .when(s % 13 == 0, F.concat(F.lit("INT''L "), "s_name", F.lit(","), region, F.lit(" (BPS)")))
                 .otherwise(F.concat(F.col("s_name"), F.lit(", "), region, F.lit("     "))))
        code = F.when(s % 5 == 0, F.concat(s.cast("string"), F.lit(" "))).otherwise(s.cast("string"))
        ports = located.select(
            s.alias("key"), F.lit("ports").alias("kind"),
            F.concat(F.lit("   '"), code, F.lit("'\t=\t'"), label, F.lit("'")).alias("line"))
        opening = (F.when(F.col("kind") == "countries", "  value i94cntyl")
                   .when(F.col("kind") == "states", "value i94addrl").otherwise("  value $i94prtl"))
        lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "line"))),
                                         lambda x: x["line"]), "\n")
        texts = (countries.unionByName(states).unionByName(ports)
                 .withColumn("shelf", F.floor(F.col("key") / DICTIONARY_LINES))
                 .groupBy("kind", "shelf").agg(lines.alias("lines")))
        closing = F.when(F.col("kind") == "ports", F.lit("\n;\n\nrun ;")).otherwise(F.lit(" ;\n\nrun ;"))
        return texts.select(
            F.concat_ws("-", "kind", F.col("shelf").cast("string")).alias("source"),
            F.concat(F.lit("proc format library=library ;\n\n/* codes */\n"), opening, F.lit("\n"), "lines",
                     closing).alias("text"))


DICTIONARY_LINES = 250
