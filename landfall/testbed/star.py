"""The dimensions over the test tables, written once per session as the warehouse would hold them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from landfall.operators import dims, facts
from landfall.operators.clean import clean_arrivals
from landfall.schemas import RAW_ARRIVALS
from landfall.session import work_path
from landfall.sinks import write_snapshot
from landfall.sizing import row_counts
from landfall.sources.arrivals import ROW_TAG
from landfall.testbed.adapter import Testbed

# What the counting questions read of an arrival: the codes behind its five keys, and its day.
COUNTED = ("i94cit", "i94res", "i94port", "i94mode", "i94visa", "arrdate")


class Star:
    """Dimension tables and their row counts, and the plan (not the rows) of the facts over the arrivals."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.bed = Testbed(spark, sf_dir)
        self._plans: dict[tuple, DataFrame] = {}
        root = work_path(spark, "star")

        def keep(name: str, content: DataFrame) -> DataFrame:
            return write_snapshot(content, f"{root}/{name}")

        self.country = keep("dim_country", dims.dim_country(self.bed.countries()))
        self.states = keep("dim_states", dims.dim_states(self.bed.states()))
        self.ports = keep("dim_ports", dims.dim_ports(self.bed.ports(), self.states))
        self.modes = keep("dim_travelmodes", dims.dim_modes(self.cleaned(["i94mode"])))
        self.visas = keep("dim_visacategories", dims.dim_visas(self.cleaned(["i94visa"])))
        self.time = keep("dim_time", dims.dim_time(self.cleaned(["arrdate", "depdate"])))
        self.types = keep("dim_airporttypes", dims.dim_airport_types(self.bed.airports()))
        self.rows = row_counts({"country": self.country, "states": self.states, "ports": self.ports,
                                "types": self.types, "modes": self.modes, "visas": self.visas, "time": self.time})
        self.lookups = facts.Lookups(self.country, self.ports, self.modes, self.visas, self.rows)

    def _plan(self, make, *key) -> DataFrame:
        if (make, *key) not in self._plans:
            self._plans[(make, *key)] = make(*key)
        return self._plans[(make, *key)]

    def _cleaned(self, columns: tuple[str, ...], tagged: bool) -> DataFrame:
        return clean_arrivals(self.bed.raw_arrivals(columns, tagged), (ROW_TAG,) if tagged else ())

    def _fact(self, columns: tuple[str, ...], tagged: bool) -> DataFrame:
        return facts.fact_rows(self.cleaned(columns, tagged), self.lookups)

    def cleaned(self, columns: Iterable[str] = RAW_ARRIVALS.names, tagged: bool = False) -> DataFrame:
        """Cleaned arrivals as a plan, described once and computed on each use."""
        return self._plan(self._cleaned, tuple(columns), tagged)

    def fact(self, columns: Iterable[str] = RAW_ARRIVALS.names, tagged: bool = False) -> DataFrame:
        """Fact rows, likewise."""
        return self._plan(self._fact, tuple(columns), tagged)

    def demographics(self) -> DataFrame:
        return facts.demographic_rows(self.bed.demographics(), self.ports, port_rows=self.rows["ports"])


_WRITTEN: dict[tuple[str, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        _WRITTEN[key] = Star(spark, sf_dir)
    return _WRITTEN[key]
