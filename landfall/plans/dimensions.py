"""The dimension pipeline: stage five files, refresh six tables in dependency order, then check them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall import schemas
from landfall.operators import dims, facts
from landfall.operators.quality import Check, dimension_checks, enforce, evaluate
from landfall.session import scratch
from landfall.sinks import read_snapshot, write_snapshot
from landfall.sources import stage, tag_rows
from landfall.sources.staging import CORRUPT


@dataclass(frozen=True)
class DimensionFiles:
    """Where the staged CSV files lie.

    ``multiline`` says that airports or demographics have line breaks within quotes. Each of their files is then parsed
    by one task; without it Spark splits large files.
    """

    countries: str
    states: str
    ports: str
    airports: str
    demographics: str
    multiline: bool = False


def table(warehouse: str, name: str) -> str:
    return f"{warehouse}/{name}"


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame | None:
    """A full-refresh table's newest content, None before its first load."""
    return read_snapshot(spark, table(warehouse, name), schemas.TABLES[name])


def staged_ports(ports: DataFrame) -> DataFrame:
    """A port without state has an empty field in the file, which reads back as null."""
    return ports.withColumn("state_code", F.coalesce("state_code", F.lit("")))


# Name, CSV separator and schema of the two files that come from elsewhere.
DELIVERED = (("airports", ",", schemas.STAGED_AIRPORTS), ("demographics", ";", schemas.STAGED_DEMOGRAPHICS))


def staging_report(spark: SparkSession, files: DimensionFiles) -> DataFrame:
    """Per delivered file, how many records have a field that does not parse, or too few or many fields."""
    checks, staged = [], {}
    for name, sep, schema in DELIVERED:
        # The parser only looks at columns that are asked for, so the condition names them all.
        whole = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.names])) >= 0
        checks.append(Check(f"Records of {name} that do not parse", name,
                            F.count_if(F.col(CORRUPT).isNotNull() & whole), ">= 0"))
        staged[name] = stage(spark, getattr(files, name), schema, sep=sep, keep_corrupt=True, multiline=files.multiline)
    return evaluate(checks, staged)


def build_dimensions(spark: SparkSession, files: DimensionFiles, warehouse: str) -> DataFrame:
    """Refresh the static dimensions and the demographics; return the check report after enforcing it.

    States load before ports and ports before demographics, which read them. Every table is written and read back
    before the next one uses it, so later joins see its real size. Members keep their keys. The report also counts the
    records of the delivered files that do not parse; what does not is loaded as null.
    """
    def refresh(name: str, content: DataFrame) -> DataFrame:
        return write_snapshot(content, table(warehouse, name))

    def current(name: str) -> DataFrame | None:
        return read_table(spark, warehouse, name)

    countries = stage(spark, files.countries, schemas.STAGED_COUNTRIES)
    states = stage(spark, files.states, schemas.STAGED_STATES)
    ports = staged_ports(stage(spark, files.ports, schemas.STAGED_PORTS))
    airports = tag_rows(stage(spark, files.airports, schemas.STAGED_AIRPORTS, multiline=files.multiline))
    demographics = tag_rows(stage(spark, files.demographics, schemas.STAGED_DEMOGRAPHICS, sep=";", multiline=files.multiline))

    tables = {}
    tables["dim_country"] = refresh("dim_country", dims.dim_country(countries, current("dim_country")))
    tables["dim_states"] = refresh("dim_states", dims.dim_states(states, current("dim_states")))
    tables["dim_ports"] = refresh(
        "dim_ports", dims.dim_ports(ports, tables["dim_states"], current("dim_ports")))
    tables["dim_airporttypes"] = refresh(
        "dim_airporttypes", dims.dim_airport_types(airports, current("dim_airporttypes")))
    tables["dim_airports"] = refresh(
        "dim_airports", dims.dim_airports(airports, tables["dim_airporttypes"], tables["dim_states"]))
    with scratch(spark, "demographics") as path:
        tables["fact_demographics"] = refresh(
            "fact_demographics", facts.fact_demographics(demographics, tables["dim_ports"], path=path))
    report = evaluate(dimension_checks(), tables).unionByName(staging_report(spark, files))
    enforce(report)
    return report
