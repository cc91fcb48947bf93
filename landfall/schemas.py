"""Schemas of the raw, staged and model tables, with the constraints the model declares.

Column names, types and order are fixed values: staged files land by position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType(),
          "date": DateType(), "ratio": DecimalType(5, 2), "degrees": DecimalType(10, 3), "feet": DecimalType(18, 0)}


def columns(listing: str) -> StructType:
    """A schema from ``name type, name type, ...``; unlike a DDL string it needs no running session."""
    schema = StructType()
    for column in listing.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema

RAW_ARRIVALS = columns("""
    cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, arrdate double,
    i94mode double, i94addr string, depdate double, i94bir double, i94visa double, biryear double, gender string,
    airline string, fltno string, visatype string""")

LAKE_KEYS = ("year", "month", "arrival_day")

STAGED_ARRIVALS = columns("""
    cicid double, arrdate double, arrival_date date, i94cit int, i94res int, i94port string, travel_mode string,
    i94addr string, depdate double, departure_date date, i94bir int, visa_category string, biryear int,
    gender string, airline string, fltno string, visatype string""")

LAKE_ARRIVALS = columns("year int, month int, arrival_day int")
for _field in STAGED_ARRIVALS:
    LAKE_ARRIVALS.add(_field)

STAGED_COUNTRIES = columns("country_code string, country_name string")
STAGED_STATES = columns("state_code string, state_name string")
STAGED_PORTS = columns("port_code string, port_name string, state_code string")
STAGED_DEMOGRAPHICS = columns("""
    city string, state string, median_age ratio, male_population int, female_population int,
    total_population int, veterans int, foreign_born int, avg_household_size ratio, state_code string,
    race string, count int""")
STAGED_AIRPORTS = columns("""
    ident string, type string, name string, elevation_ft feet, continent string, iso_country string,
    iso_region string, municipality string, gps_code string, iata_code string, local_code string,
    coordinates string""")
STAGED_TEMPERATURES = columns("""
    dt string, average_temperature degrees, average_temperature_uncertainty degrees, city string,
    country string, latitude string, longitude string""")

# The model. Keys are BIGINT throughout, as the facts can outgrow INT.
TABLES = {
    "dim_country": columns("country_id bigint, country_code string, country_name string"),
    "dim_states": columns("state_id bigint, state_code string, state_name string"),
    "dim_ports": columns("port_id bigint, state_id bigint, port_code string, port_name string"),
    "dim_travelmodes": columns("travel_mode_id bigint, mode string"),
    "dim_visacategories": columns("visa_category_id bigint, name string"),
    "dim_airporttypes": columns("airport_type_id bigint, airport_type string"),
    "dim_time": columns("ts int, year int, month int, day int"),
    "dim_airports": columns("""
        airport_id bigint, airport_name string, airport_type_id bigint, state_id bigint, continent string,
        elevation_ft int, municipality string, gps_code string, iata_code string, local_code string,
        coordinates string"""),
    "fact_demographics": columns("""
        demographics_id bigint, city_id bigint, median_age ratio, male_population int, female_population int,
        total_population int, veterans int, foreign_born int, avg_household_size ratio, race string, count int"""),
    "fact_immigration": columns("""
        immigration_id bigint, cicid double, citizenship_country_id bigint, residence_country_id bigint,
        port_id bigint, arrival_date date, arrdate double, departure_date date, depdate double,
        travel_mode_id bigint, age int, gender string, visa_category_id bigint, visatype string, airline string,
        fltno string"""),
}
FACT_ARRIVALS = tuple(TABLES["fact_immigration"].names)
FACT_DEMOGRAPHICS = tuple(TABLES["fact_demographics"].names)


@dataclass(frozen=True)
class Constraints:
    """What the model declares about one table; files do not enforce it, so quality queries report it."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()  # (column, referenced table, referenced column)


# The declared keys, lengths and references of the model.
MODEL = {
    "dim_country": Constraints(
        unique=("country_id", "country_code", "country_name"),
        not_null=("country_code", "country_name"),
        max_length=(("country_code", 3), ("country_name", 100))),
    "dim_states": Constraints(
        unique=("state_id", "state_code", "state_name"),
        not_null=("state_code", "state_name"),
        max_length=(("state_code", 2), ("state_name", 100))),
    "dim_ports": Constraints(
        unique=("port_id", "port_code", "port_name"),
        not_null=("port_code",),
        max_length=(("port_code", 3), ("port_name", 100)),
        references=(("state_id", "dim_states", "state_id"),)),
    "dim_travelmodes": Constraints(
        unique=("travel_mode_id",), not_null=("mode",), max_length=(("mode", 25),)),
    "dim_visacategories": Constraints(
        unique=("visa_category_id",), not_null=("name",), max_length=(("name", 50),)),
    "dim_airporttypes": Constraints(
        unique=("airport_type_id",), not_null=("airport_type",), max_length=(("airport_type", 50),)),
    "dim_time": Constraints(unique=("ts",), not_null=("ts", "year", "month", "day")),
    "dim_airports": Constraints(
        unique=("airport_id",),
        max_length=(("airport_name", 200), ("continent", 50), ("municipality", 100), ("gps_code", 25),
                    ("iata_code", 25), ("local_code", 25), ("coordinates", 256)),
        references=(("airport_type_id", "dim_airporttypes", "airport_type_id"),
                    ("state_id", "dim_states", "state_id"))),
    "fact_demographics": Constraints(
        unique=("demographics_id",), max_length=(("race", 100),),
        references=(("city_id", "dim_ports", "port_id"),)),
    "fact_immigration": Constraints(
        unique=("immigration_id",), not_null=("arrival_date", "arrdate"),
        max_length=(("gender", 1), ("visatype", 10), ("airline", 5), ("fltno", 10)),
        references=(("citizenship_country_id", "dim_country", "country_id"),
                    ("residence_country_id", "dim_country", "country_id"),
                    ("port_id", "dim_ports", "port_id"),
                    ("travel_mode_id", "dim_travelmodes", "travel_mode_id"),
                    ("visa_category_id", "dim_visacategories", "visa_category_id"))),
}
