"""The model as temporary views, for questions asked in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.plans.dimensions import read_table
from landfall.plans.facts import read_facts
from landfall.schemas import TABLES

# The four standing questions, to be filled in with ``year`` and ``months`` (named parameters of ``spark.sql``).
# The period also bounds ``arrival_date`` through the join with the calendar, which prunes the fact partitions.
_PERIOD = """
    period AS (
      SELECT date_add(DATE'1960-01-01', ts) AS arrival_date FROM dim_time
      WHERE year = :year AND array_contains(:months, month)),
    arrived AS (SELECT f.* FROM fact_immigration f JOIN period p ON f.arrival_date = p.arrival_date)"""

QUESTIONS = {
    "port_and_state": f"""WITH {_PERIOD},
      counted AS (SELECT port_id, count(*) AS immigrant_count FROM arrived GROUP BY port_id)
    SELECT p.port_name, s.state_name, c.immigrant_count
    FROM counted c JOIN dim_ports p ON c.port_id = p.port_id JOIN dim_states s ON p.state_id = s.state_id
    ORDER BY c.immigrant_count DESC, p.port_name, p.port_id""",
    "country": f"""WITH {_PERIOD},
      counted AS (SELECT residence_country_id, count(*) AS count FROM arrived GROUP BY residence_country_id)
    SELECT d.country_name, c.count
    FROM counted c JOIN dim_country d ON c.residence_country_id = d.country_id
    ORDER BY c.count DESC, d.country_name, d.country_id""",
    "purpose": f"""WITH {_PERIOD},
      counted AS (SELECT visa_category_id, count(*) AS count FROM arrived GROUP BY visa_category_id)
    SELECT v.name, c.count
    FROM counted c JOIN dim_visacategories v ON c.visa_category_id = v.visa_category_id
    ORDER BY c.count DESC, v.name""",
    "population": f"""WITH {_PERIOD},
      counted AS (SELECT port_id, count(*) AS arrivals FROM arrived GROUP BY port_id),
      figures AS (
        SELECT city_id, total_population, count(*) AS figures FROM fact_demographics
        GROUP BY city_id, total_population)
    SELECT p.port_name, g.total_population, c.arrivals * g.figures AS immigrant_count, c.arrivals
    FROM counted c JOIN figures g ON c.port_id = g.city_id JOIN dim_ports p ON c.port_id = p.port_id
    ORDER BY immigrant_count DESC, p.port_name, p.port_id, g.total_population""",
}


def register(tables: dict[str, DataFrame]) -> None:
    """Make each table a temporary view of its name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def register_warehouse(spark: SparkSession, warehouse: str) -> None:
    """Every loaded table of the warehouse as a temporary view."""
    tables = {name: read_table(spark, warehouse, name) for name in TABLES if name != "fact_immigration"}
    tables["fact_immigration"] = read_facts(spark, warehouse)
    register({name: df for name, df in tables.items() if df is not None})


def ask(spark: SparkSession, question: str, year: int, months: list[int]) -> DataFrame:
    """One of the standing questions over the registered views."""
    return spark.sql(QUESTIONS[question], args={"year": year, "months": months})
