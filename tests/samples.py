"""Small inputs for the tests."""

from __future__ import annotations

from landfall.schemas import RAW_ARRIVALS, STAGED_COUNTRIES, STAGED_DEMOGRAPHICS, STAGED_PORTS, STAGED_STATES

USUAL = {"cicid": 1.0, "i94yr": 2016.0, "i94mon": 1.0, "i94cit": 101.0, "i94res": 102.0, "i94port": "AAA",
         "arrdate": 20454.0, "i94mode": 1.0, "i94addr": "CA", "depdate": 20460.0, "i94bir": 30.0, "i94visa": 2.0,
         "biryear": 1986.0, "gender": "F", "airline": "XX", "fltno": "001", "visatype": "B2"}


def arrival(**changes) -> dict:
    return {**USUAL, **changes}


def raw(spark, *arrivals):
    return spark.createDataFrame([tuple(a[c] for c in RAW_ARRIVALS.names) for a in arrivals], RAW_ARRIVALS)


def countries(spark):
    return spark.createDataFrame([("101", "ALBANIA"), ("102", "ANDORRA"), ("9X", "NOWHERE")], STAGED_COUNTRIES)


def states(spark):
    return spark.createDataFrame([("ME", "MAINE"), ("OR", "OREGON")], STAGED_STATES)


def ports(spark):
    return spark.createDataFrame(
        [("AAA", "PORTLAND", "ME"), ("BBB", "PORTLAND", "OR"), ("CCC", "LONDON", ""), ("DDD", "SALEM", "OR")],
        STAGED_PORTS)


def demographics(spark):
    rows = [("Portland", "Oregon", None, 1, 2, 600, 4, 5, None, "OR", race, 10) for race in ("White", "Asian")]
    rows += [("Salem", "Oregon", None, 1, 2, 160, 4, 5, None, "OR", "White", 10),
             ("Nowhere", "Oregon", None, 1, 2, 1, 4, 5, None, "OR", "White", 10)]
    return spark.createDataFrame(rows, STAGED_DEMOGRAPHICS)
