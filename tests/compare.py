"""Run the registered queries next to their SQL: ``python -m tests.compare [sf] [query ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_by_name(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "DATE": "date",
          "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns, types and rows agree; else what differs."""
    relation = con.sql(sql)
    wanted_types = {c: _KINDS.get(str(t), str(t).lower()) for c, t in zip(relation.columns, relation.types)}
    found_types = dict(df.dtypes)
    if wanted_types != found_types:
        both = set(wanted_types) | set(found_types)
        return "schema: " + ", ".join(f"{c} {found_types.get(c)} != {wanted_types.get(c)}" for c in sorted(both)
                                      if wanted_types.get(c) != found_types.get(c))
    wanted = rows_by_name(relation.columns, relation.fetchall())
    found = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    if wanted == found:
        return None
    return (f"rows: {sum(found.values())} != {sum(wanted.values())}; "
            f"only ours {list((found - wanted).items())[:3]}; only SQL {list((wanted - found).items())[:3]}")


def main() -> int:
    import __spark_entry__ as spark_entry
    from landfall.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), spark_entry.oracle_sql(), 0
    for name, run in spark_entry.queries().items():
        if (sys.argv[2:] and name not in sys.argv[2:]) or name not in oracles:
            continue
        start = time.time()
        try:
            found = difference(run(spark, sf_dir), con, oracles[name])
        except Exception as error:  # report every query, whatever it raises
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
