"""Small helpers for ``mapInArrow``: bounded slices of a batch, row-wise annotation, model broadcast."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

SLICE_BYTES = 2 << 20
SLICE_ROWS = 1024


def fields(ddl: str) -> list[StructField]:
    """The fields of a DDL string, such as ``"n_words bigint, kept boolean"``."""
    return _parse_datatype_string(ddl).fields


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES,
           rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive slices of one to ``rows`` rows whose ``column`` holds, beside the first row's, less than
    ``limit`` bytes. Work per slice may thus hold a table of rows by features also where texts are short."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    cut = np.cumsum(sizes, dtype=np.int64) // limit
    starts = np.flatnonzero((np.diff(cut, prepend=-1) != 0) | (np.arange(batch.num_rows) % rows == 0))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(start), int(end - start))


def values(batch: pa.RecordBatch, column: str, empty):
    """The column as a Python list, nulls as ``empty``."""
    return [empty if x is None else x for x in batch.column(column).to_pylist()]


def annotate(df: DataFrame, column: str, added: str, make: Callable[[], Callable[[pa.RecordBatch], dict]],
             keep: str | None = None) -> DataFrame:
    """``df`` with new columns that depend on each row's ``column`` alone, in one pass without a shuffle.

    ``make()`` runs once per task and returns a function from a slice to the new columns' arrays. Columns of ``df``
    that have the name of a new one are replaced. ``keep`` names a boolean among the new columns: rows where it is
    false are dropped, and none of the new columns is returned.
    """
    new = fields(added)
    names = {f.name.lower() for f in new}
    old = df.schema.fields if keep else [f for f in df.schema.fields if f.name.lower() not in names]
    at = [df.columns.index(f.name) for f in old]
    schema = StructType(old if keep else [*old, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, column):
                made = work(part)
                arrays = [part.column(i) for i in at]
                if keep:
                    out = pa.RecordBatch.from_arrays(arrays, names=[f.name for f in old])
                    yield out.filter(pa.array(made[keep], pa.bool_()))
                else:
                    arrays += [x if isinstance(x := made[f.name], pa.Array) else pa.array(x) for f in new]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)
