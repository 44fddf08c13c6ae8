"""Helpers for functions that map Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROWS = 512


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is built from one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def lists_of(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one array for each row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def add_columns(
    df: DataFrame,
    source: str,
    fields: list[T.StructField],
    compute: Callable[[pa.Array], list[pa.Array]],
) -> DataFrame:
    """`df` with columns computed from column `source`, batch by batch.

    A column of `df` that bears one of the new names (in any case) is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    keep = [f.name for f in kept]

    def run(batches):
        for batch in slices(batches):
            made = compute(batch.column(source))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), *made], [*keep, *(f.name for f in fields)]
            )

    wanted = keep if source in keep else [*keep, source]
    return df.select(*(f"`{n}`" for n in wanted)).mapInArrow(run, T.StructType([*kept, *fields]))


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal values in the columns `names` (whole numbers), also
    where a run goes on in the next batch."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
        starts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            if held and tuple(ids[start]) != now:
                yield pa.Table.from_batches(held)
                held = []
            now = tuple(ids[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
