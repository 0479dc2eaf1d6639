"""Embeddings as rows of integers: floor(scale * component), packed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import written


def integer_vectors(df: DataFrame, vector: str, scale: int, limit: int, keep: list[str]) -> tuple[DataFrame, int]:
    """(``keep``…, x) and the number of components: x holds floor(scale * component) as little-endian 64-bit integers.

    Rows whose vector is NULL, or holds a NULL or non-finite component, are left out. All vectors must have one length; where
    a table mixes lengths, those of the commonest one (the larger at a tie) are taken, the others are left out. A component
    whose integer would reach ``limit`` ends the job with a ValueError, as sums beyond 64 bits would be wrong.
    """
    values = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(*[F.col(f"`{c}`") for c in keep], values.alias("x"))
    fine = rows.filter(F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    common = fine.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dims = common["n"] if common else 0

    def run(batches):
        for batch in batches:
            x = np.floor(batch.column("x").flatten().to_numpy().reshape(batch.num_rows, dims) * scale)
            if x.size and np.abs(x).max() >= limit:
                raise ValueError(f"a component of {vector} times {scale} reaches {limit}")
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], _packed(x.astype("<i8"))], names=[*keep, "x"])

    schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keep)
    return written(fine.filter(F.size("x") == dims).mapInArrow(run, f"{schema}x binary"), "vectors"), dims


def _packed(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * 8)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def matrices(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches, and their vectors as rows of a matrix."""
    for batch in batches:
        if batch.num_rows:
            column = batch.column("x").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if dims else b""
            yield batch, np.frombuffer(data, "<i8").reshape(batch.num_rows, dims)
