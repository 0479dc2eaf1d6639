"""Sums of products of all column pairs in one pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram(df: DataFrame, columns: list[Column]) -> np.ndarray:
    """XᵀX over NULL-free numeric expressions.

    Every task multiplies its Arrow batches and hands on one p×p partial; the
    partials are added by Spark, so only p² sums reach the driver.
    """
    p = len(columns)
    narrow = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def partial(batches):
        total = np.zeros((p, p))
        for batch in batches:
            x = np.column_stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
            total += x.T @ x
        yield pa.record_batch([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["s"])

    sums = (
        narrow.mapInArrow(partial, "s array<double>")
        .select(F.posexplode("s").alias("i", "v"))
        .groupBy("i").agg(F.sum("v").alias("v")).collect()
    )
    out = np.zeros(p * p)
    for r in sums:
        out[r["i"]] = r["v"]
    return out.reshape(p, p)


def means(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, float], dict[str, int]]:
    """Row count, mean and non-NULL count per column."""
    row = df.agg(
        F.count("*").alias("_n"), *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.count(c).alias(f"n_{c}") for c in columns]
    ).first()
    return row["_n"], {c: float(row[f"m_{c}"] or 0.0) for c in columns}, {c: row[f"n_{c}"] for c in columns}
