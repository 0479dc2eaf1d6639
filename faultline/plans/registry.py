"""Registry of the queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.plans.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ("cat",)):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql.strip()
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns, so that sums taken in another order compare equal."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`").cast("double"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def r(expr: str, name: str | None = None) -> str:
    """SQL twin of ``rounded``."""
    out = f"round(CAST({expr} AS DOUBLE), 6) + 0.0"
    return f"{out} AS {name}" if name else out


def rs(*names: str) -> str:
    return ", ".join(r(n, n) for n in names)
