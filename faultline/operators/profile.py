"""Profiles and aggregates; every statistic comes out of one partial aggregation."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.clean import numeric_columns
from faultline.operators.gram import gram, means
from faultline.operators.quantiles import exact_percentiles


def per_column(df: DataFrame, columns: list[str], stats: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Long table (column, stat…): all aggregates in one pass, then unpivoted."""
    wide = df.agg(*[fn(c).alias(f"{c}|{s}") for c in columns for s, fn in stats.items()])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{s}`").alias(s) for s in stats]) for c in columns
    ])))


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def missing_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Counts on the raw values: NaN is both missing and non-finite."""
    columns = columns or df.columns

    def nan(c):
        return F.isnan(c) if _is_float(df, c) else F.lit(False)

    def inf(c, sign):
        return (F.col(c) == F.lit(sign * float("inf"))) if _is_float(df, c) else F.lit(False)

    null = {c: F.col(c).isNull() | F.coalesce(nan(c), F.lit(False)) for c in columns}
    return per_column(df, columns, {
        "total": lambda c: F.count("*"),
        "null_count": lambda c: F.count_if(null[c]),
        "pos_inf": lambda c: F.count_if(inf(c, 1)),
        "neg_inf": lambda c: F.count_if(inf(c, -1)),
        "non_finite": lambda c: F.count_if(nan(c) | inf(c, 1) | inf(c, -1)) if _is_float(df, c) else F.count_if(F.lit(False)),
        "null_pct": lambda c: F.coalesce(F.try_divide(F.count_if(null[c]) * 100.0, F.count("*")), F.lit(0.0)),
    })


def missing_delta(raw: DataFrame, patched: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values before and after; a column absent on a side gives NULLs."""
    shared = [c for c in columns if c in raw.columns and c in patched.columns]
    count = {"n": lambda c: F.count_if(F.col(c).isNull())}
    names = raw.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    before = per_column(raw, shared, count).withColumnRenamed("n", "raw_missing")
    after = per_column(patched, shared, count).withColumnRenamed("n", "patched_missing")
    return names.join(before, "column", "left").join(after, "column", "left").withColumn(
        "reduction", F.col("raw_missing") - F.col("patched_missing")
    )


def missing_flag(df: DataFrame, c: str) -> Column:
    flag = F.col(c).isNull()
    if _is_float(df, c):
        flag = flag | F.isnan(c)
    if isinstance(df.schema[c].dataType, T.StringType):
        flag = flag | (F.col(c) == "")
    return F.coalesce(flag, F.lit(True)).cast("int")


def missing_mask(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, *[missing_flag(df, c).alias(c) for c in columns])


def sparsity(df: DataFrame, columns: list[str], limit: float = 0.4) -> DataFrame:
    mask = missing_mask(df, columns)
    ratio = per_column(mask, columns, {
        "missing": lambda c: F.coalesce(F.sum(c), F.lit(0)),
        "sparsity_ratio": lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 4),
    })
    return ratio.withColumn("status", F.when(F.col("sparsity_ratio") > limit, "OUT").otherwise("IN"))


_NOISE = 2e-16  # a double's rounding, relative to the value that is centred


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson r of all pairs (col_a, col_b, r), pairwise complete, 0 when degenerate.

    One pass for the means, one for the products of the centred values, their
    squares and the presence masks of the columns that hold NULLs.
    """
    total, mean, count = means(df, columns)
    holes = [c for c in columns if count[c] < total]
    value = [F.coalesce(F.col(c).cast("double") - F.lit(mean[c]), F.lit(0.0)) for c in columns]
    masks = [F.col(c).isNotNull().cast("int") for c in holes]
    g = gram(df, [F.lit(1.0), *masks, *value, *[v * v for v in value]])
    present = {c: 1 + holes.index(c) if c in holes else 0 for c in columns}
    x = {c: 1 + len(holes) + i for i, c in enumerate(columns)}
    square = {c: x[c] + len(columns) for c in columns}
    rows = []
    for a in columns:
        for b in columns:
            n = max(g[present[a], present[b]], 1.0)
            sa, sb = g[x[a], present[b]], g[x[b], present[a]]
            va, vb = g[square[a], present[b]] - sa * sa / n, g[square[b], present[a]] - sb * sb / n
            flat = va <= n * (_NOISE * mean[a]) ** 2 or vb <= n * (_NOISE * mean[b]) ** 2  # no more than rounding gives
            rows.append((a, b, 0.0 if flat else float((g[x[a], x[b]] - sa * sb / n) / math.sqrt(va * vb))))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def null_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    return correlation(missing_mask(df, columns), columns)


def adjusted_skew(x: Column | str) -> Column:
    """Bias-corrected sample skewness; NULL below three values."""
    n = F.count(x)
    return F.when(n > 2, F.coalesce(F.skewness(x), F.lit(0.0)) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0)))


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    return per_column(df, columns, {"mean": F.avg, "variance": F.var_pop})


def skew_kurtosis(df: DataFrame, columns: list[str]) -> DataFrame:
    return per_column(df, columns, {
        "skew_pop": F.skewness,
        "kurtosis_excess": F.kurtosis,
        "kurtosis_plain": lambda c: F.kurtosis(c) + 3,
    })


def skew_table(df: DataFrame, columns: list[str]) -> DataFrame:
    return per_column(df, columns, {"skew": adjusted_skew})


def safe_std(x: Column | str) -> Column:
    """Sample deviation; 1 when missing or zero."""
    return F.coalesce(F.nullif(F.stddev_samp(x), F.lit(0.0)), F.lit(1.0))


def long_form(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    stats = per_column(df, columns, {
        "n": F.count, "mean": F.avg, "std": F.stddev_samp,
        "min": lambda c: F.min(F.col(c).cast("double")), "max": lambda c: F.max(F.col(c).cast("double")),
    })
    q = exact_percentiles(long_form(df, columns), ["column"], "value", [0.25, 0.5, 0.75])
    return stats.join(q.select(
        "column", *[F.col("percentiles")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))]
    ), "column", "left")


def boxplot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Median, hinges and whiskers: the outermost values within 1.5 hinge ranges."""
    long = long_form(df, columns).filter("value IS NOT NULL")
    q = exact_percentiles(long, ["column"], "value", [0.25, 0.5, 0.75]).select(
        "column", *[F.col("percentiles")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    fence = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - fence) & (F.col("value") <= F.col("q3") + fence)
    return long.join(F.broadcast(q), "column").groupBy("column", "q1", "median", "q3").agg(  # one row per column
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def daily(df: DataFrame, mean_of: str | None = None) -> DataFrame:
    """One row per calendar day, empty days included: magnitude count, max, mean,
    and either the span in seconds or the mean of ``mean_of``."""
    from faultline.functions.scalar import seconds_between

    extra = (
        F.avg(mean_of).alias(f"{mean_of}_mean") if mean_of
        else seconds_between(F.max("time"), F.min("time")).alias("day_span_s")
    )
    days = df.groupBy(F.to_date("time").alias("day")).agg(
        F.count("mag").alias("mag_count"), F.max("mag").alias("mag_max"), F.avg("mag").alias("mag_mean"), extra
    )
    calendar = df.agg(F.to_date(F.min("time")).alias("a"), F.to_date(F.max("time")).alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day")
    )
    return calendar.join(days, "day", "left").withColumn("mag_count", F.coalesce("mag_count", F.lit(0)))


def fill_numeric(df: DataFrame, columns: list[str] | None = None, filler: str = "mean") -> DataFrame:
    """NULLs become the column mean (one aggregate row read here) or 0."""
    columns = numeric_columns(df, columns)
    if not columns:
        return df
    if filler != "mean":
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in columns if means[c] is not None})


def histogram(df: DataFrame, columns: list[str], bins: int = 30, log: bool = False) -> DataFrame:
    """(column, bin, low, high, n): equal-width, the last bin closed; with ``log``
    over the natural log of the positive values."""
    long = long_form(df, columns).filter("value IS NOT NULL")
    if log:
        long = long.filter("value > 0").withColumn("value", F.log("value"))
    edges = long.groupBy("column").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    width = (F.col("b") - F.col("a")) / bins
    counted = (
        long.join(F.broadcast(edges), "column")  # one row per column
        .withColumn("bin", F.least(
            F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("a"), width)), F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy("column", "bin").agg(F.count("*").alias("n"))
    )
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["column", "bin"], "left").select(
        "column", "bin",
        (F.col("a") + F.col("bin") * width).alias("low"), (F.col("a") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def joint_counts(df: DataFrame, *axes: Column) -> DataFrame:
    return df.groupBy(*axes).agg(F.count("*").alias("n"))
