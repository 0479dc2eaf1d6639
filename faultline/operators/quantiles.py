"""Exact percentiles by rank, without holding a group's values in one buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.ordered import Ordered, lay_out, running_sum
from faultline.session import small_side


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """(keys…, n, percentiles ARRAY<DOUBLE>) with linear interpolation, NULLs ignored.

    Equal values are counted first (partial aggregation before the shuffle), the
    distinct values are range-sorted, and only rows covering a wanted rank go on.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    return percentiles_of_counts(lay_out(counts, *keys, "_v"), keys, probs)


def percentiles_of_counts(laid: Ordered, keys: list[str], probs: list[float]) -> DataFrame:
    """Percentiles from distinct values ``_v`` with counts ``_n``, laid out by keys and value."""
    if not keys:
        raise ValueError("give at least one key column (a constant will do)")
    ranked = running_sum(laid, "_n", "_end").withColumn("_begin", F.col("_end") - F.col("_n"))
    bounds = ranked.groupBy(*keys).agg(F.min("_begin").alias("_first"), F.max("_end").alias("_last"))
    spans = [f"{float(p)!r}D * (n - 1)" for p in probs]
    wanted = bounds.selectExpr(*keys, "_first", "_last - _first AS n").selectExpr(
        *keys, "_first", "n", *[f"floor({x}) AS lo{i}" for i, x in enumerate(spans)], *[f"ceil({x}) AS hi{i}" for i, x in enumerate(spans)])
    # Plain comparisons pick the few rows that cover a wanted rank; only they are exploded.
    covers = " OR ".join(f"(hi{i} >= b AND lo{i} < e)" for i in range(len(probs)))
    spots = ", ".join(f"struct({i} AS i, lo{i} AS lo, hi{i} AS hi, {x} - lo{i} AS part)" for i, x in enumerate(spans))
    rows = (
        ranked.join(small_side(wanted, "ranks"), keys).withColumns({"b": F.col("_begin") - F.col("_first"), "e": F.col("_end") - F.col("_first")})
        .filter(covers).selectExpr(*keys, "_v", "n", "b", "e", f"inline(array({spots}))")
    )

    def inside(rank: str):
        return (F.col(rank) >= F.col("b")) & (F.col(rank) < F.col("e"))

    per_prob = rows.groupBy(*keys, "n", "i").agg(
        F.max(F.when(inside("lo"), F.col("_v"))).alias("low"), F.max(F.when(inside("hi"), F.col("_v"))).alias("high"),
        F.max("part").alias("part"))
    at = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return per_prob.groupBy(*keys, "n").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", at.alias("v")))), lambda s: s["v"]).alias("percentiles")  # one per prob
    )
