"""Scores of predictions, each from one aggregate row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _residual(actual: str, predicted: str) -> Column:
    return F.col(actual) - F.col(predicted)


def r2_expr(actual: str, predicted: str) -> Column:
    """1 − residual/total; NULL for 0/0."""
    total = F.var_pop(actual) * F.count(actual)
    rest = F.sum(_residual(actual, predicted) ** 2)
    return F.when(total > 0, F.lit(1.0) - F.try_divide(rest, total))


def r2_guarded_expr(actual: str, predicted: str) -> Column:
    """Constant actuals score 1 when hit exactly, else 0."""
    rest = F.sum(_residual(actual, predicted) ** 2)
    return F.coalesce(r2_expr(actual, predicted), F.when(rest == 0, 1.0).otherwise(0.0))


def r2_score(df: DataFrame, actual: str, predicted: str) -> float:
    """Guarded score; empty input and non-finite values are errors."""
    def bad(c):
        return F.count_if(F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    row = df.agg(
        F.count("*").alias("n"), bad(actual).alias("bad_a"), bad(predicted).alias("bad_p"),
        r2_guarded_expr(actual, predicted).alias("r2"),
    ).first()
    if row["n"] == 0:
        raise ValueError("no rows to score")
    if row["bad_a"] or row["bad_p"]:
        raise ValueError("non-finite or missing values")
    return row["r2"]


def regression_exprs(actual: str, predicted: str, swap: bool = False) -> dict[str, Column]:
    """MAE, RMSE, half-MSE cost and R². ``swap`` scores R² with the arguments exchanged."""
    if swap:
        actual, predicted = predicted, actual
    e = _residual(actual, predicted)
    return {
        "mae": F.avg(F.abs(e)),
        "rmse": F.sqrt(F.avg(e * e)),
        "half_mse": F.avg(e * e) / 2,
        "r2": r2_expr(actual, predicted),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: tuple[str, ...] = (), swap: bool = False) -> DataFrame:
    stats = [c.alias(n) for n, c in regression_exprs(actual, predicted, swap).items()]
    return df.groupBy(*by).agg(F.count("*").alias("n"), *stats) if by else df.agg(F.count("*").alias("n"), *stats)


def huber_expr(actual: str, predicted: str, delta: float = 1.0) -> Column:
    e = F.abs(_residual(actual, predicted))
    return F.avg(F.when(e <= delta, 0.5 * e * e).otherwise(delta * (e - 0.5 * delta)))
