"""Linear models from Gram statistics: the data is read once, solving is p×p."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.gram import gram, means


@dataclass(frozen=True)
class LinearModel:
    features: list[str]
    weights: list[float]
    intercept: float
    history: tuple[float, ...] = ()

    def predict(self) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.weights):
            out = out + F.col(c) * F.lit(float(w))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [("intercept", float(self.intercept)), *[(c, float(w)) for c, w in zip(self.features, self.weights)]]
        return spark.createDataFrame(rows, "term string, weight double")


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).na.drop("any")


def _centred(df: DataFrame, features: list[str], target: str):
    """Rows, means, and the Gram matrix of centred features and target."""
    rows = _complete(df, [*features, target])
    n, mean, _ = means(rows, [*features, target])
    if n == 0:
        raise ValueError("no complete rows to fit on")
    g = gram(rows, [F.col(c).cast("double") - F.lit(mean[c]) for c in (*features, target)])
    return n, mean, g


def fit_ridge(df: DataFrame, features: list[str], target: str, alpha: float = 1.0) -> LinearModel:
    """Least squares with penalty alpha on the weights, not on the intercept."""
    _, mean, g = _centred(df, features, target)
    p = len(features)
    w = np.linalg.solve(g[:p, :p] + alpha * np.eye(p), g[:p, p])
    return LinearModel(features, w.tolist(), mean[target] - float(sum(mean[c] * x for c, x in zip(features, w))))


def fit_ols(df: DataFrame, features: list[str], target: str, intercept: bool = True) -> LinearModel:
    """Least squares of minimal norm."""
    if not intercept:
        rows = _complete(df, [*features, target])
        g = gram(rows, [F.col(c) for c in (*features, target)])
        w = np.linalg.lstsq(g[:-1, :-1], g[:-1, -1], rcond=None)[0]
        return LinearModel(features, w.tolist(), 0.0)
    _, mean, g = _centred(df, features, target)
    w = np.linalg.lstsq(g[:-1, :-1], g[:-1, -1], rcond=None)[0]
    return LinearModel(features, w.tolist(), mean[target] - float(sum(mean[c] * x for c, x in zip(features, w))))


def _start(p: int, theta0: list[float] | None, seed: int) -> np.ndarray:
    if theta0 is not None:
        return np.asarray(theta0, dtype=float)
    return np.random.default_rng(seed).uniform(-1, 1, p)


def fit_gradient_descent(
    df: DataFrame, features: list[str], target: str, rate: float = 0.001, iterations: int = 50_000,
    tolerance: float = 1e-6, theta0: list[float] | None = None, seed: int = 0,
) -> LinearModel:
    """Batch gradient descent on half the mean squared error.

    The gradient of the whole batch is A·θ − c with A = XᵀX/n and c = Xᵀy/n, so the
    iterates are those of the row form although the rows are read once.
    """
    rows = _complete(df, [*features, target])
    g = gram(rows, [F.lit(1.0), *[F.col(c) for c in features], F.col(target)])
    n = g[0, 0]
    if not n:
        raise ValueError("no complete rows to fit on")
    a, c, s = g[:-1, :-1] / n, g[:-1, -1] / n, g[-1, -1] / n
    theta = _start(len(features) + 1, theta0, seed)
    history: list[float] = []
    for _ in range(iterations):
        theta = theta - rate * (a @ theta - c)
        cost = 0.5 * float(theta @ a @ theta - 2 * c @ theta + s)
        if history and abs(history[-1] - cost) < tolerance:
            break
        history.append(cost)
    return LinearModel(features, theta[1:].tolist(), float(theta[0]), tuple(history))


def fit_sgd(
    df: DataFrame, features: list[str], target: str, rate: float = 0.01, epochs: int = 1000, tolerance: float = 1e-5,
    blocks: int = 32, seed: int = 42, key: str = "idx",
) -> LinearModel:
    """Mini-batch descent over ``blocks`` hashed row blocks, in a seeded order per epoch.

    One pass collects a small Gram matrix per block; the loss is the squared error
    without a penalty, stopped when an epoch no longer improves by ``tolerance``.
    """
    columns = [*features, target]
    rows = df.select(key, *columns).na.drop("any").withColumn("_b", F.pmod(F.xxhash64(F.lit(seed), key), F.lit(blocks)))
    terms = [F.lit(1.0), *[F.col(c).cast("double") for c in columns]]
    size = len(terms)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    sums = rows.groupBy("_b").agg(*[F.sum(terms[i] * terms[j]).alias(f"s{i}_{j}") for i, j in pairs]).orderBy("_b").collect()
    parts = []
    for r in sums:
        g = np.zeros((size, size))
        for i, j in pairs:
            g[i, j] = g[j, i] = r[f"s{i}_{j}"]
        parts.append(g / g[0, 0])
    rng = np.random.default_rng(seed)
    whole, theta, best = sum(parts) / len(parts), np.zeros(size - 1), float("inf")
    history: list[float] = []
    for _ in range(epochs):
        for k in rng.permutation(len(parts)):
            theta = theta - rate * (parts[k][:-1, :-1] @ theta - parts[k][:-1, -1])
        cost = 0.5 * float(theta @ whole[:-1, :-1] @ theta - 2 * whole[:-1, -1] @ theta + whole[-1, -1])
        history.append(cost)
        if best - cost < tolerance:
            break
        best = min(best, cost)
    return LinearModel(features, theta[1:].tolist(), float(theta[0]), tuple(history))


def compare_models(df: DataFrame, models: dict[str, LinearModel], target: str, key: str = "idx") -> DataFrame:
    """Long table (model, key, actual, predicted) over complete rows; one pass."""
    features = sorted({c for m in models.values() for c in m.features})
    return df.select(key, target, *[c for c in features if c != target]).na.drop("any").select(
        key, F.col(target).alias("actual"),
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("model"), m.predict().alias("predicted")) for name, m in models.items()
        ])),
    )


def cost_history(spark: SparkSession, models: dict[str, LinearModel]) -> DataFrame:
    rows = [(name, i, float(c)) for name, m in models.items() for i, c in enumerate(m.history)]
    return spark.createDataFrame(rows, "model string, step int, cost double")
