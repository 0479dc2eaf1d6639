"""Filling missing measurements: weighted neighbours, then a ridge on the log target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.clean import DEFAULT_IMPUTE_COLUMNS, numeric_columns
from faultline.operators.features import fit_zscore, frequent_labels, hybrid_onehot
from faultline.operators.joins import fill_from
from faultline.operators.knn import nearest
from faultline.operators.linear import LinearModel, fit_ridge
from faultline.operators.profile import safe_std
from faultline.operators.windows import split_stratified
from faultline.session import written

GEO = ("latitude", "longitude")
RIDGE_FEATURES = ("latitude", "longitude", "gap", "rms")


@dataclass(frozen=True)
class NeighbourOptions:
    columns: tuple[str, ...] = DEFAULT_IMPUTE_COLUMNS
    k: int = 5
    geo_weight: float = 1.0
    other_weight: float = 0.4
    scale: str = "full"   # deviation the predicted rows are scaled by: "full" table or "train"

    def weight(self, c: str) -> float:
        return self.geo_weight if c in GEO else self.other_weight


def _std(df: DataFrame, columns: tuple[str, ...]) -> dict[str, float]:
    row = df.agg(*[safe_std(c).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def _scaled(df: DataFrame, o: NeighbourOptions, std: dict[str, float], keep: list[Column]) -> DataFrame:
    return df.select(*keep, *[(F.col(c) / F.lit(std[c]) * F.lit(o.weight(c))).alias(c) for c in o.columns])


def weighted_mean() -> Column:
    """Inverse-distance mean of (distance, value); exact hits take all."""
    hit = F.avg(F.when(F.col("distance") == 0, F.col("value")))
    inverse = F.try_divide(F.lit(1.0), F.col("distance"))
    return F.coalesce(hit, F.try_divide(F.sum(inverse * F.col("value")), F.sum(inverse)))


def neighbour_values(
    train: DataFrame, pred: DataFrame | None, target: str, o: NeighbourOptions = NeighbourOptions(), full: DataFrame | None = None
) -> DataFrame:
    """(idx, target) for rows that lack the target.

    Donors are training rows that have it. Predicted rows are scaled by the full
    table's deviation (or the training one), and their values scaled back by it.
    """
    std = _std(train, o.columns)
    others = [c for c in o.columns if c != target]
    donors = _scaled(train.filter(F.col(target).isNotNull()), o, std, [F.col("idx"), F.col(target).alias("raw")])
    mean = train.agg(F.avg(target)).first()[0]

    def wanted(df: DataFrame, own: dict[str, float]) -> DataFrame:
        back = F.lit(own[target] / std[target]).alias("back")
        return _scaled(df.filter(F.col(target).isNull()), o, own, [F.col("idx"), back])

    asked = wanted(train, std)
    if pred is not None:
        whole = train.unionByName(pred) if full is None else full
        asked = asked.unionByName(wanted(pred, _std(whole, o.columns) if o.scale == "full" else std))
    near = nearest(asked, donors, others, o.k, "raw", width=len(o.columns))
    values = near.groupBy("idx").agg(weighted_mean().alias("v"))
    return asked.select("idx", "back").join(values, "idx", "left").select(
        "idx", (F.coalesce("v", F.lit(mean)) * F.col("back")).alias(target))


def train_pred(df: DataFrame, seed: str = "42", shuffle: bool = True) -> tuple[DataFrame, DataFrame]:
    """80/20, stratified by a missing gap when there is a gap column."""
    stratum = F.col("gap").isNull() if "gap" in df.columns else None
    parts = written(split_stratified(df, stratum, seed=seed, shuffle=shuffle))
    return parts.filter("part = 'train'").drop("part"), parts.filter("part = 'pred'").drop("part")


def impute_numeric(df: DataFrame, columns: list[str] | None = None, k: int = 5, shuffle: bool = True, **options) -> DataFrame:
    """Every NULL in the chosen numeric columns filled by neighbours."""
    chosen = numeric_columns(df, list(columns or DEFAULT_IMPUTE_COLUMNS))
    if not chosen:
        return df
    o = NeighbourOptions(tuple(chosen), k, **options)
    train, pred = train_pred(df, shuffle=shuffle)
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in chosen]).first()
    out = df.withColumns({c: F.col(c).cast("double") for c in chosen})
    for c in chosen:
        if missing[c]:
            out = fill_from(out, neighbour_values(train, pred, c, o))
    return out


def ridge_fill(df: DataFrame, alpha: float = 1.0, inverse: str = "exp", target: str = "dmin") -> tuple[DataFrame, LinearModel]:
    """NULL targets from a ridge on log(target + 1); the inverse is exp (or expm1)."""
    features = list(RIDGE_FEATURES)
    absent = [c for c in (*features, target) if c not in df.columns]
    if absent:
        raise ValueError(f"ridge imputation lacks {absent}")
    model = fit_ridge(df.withColumn("_log", F.log(F.col(target) + 1)), features, "_log", alpha)
    back = F.exp(model.predict()) if inverse == "exp" else F.expm1(model.predict())
    return df.withColumn(target, F.coalesce(F.col(target), back)), model


def impute_and_regress(df: DataFrame, k: int = 5, alpha: float = 1.0, shuffle: bool = True, **options) -> dict:
    """Neighbours for gap, ridge for dmin; the filled table and its pieces."""
    columns = tuple(numeric_columns(df, list(DEFAULT_IMPUTE_COLUMNS)))
    if not columns:
        raise ValueError("none of the imputation columns is numeric")
    train, pred = train_pred(df, shuffle=shuffle)
    gap = written(neighbour_values(train, pred, "gap", NeighbourOptions(columns, k, **options)))
    filled = fill_from(df, gap)
    final, model = ridge_fill(filled, alpha)
    return {"gap": gap, "filled": filled, "model": model, "final": final}


def dmin_regression_table(df: DataFrame, gap: DataFrame) -> DataFrame:
    """Gap patched, cube roots of the double features, one-hot labels, z-scores
    fitted on rows with dmin; ``part`` says whether dmin is known."""
    from faultline.functions.scalar import safe_cbrt
    from pyspark.sql import types as T

    filled = fill_from(df, gap)
    doubles = [f.name for f in filled.schema if isinstance(f.dataType, T.DoubleType) and f.name != "dmin"]
    rooted = filled.withColumns({c: safe_cbrt(F.col(c)) for c in doubles})
    parts = hybrid_onehot(rooted, labels=frequent_labels(rooted)).withColumn(
        "part", F.when(F.col("dmin").isNotNull(), "train").otherwise("pred"))
    return fit_zscore(parts.filter("part = 'train'"), doubles).transform(parts)
