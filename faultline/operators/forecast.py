"""Recursive hourly forecasts of many series at once, and scored test sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.features import Scale, fit_minmax
from faultline.operators.gram import means
from faultline.operators.linear import LinearModel
from faultline.operators.ordered import CHUNK, ranges

TARGETS = ("mag", "dmin", "rms")


WINDOWS = 4_096  # rows whose windows are multiplied at once


def lagged_rows(df: DataFrame, series: str, targets: tuple[str, ...], lags: int) -> DataFrame:
    """(chunk, series, own, targets…) in the order of each series within its chunk. A chunk's own rows follow copies of the
    ``lags`` rows before them, so that a pass over a partition meets every window without any being written out."""
    cut = ranges(df.select("idx", "time", series, *targets), series, "time", "idx")
    rows = cut.framed(before=lags).repartition(CHUNK, series).sortWithinPartitions(CHUNK, series, "time", "idx")
    return rows.select(CHUNK, F.col(series).alias("series"), (F.col("_home") == F.col(CHUNK)).alias("own"), *[F.col(t).cast("double").alias(t) for t in targets])


def _begins(chunk: np.ndarray, series: pa.Array) -> np.ndarray:
    """Whether a row's chunk or series is another than the row's before it; NULLs are one series."""
    here, before = series.slice(1), series.slice(0, len(series) - 1)
    other = pc.or_(pc.fill_null(pc.not_equal(here, before), False), pc.not_equal(pc.is_null(here), pc.is_null(before)))
    return np.r_[True, (chunk[1:] != chunk[:-1]) | other.to_numpy(zero_copy_only=False)]


def _windows(batches, targets: tuple[str, ...], lags: int, repeat_oldest: bool):
    """(windows, targets) of the own rows of ``lagged_rows`` that have ``lags`` rows before them in their series, newest first; at
    most WINDOWS at once. With ``repeat_oldest`` one row before is enough: the window is filled up with the series' oldest row, so
    in short series most of a window is one value. Rows with a NULL among these figures are left out."""
    n, last = len(targets), None
    held, gaps = np.zeros((0, n)), np.zeros(0, bool)
    for batch in batches:
        if not batch.num_rows:
            continue
        chunk, series = batch.column(0).to_numpy(), batch.column(1)
        columns = [batch.column(t) for t in targets]
        new = _begins(chunk, series)
        new[0] = last != (chunk[0], series[0].as_py())
        last = chunk[-1], series[-1].as_py()
        values = np.concatenate([held, np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns])])
        gaps = np.concatenate([gaps, np.any([c.is_null().to_numpy(zero_copy_only=False) for c in columns], 0)])
        at = len(held) + np.arange(batch.num_rows)
        begin = np.maximum.accumulate(np.where(new, at, 0))
        missing = np.r_[0, np.cumsum(gaps)]
        known = (missing[at + 1] == missing[np.maximum(at - lags, begin)]) & ~np.isnan(values[at]).any(1)
        used = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False) & known & (at - begin >= (1 if repeat_oldest else lags)))
        for i in range(0, len(used), WINDOWS):
            rows = at[used[i:i + WINDOWS]]
            past = np.maximum(rows[:, None] - np.arange(1, lags + 1), begin[used[i:i + WINDOWS], None])
            yield values.take(past, 0).reshape(len(rows), lags * n), values[rows]
        keep = max(begin[-1], len(values) - lags)
        held, gaps = values[keep:], gaps[keep:]


def _filled(window: str, lags: int) -> Column:
    """The array with its last element repeated up to ``lags`` elements."""
    return F.concat(window, F.array_repeat(F.get(window, F.size(window) - 1), F.lit(lags) - F.size(window)))


def lag_names(targets: tuple[str, ...], lags: int) -> list[str]:
    return [f"{t}_lag{j}" for j in range(1, lags + 1) for t in targets]


def _window_gram(rows: DataFrame, targets: tuple[str, ...], lags: int, shift: np.ndarray, repeat_oldest: bool) -> np.ndarray:
    """Sums of products of 1, the window and the targets of ``lagged_rows``, each less its target's ``shift``. Every task
    multiplies the windows it meets; a line of the matrix is summed in one place."""
    n = len(targets)
    offsets = np.r_[0.0, np.tile(shift, lags), shift]

    def partial(batches):
        total = np.zeros((1 + n * (lags + 1),) * 2)
        for window, y in _windows(batches, targets, lags, repeat_oldest):
            x = np.column_stack([np.ones(len(y)), window, y]) - offsets
            total += x.T @ x
        if total[0, 0]:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([line.tobytes() for line in total], pa.binary())], names=["i", "s"])

    def summed(lines: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in lines.column("s").to_pylist())
        return pa.table({"i": lines.column("i")[:1], "s": pa.array([total.tobytes()], pa.binary())})

    lines = rows.mapInArrow(partial, "i int, s binary").groupBy("i").applyInArrow(summed, "i int, s binary").collect()
    return np.array([np.frombuffer(r["s"]) for r in sorted(lines, key=lambda r: r["i"])])


def fit_lag_models(df: DataFrame, series: str, targets: tuple[str, ...] = TARGETS, lags: int = 4, repeat_oldest: bool = False) -> dict[str, LinearModel]:
    """One least-squares model of minimal norm per target over the last ``lags`` rows of all targets: one pass over the windows
    gives the sums for all of them."""
    _, mean, _ = means(df, list(targets))
    shift = np.array([mean[t] for t in targets])  # close to every column's mean, so that centring below takes little away
    g = _window_gram(lagged_rows(df, series, targets, lags), targets, lags, shift, repeat_oldest)
    if not len(g) or not g[0, 0]:
        raise ValueError("no complete rows to fit on")
    p, first = lags * len(targets), g[0, 1:] / g[0, 0]
    centred = g[1:, 1:] - g[0, 0] * np.outer(first, first)
    weights = np.linalg.lstsq(centred[:p, :p], centred[:p, p:], rcond=None)[0]
    centre = first + np.r_[np.tile(shift, lags), shift]
    return {t: LinearModel(lag_names(targets, lags), weights[:, k].tolist(), float(centre[p + k] - centre[:p] @ weights[:, k])) for k, t in enumerate(targets)}


def last_windows(df: DataFrame, series: str, targets: tuple[str, ...], lags: int) -> DataFrame:
    """(series, last_time, window): the newest rows of each series, newest first.
    A short series repeats its oldest row."""
    newest = Window.partitionBy(series).orderBy(F.desc("time"), F.desc("idx"))
    top = df.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= lags)
    rows = top.groupBy(series).agg(
        F.max("time").alias("last_time"),
        F.transform(F.array_sort(F.collect_list(F.struct("_r", F.array(*[F.col(t).cast("double") for t in targets]).alias("v")))),
                    lambda s: s["v"]).alias("w"))
    return rows.select(series, "last_time", _filled("w", lags).alias("window"))


def recurse(window: Column, models: dict[str, LinearModel], targets: tuple[str, ...], lags: int, steps: int) -> Column:
    """Array of ``steps`` predictions; each one becomes the newest row of the window."""
    names = lag_names(targets, lags)
    weights = {t: dict(zip(models[t].features, models[t].weights)) for t in targets}

    def score(state: Column, t: str) -> Column:
        terms = F.zip_with(state["window"], F.array(*[F.lit(float(weights[t][name])) for name in names]), lambda x, y: x * y)
        return F.aggregate(terms, F.lit(float(models[t].intercept)), lambda a, x: a + x)

    def step(state: Column, _: Column) -> Column:
        new = F.array(*[score(state, t) for t in targets])
        return F.struct(
            F.concat(new, F.slice(state["window"], 1, (lags - 1) * len(targets))).alias("window"),
            F.concat(state["out"], F.array(new)).alias("out"))

    start = F.struct(F.flatten(window).alias("window"), F.expr("cast(array() as array<array<double>>)").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["out"])


def forecast(df: DataFrame, series: str, days: float = 2, targets: tuple[str, ...] = TARGETS, lags: int = 4,
             repeat_oldest: bool = False) -> DataFrame:
    """(series, timestamp, targets…): int(days·24) hourly rows after each series' last event.

    Targets are scaled to (0, 1), predicted from the window, scaled back. The state
    of a series is its last ``lags`` rows, so long series cost no more than short ones.
    Models are fitted on rows with ``lags`` rows before them, or, if ``repeat_oldest``, with one, as short windows are filled up.
    """
    steps = int(days * 24)
    clean = df.select("idx", "time", series, *targets)
    scale = fit_minmax(clean, list(targets))
    scaled = scale.transform(clean)
    models = fit_lag_models(scaled, series, targets, lags, repeat_oldest)
    made = last_windows(scaled, series, targets, lags).select(
        series, "last_time", F.posexplode(recurse(F.col("window"), models, targets, lags, steps)).alias("i", "p"))
    rows = made.select(
        series, (F.col("last_time") + F.make_dt_interval(hours=F.col("i") + 1)).alias("timestamp"),
        *[F.col("p")[k].alias(t) for k, t in enumerate(targets)])
    return scale.inverse(rows)


def payload(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Time as text with microseconds, for delivery."""
    return df.withColumn(time, F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def payload_columns(df: DataFrame, series: str, time: str = "timestamp") -> DataFrame:
    """(series, payload): per series one JSON object of column → list in time order, as long as its forecast."""
    names = [c for c in df.columns if c not in (time, series)]
    rows = payload(df, time).groupBy(series).agg(F.array_sort(F.collect_list(F.struct(time, *names))).alias("r"))
    return rows.select(series, F.to_json(F.struct(*[F.col(f"r.{n}").alias(n) for n in (time, *names)])).alias("payload"))


def test_report(df: DataFrame, scale: Scale, targets: tuple[str, ...], key: str = "idx") -> DataFrame:
    """Long (key, target, actual, predicted) in original units, from columns
    ``<t>_actual`` and ``<t>_predicted`` scaled by ``scale``."""
    def back(t: str, side: str) -> Column:
        shift, width = scale.params[t]
        return F.col(f"{t}_{side}") * F.lit(width) + F.lit(shift)

    return df.select(key, F.inline(F.array(*[
        F.struct(F.lit(t).alias("target"), back(t, "actual").alias("actual"), back(t, "predicted").alias("predicted")) for t in targets
    ])))
