"""Time gaps, rolling windows, sequences, splits and fills in a global order.

None of these opens a window over a whole key: hot cells and the time order as
a whole are cut into equal chunks or range partitions (see ``ordered``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.scalar import micros, seconds_between
from faultline.operators.ordered import (
    PART, POS, ROW, Ordered, carry_forward, chunked, frame, home, lay_out, ranges, split_by_row, with_row_index,
)
from faultline.session import small_side

DAY_US = 86_400_000_000


def time_since_last(df: DataFrame, by: str | None = None, name: str = "time_since_last_event") -> DataFrame:
    """Seconds since the previous event in (by,) time, idx order; the first has NULL."""
    keys = (by,) if by else ()
    cut = ranges(df, *keys, "time", "idx")
    gap = seconds_between(F.col("time"), F.lag("time").over(cut.over(*keys)))
    return home(cut.framed(before=1).withColumn(name, gap))


def rolling_rows(df: DataFrame, keys: tuple[str, ...], windows: tuple[int, ...] = (1, 7, 30), value: str = "mag") -> DataFrame:
    """Per key, over the last w rows: the count of values once w rows were seen,
    and the maximum when all w values are present."""
    cut = ranges(df, *keys, "time", "idx")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    new = {}
    for w in windows:
        over = cut.over(*keys).rowsBetween(1 - w, 0)
        n = F.count(value).over(over)
        new[f"eq_count_last_{w}d"] = F.when(known & (F.count(F.lit(1)).over(over) == w), n.cast("double"))
        new[f"max_mag_last_{w}d"] = F.when(known & (n == w), F.max(value).over(over))
    return home(cut.framed(before=max(windows) - 1).withColumns(new))


def _running_by_key(ordered: Ordered, keys: list[str], count: str, top: str) -> DataFrame:
    """Adds ``run_n`` and ``run_v``: running sum of ``count`` and maximum of ``top`` within
    each key, keys being contiguous in the order.

    A partition hands on its last key with the figures so far, for the case that the
    key goes on in the next one; that one row per partition reaches the driver.
    """
    w = Window.partitionBy(PART, *keys).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    df = ordered.df.withColumns({"run_n": F.sum(count).over(w), "run_v": F.max(top).over(w)})
    key = F.struct(*keys)
    tails = df.groupBy(PART).agg(
        F.min_by(key, POS).alias("first"), F.max_by(key, POS).alias("last"), F.max_by(F.struct("run_n", "run_v"), POS).alias("sum")
    ).collect()
    held, rows = None, []
    for t in sorted(tails, key=lambda r: r[PART]):
        n, v = t["sum"]["run_n"], t["sum"]["run_v"]
        if held:
            rows.append((t[PART], *held))
            if held[0] == t["last"] == t["first"]:
                n += held[1]
                v = max((x for x in (v, held[2]) if x is not None), default=None)
        held = (t["last"], n, v)
    schema = T.StructType([
        T.StructField(PART, T.IntegerType()), T.StructField("_k", T.StructType([ordered.df.schema[k] for k in keys])),
        T.StructField("_n", T.LongType()), T.StructField("_v", ordered.df.schema[top].dataType)])
    same = F.coalesce(F.col("_k") == key, F.lit(False))
    return df.join(ordered.small(rows, schema), PART, "left").withColumns({
        "run_n": F.col("run_n") + F.when(same, F.col("_n")).otherwise(F.lit(0)),
        "run_v": F.greatest("run_v", F.when(same, F.col("_v"))),
    }).drop("_k", "_n", "_v")


def rolling_days(df: DataFrame, cell: str, days: tuple[int, ...] = (1, 7, 30), value: str = "mag") -> DataFrame:
    """Per cell, over [time − w days, time]: count and maximum of ``value``.

    Work is linear in the rows whatever the window holds. A window is the head of
    its last day, the whole days before that, and the tail of its first day: running
    figures forward and backward inside each day, and a small table of days between.
    Rows without a cell or a time stay, with NULL figures.
    """
    points = df.filter(F.col(cell).isNotNull() & F.col("time").isNotNull()).groupBy(F.col(cell).alias("c"), micros(F.col("time")).alias("t")).agg(
        F.count(value).alias("n"), F.max(value).alias("v"))
    day = F.floor(F.col("at") / DAY_US)
    kind = df.schema[value].dataType

    # Heads: from the start of the day up to the event.
    ahead = points.withColumnRenamed("t", "at").withColumn("day", day)
    heads = _running_by_key(lay_out(ahead, "c", "at"), ["c", "day"], "n", "v").select(
        "c", F.col("at").alias("t"), F.lit(0).alias("w"), "run_n", "run_v")

    # Tails: from time − w days to the end of that day; the bound itself counts.
    bounds = points.select("c", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast(kind).alias("v"), "t",
                           F.explode(F.array(*[F.lit(w) for w in days])).alias("w")).withColumn("at", F.col("t") - F.col("w") * DAY_US)
    marks = points.select("c", "n", "v", "t", F.lit(0).alias("w"), F.col("t").alias("at"))
    behind = marks.unionByName(bounds).withColumns({"day": day, "back": -F.col("at"), "bound": F.col("w") > 0})
    tails = _running_by_key(lay_out(behind, "c", "back", "bound", "w"), ["c", "day"], "n", "v").filter("bound").select(
        "c", "t", "w", "run_n", "run_v")

    # Whole days between; a cell has one row per day with events.
    per_day = ahead.groupBy("c", "day").agg(F.sum("n").alias("n"), F.max("v").alias("v"))
    between = {}
    for w in days:
        if w > 1:
            span = Window.partitionBy("c").orderBy("day").rangeBetween(1 - w, -1)
            between[f"n{w}"], between[f"v{w}"] = F.coalesce(F.sum("n").over(span), F.lit(0)), F.max("v").over(span)
        else:
            between["n1"], between["v1"] = F.lit(0).cast("bigint"), F.lit(None).cast(kind)
    whole = per_day.withColumns(between).drop("n", "v")

    def of(w: int, what: str) -> Column:
        return F.max(F.when(F.col("w") == w, F.col(what)))

    parts = heads.unionByName(tails).groupBy("c", "t").agg(
        *[of(w, f"run_{x}").alias(f"{x}_{w}") for w in (0, *days) for x in ("n", "v")])
    stats = parts.withColumn("day", F.floor(F.col("t") / DAY_US)).join(whole, ["c", "day"]).select(
        F.col("c").alias(cell), F.col("t").alias("_t"),
        *[(F.col("n_0") + F.col(f"n_{w}") + F.col(f"n{w}")).alias(f"eq_count_last_{w}d") for w in days],
        *[F.greatest("v_0", f"v_{w}", f"v{w}").alias(f"max_mag_last_{w}d") for w in days])
    return df.withColumn("_t", micros(F.col("time"))).join(stats, [cell, "_t"], "left").drop("_t")


def events_last(df: DataFrame, windows: tuple[int, ...] = (1, 7, 30, 90)) -> DataFrame:
    """w once at least w events have been seen in time order, else 0."""
    # The first rows decide: a window is full from its w-th row on.
    head = df.select("time", "idx").orderBy("time", "idx").limit(max(windows)).collect()

    def full(w: int) -> Column:
        if len(head) < w:
            return F.lit(0)
        time, idx = (F.lit(head[w - 1][c]).cast(df.schema[c].dataType) for c in ("time", "idx"))
        if head[w - 1]["time"] is None:  # NULL times come first
            return F.when(F.col("time").isNotNull() | (F.col("idx") >= idx), F.lit(w)).otherwise(F.lit(0))
        return F.when((F.col("time") > time) | ((F.col("time") == time) & (F.col("idx") >= idx)), F.lit(w)).otherwise(F.lit(0))

    return df.withColumns({f"events_last_{w}": full(w) for w in windows})


def sequences(df: DataFrame, features: list[str], targets: list[str], window: int = 168, order: tuple[str, ...] = ("time", "idx")) -> DataFrame:
    """One row per start i with a full window: (row, x = features of rows
    i..i+w−1 as array of arrays, y = targets of row i+w). n − w rows."""
    narrow = df.select(
        *order, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
        F.array(*[F.col(c).cast("double") for c in targets]).alias("_y"))
    laid = lay_out(narrow, *order)
    rows = chunked(laid, after=window)
    w = frame()
    made = rows.withColumns({
        "x": F.collect_list("_x").over(w.rowsBetween(0, window - 1)),
        "y": F.lead("_y", window).over(w),
    })
    return home(made).filter(F.col(ROW) < laid.total - window).drop("_x", "_y").withColumnRenamed(ROW, "row")


def split_sequential(df: DataFrame, order: str = "idx", train: float = 0.7) -> DataFrame:
    """⌊train·n⌋ rows, then half of what is left, then the rest, as a ``split`` column."""
    if not 0 < train < 1:
        raise ValueError("train must lie between 0 and 1")
    laid = lay_out(df, order)
    if not laid.total:
        raise ValueError("nothing to split")
    return with_row_index(laid).withColumn("split", split_by_row(F.col(ROW), laid.total, train)).drop(ROW, PART, POS)


def split_xy(df: DataFrame, target: str = "mag") -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"target {target!r} is not in the table")
    return df.withColumnRenamed(target, "y")


def split_stratified(df: DataFrame, stratum: Column | None, share: float = 0.2, seed: str = "42", key: str = "idx", shuffle: bool = True) -> DataFrame:
    """``part`` = 'pred' for the share of each stratum first in a keyed hash order.

    Stratum sizes are exact, the choice depends on key and seed only.
    """
    if not shuffle:
        if stratum is not None:
            raise ValueError("a stratified split needs shuffle=True")
        laid = lay_out(df, key)
        cut = laid.total - -(-laid.total * share // 1)
        return with_row_index(laid).withColumn("part", F.when(F.col(ROW) < cut, "train").otherwise("pred")).drop(ROW, PART, POS)
    marked = df.withColumns({
        "_s": stratum if stratum is not None else F.lit(0),
        "_h": F.md5(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}"))),
    })
    rows = with_row_index(lay_out(marked, "_s", "_h", key)).drop(PART, POS)
    spans = rows.groupBy("_s").agg(F.min(ROW).alias("_first"), F.count("*").alias("_n"))
    taken = F.col(ROW) - F.col("_first") < F.round(F.col("_n") * share)
    spans = small_side(spans.withColumnRenamed("_s", "_stratum"), "strata")
    joined = rows.join(spans, F.col("_s").eqNullSafe(F.col("_stratum"))).drop("_stratum")  # a NULL stratum is one, too
    return joined.withColumn("part", F.when(taken, "pred").otherwise("train")).drop(
        "_s", "_h", ROW, "_first", "_n")


def fill_forward(df: DataFrame, columns: list[str], order: str = "idx") -> DataFrame:
    names = df.columns
    return carry_forward(lay_out(df, order), columns).select(*names)


def forecast_hours(df: DataFrame, days: float, time: str = "time") -> DataFrame:
    """int(days·24) hourly stamps after the last event."""
    hours = int(days * 24)
    return df.agg(F.max(time).alias("last")).select(
        F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("step"), "last"
    ).select("step", (F.col("last") + F.make_dt_interval(hours="step")).alias("timestamp"))
