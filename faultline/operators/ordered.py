"""Global order without a single-partition window.

``lay_out`` range-partitions a table on a unique order, sorts inside the
partitions and writes it once with its partition number and position. Range
bounds are sampled on the whole order key, so a hot key is spread over as many
partitions as it needs. Most of what is below works on that layout: only one small
row per partition ever reaches the driver. ``ranges`` serves frames of a bounded
number of rows with a single exchange and no written copy.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import written

PART, POS, ROW, CHUNK, SLOT = "_part", "_pos", "_row", "_chunk", "_slot"
SLOTS = 8   # of a chunk of ``ranges``: copies for frames are whole slots
_POSITION_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id


@dataclass
class Ordered:
    df: DataFrame   # input columns + _part, _pos

    @cached_property
    def sizes(self) -> dict[int, int]:
        """Rows per partition, counted when first needed."""
        return {r[PART]: r["n"] for r in self.df.groupBy(PART).agg(F.count("*").alias("n")).collect()}

    @property
    def total(self) -> int:
        return sum(self.sizes.values())

    def small(self, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
        """A table with at most one row per partition."""
        return F.broadcast(self.df.sparkSession.createDataFrame(rows, schema))

    def starts(self) -> dict[int, int]:
        start, out = 0, {}
        for part in sorted(self.sizes):
            out[part] = start
            start += self.sizes[part]
        return out


def lay_out(df: DataFrame, *order: str) -> Ordered:
    """``order`` must identify rows uniquely, so that hot keys can be split."""
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)))
    )
    return Ordered(written(ranged, "ordered"))


def with_row_index(ordered: Ordered, name: str = ROW) -> DataFrame:
    """Dense 0-based position in the global order."""
    starts = ordered.small(list(ordered.starts().items()), f"{PART} int, _start bigint")
    return (
        ordered.df.join(starts, PART)
        .withColumn(name, F.col("_start") + F.col(POS))
        .drop("_start")
    )


def _chunk_rows(ordered: Ordered, halo: int, limit: int) -> int:
    slots = 2 * ordered.df.sparkSession.sparkContext.defaultParallelism
    return max(1, 8 * halo, min(limit, -(-ordered.total // slots)))


def chunked(ordered: Ordered, before: int = 0, after: int = 0, limit: int = 1_000_000) -> DataFrame:
    """Equal-sized chunks of the global order, each with copies of the rows its
    bounded frames reach into. Use ``frame(...)`` on it, then ``home(...)``."""
    size = _chunk_rows(ordered, max(before, after), limit)
    df = with_row_index(ordered)
    chunk = F.floor(F.col(ROW) / size).cast("bigint")
    offset = F.col(ROW) % size
    copies = F.array(
        chunk,
        F.when(offset >= size - before, chunk + 1),
        F.when(offset < after, chunk - 1),
    )
    return (
        df.withColumn("_home", chunk)
        .withColumn(CHUNK, F.explode(F.array_compact(copies)))
        .drop(PART, POS)
    )


@dataclass
class Ranges:
    """Rows with the slot of the global order they fall into; ``counts`` has the rows of each slot, SLOTS of which are a chunk."""

    df: DataFrame   # input columns + _slot
    order: tuple[str, ...]
    counts: list[int]

    def _reach(self, rows: int) -> int:
        """Slots before any chunk that hold at least ``rows`` rows, or all there are."""
        upto, most = list(accumulate(self.counts, initial=0)), 0
        for start in range(SLOTS, len(self.counts), SLOTS):
            most = max(most, start - max(0, bisect_right(upto, upto[start] - rows) - 1))
        return most

    def framed(self, before: int) -> DataFrame:
        """Chunks for frames of so many rows back: each has copies of the slots its frames reach into. Use ``over`` on it, then
        ``home``."""
        own, top = F.floor(F.col(SLOT) / SLOTS), max(0, (len(self.counts) - 1) // SLOTS)
        last = F.floor((F.col(SLOT) + self._reach(before)) / SLOTS)
        return self.df.withColumn("_home", own).withColumn(CHUNK, F.explode(F.sequence(own, F.least(last, F.lit(top))))).drop(SLOT)

    def over(self, *keys: str):
        return Window.partitionBy(CHUNK, *keys).orderBy(*self.order)


def ranges(df: DataFrame, *order: str) -> Ranges:
    """Cuts the global order for bounded frames without moving a row: the frames' window then makes the only exchange.

    ``order`` must identify rows uniquely, so that hot keys can be split. One pass draws a row for each of some slots (by hash, so
    the draw is even and each task sends at most one row a slot), whose sorted keys are the slots' bounds; a second pass counts
    the rows of each slot exactly, so what is copied for the frames is always enough. Only bounds and counts reach the driver.
    """
    chunks = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = SLOTS * chunks
    key, mixed = F.struct(*[F.col(c) for c in order]), F.xxhash64(*order)
    drawn = df.groupBy(F.pmod(mixed, F.lit(slots)).alias("b")).agg(F.min_by(key, mixed).alias("k"))
    points = written(drawn.agg(F.sort_array(F.collect_list("k")).alias("points")), "points")
    steps = [1 << i for i in reversed(range(slots.bit_length()))]
    slot = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(F.col("_points"), at + step - 1) <= F.col("_key"), F.lit(False)), at + step).otherwise(at))
    marked = df.withColumns({"_points": points.scalar(), "_key": key}).withColumn(SLOT, slot).drop("_points", "_key")
    found = {r[SLOT]: r["count"] for r in marked.groupBy(SLOT).count().collect()}
    return Ranges(marked, order, [found.get(i, 0) for i in range(max(found, default=-1) + 1)])


def frame(*keys: str):
    """Window over a chunk (and optional keys) in the global order."""
    return Window.partitionBy(CHUNK, *keys).orderBy(ROW)


def home(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_home") == F.col(CHUNK)).drop("_home", CHUNK)


def carry_forward(ordered: Ordered, columns: list[str]) -> DataFrame:
    """Last non-NULL value at or before each row, for each column."""
    last_in_part = ordered.df.groupBy(PART).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(POS))).alias(c) for c in columns]
    )
    tails = {r[PART]: r for r in last_in_part.collect()}
    held: list = [None] * len(columns)
    rows = []
    for part in sorted(tails):
        rows.append((part, *held))
        held = [tails[part][c] if tails[part][c] is not None else h for c, h in zip(columns, held)]
    schema = T.StructType(
        [T.StructField(PART, T.IntegerType())]
        + [T.StructField(f"_in_{c}", ordered.df.schema[c].dataType) for c in columns]
    )
    w = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return ordered.df.join(ordered.small(rows, schema), PART).select(
        *[c for c in ordered.df.columns if c not in columns],
        *[F.coalesce(F.last(c, ignorenulls=True).over(w), F.col(f"_in_{c}")).alias(c) for c in columns],
    )


def running_sums(ordered: Ordered, values: dict[str, str]) -> DataFrame:
    """Adds name → inclusive running sum of a column over the whole order."""
    sums = ordered.df.groupBy(PART).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    schema = T.StructType(
        [T.StructField(PART, T.IntegerType())] + [T.StructField(f"_in_{n}", sums.schema[n].dataType) for n in values]
    )
    held, rows = [_zero(sums.schema[n].dataType) for n in values], []
    for r in sorted(sums.collect(), key=lambda r: r[PART]):
        rows.append((r[PART], *held))
        held = [h + (r[n] or 0) for h, n in zip(held, values)]
    w = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return ordered.df.join(ordered.small(rows, schema), PART).withColumns({
        n: F.col(f"_in_{n}") + F.coalesce(F.sum(v).over(w), F.lit(0)) for n, v in values.items()
    }).drop(*[f"_in_{n}" for n in values])


def _zero(kind: T.DataType) -> float | int:
    return 0.0 if isinstance(kind, T.DoubleType) else 0


def running_sum(ordered: Ordered, value: str, name: str) -> DataFrame:
    return running_sums(ordered, {name: value})


def split_by_row(row: Column, total: int, first: float, second: float | None = None) -> Column:
    """Split label by dense row index; ``second=None`` halves what is left."""
    train = int(total * first)
    valid = int((total - train) / 2) if second is None else int(total * second)
    return F.when(row < train, "train").when(row < train + valid, "valid").otherwise("test")
