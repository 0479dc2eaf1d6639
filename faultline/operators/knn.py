"""Exact nearest neighbours with missing values, by space partitioning.

Points are split by their pattern of missing columns, then by a k-d tree over the
columns they have. A query is answered in its home leaf first; the distance of its
k-th neighbour there tells which other leaves it still has to visit. Leaves hold a
bounded number of points and the queries of a leaf are cut into blocks, so
no task depends on how popular a place is.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from faultline.session import small_side, written

LEAF_POINTS = 2_000       # points aimed at per leaf
LEAF_LIMIT = 20_000       # points of a leaf that a task takes at once; a fuller leaf is asked in parts
QUERY_BLOCK = 4_096       # queries per block within a leaf
SAMPLE_PER_LEAF = 32      # sampled points that place the splits
MAX_SAMPLE = 400_000      # bound on the driver's sample
VISIT_ROWS = 2_000        # queries whose leaves are looked up together
TILE = 1 << 17            # distances held at once: they stay in a core's cache
RANK_DIGITS = 9           # distances equal to this many digits rank as ties; what is returned is not rounded


class _Grower:
    """Collects the nodes of all trees; ``arrays`` is what tasks get."""

    def __init__(self, p: int):
        self.p = p
        self.axis, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.low, self.high = [], []
        self.roots: dict[int, int] = {}
        self.leaves = 0

    def _node(self, low: np.ndarray, high: np.ndarray) -> int:
        for column, value in ((self.axis, 0), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.leaf, -1), (self.low, low), (self.high, high)):
            column.append(value)
        return len(self.axis) - 1

    def grow(self, pattern: int, sample: np.ndarray, dims: list[int], leaves: float) -> None:
        """A tree over the columns ``dims``, cut until about ``leaves`` leaves are there."""
        root = self._node(np.full(self.p, -np.inf), np.full(self.p, np.inf))
        self.roots[pattern] = root
        todo = deque([(root, sample, leaves)])
        while todo:
            at, pts, want = todo.popleft()
            cut = _cut(pts, dims) if want > 1 else None
            if cut is None:
                self.leaf[at] = self.leaves
                self.leaves += 1
                continue
            self.axis[at], self.cut[at] = cut
            below = pts[:, cut[0]] <= cut[1]
            high, low = self.high[at].copy(), self.low[at].copy()
            high[cut[0]] = low[cut[0]] = cut[1]
            self.left[at] = self._node(self.low[at], high)
            self.right[at] = self._node(low, self.high[at])
            todo += [(self.left[at], pts[below], want / 2), (self.right[at], pts[~below], want / 2)]

    def arrays(self) -> dict:
        names = ("axis", "cut", "left", "right", "leaf", "low", "high")
        return {"roots": self.roots, **{n: np.array(getattr(self, n)) for n in names}}


def _cut(pts: np.ndarray, dims: list[int]) -> tuple[int, float] | None:
    """Middle of the widest column that still varies."""
    if len(pts) < 2 or not dims:
        return None
    axis = max(dims, key=lambda d: np.ptp(pts[:, d]))
    values = np.unique(pts[:, axis])
    if len(values) < 2:
        return None
    return axis, float(min(np.median(pts[:, axis]), values[-2]))


def _home(tree: dict, pattern: int, x: np.ndarray) -> np.ndarray:
    """Leaf of each row under a pattern's tree; a missing value goes left."""
    at = np.full(len(x), tree["roots"][pattern])
    rows = np.arange(len(x))
    while True:
        inner = tree["leaf"][at] < 0
        if not inner.any():
            return tree["leaf"][at]
        n = at[inner]
        right = x[rows[inner], tree["axis"][n]] > tree["cut"][n]
        at[inner] = np.where(right, tree["right"][n], tree["left"][n])


def _within(tree: dict, patterns: dict[int, np.ndarray], x: np.ndarray, reach: np.ndarray, skip: np.ndarray, width: int):
    """Pairs (row, leaf) of leaves that may hold a point as near as ``reach``."""
    rows_out, leaf_out = [np.empty(0, int)], [np.empty(0, int)]
    have = ~np.isnan(x)
    for pattern, present in patterns.items():
        shared = have & present
        count = shared.sum(axis=1)
        rows = np.flatnonzero(count > 0)
        nodes = np.full(len(rows), tree["roots"][pattern])
        while len(rows):
            gap = np.maximum(np.maximum(tree["low"][nodes] - x[rows], x[rows] - tree["high"][nodes]), 0.0)
            gap = np.where(shared[rows], gap, 0.0)
            near = (gap ** 2).sum(axis=1) * (width / count[rows]) <= (reach[rows] + 1e-8) ** 2 + 1e-12
            rows, nodes = rows[near], nodes[near]
            leaf = tree["leaf"][nodes]
            done = (leaf >= 0) & (leaf != skip[rows])
            rows_out.append(rows[done])
            leaf_out.append(leaf[done])
            inner = leaf < 0
            rows, nodes = np.repeat(rows[inner], 2), np.column_stack([tree["left"][nodes[inner]], tree["right"][nodes[inner]]]).ravel()
    return np.concatenate(rows_out), np.concatenate(leaf_out)


def _distances(q: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
    """Distance over the shared columns, scaled up for the missing ones; NaN if none."""
    return _distances_of(q[:, None, :], x[None, :, :], width)


def _distances_of(q: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
    """The same for pairs of rows."""
    total = shared = 0.0
    for c in range(q.shape[-1]):
        d = q[..., c] - x[..., c]
        ok = ~np.isnan(d)
        total = total + np.where(ok, d * d, 0.0)
        shared = shared + ok
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.sqrt(total * (width / shared))


def _ranked_near(q: np.ndarray, x: np.ndarray, donor: np.ndarray, k: int, width: int):
    """(row of q, row of x, distance) of the k first donors of each question, as distances rounded to RANK_DIGITS digits and then
    donors rank them. Where all points miss the same columns, questions are taken by what they miss: then the squares of a
    question stand for one number of columns, and only those close to the k-th smallest are made distances."""
    have = ~np.isnan(x)
    even = (have.all(0) | ~have.any(0)).all()
    missing = np.isnan(q) @ (1 << np.arange(q.shape[1])) if even else np.zeros(len(q), int)
    columns, step = np.ascontiguousarray(x.T), max(1, TILE // len(x))
    total, part = (np.empty((step, len(x))) for _ in range(2))
    for pattern in np.unique(missing):
        mine = np.flatnonzero(missing == pattern)
        dims = [c for c in range(q.shape[1]) if have[0, c] and not pattern >> c & 1]
        if even and not dims:
            continue
        share = width / len(dims) if even else 1.0
        for start in range(0, len(mine), step):
            asked = mine[start:start + step]
            if even:
                squares, diff = total[:len(asked)], part[:len(asked)]
                for i, c in enumerate(dims):
                    np.subtract(q[asked, c][:, None], columns[c], out=diff)
                    np.multiply(diff, diff, out=diff if i else squares)
                    if i:
                        squares += diff
            else:
                squares = _distances(q[asked], x, width) ** 2
            if len(x) > k:
                kth = np.sqrt(np.partition(squares, k - 1, axis=1)[:, k - 1] * share)
                kth[~np.isfinite(kth)] = np.inf
                reach = (kth + 4 * 10.0 ** -RANK_DIGITS) ** 2 / share * (1 + 1e-9)
                rows, cols = np.nonzero(squares <= reach[:, None])
            else:
                kth = np.full(len(asked), np.inf)
                rows, cols = np.nonzero(squares < np.inf)
            d = np.sqrt(squares[rows, cols] * share) if even else _distances_of(q[asked][rows], x[cols], width)
            ranked = np.round(d, RANK_DIGITS)
            near = np.flatnonzero((ranked <= np.round(kth, RANK_DIGITS)[rows] + 10.0 ** -RANK_DIGITS) & np.isfinite(d))
            rows, cols, d, ranked = rows[near], cols[near], d[near], ranked[near]
            order = np.lexsort((donor[cols], ranked, rows))
            rows, cols, d = rows[order], cols[order], d[order]
            best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k  # from where each question's donors begin
            yield asked[rows[best]], cols[best], d[best]


def _pattern(columns: list[str]) -> Column:
    out = F.lit(0)
    for i, c in enumerate(columns):
        out = out + F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return out.cast("int")


def _matrix(pdf: pd.DataFrame, p: int) -> np.ndarray:
    return pdf[[f"x{i}" for i in range(p)]].to_numpy(dtype=float)


def nearest(
    queries: DataFrame, donors: DataFrame, columns: list[str], k: int, payload: str, key: str = "idx", width: int | None = None
) -> DataFrame:
    """(key, rank, distance, donor, value): the k nearest donors of every query.

    Ties of the distance, to RANK_DIGITS digits, go to the smaller donor key. ``payload`` is carried along from the donor.
    ``width`` is the number of columns a distance stands for, if not all are given.
    Queries that share no column with any donor do not appear.
    """
    p = len(columns)
    width = width or p
    xs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    names = [f"x{i}" for i in range(p)]
    points = donors.select(F.col(key).alias("donor"), F.col(payload).alias("value"), *xs)
    # Copies are equally far from any query, so only the k first of each can matter.
    copies = Window.partitionBy(*names).orderBy("donor")
    kept = points.withColumn("_c", F.row_number().over(copies)).filter(F.col("_c") <= k).drop("_c")
    kept = written(kept.withColumn("pattern", _pattern(names)), "donors")
    asked = queries.select(F.col(key).alias("query"), *xs)
    # Equal queries are answered once.
    questions = written(
        asked.groupBy(*names).agg(F.min("query").alias("q")).withColumn("pattern", _pattern(names)), "questions"
    )
    tree, patterns = _plant(kept, names)
    if not patterns:
        return _empty(queries, donors, key, payload)
    shipped = queries.sparkSession.sparkContext.broadcast((tree, patterns))
    main = max(patterns, key=lambda m: patterns[m][1])

    def leaf_of(*cols: pd.Series) -> pd.Series:
        tree_, _ = shipped.value
        pattern = cols[0].to_numpy()
        x = np.column_stack([c.to_numpy(dtype=float) for c in cols[1:]])
        out = np.zeros(len(x), int)
        for m in np.unique(pattern):
            rows = np.flatnonzero(pattern == m)
            out[rows] = _home(tree_, int(m), x[rows])
        return pd.Series(out)

    leaf = F.pandas_udf(leaf_of, "int")
    placed = written(kept.withColumn("leaf", leaf("pattern", *names)), "leaves")
    # Where the sample was too small to cut a place finely, its leaf is taken in parts.
    parts = placed.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF_LIMIT).cast("int").alias("parts"))
    parts = small_side(parts, "leaf-parts")
    first = questions.withColumn("leaf", leaf(F.lit(main), *names))
    found = written(_best(_answer(first, placed, parts, p, k, width), k), "found")

    # Distance of the k-th neighbour at home, then the other leaves within it.
    reach = found.groupBy("q").agg(F.count("*").alias("n"), (F.max("distance") + 10.0 ** -RANK_DIGITS).alias("far"))
    homes = first.join(reach, "q", "left").withColumn(
        "reach", F.when(F.col("n") >= k, F.col("far")).otherwise(F.lit(float("inf"))))

    def visits(batches):
        tree_, patterns_ = shipped.value
        present = {m: v[0] for m, v in patterns_.items()}
        for pdf in batches:
            for start in range(0, len(pdf), VISIT_ROWS):
                some = pdf.iloc[start:start + VISIT_ROWS]
                rows, leaves = _within(tree_, present, _matrix(some, p), some["reach"].to_numpy(), some["leaf"].to_numpy(), width)
                yield some.iloc[rows][["q", *names]].assign(leaf=leaves)

    schema = T.StructType([questions.schema["q"], *[questions.schema[n] for n in names], T.StructField("leaf", T.IntegerType())])
    more = written(homes.select("q", *names, "leaf", "reach").mapInPandas(visits, schema), "visits")  # read for the blocks and the answers
    candidates = found.drop("rank").unionByName(_answer(more, placed, parts, p, k, width))
    best = _best(candidates, k)
    answers = best.groupBy("q").agg(F.collect_list(F.struct("rank", "distance", "donor", "value")).alias("near"))  # k entries
    per_vector = questions.join(answers, "q").drop("pattern")
    same = [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return asked.alias("a").join(per_vector.alias("b"), condition).select(
        F.col("a.query").alias(key), F.inline("b.near")
    )


def _empty(queries: DataFrame, donors: DataFrame, key: str, payload: str) -> DataFrame:
    return queries.sparkSession.createDataFrame([], T.StructType([
        T.StructField(key, queries.schema[key].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("distance", T.DoubleType()), T.StructField("donor", donors.schema[key].dataType),
        T.StructField("value", donors.schema[payload].dataType)]))


def _plant(points: DataFrame, names: list[str]) -> tuple[dict, dict[int, tuple[np.ndarray, int]]]:
    """Trees per missing pattern, from a bounded sample. The sample only shapes the
    leaves; results do not depend on it."""
    p = len(names)
    counts = {r["pattern"]: r["count"] for r in points.groupBy("pattern").count().collect()}
    total = sum(counts.values())
    trees, patterns = _Grower(p), {}
    if not total:
        return trees.arrays(), patterns
    share = min(1.0, min(MAX_SAMPLE, SAMPLE_PER_LEAF * (total / LEAF_POINTS + len(counts))) / total)
    sample = points.sample(share, seed=7).select("pattern", *names).limit(2 * MAX_SAMPLE).toPandas()
    for m, n in sorted(counts.items()):
        mine = sample[sample["pattern"] == m][names].to_numpy(dtype=float)
        dims = [i for i in range(p) if not m >> i & 1]
        trees.grow(m, mine, dims, n / LEAF_POINTS)
        patterns[m] = (np.array([not m >> i & 1 for i in range(p)]), n)
    return trees.arrays(), patterns


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest of each question's candidates, with their rank."""
    order = Window.partitionBy("q").orderBy(F.round("distance", RANK_DIGITS), "donor")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _answer(questions: DataFrame, placed: DataFrame, parts: DataFrame, p: int, k: int, width: int) -> DataFrame:
    """k best donors of each question within each part of the leaf it names.

    A leaf with many questions is copied once per block of them, one with many donors is asked part by part.
    """
    names = [f"x{i}" for i in range(p)]
    blocks = questions.groupBy("leaf").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    shape = small_side(blocks.join(parts, "leaf"), "leaf-blocks")  # one row per leaf
    asked = questions.select("q", *names, "leaf").join(shape, "leaf").withColumns({
        "block": F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"),
        "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))}).drop("blocks", "parts")
    given = placed.select(*names, "donor", "value", "leaf").join(shape, "leaf").withColumns({
        "part": F.pmod(F.xxhash64("donor"), F.col("parts")).cast("int"),
        "block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))}).drop("blocks", "parts")
    schema = T.StructType([
        questions.schema["q"], T.StructField("distance", T.DoubleType()), placed.schema["donor"], placed.schema["value"]])

    def pick(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in schema.names})
        x, q = _matrix(right, p), _matrix(left, p)
        donor, value, asked_ = right["donor"].to_numpy(), right["value"].to_numpy(), left["q"].to_numpy()
        found = list(_ranked_near(q, x, donor, k, width))
        rows, cols, d = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pd.DataFrame({"q": asked_[rows], "distance": d, "donor": donor[cols], "value": value[cols]})

    keys = ("leaf", "block", "part")
    return asked.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInPandas(pick, schema)


def majority(near: DataFrame, key: str = "idx") -> DataFrame:
    """(key, predicted): most frequent value among the neighbours; a tie goes to the
    value of the nearest of them."""
    votes = near.groupBy(key, F.col("value").alias("label")).agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    return votes.groupBy(key).agg(F.max_by("label", F.struct("n", -F.col("first"))).alias("predicted"))
