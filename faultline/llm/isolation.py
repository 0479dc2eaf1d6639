"""Quality rules with an isolation forest on their statistics.

Trees split a random statistic at a random value; a document that few splits set apart from ordinary ones has a short
path. Trees grow on the good ones of a bounded sample of ``fit_rows`` labelled rows (the smallest hashes of their ids),
inside the box that all rows of the sample span: ordinary texts have no symbols at all, so a cut between them and
junk must be able to fall where no ordinary row lies. The path length below which a document is an anomaly is set from
all labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.textstats import COUNTS, FEATURES, features

#: The statistics of the rules: word length, symbols, repetition, capitals, digits, table bars, exclamations.
RULES = ["log_word_length", "symbols", "dup_lines", "repeats", "log_distinct", "upper", "digits", "bars", "shouts"]
_COLUMNS = [FEATURES.index(r) for r in RULES]

FIT_ROWS = 16_384     # bound of the sample the trees grow on
TREES, SAMPLE = 128, 256
GOOD_LOST = 0.002     # share of labelled good rows that a threshold may reject
BINS = 2_000


def expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    feature: np.ndarray   # trees x nodes; -1 at a leaf
    cut: np.ndarray
    right: np.ndarray     # the left child follows its parent
    path: np.ndarray      # at a leaf, the path length of the rows that end there
    sample: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): towards 1 for anomalies, below 0.5 for ordinary rows."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int32)
            while len(open_ := np.flatnonzero(self.feature[t][node] >= 0)):
                at = node[open_]
                left = x[rows[open_], self.feature[t][at]] < self.cut[t][at]
                node[open_] = np.where(left, at + 1, self.right[t][at])
            total += self.path[t][node]
        return np.exp2(-total / len(self.feature) / max(float(expected_path(self.sample)), 1e-9))


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 17) -> Forest:
    """A forest over the rows of x in the box [low, high]; with no rows, one that finds everything alike."""
    rng, grown = np.random.default_rng(seed), []
    sample = min(sample, len(x))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    for _ in range(trees):
        nodes: list[list[float]] = []

        def split(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> None:
            me = len(nodes)
            nodes.append([-1, 0.0, 0, depth + float(expected_path(len(rows)))])
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(rows) < 2 or not len(open_):
                return
            f = int(rng.choice(open_))
            cut = float(rng.uniform(low[f], high[f]))
            left, below, above = rows[:, f] < cut, high.copy(), low.copy()
            below[f] = above[f] = cut
            split(rows[left], low, below, depth + 1)
            nodes[me] = [f, cut, len(nodes), 0.0]
            split(rows[~left], above, high, depth + 1)

        split(x[rng.choice(len(x), sample, replace=False)] if sample else x, low, high, 0)
        grown.append(nodes)
    size = max(map(len, grown))
    table = np.array([n + [[-1, 0.0, 0, 0.0]] * (size - len(n)) for n in grown])
    return Forest(table[..., 0].astype(np.int32), table[..., 1], table[..., 2].astype(np.int32), table[..., 3], max(sample, 1))


def statistics(counted: dict[str, np.ndarray]) -> np.ndarray:
    return features(counted)[:, _COLUMNS]


def fit(labelled: DataFrame, key: str = "doc_id", label: str = "quality", fit_rows: int = FIT_ROWS) -> Forest:
    """Forest from at most ``fit_rows`` rows with label 0 or 1. ``labelled`` has the COUNTS and one label per row."""
    known = labelled.filter(F.col(label).isin(0, 1)).select(*COUNTS, F.col(label).alias("_y"), F.xxhash64(F.col(key)).alias("_h"))
    rows = known.orderBy("_h", *COUNTS).limit(fit_rows).toPandas()
    x = statistics({c: rows[c].to_numpy() for c in COUNTS})
    low, high = (x.min(0), x.max(0)) if len(x) else (np.zeros(x.shape[1]),) * 2
    return grow(x[rows["_y"].to_numpy() == 1], low, high)


def scored(counted: DataFrame, forest: Forest, name: str = "anomaly") -> DataFrame:
    """``counted`` with the forest's score, in one pass."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema if f.name != name)

    def run(batches):
        for rows in batches:
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(forest.score(statistics({c: rows.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})))], names=[*rows.schema.names, name])

    return counted.select(*[f"`{c}`" for c in counted.columns if c != name]).mapInArrow(run, f"{schema}, {name} double")


def threshold(labelled: DataFrame, label: str = "quality", score: str = "anomaly", good_lost: float = GOOD_LOST, bins: int = BINS) -> float:
    """Score above which a document is an anomaly: most labelled bad rows caught less good rows lost, with at most the
    share ``good_lost`` of the good ones above it. Taken from counts over all labelled rows; 1 (nothing) without labels."""
    bin_ = F.floor(F.col(score) * bins)
    got = {(r["b"], r["q"]): r["n"] for r in labelled.filter(F.col(label).isin(0, 1)).groupBy(bin_.alias("b"), F.col(label).alias("q")).agg(F.count("*").alias("n")).collect()}
    bad, good = (np.array([got.get((b, q), 0) for b in range(bins + 1)], float) for q in (0, 1))
    caught = np.cumsum(bad[::-1])[::-1] / max(bad.sum(), 1)
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)
    gain = np.where(lost <= good_lost, caught - lost, -1.0)
    best = int(np.flatnonzero(gain == gain.max())[-1]) if bad.sum() and gain.max() > 0 else bins + 1
    return best / bins


def base_failed() -> "F.Column":
    """Too short, or mostly words inside repeated 3-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
