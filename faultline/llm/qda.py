"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance of its own, shrunk towards the pooled covariance and towards a multiple of the
identity, so that few labelled rows or statistics that never vary still give an invertible matrix. A score is the
posterior probability of label 1, from the difference of the log densities; Mahalanobis distances use Cholesky factors
that are computed once with the model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.textbytes import chunks
from faultline.llm.textstats import COUNTS, FEATURES, counts, features

TO_POOLED, TO_SPHERE = 0.1, 0.02  # shares of the shrinkage


def held_out(key: str = "doc_id", folds: int = 5):
    """Rows that never train: crc32 of the id as text divisible by ``folds``; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % folds == 0, F.lit(True))


@dataclass
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray      # class x statistic, after centring and scaling
    inverses: np.ndarray   # inverse Cholesky factors of the class covariances
    offsets: np.ndarray    # log prior - half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [o - 0.5 * (((z - m) @ inv.T) ** 2).sum(1) for m, inv, o in zip(self.means, self.inverses, self.offsets)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def from_moments(n: np.ndarray, s: np.ndarray, ss: np.ndarray, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE) -> Discriminant:
    """Model from the counts, sums and sums of products of class 0 and 1. A class without rows counts as none of the
    prior; with no rows at all every score is the prior of one half."""
    d, n = s.shape[1], np.maximum(n, 0.0)
    total = max(n.sum(), 1.0)
    centre = s.sum(0) / total
    scale = np.sqrt(np.maximum(np.diag(ss.sum(0)) / total - centre**2, 0))
    scale[scale < 1e-9] = 1.0
    means, covs = np.zeros((2, d)), np.zeros((2, d, d))
    for k in (0, 1):
        if n[k]:
            mean = s[k] / n[k]
            covs[k] = (ss[k] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
            means[k] = (mean - centre) / scale
    pooled = (covs * n[:, None, None]).sum(0) / total
    inverses, offsets = np.zeros((2, d, d)), np.zeros(2)
    for k in (0, 1):
        cov = (1 - to_pooled) * covs[k] + to_pooled * pooled
        cov = (1 - to_sphere) * cov + to_sphere * max(np.trace(cov) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(cov)
        inverses[k] = np.linalg.inv(factor)
        offsets[k] = np.log((n[k] + 1e-9) / (total + 2e-9)) - np.log(np.diag(factor)).sum() if n.sum() else 0.0
    return Discriminant(centre, scale, means, inverses, offsets)


def fit(labelled: DataFrame, label: str = "quality") -> Discriminant:
    """Model from all rows with label 0 or 1; ``labelled`` has the COUNTS. Moments are summed on the executors, so the
    driver gets 2 x (1 + d + d * d) figures whatever the number of rows."""
    d = len(FEATURES)

    def moments(batches):
        for rows in batches:
            x = features({c: rows.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})
            y = rows.column(label).to_numpy(zero_copy_only=False)
            sums = [np.r_[len(p), p.sum(0), (p.T @ p).ravel()] for k in (0, 1) for p in [x[y == k]]]
            yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([list(v) for v in sums], pa.list_(pa.float64()))], names=["k", "v"])

    parts = labelled.filter(F.col(label).isin(0, 1)).select(*COUNTS, F.col(label).cast("int").alias(label)).mapInArrow(moments, "k int, v array<double>")
    got = parts.select("k", F.posexplode("v").alias("i", "v")).groupBy("k", "i").agg(F.sum("v").alias("v")).collect()
    table = np.zeros((2, 1 + d + d * d))
    for r in got:
        table[r["k"], r["i"]] = r["v"]
    return from_moments(table[:, 0], table[:, 1:1 + d], table[:, 1 + d:].reshape(2, d, d))


def score_counts(counted: DataFrame, model: Discriminant, key: str = "doc_id") -> DataFrame:
    """(doc_id, score) of rows with the COUNTS."""
    kind = counted.schema[key].dataType.simpleString()

    def run(batches):
        for rows in batches:
            x = features({c: rows.column(c).to_numpy(zero_copy_only=False) for c in COUNTS})
            yield pa.RecordBatch.from_arrays([rows.column(key), pa.array(model.score(x))], names=[key, "score"])

    return counted.select(f"`{key}`", *COUNTS).mapInArrow(run, f"`{key}` {kind}, score double")


def keep_good(docs: DataFrame, model: Discriminant, least: float, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose score is at least ``least``; texts are scored where they lie."""
    def run(batches):
        for batch in batches:
            keep = [model.score(features(counts(data, offsets))) >= least for _, data, offsets in chunks([batch], text)]
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return docs.mapInArrow(run, docs.schema)
