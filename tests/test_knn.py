"""Neighbours by space partitioning against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import impute, knn

COLS = ["a", "b", "c", "d"]


def _data(seed: int, n: int):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    x[rng.random((n, 4)) < 0.15] = np.nan
    x[: n // 3] = [0.5, 0.5, np.nan, 0.1]        # a third are copies
    pdf = pd.DataFrame(x, columns=COLS)
    pdf["idx"] = rng.permutation(n)
    pdf["value"] = rng.integers(0, 1000, n).astype(float)
    return pdf


def _frame(spark, pdf):
    df = spark.createDataFrame(pdf, ", ".join(f"{c} double" for c in COLS) + ", idx bigint, value double")
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in COLS}).repartition(5)


def _brute(queries, donors, k, width):
    q, x = queries[COLS].to_numpy(), donors[COLS].to_numpy()
    out = {}
    for i, idx in enumerate(queries.idx):
        d = q[i] - x
        shared = (~np.isnan(d)).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.sqrt(np.nansum(d * d, axis=1) * (width / shared))
        ok = np.flatnonzero(shared > 0)
        best = ok[np.lexsort((donors.idx.to_numpy()[ok], np.round(dist, knn.RANK_DIGITS)[ok]))][:k]
        out[idx] = [(donors.idx.iloc[j], dist[j], donors.value.iloc[j]) for j in best]
    return out


def test_small_distances_are_returned_as_they_are(spark):
    row = "idx bigint, a double, value double"
    donors = spark.createDataFrame([(1, 1e-10, 1.0), (2, 3e-10, 2.0), (3, 5.0, 3.0)], row)
    got = knn.nearest(spark.createDataFrame([(9, 0.0, 0.0)], row), donors, ["a"], 2, "value").orderBy("rank").collect()
    assert [(r["donor"], r["distance"]) for r in got] == [(1, pytest.approx(1e-10, rel=1e-6)), (2, pytest.approx(3e-10, rel=1e-6))]


@pytest.mark.parametrize("leaf, block, limit, sample", [(20, 16, 20_000, 400_000), (2000, 4096, 20_000, 400_000), (20, 64, 30, 20)])
def test_nearest_equals_brute_force(spark, monkeypatch, leaf, block, limit, sample):
    """Also with a sample that is far too small for the leaves: they are asked in parts of bounded size."""
    monkeypatch.setattr(knn, "LEAF_LIMIT", limit)
    monkeypatch.setattr(knn, "MAX_SAMPLE", sample)
    monkeypatch.setattr(knn, "LEAF_POINTS", leaf)
    monkeypatch.setattr(knn, "QUERY_BLOCK", block)
    donors, queries = _data(1, 600), _data(2, 240)
    got = knn.nearest(_frame(spark, queries), _frame(spark, donors), COLS, 5, "value", width=6).toPandas()
    want = _brute(queries, donors, 5, 6)
    for idx, near in want.items():
        mine = got[got.idx == idx].sort_values("rank")
        assert mine.donor.tolist() == [n[0] for n in near]
        assert mine.distance.tolist() == pytest.approx([n[1] for n in near])
        assert mine.value.tolist() == [n[2] for n in near]
    assert len(got) == sum(len(v) for v in want.values())


def test_no_donors(spark):
    queries = _frame(spark, _data(2, 30))
    assert knn.nearest(queries, queries.filter("idx < 0"), COLS, 3, "value").count() == 0


def test_fewer_donors_than_neighbours(spark):
    donors, queries = _data(1, 600).iloc[300:303], _data(2, 30)
    got = knn.nearest(_frame(spark, queries), _frame(spark, donors), COLS, 5, "value").toPandas()
    want = _brute(queries, donors, 5, 4)
    assert len(got) == sum(len(v) for v in want.values())


def test_vote_tie_goes_to_the_nearest(spark):
    near = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "y"), (1, 4, "x"), (2, 1, "z")], "idx bigint, rank int, value string")
    assert {r["idx"]: r["predicted"] for r in knn.majority(near).collect()} == {1: "x", 2: "z"}


def _catalog(spark, n=400):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({
        "idx": np.arange(n), "latitude": rng.uniform(-90, 90, n), "longitude": rng.uniform(-180, 180, n),
        "dmin": rng.uniform(0, 5, n), "gap": rng.uniform(0, 300, n), "rms": rng.uniform(0, 1, n)})
    pdf.loc[rng.random(n) < 0.2, "gap"] = np.nan
    pdf.loc[rng.random(n) < 0.3, "dmin"] = np.nan
    df = spark.createDataFrame(pdf, "idx bigint, latitude double, longitude double, dmin double, gap double, rms double")
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("gap", "dmin")}), pdf


def test_imputing_equals_numpy(spark):
    """Donor mean by inverse distance, predicted rows scaled by the full table."""
    df, pdf = _catalog(spark)
    train, pred = impute.train_pred(df)
    got = impute.neighbour_values(train, pred, "gap").toPandas().set_index("idx").gap
    tr, pr = train.toPandas(), pred.toPandas()
    cols = list(impute.DEFAULT_IMPUTE_COLUMNS)
    weight = np.array([1.0, 1.0, 0.4, 0.4, 0.4])
    std, full = tr[cols].std(), pdf[cols].std()
    donors = tr[tr.gap.notna()]
    dx = (donors[cols] / std * weight).to_numpy()
    for part, s in ((tr, std), (pr, full)):
        for _, row in part[part.gap.isna()].iterrows():
            diff = (row[cols] / s * weight).to_numpy(dtype=float) - dx
            shared = (~np.isnan(diff)).sum(axis=1)
            d = np.sqrt(np.nansum(diff ** 2, axis=1) * 5 / shared)
            near = np.argsort(d, kind="stable")[:5]
            want = np.average(donors.gap.to_numpy()[near], weights=1 / d[near]) * s["gap"] / std["gap"]
            assert got[row.idx] == pytest.approx(want, rel=1e-6)


def test_impute_numeric_fills_everything_and_keeps_known_cells(spark):
    df, pdf = _catalog(spark)
    out = impute.impute_numeric(df).toPandas().set_index("idx")
    assert out.notna().all().all()
    known = pdf.set_index("idx")
    for c in ("gap", "dmin", "latitude"):
        mask = known[c].notna()
        assert np.allclose(out.loc[mask[mask].index, c], known.loc[mask, c])


def test_ridge_inverse_forms(spark):
    df, _ = _catalog(spark)
    filled, _ = impute.ridge_fill(df.fillna({"gap": 100.0}))
    minus, _ = impute.ridge_fill(df.fillna({"gap": 100.0}), inverse="expm1")
    gone = df.filter("dmin IS NULL").select("idx")
    both = filled.select("idx", F.col("dmin").alias("a")).join(minus.select("idx", F.col("dmin").alias("b")), "idx").join(gone, "idx").toPandas()
    assert np.allclose(both.a - both.b, 1.0)
    with pytest.raises(ValueError):
        impute.ridge_fill(df.drop("rms"))


def test_near_points_equal_the_whole_matrix_of_distances():
    """Ties, missing columns on either side, infinite values, fewer points than neighbours; squares stay small beside the whole matrix."""
    rng, k, width = np.random.default_rng(5), 5, 5
    for kind in ("plain", "ties", "asked", "given", "both", "few", "infinite"):
        q, x = rng.normal(size=(300, 4)), rng.normal(size=(4 if kind == "few" else 700, 4))
        if kind == "ties":
            q, x = np.round(q * 2) / 2, np.round(x * 2) / 2
        if kind in ("asked", "both"):
            q[rng.random(q.shape) < 0.3] = np.nan
        if kind == "given":
            x[:, :2] = np.nan
        if kind == "both":
            x[rng.random(x.shape) < 0.2] = np.nan
        if kind == "infinite":
            x[rng.random(len(x)) < 0.995, 0] = np.inf
        donor = rng.permutation(len(x))
        d = knn._distances(q, x, width)
        want = [[(int(c), d[i, c]) for c in np.lexsort((donor, np.round(d[i], knn.RANK_DIGITS)))[:k] if np.isfinite(d[i, c])] for i in range(len(q))]
        got = [[] for _ in q]
        for rows, cols, near in knn._ranked_near(q, x, donor, k, width):
            for i, c, v in zip(rows, cols, near):
                got[i].append((int(c), v))
        assert got == want, kind
