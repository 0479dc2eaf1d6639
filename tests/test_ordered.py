"""Global-order operators against pandas, with hot keys and many small chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import ordered, windows

N = 3_000


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    hot = rng.random(N) < 0.4
    pdf = pd.DataFrame({
        "idx": np.arange(N),
        "cell": np.where(hot, "hot", np.char.add("c", rng.integers(0, 300, N).astype(str))),
        "time": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 60 * 24 * 3600, N), unit="s"),
        "mag": np.where(rng.random(N) < 0.1, np.nan, rng.integers(20, 80, N) / 10),
    })
    pdf.loc[rng.random(N) < 0.2, "time"] = pd.Timestamp("2024-01-20")  # many equal times
    return pdf


@pytest.fixture
def df(spark, table):
    schema = "idx bigint, cell string, time timestamp_ntz, mag double"
    return spark.createDataFrame(table, schema).withColumn("mag", F.nanvl("mag", F.lit(None))).repartition(7)


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch, many_partitions):
    """Chunks of 64 rows, so that every frame crosses chunk borders."""
    monkeypatch.setattr(ordered, "_chunk_rows", lambda laid, halo, limit: max(64, halo))


def test_row_index_is_the_global_row_number(df, table):
    got = ordered.with_row_index(ordered.lay_out(df, "time", "idx")).select("idx", "_row").toPandas()
    want = table.sort_values(["time", "idx"]).idx.to_numpy()
    assert (got.sort_values("_row").idx.to_numpy() == want).all()
    assert sorted(got._row) == list(range(N))


def test_frames_over_ranges_need_one_exchange(df, table, tmp_path):
    df.write.parquet(f"{tmp_path}/rows")
    rows = df.sparkSession.read.parquet(f"{tmp_path}/rows")
    for out in (windows.time_since_last(rows), windows.time_since_last(rows, by="cell"), windows.rolling_rows(rows, ("cell",))):
        plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert plan.count("Exchange") == 1 and "ordered-" not in plan  # nothing but the frames' own shuffle


def test_ranges_copy_enough_rows_for_any_frame(df):
    """Slots of a few rows, frames that reach over several chunks, and a key that fills many of them."""
    cut = ordered.ranges(df, "cell", "time", "idx")
    assert sum(cut.counts) == N and len(cut.counts) > 8 * ordered.SLOTS
    for before in (0, 1, 29, 500, 2 * N):
        own = cut.framed(before)
        assert ordered.home(own).count() == N
        held = {(r["_chunk"], r["copy"]): r["count"] for r in own.groupBy("_chunk", (F.col("_home") < F.col("_chunk")).alias("copy")).count().collect()}
        seen = 0
        for chunk in sorted({c for c, _ in held}):
            assert held.get((chunk, True), 0) >= min(before, seen)
            seen += held[(chunk, False)]


def test_ranges_of_odd_tables(spark):
    schema = "idx bigint, cell string, time timestamp_ntz, mag double"
    assert windows.rolling_rows(spark.createDataFrame([], schema), ("cell",)).count() == 0
    rows = [(1, None, None, 1.0), (2, None, None, 2.0), (None, "a", None, None)]
    got = windows.time_since_last(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 3 and all(r["time_since_last_event"] is None for r in got)


def test_time_since_last(df, table):
    got = windows.time_since_last(df).toPandas().set_index("idx").time_since_last_event
    want = table.sort_values(["time", "idx"]).set_index("idx").time.diff().dt.total_seconds()
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_time_since_last_by_cell(df, table):
    got = windows.time_since_last(df, by="cell").toPandas().set_index("idx").time_since_last_event
    want = table.sort_values(["time", "idx"]).set_index("idx").groupby("cell").time.diff().dt.total_seconds()
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False)


def test_rolling_rows_equal_pandas(df, table):
    got = windows.rolling_rows(df, ("cell",), (1, 7, 30)).toPandas().set_index("idx").sort_index()
    by = table.sort_values(["time", "idx"]).set_index("idx").groupby("cell").mag
    for w in (1, 7, 30):
        count = by.rolling(w, min_periods=0).count().droplevel(0)
        seen = by.cumcount() + 1
        want = count.where(seen >= w).sort_index()
        pd.testing.assert_series_equal(got[f"eq_count_last_{w}d"], want, check_names=False)
        top = by.rolling(w).max().droplevel(0).sort_index()
        pd.testing.assert_series_equal(got[f"max_mag_last_{w}d"], top, check_names=False)


def test_rolling_days_equal_brute_force(df, table):
    got = windows.rolling_days(df, "cell").toPandas().set_index("idx").sort_index()
    for w in (1, 7, 30):
        counts, tops = {}, {}
        for _, g in table.groupby("cell"):
            t, m = g.time.to_numpy(), g.mag.to_numpy()
            for i, idx in enumerate(g.idx):
                inside = m[(t <= t[i]) & (t >= t[i] - np.timedelta64(w, "D"))]
                inside = inside[~np.isnan(inside)]
                counts[idx], tops[idx] = len(inside), inside.max() if len(inside) else np.nan
        assert (got[f"eq_count_last_{w}d"] == pd.Series(counts).sort_index()).all()
        pd.testing.assert_series_equal(got[f"max_mag_last_{w}d"], pd.Series(tops).sort_index(), check_names=False)


def test_fill_forward(df, table):
    got = windows.fill_forward(df.select("idx", "mag"), ["mag"]).toPandas().set_index("idx").mag.sort_index()
    want = table.set_index("idx").mag.sort_index().ffill()
    pd.testing.assert_series_equal(got, want, check_names=False)


def test_sequences(df, table):
    filled = df.fillna({"mag": 0.0})
    got = windows.sequences(filled, ["mag"], ["mag"], 20).toPandas().sort_values("row")
    m = table.fillna({"mag": 0.0}).sort_values(["time", "idx"]).mag.to_numpy()
    assert len(got) == N - 20
    for row, x, y in zip(got.row, got.x, got.y):
        assert [v[0] for v in x] == m[row:row + 20].tolist() and y[0] == m[row + 20]


def test_sequential_split_sizes(df):
    sizes = {r["split"]: r["count"] for r in windows.split_sequential(df).groupBy("split").count().collect()}
    assert sizes == {"train": 2100, "valid": 450, "test": 450}
    for bad in (0, 1):
        with pytest.raises(ValueError):
            windows.split_sequential(df, train=bad)
    with pytest.raises(ValueError):
        windows.split_sequential(df.filter("idx < 0"))
    with pytest.raises(ValueError):
        windows.split_xy(df, "absent")


def test_stratified_split_sizes(df, table):
    out = windows.split_stratified(df, F.col("mag").isNull())
    got = {(r["m"], r["part"]): r["count"] for r in out.groupBy(F.col("mag").isNull().alias("m"), "part").count().collect()}
    missing = int(table.mag.isna().sum())
    assert got[(True, "pred")] == round(0.2 * missing) and got[(False, "pred")] == round(0.2 * (N - missing))
    again = windows.split_stratified(df.repartition(3), F.col("mag").isNull())
    assert out.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        windows.split_stratified(df, F.col("mag").isNull(), shuffle=False)
    plain = windows.split_stratified(df, None, shuffle=False)
    assert plain.filter("part = 'pred'").agg(F.min("idx")).first()[0] == 2400


def test_asof_with_a_hot_key(spark, df, table):
    from faultline.operators.joins import asof_join

    right = df.select("cell", (F.col("time") + F.expr("interval 1 hour")).alias("time"), F.col("idx").alias("rid"))
    got = asof_join(df, right, "time", ["rid"], by="cell", tolerance_seconds=5 * 86400).toPandas().set_index("idx")
    shifted = table.assign(time=table.time + pd.Timedelta("1h")).sort_values("time")[["cell", "time"]]
    shifted["t2"] = shifted.time
    want = pd.merge_asof(table.sort_values("time"), shifted, on="time", by="cell", tolerance=pd.Timedelta("5D")).set_index("idx").t2
    pd.testing.assert_series_equal(got.time_right.sort_index(), want.sort_index(), check_names=False, check_dtype=False)


def test_hot_key_is_spread_over_partitions(df):
    laid = ordered.lay_out(df.repartition(8), "cell", "time", "idx")
    parts = laid.df.filter("cell = 'hot'").select("_part").distinct().count()
    assert parts > 1
