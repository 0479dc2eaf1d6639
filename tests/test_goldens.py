"""Hand-sized cases with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline.functions.binning import fit_bins
from faultline.functions.documents import with_detail_values
from faultline.functions.scalar import epoch_millis, wkt_ordinate
from faultline.operators import clean, features, joins, metrics, profile, windows
from faultline.operators.quantiles import exact_percentiles

T = dt.datetime


def test_skew_and_percentile(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 50)], "x double")
    row = df.agg(profile.adjusted_skew("x").alias("g"), F.skewness("x").alias("p")).first()
    assert row["g"] == pytest.approx(2.2206404584946937)
    assert row["p"] == pytest.approx(1.4896509056341307)
    q = exact_percentiles(df.withColumn("k", F.lit(1)), ["k"], "x", [0.1, 1.0]).first()
    assert q["percentiles"] == pytest.approx([1.4, 50.0]) and q["n"] == 5


def test_percentiles_equal_numpy_with_a_hot_value(spark, many_partitions):
    import numpy as np

    values = [7.0] * 400 + [float(i * i % 101) for i in range(601)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", None)], "k string, v double").repartition(8)
    probs = [0.0, 0.1, 0.333, 0.5, 0.9, 1.0]
    got = {r["k"]: r["percentiles"] for r in exact_percentiles(df, ["k"], "v", probs).collect()}
    assert got["a"] == pytest.approx(np.quantile(values, probs).tolist())
    assert got["b"] == [1.0] * 6


def test_equal_width_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.2345678, 3.3, 7.77777, 10.0, None)], "x double")
    bins = fit_bins(df, ["x"], 5)["x"]
    labels = bins.labels()
    got = [r["b"] for r in df.select("x", bins.index(F.col("x")).alias("b")).collect()]
    assert [None if b is None else labels[b] for b in got] == [
        "(-0.01, 2.0]", "(-0.01, 2.0]", "(2.0, 4.0]", "(6.0, 8.0]", "(8.0, 10.0]", None]


def test_bin_edges_are_rounded(spark):
    df = spark.createDataFrame([(x,) for x in (-120.123456, -119.5, 33.98765)], "x double")
    bins = fit_bins(df, ["x"], 50)["x"]
    got = [bins.labels()[r["b"]] for r in df.select(bins.index(F.col("x")).alias("b")).collect()]
    assert got == ["(-120.278, -117.041]", "(-120.278, -117.041]", "(30.905, 33.988]"]


def test_constant_column_bins(spark):
    bins = fit_bins(spark.createDataFrame([(5.0,), (5.0,)], "x double"), ["x"], 5)["x"]
    assert bins.low < 5 < bins.high


def test_row_rolling(spark):
    rows = [(i, T(2024, 1, 1, i), m, 1.0, 1.0) for i, m in enumerate([1.0, None, 3.0, 2.0])]
    df = spark.createDataFrame(rows, "idx bigint, time timestamp_ntz, mag double, lat double, lon double")
    got = windows.rolling_rows(df, ("lat", "lon"), (2,)).orderBy("idx").collect()
    assert [r["eq_count_last_2d"] for r in got] == [None, 1, 1, 2]
    assert [r["max_mag_last_2d"] for r in got] == [None, None, None, 3.0]


def test_daily_resample(spark):
    rows = [(T(2024, 1, 1, 1), 1.0), (T(2024, 1, 1, 2), None), (T(2024, 1, 3, 3), 3.0), (T(2024, 1, 3, 3), 2.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, mag double")
    got = [tuple(r)[1:] for r in profile.daily(df).orderBy("day").collect()]
    assert got == [(1, 1.0, 1.0, 3600.0), (0, None, None, None), (2, 3.0, 2.5, 0.0)]


def test_combine_first(spark):
    left = spark.createDataFrame([(5, 1, None), (3, None, 2)], "idx bigint, z int, b int")
    right = spark.createDataFrame([(5, 9, 1), (3, 8, 2), (4, 7, 3)], "idx bigint, b int, a int")
    out = joins.combine_first(left, right)
    assert out.columns == ["idx", "a", "b", "z"]
    assert {tuple(r) for r in out.collect()} == {(5, 1, 9, 1), (3, 2, 2, None)}


def test_epoch_millis(spark):
    got = spark.range(1).select(epoch_millis(F.lit(1700000000123)).alias("t")).first()["t"]
    assert got == T(2023, 11, 14, 22, 13, 20, 123000)


@pytest.mark.parametrize("text, want", [
    ("POINT Z (1.5 -2 3e1)", (1.5, -2.0, 30.0)), ("POINT (1 2 3)", (1.0, 2.0, 3.0)), ("POINT (1 2)", (None,) * 3),
    ("LINESTRING (1 2, 3 4)", (None,) * 3), (None, (None,) * 3), ("POINT EMPTY", (None,) * 3), ("POINT Z (1 2 3.4.5)", (1.0, 2.0, None)),
])
def test_wkt(spark, text, want):
    df = spark.createDataFrame([(text,)], "geo string").select(*[wkt_ordinate(F.col("geo"), i) for i in range(3)])
    assert tuple(df.first()) == want


def test_coordinate_guards(spark):
    with pytest.raises(KeyError):
        clean.expand_coordinates(spark.createDataFrame([(1,)], "x int"))
    with pytest.raises(ValueError, match="missing"):
        clean.check_coordinates(spark.createDataFrame([(None,)], "geo string"))
    with pytest.raises(ValueError, match="3-D"):
        clean.check_coordinates(spark.createDataFrame([("POINT (1 2)",)], "geo string"))


def test_detail_search_takes_the_first_hit(spark):
    doc = ('{"type":"FeatureCollection","features":[{"properties":{"products":{'
           '"phase-data":[{"properties":{"azimuthal-gap":"77","minimum-distance":"0.5"}}],'
           '"origin":[{"properties":{"depth":"x"}},{"properties":{"azimuthal-gap":"12","num-stations-used":" 9 "}},'
           '{"properties":{"azimuthal-gap":"13"}}],"other":[{"properties":{"depth":"4.5"}}]}}}]}')
    df = spark.createDataFrame([(doc,), ("nonsense",), (None,), ('{"properties":{"products":{}}}',)], "body string")
    keys = {"gap": "azimuthal-gap", "nst": "num-stations-used", "dmin": "minimum-distance", "depth": "depth"}
    got = [tuple(r)[1:] for r in with_detail_values(df, "body", keys).collect()]
    assert got == [(12.0, 9.0, 0.5, None)] + [(None,) * 4] * 3
    every = with_detail_values(df.limit(1), "body", {"gap": "azimuthal-gap"}, products=None).first()
    assert every["gap"] in (77.0, 12.0)   # products of a map come in no fixed order


def test_numeric_columns_leave_out_booleans_and_text(spark):
    df = spark.createDataFrame([(1, 1.0, True, "a")], "i int, d double, b boolean, s string")
    assert clean.numeric_columns(df) == ["i", "d"]
    assert clean.numeric_columns(df, ["d", "b", "x"]) == ["d"]
    assert clean.non_numeric_columns(df) == ["b", "s"]


def test_prune_needs_its_columns(spark):
    with pytest.raises(KeyError):
        clean.prune_table(spark.createDataFrame([(1,)], "x int"))


def test_constant_columns_do_not_correlate(spark):
    df = spark.createDataFrame([(float(i), 0.1, 2.0 * i) for i in range(50)], "a double, c double, b double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0) and got[("a", "c")] == 0.0 and got[("c", "c")] == 0.0


def test_nan_is_missing_after_normalising(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert clean.normalise_nan(df).filter("x IS NULL").count() == 2


def test_r2_guards(spark):
    def frame(*rows):
        return spark.createDataFrame(list(rows), "y double, p double")

    assert metrics.r2_score(frame((1.0, 1.0), (1.0, 1.0)), "y", "p") == 1.0
    assert metrics.r2_score(frame((1.0, 1.0), (1.0, 2.0)), "y", "p") == 0.0
    with pytest.raises(ValueError):
        metrics.r2_score(frame((1.0, float("nan"))), "y", "p")
    with pytest.raises(ValueError):
        metrics.r2_score(spark.createDataFrame([], "y double, p double"), "y", "p")


def test_onehot_rows_sum_to_one(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None) for i in range(100)] + [(100, "rare")], "idx bigint, magType string")
    out = features.hybrid_onehot(df, labels=features.frequent_labels(df, share=0.05))
    assert set(out.columns) == {"idx", "a", "b", "c", "others"}
    assert out.filter("a + b + c + others <> 1").count() == 0
    assert out.filter("idx = 100").first()["others"] == 1


def test_zscore_has_mean_zero_and_deviation_one(spark, sf):
    from faultline.plans import views

    df = views.catalog(spark, sf).select("mag", "gap")
    out = features.fit_zscore(df, ["mag", "gap"]).transform(df).agg(F.avg("gap").alias("m"), F.stddev_pop("gap").alias("s")).first()
    assert out["m"] == pytest.approx(0, abs=1e-9) and out["s"] == pytest.approx(1)


def test_patch_keeps_known_cells(spark, sf):
    from faultline.plans import views

    cat = views.catalog(spark, sf).select("idx", "nst", "gap", "dmin")
    out = joins.fill_from(cat, clean.refine_patch(views.patch(spark, sf))).alias("o")
    changed = cat.alias("c").join(out, "idx").filter("c.gap IS NOT NULL AND NOT c.gap <=> o.gap OR c.dmin IS NOT NULL AND NOT c.dmin <=> o.dmin")
    assert changed.count() == 0


def test_asof_takes_inclusive_tolerance(spark):
    left = spark.createDataFrame([(1, "a", T(2024, 1, 2)), (2, "a", T(2024, 1, 3, 0, 0, 1)), (3, "b", T(2024, 1, 2))], "idx bigint, k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", T(2024, 1, 1), 7.0), ("a", T(2024, 1, 5), 8.0)], "k string, t timestamp_ntz, v double")
    got = {r["idx"]: r["v"] for r in joins.asof_join(left, right, "t", ["v"], by="k", tolerance_seconds=86400).collect()}
    assert got == {1: 7.0, 2: None, 3: None}


def test_incremental_guards(spark):
    df = spark.createDataFrame([(1,), (2,)], "idx bigint")
    assert joins.not_processed(df, None).count() == 2
    with pytest.raises(ValueError):
        joins.not_processed(df, df)


def test_injected_fetch_looks_every_link_up_once(spark):
    links = spark.createDataFrame([(" u1 ",), ("u1",), ("u2",)], "detail string")
    store = {"u1": "{}"}
    got = {r["detail"]: r["body"] for r in joins.fetch_documents(links, store.get).collect()}
    assert got == {"u1": "{}", "u2": None}
