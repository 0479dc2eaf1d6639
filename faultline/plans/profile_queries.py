"""Profiles, aggregates, scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import clean, joins, metrics, profile
from faultline.operators.quantiles import exact_percentiles
from faultline.plans import views
from faultline.plans.registry import query, r, rs

NUM = ["mag", "rms", "dmin", "gap", "elevation"]
MASKED = ["nst", "dmin", "gap", "felt", "detail", "geo"]


def _each(columns, select: str, source: str = "cat") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns)


_NONFINITE = ("isnan(x) OR isinf(x)")


@query("prof_missing",
       f"SELECT 'x' AS \"column\", count(*) AS total, count(*) FILTER (x IS NULL OR isnan(x)) AS null_count, "
       "count(*) FILTER (x = 'Infinity'::DOUBLE) AS pos_inf, count(*) FILTER (x = '-Infinity'::DOUBLE) AS neg_inf, "
       f"count(*) FILTER ({_NONFINITE}) AS non_finite, {r('100.0 * count(*) FILTER (x IS NULL OR isnan(x)) / count(*)', 'null_pct')} "
       "FROM nonfinite" + "".join(f" UNION ALL SELECT '{c}', count(*), count(*) FILTER ({c} IS NULL), 0, 0, 0, "
                                  f"{r(f'100.0 * count(*) FILTER ({c} IS NULL) / count(*)')} FROM nonfinite" for c in ("idx", "label")), ("nonfinite",))
def _(spark, d):
    rows = views.nonfinite(spark, d)
    return profile.missing_summary(rows, rows.columns)


@query("prof_numeric_columns", _each(
    ["idx", "time_ms", "updated", "mag", "rms", "gap", "dmin", "nst", "felt", "tsunami", "sig", "longitude", "latitude", "elevation"],
    "count({c}) AS present"))
def _(spark, d):
    cat = views.catalog(spark, d)
    columns = clean.numeric_columns(cat)
    return profile.per_column(cat, columns, {"present": F.count})


@query("prof_missing_delta",
       "WITH j AS (SELECT c.nst, c.dmin, c.gap, coalesce(c.nst, p.nst) AS nst2, coalesce(c.dmin, p.dmin) AS dmin2, "
       "coalesce(c.gap, p.gap) AS gap2 FROM cat c LEFT JOIN patch p ON c.idx = p.old_idx) "
       + " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS raw_missing, count(*) - count({c}2) AS patched_missing, "
           f"count({c}2) - count({c}) AS reduction FROM j" for c in ("nst", "dmin", "gap"))
       + " UNION ALL SELECT 'depth', NULL, NULL, NULL", ("cat", "patch"))
def _(spark, d):
    raw = views.catalog(spark, d).select("idx", "nst", "dmin", "gap")
    patched = joins.fill_from(raw, clean.refine_patch(views.patch(spark, d)))
    return profile.missing_delta(raw, patched, ["nst", "dmin", "gap", "depth"])


def _flag(c: str) -> str:
    return f"CASE WHEN {c} IS NULL" + (f" OR {c} = ''" if c in ("detail", "geo") else "") + " THEN 1 ELSE 0 END"


_MASK = "mask AS (SELECT idx, " + ", ".join(f"{_flag(c)} AS {c}" for c in MASKED) + " FROM cat)"


@query("prof_mask", f"WITH {_MASK} SELECT idx, {', '.join(f'CAST({c} AS INT) AS {c}' for c in MASKED)} FROM mask")
def _(spark, d):
    return profile.missing_mask(views.catalog(spark, d), MASKED, keep=("idx",))


@query("prof_sparsity", f"WITH {_MASK} " + _each(
    MASKED, "CAST(sum({c}) AS BIGINT) AS missing, round(avg({c}), 4) AS sparsity_ratio, "
            "CASE WHEN round(avg({c}), 4) > 0.4 THEN 'OUT' ELSE 'IN' END AS status", "mask"))
def _(spark, d):
    return profile.sparsity(views.catalog(spark, d), MASKED)


def _pearson(a: str, b: str) -> str:
    x, y = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
    return f"coalesce(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 0.0)"


def _matrix(columns, source) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(_pearson(a, b), 'r')} FROM {source}" for a in columns for b in columns)


@query("prof_null_corr", f"WITH {_MASK}, m AS ({_matrix(MASKED, 'mask')}) "
       "SELECT *, CASE WHEN r > 0 THEN 'positive' WHEN r < 0 THEN 'negative' ELSE 'none' END AS side FROM m")
def _(spark, d):
    m = profile.null_correlation(views.catalog(spark, d), MASKED).withColumn("r", F.round("r", 6))
    return m.withColumn("side", F.when(F.col("r") > 0, "positive").when(F.col("r") < 0, "negative").otherwise("none"))


@query("agg_corr_matrix", _matrix(NUM + ["tsunami"], "cat"))
def _(spark, d):
    return profile.correlation(views.catalog(spark, d), NUM + ["tsunami"])


@query("agg_moments", _each(NUM, r("avg({c})", "mean") + ", " + r("var_pop({c})", "variance")))
def _(spark, d):
    return profile.moments(views.catalog(spark, d), NUM)


_Z = "(({c} - (SELECT avg({c}) FROM cat)) / (SELECT stddev_pop({c}) FROM cat))"


@query("agg_skew_pop", _each(NUM, r(f"avg(pow({_Z}, 3))", "skew_pop")))
def _(spark, d):
    return profile.skew_kurtosis(views.catalog(spark, d), NUM).select("column", "skew_pop")


@query("agg_kurtosis", _each(NUM, r("kurtosis_pop({c})", "kurtosis_excess") + ", " + r("kurtosis_pop({c}) + 3", "kurtosis_plain")))
def _(spark, d):
    return profile.skew_kurtosis(views.catalog(spark, d), NUM).drop("skew_pop")


@query("agg_skew_adj", _each(NUM, r("skewness({c})", "skew")))
def _(spark, d):
    return profile.skew_table(views.catalog(spark, d), NUM)


@query("agg_safe_std", "SELECT " + ", ".join(r(f"coalesce(nullif(stddev_samp({c}), 0), 1)", c) for c in NUM) + ", "
       + r("1.0", "constant") + " FROM cat")
def _(spark, d):
    cat = views.catalog(spark, d).withColumn("constant", F.lit(7.0))
    return cat.agg(*[profile.safe_std(c).alias(c) for c in NUM + ["constant"]])


@query("agg_describe", _each(NUM, "count({c}) AS n, " + ", ".join(
    r(e, n) for e, n in [("avg({c})", "mean"), ("stddev_samp({c})", "std"), ("min({c})", "min"), ("max({c})", "max"),
                         ("quantile_cont({c}, 0.25)", "p25"), ("quantile_cont({c}, 0.5)", "p50"),
                         ("quantile_cont({c}, 0.75)", "p75")])))
def _(spark, d):
    return profile.describe(views.catalog(spark, d), NUM)


@query("agg_mag_range_by_type",
       "SELECT coalesce(magType, 'all') AS magType, count(*) AS n, " + r("min(mag)", "mag_min") + ", " + r("max(mag)", "mag_max")
       + " FROM cat GROUP BY GROUPING SETS ((magType), ())")
def _(spark, d):
    return views.catalog(spark, d).rollup("magType").agg(
        F.count("*").alias("n"), F.min("mag").alias("mag_min"), F.max("mag").alias("mag_max")
    ).withColumn("magType", F.coalesce("magType", F.lit("all")))


@query("agg_value_counts", "SELECT magType, count(*) AS n FROM cat GROUP BY magType")
def _(spark, d):
    return profile.value_counts(views.catalog(spark, d), "magType").orderBy(F.desc("n"), "magType")


@query("agg_singletons", "SELECT place, count(*) AS n FROM cat GROUP BY place HAVING count(*) = 1")
def _(spark, d):
    return profile.value_counts(views.catalog(spark, d), "place").filter("n = 1")


@query("agg_region_null_dmin",
       "SELECT string_split(place, ',')[-1] AS region, count(*) AS n FROM cat WHERE dmin IS NULL GROUP BY 1")
def _(spark, d):
    from faultline.functions.scalar import region_of
    gone = views.catalog(spark, d).filter("dmin IS NULL").withColumn("region", region_of(F.col("place")))
    return profile.value_counts(gone, "region")


@query("agg_daily",
       "WITH cal AS (SELECT CAST(unnest(generate_series(min(time)::DATE, max(time)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM rev) "
       "SELECT day, count(mag) AS mag_count, " + r("max(mag)", "mag_max") + ", " + r("avg(mag)", "mag_mean") + ", "
       + r("epoch(max(time) - min(time))", "day_span_s") + " FROM cal LEFT JOIN rev ON time::DATE = day GROUP BY day", ("rev",))
def _(spark, d):
    return profile.daily(clean.reviewed(views.catalog(spark, d)))


@query("fill_mean", "SELECT idx, " + r("coalesce(gap, avg(gap) OVER ())", "gap") + ", " + r("coalesce(dmin, avg(dmin) OVER ())", "dmin")
       + " FROM cat")
def _(spark, d):
    return profile.fill_numeric(views.catalog(spark, d).select("idx", "gap", "dmin"), ["gap", "dmin"])


@query("fill_zero", "SELECT idx, coalesce(nst, 0) AS nst, " + r("coalesce(gap, 0)", "gap") + " FROM cat")
def _(spark, d):
    return profile.fill_numeric(views.catalog(spark, d).select("idx", "nst", "gap"), filler="zero")


# Scores compare the magnitude with a rough stand-in prediction.
_PRED = "p AS (SELECT magType, mag AS y, 0.9 * mag + rms - 0.5 AS yhat FROM cat)"


def _scored(spark, d):
    return views.catalog(spark, d).select("magType", F.col("mag").alias("y"), (0.9 * F.col("mag") + F.col("rms") - 0.5).alias("yhat"))


_R2 = "1 - sum((y - yhat) ** 2) / (var_pop(y) * count(y))"


@query("metric_r2", f"WITH {_PRED} SELECT magType, {r(_R2, 'r2')}, {r(_R2, 'r2_guarded')} FROM p GROUP BY magType")
def _(spark, d):
    return _scored(spark, d).groupBy("magType").agg(
        metrics.r2_expr("y", "yhat").alias("r2"), metrics.r2_guarded_expr("y", "yhat").alias("r2_guarded"))


@query("metric_regression",
       f"WITH {_PRED} SELECT count(*) AS n, {r('avg(abs(y - yhat))', 'mae')}, {r('sqrt(avg((y - yhat) ** 2))', 'rmse')}, "
       f"{r('avg((y - yhat) ** 2) / 2', 'half_mse')}, {r(_R2, 'r2')}, "
       f"{r('1 - sum((y - yhat) ** 2) / (var_pop(yhat) * count(y))', 'r2_swapped')} FROM p")
def _(spark, d):
    stats = metrics.regression_exprs("y", "yhat")
    stats["r2_swapped"] = metrics.regression_exprs("y", "yhat", swap=True)["r2"]
    return _scored(spark, d).agg(F.count("*").alias("n"), *[c.alias(n) for n, c in stats.items()])


@query("metric_huber", f"WITH {_PRED} SELECT " + r(
    "avg(CASE WHEN abs(y - yhat) <= 1 THEN 0.5 * (y - yhat) ** 2 ELSE abs(y - yhat) - 0.5 END)", "huber") + " FROM p")
def _(spark, d):
    return _scored(spark, d).agg(metrics.huber_expr("y", "yhat").alias("huber"))


_GRID = [(10 + 80 * i / 19) / 100 for i in range(20)]


@query("agg_percentile_grid", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {i} AS step, {r(f'quantile_cont({c}, {p!r})', 'percentile')} FROM cat"
    for c in NUM for i, p in enumerate(_GRID)))
def _(spark, d):
    long = profile.long_form(views.catalog(spark, d), NUM)
    q = exact_percentiles(long, ["column"], "value", _GRID)
    return q.select("column", F.posexplode("percentiles").alias("step", "percentile"))


def _hist_sql(value: str, where: str, bins: int = 30) -> str:
    parts = []
    for c in NUM:
        v = value.format(c=c)
        parts.append(
            f"SELECT '{c}' AS \"column\", k AS bin, {r('a + k * w', 'low')}, {r('a + (k + 1) * w', 'high')}, "
            f"(SELECT count(*) FROM cat WHERE {where.format(c=c)} AND least(CAST(floor(({v} - a) / w) AS INT), {bins - 1}) = k) AS n "
            f"FROM (SELECT min({v}) AS a, (max({v}) - min({v})) / {bins} AS w FROM cat WHERE {where.format(c=c)}), "
            f"(SELECT CAST(unnest(range(0, {bins})) AS INT) AS k)")
    return " UNION ALL ".join(parts)


@query("agg_histogram", _hist_sql("{c}", "{c} IS NOT NULL"))
def _(spark, d):
    return profile.histogram(views.catalog(spark, d), NUM)


@query("agg_log_histogram", _hist_sql("ln({c})", "{c} > 0"))
def _(spark, d):
    return profile.histogram(views.catalog(spark, d), NUM, log=True)


@query("agg_boxplot", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rs('q1', 'median', 'q3')}, "
    f"{r('min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1))'.format(c=c), 'whisker_low')}, "
    f"{r('max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1))'.format(c=c), 'whisker_high')}, "
    f"count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers "
    f"FROM cat, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM cat) "
    "GROUP BY q1, median, q3" for c in NUM))
def _(spark, d):
    return profile.boxplot(views.catalog(spark, d), NUM)


@query("agg_hist2d",
       "SELECT CAST(floor(latitude / 10) AS BIGINT) AS lat10, CAST(floor(longitude / 10) AS BIGINT) AS lon10, magType, count(*) AS n "
       "FROM cat GROUP BY 1, 2, 3")
def _(spark, d):
    return profile.joint_counts(
        views.catalog(spark, d), F.floor(F.col("latitude") / 10).alias("lat10"),
        F.floor(F.col("longitude") / 10).alias("lon10"), F.col("magType"))


@query("agg_hist2d_mag",
       "SELECT CAST(floor(mag) AS BIGINT) AS mag1, magType, CAST(floor(longitude / 10) AS BIGINT) AS lon10, count(*) AS n FROM cat GROUP BY 1, 2, 3")
def _(spark, d):
    return profile.joint_counts(
        views.catalog(spark, d), F.floor("mag").alias("mag1"), F.col("magType"), F.floor(F.col("longitude") / 10).alias("lon10"))
