"""Encoders, scalers, feature tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import clean, features
from faultline.plans import views
from faultline.plans.clean_queries import CODES, bin_ctes, _SPLIT
from faultline.plans.profile_queries import NUM, _pearson
from faultline.plans.registry import query, r, rs


def _z(c: str, source: str) -> str:
    return f"({c} - (SELECT avg({c}) FROM {source})) / nullif((SELECT stddev_pop({c}) FROM {source}), 0)"


_TRAIN = "train AS (SELECT * FROM splits WHERE split = 'train')"


@query("feat_zscore", f"WITH {_SPLIT}, {_TRAIN} SELECT idx, split, {', '.join(r(_z(c, 'train'), c) for c in NUM)} FROM splits", ("base",))
def _(spark, d):
    parts = features.split_sequential(clean.model_base(views.catalog(spark, d)).select("idx", *NUM))
    return features.fit_zscore(parts.filter("split = 'train'"), NUM).transform(parts)


def _mm(c: str) -> str:
    return f"coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), CASE WHEN {c} IS NOT NULL THEN 0 END)"


@query("feat_minmax", "SELECT idx, " + ", ".join(r(_mm(c), c) for c in NUM) + ", " + r("0", "constant") + " FROM cat")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", *NUM, F.lit(3.0).alias("constant"))
    return features.fit_minmax(cat, [*NUM, "constant"]).transform(cat)


@query("feat_minmax_inverse", "SELECT idx, " + rs(*NUM) + " FROM cat")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", *NUM)
    scale = features.fit_minmax(cat, NUM)
    return scale.inverse(scale.transform(cat))


def hot(source: str, labels: tuple[str, ...] = ("ml", "mb", "md", "mww")) -> str:
    flags = ", ".join(f"CASE WHEN magType = '{t}' THEN 1 ELSE 0 END AS {t}" for t in labels)
    known = ", ".join(f"'{t}'" for t in labels)
    return f"hot AS (SELECT *, {flags}, CASE WHEN magType IN ({known}) THEN 0 ELSE 1 END AS others FROM {source})"



@query("feat_hybrid_onehot", f"WITH {hot('cat')} SELECT idx, ml, mb, md, mww, others FROM hot")
def _(spark, d):
    return features.hybrid_onehot(views.catalog(spark, d).select("idx", "magType"))


@query("feat_label_shares",
       "SELECT magType, count(*) AS n, " + r("count(*) / (SELECT count(*) FROM cat)", "share")
       + ", count(*) / (SELECT count(*) FROM cat) >= 0.003 AS kept FROM cat GROUP BY magType")
def _(spark, d):
    cat = views.catalog(spark, d)
    total = cat.count()
    share = F.col("n") / F.lit(total)
    return cat.groupBy("magType").agg(F.count("*").alias("n")).withColumns(
        {"share": share, "kept": share >= features.MIN_LABEL_SHARE})


@query("feat_missing_flags", f"WITH {hot('cat')} SELECT idx, ml, mb, md, mww, others, "
       f"CAST(dmin IS NULL AS INT) AS dmin_missing, CAST(gap IS NULL AS INT) AS gap_missing, {rs('dmin', 'gap')} FROM hot")
def _(spark, d):
    return features.missing_flags(views.catalog(spark, d).select("idx", "magType", "dmin", "gap"))


@query("feat_label_encode", "SELECT idx, magType, CAST(dense_rank() OVER (ORDER BY magType) - 1 AS INT) AS code FROM cat")
def _(spark, d):
    return features.label_encode(views.catalog(spark, d).select("idx", "magType"), "magType", "code")


_SKEWED = ["gap", "elevation", "dmin_km", "mag", "rms"]


@query("feat_skew_transform",
       "WITH k AS (SELECT *, dmin * 111.19 AS dmin_km FROM cat) " + " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", {r(f'skewness({c})', 'skew')}, CASE WHEN skewness({c}) > 1 THEN 'log' "
           f"WHEN skewness({c}) > 0.5 THEN 'sqrt' ELSE 'none' END AS transform FROM k" for c in _SKEWED))
def _(spark, d):
    return features.skew_decisions(clean.convert_dmin(views.catalog(spark, d)), _SKEWED)


def _skewed(c: str, over: str = "OVER ()") -> str:
    return (f"CASE WHEN skewness({c}) {over} > 1 AND {c} > 0 THEN ln({c} + 1) "
            f"WHEN skewness({c}) {over} > 0.5 AND skewness({c}) {over} <= 1 AND {c} > 0 THEN sqrt({c}) ELSE {c} END")


@query("pipe_transform_skew", "WITH k AS (SELECT *, dmin * 111.19 AS dmin_km FROM cat) SELECT idx, "
       + ", ".join(r(_skewed(c), c) for c in _SKEWED) + " FROM k")
def _(spark, d):
    table = clean.convert_dmin(views.catalog(spark, d).select("idx", "gap", "elevation", "dmin", "mag", "rms"))
    return features.skew_transform(table, _SKEWED)


@query("pipe_transform_fixed",
       "SELECT idx, " + r("CASE WHEN dmin > 0 THEN ln(dmin * 111.19 + 1) ELSE dmin * 111.19 END", "log_dmin_km") + ", "
       + r("CASE WHEN dmin > 0 THEN sqrt(dmin * 111.19) ELSE dmin * 111.19 END", "sqrt_dmin_km") + ", "
       + r("CASE WHEN elevation <> 0 THEN cbrt(elevation) ELSE elevation END", "cbrt_elevation") + " FROM cat")
def _(spark, d):
    out = clean.convert_dmin(views.catalog(spark, d).select("idx", "dmin", "elevation")).select(
        "idx", F.col("dmin_km").alias("log_dmin_km"), F.col("dmin_km").alias("sqrt_dmin_km"), F.col("elevation").alias("cbrt_elevation"))
    for log, square, column in ((True, True, "log_dmin_km"), (False, True, "sqrt_dmin_km"), (False, False, "cbrt_elevation")):
        out = features.fixed_transform(out, log, square, (column,), convert=False)
    return out


_PICK = ["mag", "rms", "double_mag", "dmin", "gap", "elevation"]
_PICKED = "k AS (SELECT *, 2 * mag + 1 AS double_mag FROM cat)"


@query("feat_corr_select", f"WITH {_PICKED} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", "
    + (" OR ".join(f"abs({_pearson(c, e)}) > 0.8" for e in _PICK[:i]) or "bool_or(false)") + " AS dropped FROM k"
    for i, c in enumerate(_PICK)))
def _(spark, d):
    return features.correlated_columns(views.catalog(spark, d).withColumn("double_mag", 2 * F.col("mag") + 1), _PICK)


EVENT_CTES = (
    "t AS (SELECT *, epoch(time - lag(time) OVER (ORDER BY time, idx)) AS ts0 FROM rev), "
    "f AS (SELECT idx, time, mag, rms, coalesce(gap, avg(gap) OVER ()) AS gap, coalesce(dmin, avg(dmin) OVER ()) AS dmin, "
    "longitude, latitude, elevation, coalesce(ts0, avg(ts0) OVER ()) AS time_since_last_event FROM t), "
    "days AS (SELECT CAST(time AS DATE) AS time_bin, count(mag) AS mag_count, max(mag) AS mag_max, avg(mag) AS mag_mean, "
    "epoch(max(time) - min(time)) AS day_span_s FROM f GROUP BY 1), "
    f"{bin_ctes('f')}, {CODES}, "
    "ev AS (SELECT * FROM codes JOIN days ON time_bin = CAST(time AS DATE))"
)
_EVENT_DOUBLES = ("mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation", "time_since_last_event",
                  "lat_bin_mid", "lon_bin_mid", "mag_max", "mag_mean", "day_span_s")


@query("pipe_event_features", f"WITH {EVENT_CTES} SELECT idx, time, time_bin, lat_lon_bin_encoded, mag_count, {rs(*_EVENT_DOUBLES)} FROM ev",
       ("rev",))
def _(spark, d):
    return features.event_features(clean.reviewed(views.catalog(spark, d)))


def _rolled(w: int) -> str:
    over = f"OVER (PARTITION BY lat_bin, lon_bin ORDER BY time, idx ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count(*) {over} = {w} THEN count(mag) {over} END AS c{w}, "
            f"CASE WHEN count(mag) {over} = {w} THEN max(mag) {over} END AS m{w}")


def _cyc(field: str, period: str, name: str) -> str:
    return f"{r(f'sin(2 * pi() * {field} / {period})', name + '_sin')}, {r(f'cos(2 * pi() * {field} / {period})', name + '_cos')}"


@query("pipe_training_table",
       f"WITH {EVENT_CTES}, ro AS (SELECT *, {', '.join(_rolled(w) for w in (1, 7, 30))} FROM ev) "
       f"SELECT idx, time, CAST(lat_lon_bin_encoded AS BIGINT) AS lat_lon_bin_encoded, mag_count, "
       + rs("mag", "rms", "gap", "dmin", "longitude", "latitude", "time_since_last_event", "mag_max", "mag_mean", "day_span_s") + ", "
       + ", ".join(r(f"coalesce(c{w}, avg(c{w}) OVER ())", f"eq_count_last_{w}d") for w in (1, 7, 30)) + ", "
       + ", ".join(r(f"coalesce(m{w}, avg(m{w}) OVER ())", f"max_mag_last_{w}d") for w in (7, 30)) + ", "
       + f"{_cyc('hour(time)', '24', 'hour')}, {_cyc('month(time)', '12', 'month')}, {_cyc('(isodow(time) - 1)', '7', 'day')}, "
       f"{_cyc('dayofyear(time)', '365.25', 'year')}, dayofyear(time)::INT AS day_of_year, month(time)::INT AS month FROM ro", ("rev",))
def _(spark, d):
    return features.training_table(clean.reviewed(views.catalog(spark, d)))


_MODEL = ["rms", "gap", "longitude", "latitude", "elevation", "dmin_km", "ml", "mb", "md", "mww", "mh", "others"]
_BASE_LABELS = ("ml", "mb", "md", "mww", "mh")  # labels over the share among the base rows
_SC = [c for c in _MODEL if c in features.SCALED]


@query("pipe_model_table",
       f"WITH {_SPLIT}, {hot('splits', _BASE_LABELS)}, km AS (SELECT *, dmin * 111.19 AS dmin_km FROM hot), "
       f"sk AS (SELECT idx, split, mag, " + ", ".join(f"{_skewed(c, 'OVER (PARTITION BY split)')} AS {c}" for c in _MODEL) + " FROM km), "
       "train AS (SELECT * FROM sk WHERE split = 'train') "
       f"SELECT idx, split, {r('mag', 'mag')}, " + ", ".join(r(_z(c, "train") if c in _SC else c, c) for c in _MODEL) + " FROM sk", ("base",))
def _(spark, d):
    return features.model_table(views.catalog(spark, d))


_LEGACY = ["mag", "time_since_last_event", "events_last_1", "events_last_7", "events_last_30", "events_last_90",
           "hour_sin", "hour_cos", "month_sin", "month_cos", "day_sin", "day_cos", "day_of_year", "month"]


def _turn(fn: str, field: str, period: int) -> str:
    return f"{fn}(2 * pi() * {field} / {period})"


@query("pipe_legacy_features",
       "WITH g AS (SELECT idx, time, mag, coalesce(epoch(time - lag(time) OVER o), 0) AS time_since_last_event, "
       + ", ".join(f"CASE WHEN row_number() OVER o >= {w} THEN {w} ELSE 0 END AS events_last_{w}" for w in (1, 7, 30, 90)) + ", "
       + ", ".join(f"{_turn(fn, f + '(time)', p)} AS {f}_{fn}" for f, p in (("hour", 24), ("month", 12), ("day", 7)) for fn in ("sin", "cos"))
       + ", dayofyear(time) AS day_of_year, month(time) AS month FROM rev WINDOW o AS (ORDER BY time, idx)) "
       "SELECT idx, time, " + ", ".join(r(_mm(c), c) for c in _LEGACY) + " FROM g", ("rev",))
def _(spark, d):
    return features.legacy_features(clean.reviewed(views.catalog(spark, d)).select("idx", "time", "mag"))


_DM = ["mag", "rms", "gap", "longitude", "latitude", "elevation"]


@query("pipe_dmin_table",
       "WITH k AS (SELECT idx, magType, mag, rms, gap, longitude, latitude, CASE WHEN elevation > 0 THEN ln(elevation + 1) ELSE elevation END AS elevation, "
       "CASE WHEN dmin > 0 THEN ln(dmin * 111.19 + 1) ELSE dmin * 111.19 END AS dmin_km FROM rev WHERE NOT (gap IS NULL AND dmin IS NULL)), "
       f"{_SPLIT.replace('FROM base', 'FROM k')}, {hot('splits')}, {_TRAIN} "
       f"SELECT idx, split, ml, mb, md, mww, {r('dmin_km', 'dmin_km')}, " + ", ".join(r(_z(c, 'train'), c) for c in _DM) + " FROM hot", ("rev",))
def _(spark, d):
    rev = clean.reviewed(views.catalog(spark, d))
    return features.dmin_table(rev.select("idx", "magType", "mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation"))
