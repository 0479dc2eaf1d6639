"""Projections, filters, predicates, base tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import binning, scalar
from faultline.functions.documents import KEY_OF, key_paths, with_detail_values
from faultline.operators import clean
from faultline.operators.ordered import lay_out, split_by_row, with_row_index
from faultline.plans import views
from faultline.plans.registry import query, r, rs

# Point text in both engines.
_NUM = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
_PT = rf"^\s*POINT\s*Z?\s*\(\s*{_NUM}\s+{_NUM}\s+{_NUM}\s*\)\s*$"


def _ord(i: int) -> str:
    return f"TRY_CAST(regexp_extract(geo, '{_PT}', {i}) AS DOUBLE)"


COORDS = f"SELECT * REPLACE ({_ord(1)} AS longitude, {_ord(2)} AS latitude, {_ord(3)} AS elevation) FROM cat"
REFINED = (
    f"refined AS (SELECT idx, time, time_ms, magType, mag, rms, gap, dmin, longitude, latitude, elevation, detail "
    f"FROM ({COORDS}) WHERE status = 'reviewed')"
)


@query("proj_coordinates", f"SELECT idx, {r('longitude','longitude')}, {r('latitude','latitude')}, "
       f"{r('elevation','elevation')} FROM ({COORDS})")
def _(spark, d):
    return clean.expand_coordinates(views.catalog(spark, d)).select("idx", *clean.ORDINATES)


@query("src_wkt_point", f"WITH c AS ({COORDS}) SELECT count(*) AS total, count(*) FILTER (geo IS NULL) AS null_geo, "
       "count(*) FILTER (geo IS NOT NULL AND longitude IS NULL) AS invalid, "
       "count(*) FILTER (longitude IS NOT NULL) AS valid FROM c")
def _(spark, d):
    return clean.coordinate_report(views.catalog(spark, d))


@query("flt_reviewed", "SELECT idx, status, " + r("mag", "mag") + " FROM cat WHERE status = 'reviewed'")
def _(spark, d):
    return clean.reviewed(views.catalog(spark, d)).select("idx", "status", "mag")


@query("flt_earthquake", "SELECT idx, magType, " + r("mag", "mag") + " FROM cat WHERE type = 'earthquake'")
def _(spark, d):
    return clean.earthquakes(views.catalog(spark, d)).select("idx", "magType", "mag")


def _prune_sql() -> str:
    strings = {"status", "type", "magType", "place", "detail", "geo"}
    rows = []
    for c in views.CATALOG:
        share = f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM rev)"
        if c in clean.ALWAYS_KEEP:
            dropped = "false"
        elif c in strings or c in clean.ALWAYS_DROP:
            dropped = "true"
        else:
            dropped = f"{share} > 0.3"
        rows.append(f"SELECT '{c}' AS \"column\", {r(share, 'null_frac')}, {str(c in strings).lower()} AS is_string, "
                    f"{dropped} AS dropped")
    return " UNION ALL ".join(rows)


@query("prune_columns", _prune_sql(), ("rev",))
def _(spark, d):
    return clean.prune_table(clean.reviewed(views.catalog(spark, d)))


@query("proj_fixed_drop", "SELECT idx, time, time_ms, type, magType, " + rs("mag", "rms", "dmin", "longitude", "latitude", "elevation")
       + ", place, geo FROM cat")
def _(spark, d):
    return views.catalog(spark, d).drop(*clean.FEED_EXTRAS)


@query("pipe_refine", f"WITH {REFINED} SELECT idx, time, time_ms, magType, detail, "
       + rs("mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation") + " FROM refined")
def _(spark, d):
    return clean.refine_catalog(views.catalog(spark, d))


@query("proj_refill", "SELECT old_idx AS idx, nst, patch_batch, " + rs("dmin", "gap") + " FROM patch", ("patch",))
def _(spark, d):
    return clean.refine_patch(views.patch(spark, d))


@query("proj_epoch_ms", "SELECT idx, epoch_ms(time_ms) AS time, epoch_ms(updated) AS updated FROM cat")
def _(spark, d):
    return views.catalog(spark, d).select(
        "idx", scalar.epoch_millis(F.col("time_ms")).alias("time"), scalar.epoch_millis(F.col("updated")).alias("updated")
    )


_PATCHED = ("idx, magType, patch_batch, mag, rms, coalesce(c.gap, p.gap) AS gap, coalesce(c.dmin, p.dmin) AS dmin, "
            "longitude, latitude, elevation")


@query("pipe_data_prep", f"WITH {REFINED}, j AS (SELECT {_PATCHED} FROM refined c LEFT JOIN patch p ON c.idx = p.old_idx) "
       "SELECT idx, magType, patch_batch, " + rs("mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation")
       + " FROM j", ("cat", "patch"))
def _(spark, d):
    return clean.two_source_base(views.catalog(spark, d), views.patch(spark, d))


@query("pipe_notebook_base",
       f"WITH k AS (SELECT * FROM ({COORDS}) WHERE status = 'reviewed'), "
       f"j AS (SELECT {_PATCHED}, place FROM k c LEFT JOIN patch p ON c.idx = p.old_idx) "
       "SELECT idx, magType, patch_batch, place, string_split(place, ',')[-1] AS region, "
       + rs("mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation") + " FROM j", ("cat", "patch"))
def _(spark, d):
    return clean.notebook_base(views.catalog(spark, d), views.patch(spark, d))


@query("proj_dmin_km", "SELECT idx, " + r("dmin * 111.19", "dmin_km") + " FROM cat")
def _(spark, d):
    return clean.convert_dmin(views.catalog(spark, d).select("idx", "dmin"))


@query("pipe_base", "SELECT idx, magType, " + rs("mag", "rms", "gap", "dmin", "longitude", "latitude", "elevation")
       + " FROM base", ("base",))
def _(spark, d):
    return clean.model_base(views.catalog(spark, d))


@query("pipe_feed_events",
       f"SELECT idx, epoch_ms(time_ms) AS time, magType, " + rs("mag", "rms", "dmin", "longitude", "latitude", "elevation")
       + f" FROM ({COORDS}) WHERE type = 'earthquake'")
def _(spark, d):
    return clean.feed_events(views.catalog(spark, d))


_NULLS = "(nst IS NULL)::INT + (dmin IS NULL)::INT + (gap IS NULL)::INT"


@query("flt_null_patterns",
       f"SELECT idx, {_NULLS} AS n_null, nst IS NULL AS nst_null, "
       f"coalesce(length(trim(detail)) > 0, false) AND {_NULLS} >= 1 AS needs_detail, "
       f"{_NULLS} BETWEEN 1 AND 2 AS one_or_two, gap IS NULL AND dmin IS NULL AS no_gap_dmin FROM cat WHERE {_NULLS} >= 1")
def _(spark, d):
    cols = ["nst", "dmin", "gap"]
    n = clean.null_count(cols)
    return views.catalog(spark, d).filter(n >= 1).select(
        "idx", n.alias("n_null"), F.col("nst").isNull().alias("nst_null"), clean.needs_detail().alias("needs_detail"),
        n.between(1, 2).alias("one_or_two"), (F.col("gap").isNull() & F.col("dmin").isNull()).alias("no_gap_dmin"),
    )


@query("flt_row_numbers",
       f"SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS row_no FROM cat WHERE coalesce(length(trim(detail)) > 0, false) "
       f"AND {_NULLS} >= 1")
def _(spark, d):
    todo = views.catalog(spark, d).filter(clean.needs_detail()).select("idx")
    return with_row_index(lay_out(todo, "idx"), "row_no").select("idx", "row_no")


@query("flt_below_avg_mag", "SELECT idx, " + r("mag", "mag") + " FROM cat WHERE mag < (SELECT avg(mag) FROM cat)")
def _(spark, d):
    return clean.below_average(views.catalog(spark, d).select("idx", "mag"), "mag")


@query("flt_any_zero", "SELECT idx, " + rs("rms", "dmin", "gap") + " FROM cat WHERE rms = 0 OR dmin = 0 OR gap = 0 OR nst = 0")
def _(spark, d):
    return views.catalog(spark, d).filter(clean.any_zero(["rms", "dmin", "gap", "nst"])).select("idx", "rms", "dmin", "gap")


@query("flt_time_range", "SELECT idx, time, " + r("gap", "gap")
       + " FROM cat WHERE time BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-10 23:59:59' AND gap < 180")
def _(spark, d):
    cat = views.catalog(spark, d)
    return clean.time_range(cat, "2024-01-03 00:00:00", "2024-01-10 23:59:59").filter("gap < 180").select("idx", "time", "gap")


@query("flt_select_prediction",
       "SELECT idx, gap IS NULL AND dmin IS NULL AS removed, " + rs("gap", "dmin") + " FROM cat")
def _(spark, d):
    gone = F.col("gap").isNull() & F.col("dmin").isNull()
    return views.catalog(spark, d).select("idx", gone.alias("removed"), "gap", "dmin")


@query("pipe_harmonise",
       "SELECT idx, time, CAST(m AS BIGINT) AS mag_whole, " + r("coalesce(gap, (SELECT avg(gap) FROM cat))", "gap") + ", "
       + r("coalesce(dmin, (SELECT avg(dmin) FROM cat))", "dmin") + " FROM (SELECT *, CAST(round(mag * 100) AS INT) AS m FROM cat)")
def _(spark, d):
    df = views.catalog(spark, d).select(
        "idx", "time", F.round(F.col("mag") * 100).cast("int").alias("mag_whole"), "gap", "dmin",
        F.to_date("time").alias("time_bin"))
    return clean.harmonise_types(df)


@query("proj_mag_class",
       "SELECT idx, CASE WHEN mag >= 7 THEN '7+' WHEN mag >= 6 THEN '6-7' WHEN mag >= 5 THEN '5-6' WHEN mag >= 4 THEN '4-5' "
       "ELSE '<4' END AS mag_class, " + r("mag * 10000", "radius") + " FROM cat")
def _(spark, d):
    return views.catalog(spark, d).select(
        "idx", scalar.magnitude_class(F.col("mag")).alias("mag_class"), (F.col("mag") * 10000).alias("radius"))


@query("proj_region", "SELECT idx, string_split(place, ',')[-1] AS region FROM cat")
def _(spark, d):
    return views.catalog(spark, d).select("idx", scalar.region_of(F.col("place")).alias("region"))


@query("lim_head_tail",
       "SELECT * FROM (SELECT 'head' AS part, idx, " + r("mag", "mag") + " FROM cat ORDER BY idx LIMIT 5) UNION ALL "
       "SELECT * FROM (SELECT 'tail' AS part, idx, " + r("mag", "mag") + " FROM cat ORDER BY idx DESC LIMIT 5)")
def _(spark, d):
    cat = views.catalog(spark, d)
    head = cat.orderBy("idx").limit(5).select(F.lit("head").alias("part"), "idx", "mag")
    tail = cat.orderBy(F.desc("idx")).limit(5).select(F.lit("tail").alias("part"), "idx", "mag")
    return head.unionByName(tail)


_SPLIT = ("sp AS (SELECT *, row_number() OVER (ORDER BY idx) - 1 AS rn, count(*) OVER () AS n FROM base), "
          "sq AS (SELECT *, CAST(floor(n * 0.7) AS BIGINT) AS a FROM sp), "
          "splits AS (SELECT *, CASE WHEN rn < a THEN 'train' WHEN rn < a + CAST(floor((n - a) / 2.0) AS BIGINT) "
          "THEN 'valid' ELSE 'test' END AS split FROM sq)")


@query("split_sequential", f"WITH {_SPLIT} SELECT idx, rn AS row_no, split FROM splits", ("base",))
def _(spark, d):
    laid = lay_out(clean.model_base(views.catalog(spark, d)).select("idx"), "idx")
    return with_row_index(laid, "row_no").select("idx", "row_no", split_by_row(F.col("row_no"), laid.total, 0.7).alias("split"))


@query("prof_shapes",
       f"WITH {_SPLIT} SELECT split, count(*) AS rows, 9 AS columns, min(idx) AS first_idx, max(idx) AS last_idx "
       "FROM splits GROUP BY split", ("base",))
def _(spark, d):
    base = clean.model_base(views.catalog(spark, d))
    laid = lay_out(base, "idx")
    named = with_row_index(laid).withColumn("split", split_by_row(F.col("_row"), laid.total, 0.7))
    return named.groupBy("split").agg(
        F.count("*").alias("rows"), F.lit(len(base.columns)).alias("columns"),
        F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"))


@query("split_701515",
       "WITH q AS (SELECT idx, row_number() OVER (ORDER BY idx) - 1 AS rn, count(*) OVER () AS n FROM base) "
       "SELECT idx, CASE WHEN rn < CAST(floor(n * 0.7) AS BIGINT) THEN 'train' "
       "WHEN rn < CAST(floor(n * 0.7) AS BIGINT) + CAST(floor(n * 0.15) AS BIGINT) THEN 'valid' ELSE 'test' END AS split FROM q",
       ("base",))
def _(spark, d):
    laid = lay_out(clean.model_base(views.catalog(spark, d)).select("idx"), "idx")
    return with_row_index(laid).select("idx", split_by_row(F.col("_row"), laid.total, 0.7, 0.15).alias("split"))


# --- scalar functions ---------------------------------------------------------

def _guarded(name, sql, fn):
    @query(name, f"SELECT idx, {r(sql.format(x='gap'), 'gap')}, {r(sql.format(x='longitude'), 'longitude')}, "
                 f"{r(sql.format(x='rms'), 'rms')} FROM cat")
    def _(spark, d):
        return views.catalog(spark, d).select("idx", *[fn(F.col(c)).alias(c) for c in ("gap", "longitude", "rms")])


_guarded("fn_safe_log", "CASE WHEN {x} > 0 THEN ln({x} + 1) ELSE {x} END", scalar.safe_log)
_guarded("fn_safe_sqrt", "CASE WHEN {x} > 0 THEN sqrt({x}) ELSE {x} END", scalar.safe_sqrt)
_guarded("fn_safe_cbrt", "CASE WHEN {x} <> 0 THEN cbrt({x}) ELSE {x} END", scalar.safe_cbrt)
_guarded("fn_safe_cbrt_positive", "CASE WHEN {x} > 0 THEN cbrt({x}) ELSE {x} END", lambda x: scalar.safe_cbrt(x, True))


def _cycle(field: str, period: str, name: str) -> str:
    return f"{r(f'sin(2 * pi() * {field} / {period})', name + '_sin')}, {r(f'cos(2 * pi() * {field} / {period})', name + '_cos')}"


_CYCLE_ENDS = "dayofyear(time)::INT AS day_of_year, month(time)::INT AS month"


@query("fn_cyclic_v1", f"SELECT idx, {_cycle('hour(time)', '24', 'hour')}, {_cycle('month(time)', '12', 'month')}, "
       f"{_cycle('day(time)', '7', 'day')}, {_CYCLE_ENDS} FROM cat")
def _(spark, d):
    return scalar.cyclic_time(views.catalog(spark, d).select("idx", "time"), version=1).drop("time")


@query("fn_cyclic_v2", f"SELECT idx, {_cycle('hour(time)', '24', 'hour')}, {_cycle('month(time)', '12', 'month')}, "
       f"{_cycle('(isodow(time) - 1)', '7', 'day')}, {_cycle('dayofyear(time)', '365.25', 'year')}, {_CYCLE_ENDS} FROM cat")
def _(spark, d):
    return scalar.cyclic_time(views.catalog(spark, d).select("idx", "time")).drop("time")


def bin_ctes(source: str, count: int = 50) -> str:
    """CTEs ``lim``, ``edges`` and ``binned`` (lat_bin, lon_bin, labels, midpoints) over ``source``."""
    def edge(lo, w, i):
        raw = f"({lo} + {i} * {w})"
        raw = f"CASE WHEN {i} = 0 THEN {lo} - 0.001 * {count} * {w} ELSE {raw} END"
        return (f"CASE WHEN abs({raw}) < 1 AND ({raw}) <> 0 THEN round({raw}, CAST(2 - floor(log10(abs({raw}))) AS INT)) "
                f"ELSE round({raw}, 3) END")

    return (
        f"lim AS (SELECT min(latitude) AS la, (max(latitude) - min(latitude)) / {count} AS wa, "
        f"min(longitude) AS lo, (max(longitude) - min(longitude)) / {count} AS wo FROM {source}), "
        f"edges AS (SELECT k, {edge('la', 'wa', 'k')} AS ea, {edge('lo', 'wo', 'k')} AS eo FROM lim, "
        f"(SELECT unnest(range(0, {count + 1})) AS k)), "
        "steps AS (SELECT a.k, (a.ea + b.ea) / 2 AS ma, (a.eo + b.eo) / 2 AS mo, "
        "concat('(', a.ea, ', ', b.ea, ']') AS ta, concat('(', a.eo, ', ', b.eo, ']') AS te "
        "FROM edges a JOIN edges b ON b.k = a.k + 1), "
        f"cut AS (SELECT s.*, len(list_filter(range(1, {count}), lambda i: latitude > la + i * wa)) AS lat_bin, "
        f"len(list_filter(range(1, {count}), lambda i: longitude > lo + i * wo)) AS lon_bin FROM {source} s, lim), "
        "binned AS (SELECT cut.*, x.ma AS lat_bin_mid, y.mo AS lon_bin_mid, concat(x.ta, '_', y.te) AS lat_lon_bin "
        "FROM cut JOIN steps x ON x.k = lat_bin JOIN steps y ON y.k = lon_bin)"
    )


@query("fn_spatial_bins", f"WITH {bin_ctes('cat')} SELECT idx, CAST(time AS DATE) AS time_bin, lat_bin::INT AS lat_bin, "
       f"lon_bin::INT AS lon_bin, {rs('lat_bin_mid', 'lon_bin_mid')} FROM binned")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "time", "latitude", "longitude")
    return binning.spatial_bins(cat, binning.fit_bins(cat, ["latitude", "longitude"])).drop("time", "latitude", "longitude")


CODES = "codes AS (SELECT *, CAST(dense_rank() OVER (ORDER BY lat_lon_bin) - 1 AS INT) AS lat_lon_bin_encoded FROM binned)"


@query("fn_cell_encode", f"WITH {bin_ctes('cat')}, {CODES} SELECT idx, lat_lon_bin_encoded, "
       f"{rs('lat_bin_mid', 'lon_bin_mid')} FROM codes")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "time", "latitude", "longitude")
    bins = binning.fit_bins(cat, ["latitude", "longitude"])
    return binning.encode_cells(binning.spatial_bins(cat, bins), bins).select(
        "idx", "lat_lon_bin_encoded", "lat_bin_mid", "lon_bin_mid")


@query("fn_numeric_coerce",
       "SELECT idx, " + r("TRY_CAST(t AS DOUBLE)", "number") + " FROM (SELECT event_id AS idx, CASE WHEN event_id % 3 = 0 THEN props "
       "WHEN event_id % 3 = 1 THEN concat(' ', value) ELSE CAST(user_id AS VARCHAR) END AS t FROM events)", ())
def _(spark, d):
    t = F.expr("CASE WHEN event_id % 3 = 0 THEN props WHEN event_id % 3 = 1 THEN concat(' ', value) ELSE CAST(user_id AS STRING) END")
    return views.table(spark, d, "events").select(F.col("event_id").alias("idx"), scalar.numeric_text(t).alias("number"))


def _found(path: str, key: str) -> str:
    return f"TRY_CAST(json_extract_string(doc, '$.properties.products.{path}[0].properties.\"{key}\"') AS DOUBLE)"


DETAIL_VALUES = (
    "parsed AS (SELECT detail AS link, json_valid(body) AS found, CASE WHEN json_valid(body) THEN body END AS doc FROM detail_docs), "
    "vals AS (SELECT link, found, "
    + ", ".join(
        f"coalesce({_found('origin', k)}, {_found(chr(34) + 'phase-data' + chr(34), k)}) AS v_{c}"
        for c, k in {"nst": "num-stations-used", "dmin": "minimum-distance", "gap": "azimuthal-gap", "depth": "depth"}.items()
    ) + " FROM parsed)"
)


@query("json_detail_extract", f"WITH {DETAIL_VALUES} SELECT link AS detail, {r('v_nst', 'nst')}, {r('v_dmin', 'dmin')}, "
       f"{r('v_gap', 'gap')}, {r('v_depth', 'depth')} FROM vals", ("detail_docs",))
def _(spark, d):
    keys = {**KEY_OF, "depth": "depth"}
    return with_detail_values(views.detail(spark, d), "body", keys).drop("body")


@query("json_path_profile",
       "SELECT regexp_replace(replace(fullkey, '\"', ''), '\\[[0-9]+\\]', '[]', 'g') AS path, count(*) AS n "
       "FROM (SELECT body FROM detail_docs WHERE json_valid(body)) d, json_tree(d.body) WHERE fullkey <> '$' GROUP BY 1", ("detail_docs",))
def _(spark, d):
    return key_paths(views.detail(spark, d), "body")


@query("fn_hash_key",
       "SELECT idx, substr(sha256(detail), 1, 8) AS link_key, trim(regexp_replace(lower(place), '[^a-z0-9_]+', '_', 'g'), '_') AS name FROM cat")
def _(spark, d):
    return views.catalog(spark, d).select(
        "idx", scalar.short_hash(F.col("detail")).alias("link_key"),
        F.btrim(F.regexp_replace(F.lower("place"), "[^a-z0-9_]+", "_"), F.lit("_")).alias("name"))
