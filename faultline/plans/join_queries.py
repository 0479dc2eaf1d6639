"""Patches, incremental selection, detail look-ups, as-of joins, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import clean, joins, profile
from faultline.plans import views
from faultline.plans.clean_queries import DETAIL_VALUES, _NULLS
from faultline.plans.registry import query, r, rs

_LINK = "coalesce(length(trim(detail)) > 0, false)"


@query("join_combine_first",
       "SELECT c.idx, patch_batch, coalesce(c.nst, p.nst) AS nst, " + r("coalesce(c.gap, p.gap)", "gap") + ", "
       + r("coalesce(c.dmin, p.dmin)", "dmin") + ", " + r("mag", "mag")
       + " FROM cat c LEFT JOIN patch p ON c.idx = p.old_idx", ("cat", "patch"))
def _(spark, d):
    left = views.catalog(spark, d).select("idx", "nst", "gap", "dmin", "mag")
    return joins.combine_first(left, clean.refine_patch(views.patch(spark, d)))


@query("join_fill_patch",
       "SELECT c.idx, coalesce(c.nst, p.nst) AS nst, " + r("coalesce(c.gap, p.gap)", "gap") + ", "
       + r("coalesce(c.dmin, p.dmin)", "dmin") + " FROM cat c LEFT JOIN patch p ON c.idx = p.old_idx", ("cat", "patch"))
def _(spark, d):
    left = views.catalog(spark, d).select("idx", "nst", "gap", "dmin")
    return joins.fill_from(left, clean.refine_patch(views.patch(spark, d)))


@query("join_incremental_anti", "SELECT idx, magType FROM cat WHERE idx NOT IN (SELECT old_idx FROM patch)", ("cat", "patch"))
def _(spark, d):
    return joins.not_processed(views.catalog(spark, d).select("idx", "magType"), views.patch(spark, d))


@query("join_patched_semi", "SELECT idx, magType FROM cat WHERE idx IN (SELECT old_idx FROM patch)", ("cat", "patch"))
def _(spark, d):
    return joins.also_in(views.catalog(spark, d).select("idx", "magType"), clean.refine_patch(views.patch(spark, d)))


_DAILY = ("days AS (SELECT CAST(time AS DATE) AS day, count(mag) AS mag_count, max(mag) AS mag_max, avg(mag) AS mag_mean, "
          "epoch(max(time) - min(time)) AS day_span_s FROM cat GROUP BY 1)")


@query("join_asof_daily",
       f"WITH {_DAILY} SELECT idx, day, mag_count, {rs('mag_max', 'mag_mean', 'day_span_s')} FROM cat LEFT JOIN days "
       "ON day = CAST(time AS DATE)")
def _(spark, d):
    cat = views.catalog(spark, d)
    days = profile.daily(cat)
    return cat.select("idx", F.to_date("time").alias("day")).join(days, "day", "left")


_QUOTES = "quotes AS (SELECT user_id, ts + INTERVAL 90 MINUTE AS ts, value AS last_value, event_id AS last_id FROM events)"


@query("join_asof_general",
       f"WITH {_QUOTES} SELECT e.event_id AS idx, CASE WHEN e.ts - q.ts <= INTERVAL 1 DAY THEN q.ts END AS ts_right, "
       f"{r('CASE WHEN e.ts - q.ts <= INTERVAL 1 DAY THEN q.last_value END', 'last_value')}, "
       "CASE WHEN e.ts - q.ts <= INTERVAL 1 DAY THEN q.last_id END AS last_id "
       "FROM events e ASOF LEFT JOIN quotes q ON e.user_id = q.user_id AND e.ts >= q.ts", ())
def _(spark, d):
    ev = views.table(spark, d, "events")
    quotes = ev.select("user_id", (F.col("ts") + F.expr("interval 90 minutes")).alias("ts"),
                       F.col("value").alias("last_value"), F.col("event_id").alias("last_id"))
    left = ev.select(F.col("event_id").alias("idx"), "user_id", "ts")
    return joins.asof_join(left, quotes, "ts", ["last_value", "last_id"], by="user_id", tolerance_seconds=86400) \
        .drop("user_id", "ts")


_UPDATES = f"{DETAIL_VALUES}, todo AS (SELECT trim(detail) AS link, idx FROM cat WHERE {_LINK} AND {_NULLS} >= 1)"


@query("join_detail_dedup",
       f"WITH {_UPDATES}, links AS (SELECT link, count(*) AS n FROM todo GROUP BY link) "
       "SELECT CAST(sum(n) AS BIGINT) AS rows_considered, count(*) AS links, count(*) FILTER (coalesce(found, false)) AS completed, "
       "count(*) FILTER (NOT coalesce(found, false)) AS failed FROM links LEFT JOIN vals USING (link)", ("cat", "detail_docs"))
def _(spark, d):
    return joins.detail_counters(views.catalog(spark, d), views.detail(spark, d))


_FILLED = ("filled AS (SELECT c.idx, c.detail, CASE WHEN need THEN coalesce(c.nst, CAST(v_nst AS BIGINT)) ELSE c.nst END AS nst, "
           "CASE WHEN need THEN coalesce(c.dmin, v_dmin) ELSE c.dmin END AS dmin, "
           "CASE WHEN need THEN coalesce(c.gap, v_gap) ELSE c.gap END AS gap, c.nst IS NULL AS no_nst, magType, mag, rms, "
           "elevation, longitude, latitude, time, time_ms "
           f"FROM (SELECT *, {_LINK} AND {_NULLS} >= 1 AS need FROM cat) c LEFT JOIN vals ON trim(c.detail) = link)")


@query("pipe_filter_and_fill", f"WITH {DETAIL_VALUES}, {_FILLED} SELECT idx, nst, {rs('dmin', 'gap')} FROM filled",
       ("cat", "detail_docs"))
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "detail", "nst", "dmin", "gap")
    return joins.fill_from_details(cat, views.detail(spark, d)).drop("detail")


@query("pipe_patch_job",
       f"WITH {DETAIL_VALUES}, {_FILLED} SELECT idx AS old_idx, time, time_ms, magType, detail, nst, "
       f"{rs('mag', 'rms', 'gap', 'dmin', 'longitude', 'latitude', 'elevation')} FROM filled WHERE no_nst "
       "AND idx NOT IN (SELECT user_id FROM events)", ("cat", "detail_docs"))
def _(spark, d):
    done = views.table(spark, d, "events").select(F.col("user_id").alias("old_idx")).distinct()
    return joins.patch_job(views.catalog(spark, d), views.detail(spark, d), done)


@query("join_cell_features",
       "WITH f AS (SELECT CAST(time AS DATE) AS day, magType, max(mag) AS top, count(*) AS n FROM cat GROUP BY 1, 2, tsunami) "
       "SELECT c.idx, n, " + r("top", "top") + " FROM cat c LEFT JOIN f ON f.day = CAST(c.time AS DATE) AND f.magType = c.magType")
def _(spark, d):
    cat = views.catalog(spark, d).withColumn("day", F.to_date("time"))
    feats = cat.groupBy("day", "magType", "tsunami").agg(F.max("mag").alias("top"), F.count("*").alias("n")).drop("tsunami")
    return cat.select("idx", "day", "magType").join(feats, ["day", "magType"], "left").select("idx", "n", "top")


@query("set_union_by_name",
       "SELECT idx, magType, " + r("gap", "gap") + ", " + r("NULL", "dmin") + " FROM cat UNION ALL "
       "SELECT old_idx, NULL, " + r("gap", "gap") + ", " + r("dmin", "dmin") + " FROM patch", ("cat", "patch"))
def _(spark, d):
    return joins.recombine(
        views.catalog(spark, d).select("idx", "magType", "gap"),
        clean.refine_patch(views.patch(spark, d)).select("idx", "gap", "dmin"))


@query("set_distinct", f"SELECT DISTINCT trim(detail) AS link FROM cat WHERE {_LINK}")
def _(spark, d):
    return views.catalog(spark, d).filter(clean.has_link()).select(F.trim("detail").alias("link")).distinct()


@query("set_split_recombine", "SELECT idx, dmin IS NOT NULL AS known, " + r("dmin", "dmin") + " FROM cat")
def _(spark, d):
    known, unknown = joins.split_by_null(views.catalog(spark, d).select("idx", "dmin"), "dmin")
    return joins.recombine(known.withColumn("known", F.lit(True)), unknown.withColumn("known", F.lit(False)))


@query("sort_time", "SELECT idx, time, " + r("mag", "mag") + " FROM cat ORDER BY time, idx")
def _(spark, d):
    return views.catalog(spark, d).select("idx", "time", "mag").orderBy("time", "idx")
