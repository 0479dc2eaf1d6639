"""Time gaps, rolling windows, sequences, splits, fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import binning
from faultline.operators import clean, profile, windows
from faultline.plans import views
from faultline.plans.clean_queries import bin_ctes
from faultline.plans.registry import query, r, rs

_GAPS = "gaps AS (SELECT idx, time, mag, epoch(time - lag(time) OVER (ORDER BY time, idx)) AS time_since_last_event FROM rev)"


def _reviewed(spark, d, *columns):
    return clean.reviewed(views.catalog(spark, d)).select(*columns)


@query("win_time_since_last", f"WITH {_GAPS} SELECT idx, {r('time_since_last_event', 'time_since_last_event')} FROM gaps", ("rev",))
def _(spark, d):
    return windows.time_since_last(_reviewed(spark, d, "idx", "time")).drop("time")


@query("daily_activity",
       f"WITH {_GAPS}, days AS (SELECT CAST(time AS DATE) AS day, count(mag) AS mag_count, max(mag) AS mag_max, avg(mag) AS mag_mean, "
       "epoch(max(time) - min(time)) AS day_span_s FROM rev GROUP BY 1) "
       f"SELECT idx, day, mag_count, {rs('mag_max', 'mag_mean', 'day_span_s', 'time_since_last_event')} "
       "FROM gaps JOIN days ON day = CAST(time AS DATE)", ("rev",))
def _(spark, d):
    rev = _reviewed(spark, d, "idx", "time", "mag")
    gaps = windows.time_since_last(rev).withColumn("day", F.to_date("time")).drop("mag", "time")
    return gaps.join(profile.daily(rev), "day", "left")


@query("win_gap_by_type",
       "SELECT idx, " + r("epoch(time - lag(time) OVER (PARTITION BY magType ORDER BY time, idx))", "gap_s") + " FROM rev", ("rev",))
def _(spark, d):
    return windows.time_since_last(_reviewed(spark, d, "idx", "time", "magType"), by="magType", name="gap_s").select("idx", "gap_s")


@query("agg_daily_gap",
       f"WITH {_GAPS}, z AS (SELECT *, coalesce(time_since_last_event, 0) AS s FROM gaps), "
       "cal AS (SELECT CAST(unnest(generate_series(min(time)::DATE, max(time)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM rev) "
       f"SELECT day, count(mag) AS mag_count, {r('max(mag)', 'mag_max')}, {r('avg(mag)', 'mag_mean')}, "
       f"{r('avg(s)', 'time_since_last_event_mean')} FROM cal LEFT JOIN z ON CAST(time AS DATE) = day GROUP BY day", ("rev",))
def _(spark, d):
    gaps = windows.time_since_last(_reviewed(spark, d, "idx", "time", "mag"))
    return profile.daily(gaps.withColumn("time_since_last_event", F.coalesce("time_since_last_event", F.lit(0.0))),
                         mean_of="time_since_last_event")


def _cells(spark, d, bins=50):
    cat = views.catalog(spark, d).select("idx", "time", "mag", "latitude", "longitude")
    return binning.spatial_bins(cat, binning.fit_bins(cat, ["latitude", "longitude"], bins))


def _rows(w: int, keys: str) -> str:
    over = f"OVER (PARTITION BY {keys} ORDER BY time, idx ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return (f"{r(f'CASE WHEN count(*) {over} = {w} THEN count(mag) {over} END', f'eq_count_last_{w}d')}, "
            f"{r(f'CASE WHEN count(mag) {over} = {w} THEN max(mag) {over} END', f'max_mag_last_{w}d')}")


@query("win_rolling_rows",
       f"WITH {bin_ctes('cat', 50)} SELECT idx, " + ", ".join(_rows(w, "lat_bin_mid, lon_bin_mid") for w in (1, 7, 30)) + " FROM binned")
def _(spark, d):
    out = windows.rolling_rows(_cells(spark, d, 50), ("lat_bin_mid", "lon_bin_mid"))
    return out.select("idx", *[c for c in out.columns if "_last_" in c])


def _days(w: int) -> str:
    over = f"OVER (PARTITION BY lat_bin, lon_bin ORDER BY time RANGE BETWEEN INTERVAL {w} DAY PRECEDING AND CURRENT ROW)"
    return f"count(mag) {over} AS eq_count_last_{w}d, {r(f'max(mag) {over}', f'max_mag_last_{w}d')}"


@query("win_rolling_days", f"WITH {bin_ctes('cat', 50)} SELECT idx, " + ", ".join(_days(w) for w in (1, 7, 30)) + " FROM binned")
def _(spark, d):
    cells = _cells(spark, d, 50).withColumn("cell", F.col("lat_bin") * 50 + F.col("lon_bin"))
    out = windows.rolling_days(cells, "cell")
    return out.select("idx", *[c for c in out.columns if "_last_" in c])


@query("win_events_last", "SELECT idx, " + ", ".join(
    f"CAST(CASE WHEN row_number() OVER (ORDER BY time, idx) >= {w} THEN {w} ELSE 0 END AS INT) AS events_last_{w}" for w in (1, 7, 30, 90))
    + " FROM rev", ("rev",))
def _(spark, d):
    return windows.events_last(_reviewed(spark, d, "idx", "time")).drop("time")


_SEQ = 168
_FOLLOW = f"(ORDER BY time, idx ROWS BETWEEN CURRENT ROW AND {_SEQ - 1} FOLLOWING)"


@query("win_sequences",
       f"WITH s AS (SELECT idx, row_number() OVER o - 1 AS \"row\", count(*) OVER () AS n, "
       f"array_to_string(list(CAST(round(mag * 100) AS BIGINT)) OVER {_FOLLOW}, ',') AS x_mag, "
       f"array_to_string(list(CAST(round(rms * 100) AS BIGINT)) OVER {_FOLLOW}, ',') AS x_rms, "
       f"lead(mag, {_SEQ}) OVER o AS y_mag, lead(rms, {_SEQ}) OVER o AS y_rms FROM cat WINDOW o AS (ORDER BY time, idx)) "
       f"SELECT \"row\", x_mag, x_rms, {rs('y_mag', 'y_rms')} FROM s WHERE \"row\" < n - {_SEQ}")
def _(spark, d):
    seq = windows.sequences(views.catalog(spark, d), ["mag", "rms"], ["mag", "rms"], _SEQ)

    def text(i):
        return F.array_join(F.transform("x", lambda v: F.round(v[i] * 100).cast("bigint").cast("string")), ",")

    return seq.select("row", text(0).alias("x_mag"), text(1).alias("x_rms"),
                      F.col("y")[0].alias("y_mag"), F.col("y")[1].alias("y_rms"))


STRATIFIED = (
    "strat AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY gap IS NULL ORDER BY md5(concat(CAST(idx AS VARCHAR), '/42')), idx) "
    "<= round(0.2 * count(*) OVER (PARTITION BY gap IS NULL)) THEN 'pred' ELSE 'train' END AS part FROM cat)"
)


@query("split_stratified", f"WITH {STRATIFIED} SELECT idx, part, gap IS NULL AS gap_missing FROM strat")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", F.col("gap").isNull().alias("gap_missing"))
    return windows.split_stratified(cat, F.col("gap_missing"))


@query("fill_forward",
       "SELECT idx, last_value(nst IGNORE NULLS) OVER w AS nst, " + r("last_value(gap IGNORE NULLS) OVER w", "gap") + ", "
       + r("last_value(dmin IGNORE NULLS) OVER w", "dmin") + " FROM cat WINDOW w AS (ORDER BY idx ROWS UNBOUNDED PRECEDING)")
def _(spark, d):
    return windows.fill_forward(views.catalog(spark, d).select("idx", "nst", "gap", "dmin"), ["nst", "gap", "dmin"])


@query("seq_forecast_hours",
       "SELECT CAST(step AS INT) AS step, (SELECT max(time) FROM cat) + step * INTERVAL 1 HOUR AS timestamp "
       "FROM (SELECT unnest(range(1, 49)) AS step)")
def _(spark, d):
    return windows.forecast_hours(views.catalog(spark, d), 2)
