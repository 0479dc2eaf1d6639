"""Sources, sinks and streaming jobs over data derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions import binning
from faultline.operators import clean
from faultline.plans import views
from faultline.plans.clean_queries import DETAIL_VALUES, _NULLS, bin_ctes
from faultline.plans.join_queries import _LINK
from faultline.plans.registry import query, r, rs
from faultline.session import new_path
from faultline.sources import feeds, tables
from faultline.streaming import jobs


@query("src_periods",
       "WITH y AS (SELECT make_date(year(min(l_shipdate)), 1, 1)::TIMESTAMP AS a, "
       "least(make_date(year(max(l_shipdate)) + 1, 1, 1)::TIMESTAMP, max(l_shipdate)) AS b FROM lineitem), "
       "s AS (SELECT unnest(generate_series(a, b, INTERVAL 180 DAY)) AS starts, b FROM y), "
       "w AS (SELECT strftime(starts, 'period_%Y%m') AS period, starts, least(starts + INTERVAL 180 DAY, b) AS ends FROM s "
       "WHERE starts < b QUALIFY row_number() OVER (PARTITION BY period ORDER BY starts DESC) = 1) "
       "SELECT period, starts, ends, concat('starttime=', strftime(starts, '%Y-%m-%d'), '%2000:00:00&endtime=', "
       "strftime(ends, '%Y-%m-%d'), '%2000:00:00&minmagnitude=2.5&orderby=time') AS request, "
       "(SELECT count(*) FROM lineitem WHERE l_shipdate >= starts AND l_shipdate < ends) AS landed FROM w", ())
def _(spark, d):
    item = views.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("t"))
    years = item.agg(F.year(F.min("t")).alias("start_year"), F.year(F.max("t")).alias("end_year"), F.max("t").alias("now"))
    periods = feeds.ingestion_windows(years)
    first = item.agg(F.date_trunc("year", F.min("t")).cast("timestamp_ntz")).first()[0]
    step = F.floor(F.timestamp_diff("DAY", F.lit(first), F.col("t")) / 180)
    end = periods.agg(F.max("ends")).first()[0]  # windows exclude their end
    landed = item.filter(F.col("t") < F.lit(end)).groupBy(step.alias("step")).agg(F.count("*").alias("landed"))
    starts = (F.lit(first) + F.make_dt_interval(days=(F.col("step") * 180).cast("int"))).alias("starts")
    counted = landed.select(starts, "landed")
    return periods.join(counted, "starts", "left").withColumn("landed", F.coalesce("landed", F.lit(0)))


@query("src_geojson", "SELECT CAST(idx AS VARCHAR) AS id, time_ms AS time, updated, status, magType, "
       + rs("mag", "gap", "dmin", "longitude", "latitude", "elevation") + " FROM cat")
def _(spark, d):
    path = new_path(spark, "geojson")
    feeds.write_geojson(views.catalog(spark, d).withColumn("time", F.col("time_ms")), path)
    return feeds.read_geojson(spark, path).select(
        "id", "time", "updated", "status", "magType", "mag", "gap", "dmin", "longitude", "latitude", "elevation")


@query("src_union_periods", "SELECT idx, magType, " + rs("mag", "gap") + ", " + r("CASE WHEN type = 'earthquake' THEN dmin END", "dmin") + " FROM cat")
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "type", "magType", "mag", "gap", "dmin")
    first, second, never = (new_path(spark, "period") for _ in range(3))
    cat.filter("type = 'earthquake'").drop("type").write.parquet(first)
    cat.filter("type <> 'earthquake'").drop("type", "dmin").write.parquet(second)
    return feeds.fetch_or_cache(spark, new_path(spark, "cache"), [first, second, never])


_CSV = "idx bigint, time timestamp_ntz, magType string, mag double, gap double, place string"


@query("src_csv", "SELECT idx, time, magType, place, " + rs("mag", "gap") + " FROM cat")
def _(spark, d):
    path = new_path(spark, "csv")
    feeds.write_csv(views.catalog(spark, d).select("idx", "time", "magType", "mag", "gap", "place"), path)
    return feeds.read_csv(spark, path, _CSV)


@query("sink_roundtrip_csv", "SELECT idx, time, magType, place, CAST(year(time) AS INT) AS year, " + rs("mag", "gap") + " FROM cat")
def _(spark, d):
    path = new_path(spark, "csv")
    feeds.write_csv(views.catalog(spark, d).select("idx", "time", "magType", "mag", "gap", "place"), path, by_year="time")
    return feeds.read_csv(spark, path, _CSV + ", year int")


@query("src_table_nonempty", "SELECT idx, magType, " + r("mag", "mag") + " FROM cat")
def _(spark, d):
    views.catalog(spark, d).select("idx", "magType", "mag").createOrReplaceTempView("faultline_raw_catalog")
    return feeds.fetch_table(spark, "faultline_raw_catalog")


_REL = "regexp_replace(url, '^[a-z]+://', '')"
_BARE = f"regexp_replace({_REL}, '\\.[^./]*$', '')"
_CLEAN = f"trim(regexp_replace(lower(replace({_BARE}, '/', '_')), '[^a-z0-9_]+', '_', 'g'), '_')"


@query("src_table_names",
       f"WITH c AS (SELECT page_id, {_CLEAN} AS c FROM pages), n AS (SELECT page_id, CASE WHEN regexp_matches(c, '^[0-9]') "
       "THEN concat('data_', c) ELSE c END AS n FROM c) SELECT page_id, CASE WHEN length(n) > 63 THEN "
       "concat(substr(n, 1, 54), '_', substr(sha256(n), 1, 8)) ELSE n END AS \"table\", "
       "count(*) OVER (PARTITION BY n) AS same_name FROM n", ())
def _(spark, d):
    pages = views.table(spark, d, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("rel"))
    named = pages.select("page_id", tables.table_name(F.col("rel")).alias("table"))
    return named.join(named.groupBy("table").agg(F.count("*").alias("same_name")), "table")


@query("sink_staged_swap", "SELECT magType, count(*) AS n, " + r("sum(mag)", "mag_sum") + " FROM rev GROUP BY magType", ("rev",))
def _(spark, d):
    cat = views.catalog(spark, d).select("idx", "status", "magType", "mag")
    tables.staged_load(cat, "faultline_swap")
    loaded = tables.staged_load(clean.reviewed(cat), "faultline_swap")
    return loaded.groupBy("magType").agg(F.count("*").alias("n"), F.sum("mag").alias("mag_sum"))


@query("sink_load_all",
       "SELECT CASE WHEN magType IN ('ml', 'md') THEN 'faultline_raw' ELSE 'faultline_prepped' END AS schema, "
       "concat('feed_magtype_', lower(magType)) AS \"table\", count(*) AS n, " + r("sum(mag)", "mag_sum") + " FROM cat WHERE magType IN ('ml', 'md', 'mb') GROUP BY magType")
def _(spark, d):
    root = new_path(spark, "imports")
    cat = views.catalog(spark, d).select("idx", "magType", "mag").filter(F.col("magType").isin("ml", "md", "mb"))
    for label in ("ml", "md", "mb"):
        folder = f"{root}/ready" if label == "mb" else root
        cat.filter(F.col("magType") == label).coalesce(1).write.option("header", True).csv(f"{folder}/feed/magType={label}")
    files = tables.discover_imports(spark, root, "ready", "faultline_raw", "faultline_prepped")
    # a writer's part files carry random names; the folder names the table
    files = files.withColumn("table", tables.table_name(F.regexp_extract("path", r"(feed/magType=[^/]*)/[^/]*$", 1)))
    loaded = tables.load_all(files, lambda path: spark.read.csv(path, header=True, schema="idx bigint, magType string, mag double"))
    sums = [spark.table(f"{x['schema']}.{x['table']}").agg(F.sum("mag").alias("mag_sum")).select(F.lit(x["table"]).alias("table"), "mag_sum") for x in loaded.collect()]
    out = sums[0]
    for s in sums[1:]:
        out = out.unionByName(s)
    return loaded.join(out, "table")


@query("sink_clustered", "SELECT idx, magType, " + rs("latitude", "longitude") + " FROM cat WHERE latitude BETWEEN 10 AND 20 AND longitude BETWEEN 0 AND 90")
def _(spark, d):
    path = new_path(spark, "clustered")
    cat = views.catalog(spark, d).select("idx", "magType", "latitude", "longitude")
    cells = cat.withColumns({"lat_cell": F.floor(F.col("latitude") / 10), "lon_cell": F.floor(F.col("longitude") / 10)})
    tables.write_clustered(cells, path, "lat_cell", "lon_cell", "idx")
    return spark.read.parquet(path).filter("latitude BETWEEN 10 AND 20 AND longitude BETWEEN 0 AND 90").drop("lat_cell", "lon_cell")


# --- streaming -------------------------------------------------------------------

def _stream(spark, d, *columns):
    events = jobs.file_stream(spark, d, views.table(spark, d, "events").schema, "events.parquet")
    return events.selectExpr(*[f"{views.CATALOG[c]} AS {c}" for c in columns])


def _cells(spark, d, stream):
    bins = binning.fit_bins(views.catalog(spark, d), ["latitude", "longitude"], 50)
    return binning.spatial_bins(stream, bins).withColumn("cell", F.col("lat_bin") * 50 + F.col("lon_bin"))


@query("st_ingest", "SELECT idx, updated, time, magType, " + r("mag", "mag") + " FROM cat")
def _(spark, d):
    return jobs.ingest(_stream(spark, d, "idx", "updated", "time", "magType", "mag"), new_path(spark, "ingest"))


@query("st_ingest_batches", "SELECT idx, updated, time, magType, " + r("mag", "mag") + " FROM cat")
def _(spark, d):
    """Several micro-batches, a third of the rows landed again in an older version."""
    landing = new_path(spark, "landing")
    cat = views.catalog(spark, d).select("idx", "updated", "time", "magType", "mag")
    older = cat.filter("idx % 3 = 0").withColumns({"updated": F.col("updated") - 1, "mag": F.col("mag") + 1})
    cat.unionByName(older).repartition(3).write.parquet(landing)
    return jobs.ingest(jobs.file_stream(spark, landing, cat.schema, files_per_batch=1), new_path(spark, "ingest"))


@query("st_daily", "SELECT CAST(time AS DATE) AS day, count(mag) AS mag_count, " + r("max(mag)", "mag_max") + ", "
       + r("avg(mag)", "mag_mean") + " FROM cat GROUP BY 1")
def _(spark, d):
    return jobs.daily(_stream(spark, d, "time", "mag"), new_path(spark, "daily"))


@query("st_sliding_cell",
       f"WITH {bin_ctes('cat', 50)}, w AS (SELECT unnest(generate_series(date_trunc('day', time) - INTERVAL 6 DAY, date_trunc('day', time), "
       "INTERVAL 1 DAY)) AS starts, CAST(lat_bin * 50 + lon_bin AS INT) AS cell, mag FROM binned) "
       f"SELECT starts, starts + INTERVAL 7 DAY AS ends, cell, count(mag) AS eq_count, {r('max(mag)', 'max_mag')} FROM w GROUP BY 1, 2, 3")
def _(spark, d):
    stream = _cells(spark, d, _stream(spark, d, "time", "mag", "latitude", "longitude")).select("time", "mag", "cell")
    return jobs.sliding(stream, new_path(spark, "sliding"), "cell")


@query("st_sliding_cell_30",
       f"WITH {bin_ctes('cat', 50)}, w AS (SELECT unnest(generate_series(date_trunc('day', time) - INTERVAL 29 DAY, date_trunc('day', time), "
       "INTERVAL 1 DAY)) AS starts, CAST(lat_bin * 50 + lon_bin AS INT) AS cell, mag FROM binned) "
       f"SELECT starts, starts + INTERVAL 30 DAY AS ends, cell, count(mag) AS eq_count, {r('max(mag)', 'max_mag')} FROM w GROUP BY 1, 2, 3")
def _(spark, d):
    stream = _cells(spark, d, _stream(spark, d, "time", "mag", "latitude", "longitude")).select("time", "mag", "cell")
    return jobs.sliding(stream, new_path(spark, "sliding"), "cell", days=30)


@query("st_gap",
       f"WITH {bin_ctes('cat', 50)} SELECT idx, CAST(lat_bin * 50 + lon_bin AS INT) AS cell, "
       + r("epoch(time - lag(time) OVER (PARTITION BY lat_bin, lon_bin ORDER BY time, idx))", "pause_s") + " FROM binned")
def _(spark, d):
    stream = _cells(spark, d, _stream(spark, d, "idx", "time", "latitude", "longitude")).select("idx", "time", "cell")
    return jobs.pauses(stream, new_path(spark, "pauses"), "cell").select("idx", "cell", "pause_s")


@query("st_sessions",
       f"WITH {bin_ctes('cat', 50)}, g AS (SELECT *, CAST(lat_bin * 50 + lon_bin AS INT) AS cell, "
       "CASE WHEN time - lag(time) OVER o < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM binned WINDOW o AS (PARTITION BY lat_bin, lon_bin ORDER BY time, idx)), "
       "n AS (SELECT *, sum(fresh) OVER (PARTITION BY cell ORDER BY time, idx) AS no FROM g) "
       f"SELECT cell, min(time) AS starts, max(time) + INTERVAL 6 HOUR AS ends, count(*) AS events, {r('max(mag)', 'max_mag')} FROM n "
       "GROUP BY cell, no HAVING max(time) + INTERVAL 6 HOUR <= (SELECT max(time) FROM cat) - INTERVAL 1 DAY")
def _(spark, d):
    stream = _cells(spark, d, _stream(spark, d, "time", "mag", "latitude", "longitude")).select("time", "mag", "cell")
    return jobs.sessions(stream, new_path(spark, "sessions"), "cell", "6 hours")


@query("st_patch",
       f"WITH {DETAIL_VALUES} SELECT c.idx, CASE WHEN need THEN coalesce(c.nst, CAST(v_nst AS BIGINT)) ELSE c.nst END AS nst, "
       f"{r('CASE WHEN need THEN coalesce(c.dmin, v_dmin) ELSE c.dmin END', 'dmin')}, {r('CASE WHEN need THEN coalesce(c.gap, v_gap) ELSE c.gap END', 'gap')} "
       f"FROM (SELECT *, {_LINK} AND {_NULLS} >= 1 AS need FROM cat) c LEFT JOIN vals ON trim(c.detail) = link", ("cat", "detail_docs"))
def _(spark, d):
    stream = _stream(spark, d, "idx", "detail", "nst", "dmin", "gap")
    return jobs.patch(stream, views.detail(spark, d), new_path(spark, "patched")).drop("detail")
