"""Sources, sinks and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faultline.operators import joins, profile
from faultline.plans import views
from faultline.session import new_path
from faultline.sources import feeds, tables
from faultline.streaming import jobs

T = dt.datetime


def test_ingestion_windows(spark):
    years = spark.createDataFrame([(2023, 2024, T(2024, 5, 1, 12))], "start_year int, end_year int, now timestamp_ntz")
    got = [(r["period"], r["starts"], r["ends"]) for r in feeds.ingestion_windows(years).orderBy("starts").collect()]
    assert got == [
        ("period_202301", T(2023, 1, 1), T(2023, 6, 30)), ("period_202306", T(2023, 6, 30), T(2023, 12, 27)),
        ("period_202312", T(2023, 12, 27), T(2024, 5, 1, 12))]
    default = spark.createDataFrame([(None, None, T(2024, 5, 1))], "start_year int, end_year int, now timestamp_ntz")
    assert feeds.ingestion_windows(default).agg(F.min("starts")).first()[0] == T(2019, 1, 1)


def test_colliding_window_keys_keep_the_last(spark):
    years = spark.createDataFrame([(2024, 2024, T(2024, 3, 1))], "start_year int, end_year int, now timestamp_ntz")
    got = feeds.ingestion_windows(years, months=1).collect()
    assert len({r["period"] for r in got}) == len(got)


def test_broken_and_empty_collections(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"type":"FeatureCollection","features":[]}\nnot json\n{"type":"FeatureCollection","features":'
                                     '[{"id":"x","properties":{"mag":3.5},"geometry":{"coordinates":[1,2]}}]}\n')
    rows = feeds.read_geojson(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and (rows[0]["mag"], rows[0]["longitude"], rows[0]["elevation"]) == (3.5, 1.0, None)


def test_nothing_fetched_is_none(spark):
    assert feeds.fetch_or_cache(spark, new_path(spark, "cache"), [new_path(spark, "never")]) is None


def test_table_guards(spark):
    with pytest.raises(RuntimeError):
        feeds.fetch_table(spark, "no_such_table")
    spark.range(0).createOrReplaceTempView("empty_table")
    with pytest.raises(ValueError):
        feeds.fetch_table(spark, "empty_table")


def test_failed_load_keeps_the_target(spark):
    tables.staged_load(spark.range(3), "load_target")
    with pytest.raises(ValueError):
        tables.staged_load(spark.range(0), "load_target")
    assert spark.table("load_target").count() == 3
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("_staging")]


@pytest.mark.parametrize("path, name", [
    ("Raw Data/Quakes-2024.csv", "raw_data_quakes_2024"), ("2024/x.csv", "data_2024_x"), ("__a__.csv", "a"),
])
def test_table_names(spark, path, name):
    assert spark.createDataFrame([(path,)], "p string").select(tables.table_name(F.col("p"))).first()[0] == name


def test_long_names_are_hashed(spark):
    import hashlib

    long = "x" * 80
    got = spark.createDataFrame([(long + ".csv",)], "p string").select(tables.table_name(F.col("p"))).first()[0]
    assert got == "x" * 54 + "_" + hashlib.sha256(long.encode()).hexdigest()[:8]


def test_discovery(spark, tmp_path):
    (tmp_path / "engineered").mkdir()
    (tmp_path / "raw.csv").write_text("a\n1\n")
    (tmp_path / "engineered" / "patch.csv").write_text("a\n1\n")
    got = {(r["schema"], r["table"]) for r in tables.discover_imports(spark, str(tmp_path), "engineered").collect()}
    assert got == {("raw", "raw"), ("prepped", "patch")}
    (tmp_path / "RAW!.csv").write_text("a\n1\n")
    with pytest.raises(ValueError):
        tables.discover_imports(spark, str(tmp_path), "engineered")
    with pytest.raises(FileNotFoundError):
        tables.discover_imports(spark, str(_empty(tmp_path)), "engineered")


def _empty(tmp_path):
    (tmp_path / "void").mkdir()
    return tmp_path / "void"


def test_bucketed_table(spark):
    tables.write_bucketed(spark.range(100).withColumn("k", F.col("id") % 7), "bucketed_target", "k", 4)
    assert spark.table("bucketed_target").count() == 100


# --- streams: three files, repeated and late rows -----------------------------------

@pytest.fixture
def landing(spark, sf):
    """The catalogue in three landed files; the second repeats a third of the first's ids with newer versions."""
    cat = views.catalog(spark, sf).select("idx", "time", "updated", "mag", "detail", "nst", "dmin", "gap", (F.col("idx") % 5).alias("cell"))
    path = new_path(spark, "landing")
    cat.filter("idx < 4000").coalesce(1).write.parquet(path)
    again = cat.filter("idx < 1300").withColumns({"updated": F.col("updated") + 1, "mag": F.col("mag") + 1})
    again.unionByName(cat.filter("idx BETWEEN 4000 AND 6999")).coalesce(1).write.mode("append").parquet(path)
    cat.filter("idx >= 7000").coalesce(1).write.mode("append").parquet(path)
    return path, cat


def _stream(spark, landing):
    path, cat = landing
    return jobs.file_stream(spark, path, cat.schema, files_per_batch=1)


def test_ingest_keeps_the_newest_version(spark, landing):
    got = jobs.ingest(_stream(spark, landing), new_path(spark, "sink"))
    assert got.count() == 10_000
    moved = got.alias("g").join(landing[1].alias("c"), "idx").filter("g.mag > c.mag + 0.5")
    assert moved.count() == 1300


def test_rerun_of_a_finished_stream_changes_nothing(spark, landing):
    sink, checkpoint = new_path(spark, "sink"), new_path(spark, "checkpoint")
    first = jobs.ingest(_stream(spark, landing), sink, checkpoint).count()
    assert jobs.ingest(_stream(spark, landing), sink, checkpoint).count() == first


def test_daily_stream_equals_batch(spark, landing):
    path, cat = landing
    got = jobs.daily(_stream(spark, landing), new_path(spark, "sink"), delay="60 days")
    want = profile.daily(spark.read.parquet(path)).select("day", "mag_count", "mag_max", F.round("mag_mean", 9).alias("mag_mean"))
    assert got.withColumn("mag_mean", F.round("mag_mean", 9)).exceptAll(want).count() == 0
    assert got.count() == want.count()


def test_pauses_carry_over_batches(spark, sf):
    cat = views.catalog(spark, sf).select("idx", "time", (F.col("idx") % 5).alias("cell"))
    path = new_path(spark, "landing")
    for a, b in ((0, 3000), (3000, 3002), (3002, 10_000)):
        cat.filter(F.col("idx").between(a, b - 1)).coalesce(1).write.mode("append").parquet(path)
    from faultline.operators.windows import time_since_last

    got = jobs.pauses(jobs.file_stream(spark, path, cat.schema, files_per_batch=1), new_path(spark, "sink"), "cell")
    want = time_since_last(cat, by="cell", name="pause_s")
    cols = ["idx", "cell", "pause_s"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.count() == 10_000


def test_stream_patch_equals_batch(spark, sf, landing):
    docs = views.detail(spark, sf)
    got = jobs.patch(_stream(spark, landing), docs, new_path(spark, "sink"))
    want = joins.fill_from_details(spark.read.parquet(landing[0]), docs)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_incremental_patch_skips_done_ids(spark, sf, landing):
    got = jobs.patch_jobs(_stream(spark, landing), views.detail(spark, sf), new_path(spark, "sink"))
    assert got.count() == got.select("idx").distinct().count() == landing[1].filter("nst IS NULL").count()
