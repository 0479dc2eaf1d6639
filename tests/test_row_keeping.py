"""Rows that used to be lost, multiplied or refused: NULL keys, repeated documents, labels in two cases, deep documents."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from faultline.functions.documents import key_paths
from faultline.operators import features, joins, tree, windows
from faultline.operators.profile import correlation
from faultline.sources import tables
from faultline.streaming import jobs


def _day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_rolling_days_keeps_rows_without_a_cell(spark):
    rows = [(1, 7, _day(0), 1.0), (2, None, _day(1), 2.0), (3, 7, _day(0.5), 3.0), (4, 7, None, 4.0)]
    df = spark.createDataFrame(rows, "idx long, cell int, time timestamp_ntz, mag double")
    got = {r["idx"]: r for r in windows.rolling_days(df, "cell", (1,)).collect()}
    assert set(got) == {1, 2, 3, 4} and got[3]["eq_count_last_1d"] == 2 and got[3]["max_mag_last_1d"] == 3.0
    assert got[2]["eq_count_last_1d"] is None and got[4]["max_mag_last_1d"] is None


def test_stratified_split_keeps_a_null_stratum(spark):
    df = spark.range(40).select(F.col("id").alias("idx"), F.when(F.col("id") >= 10, F.col("id") % 2).alias("s"))
    got = windows.split_stratified(df, F.col("s")).groupBy("s", "part").count().collect()
    assert sum(r["count"] for r in got) == 40
    assert {r["s"]: r["count"] for r in got if r["part"] == "pred"} == {None: 2, 0: 3, 1: 3}


def test_events_last_counts_from_the_start(spark):
    df = spark.createDataFrame([(i, _day(i // 2)) for i in range(9)], "idx long, time timestamp_ntz")
    got = {r["idx"]: (r["events_last_1"], r["events_last_7"], r["events_last_30"]) for r in windows.events_last(df, (1, 7, 30)).collect()}
    assert got == {i: (1, 7 if i >= 6 else 0, 0) for i in range(9)}


def test_two_documents_of_a_link_give_one_row(spark):
    def body(nst):
        return json.dumps({"properties": {"products": {"origin": [{"properties": {"num-stations-used": str(nst)}}]}}})

    events = spark.createDataFrame([(1, "https://x/1", None, 1.0, 2.0)], "idx long, detail string, nst long, dmin double, gap double")
    docs = spark.createDataFrame([("https://x/1", body(3), 2), (" https://x/1", body(5), 7), ("https://x/1", None, 9)], "detail string, body string, fetched int")
    assert [r["nst"] for r in joins.fill_from_details(events, docs).collect()] == [5]  # the latest that has a body
    assert joins.fill_from_details(events, docs.drop("fetched")).count() == 1
    with pytest.raises(ValueError):
        joins.fill_from(events, events.unionByName(events))
    with pytest.raises(ValueError):
        joins.combine_first(events, events.unionByName(events))


def test_correlation_of_a_column_with_a_large_mean(spark):
    df = spark.createDataFrame([(1.7e12 + i, float(i), 5.0) for i in range(3)], "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in correlation(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1) and got["a", "a"] == pytest.approx(1) and got["a", "c"] == got["c", "c"] == 0


def test_labels_in_two_cases_and_with_a_columns_name(spark):
    rows = [(1, 2.5, "ml"), (2, 3.5, "Ml"), (3, 4.5, "mag"), (4, 5.5, None)]
    df = spark.createDataFrame(rows, "idx long, mag double, magType string")
    got = features.hybrid_onehot(df, labels=["ml", "Ml", "mag"]).orderBy("idx").collect()
    assert [r["mag"] for r in got] == [2.5, 3.5, 4.5, 5.5]
    assert [tuple(r)[2:] for r in got] == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1)]
    assert len({c.lower() for c in got[0].asDict()}) == len(got[0])


def test_null_labels_have_no_code(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x string")
    assert {r["x"]: r["n"] for r in features.label_encode(df, "x", "n").collect()} == {None: None, "a": 0, "b": 1}


def test_key_paths_of_a_deep_document(spark):
    deep = 1
    for level in range(12, 0, -1):
        deep = {f"k{level}": deep} if level % 3 else {f"k{level}": [deep, deep]}
    df = spark.createDataFrame([(json.dumps(deep),), ("not json",), (None,), ("{}",)], "body string")
    got = {r["path"]: r["n"] for r in key_paths(df, "body").collect()}
    assert max(p.count(".") for p in got) == 12 and got["$.k1.k2.k3[]"] == 2
    assert max(got.values()) == 16 and sum(p.endswith("k12") for p in got) == 1
    assert key_paths(df.limit(0), "body").count() == 0


def test_a_failing_swap_puts_the_target_back(spark, monkeypatch):
    tables.staged_load(spark.range(3), "swap_target")
    rename = tables._rename

    def failing(session, old, new):
        if new == "swap_target" and "_staging_" in old:
            raise RuntimeError("no rename")
        rename(session, old, new)

    monkeypatch.setattr(tables, "_rename", failing)
    with pytest.raises(RuntimeError):
        tables.staged_load(spark.range(5), "swap_target")
    assert spark.table("swap_target").count() == 3
    monkeypatch.undo()
    assert tables.staged_load(spark.range(5), "swap_target").count() == 5
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("_staging", "_backup"))]
    with pytest.raises(ValueError):
        tables.staged_load(spark.range(1), " ")


def test_load_all_creates_schemas_and_stops_at_a_bad_file(spark, tmp_path):
    (tmp_path / "ready").mkdir()
    (tmp_path / "one.csv").write_text("a\n1\n2\n")
    (tmp_path / "ready" / "two.csv").write_text("a\n3\n")
    files = tables.discover_imports(spark, str(tmp_path), "ready", "load_raw", "load_ready")
    read = lambda path: spark.read.csv(path, header=True)
    assert {(r["schema"], r["table"], r["n"]) for r in tables.load_all(files, read).collect()} == {("load_raw", "one", 2), ("load_ready", "two", 1)}
    (tmp_path / "ready" / "two.csv").write_text("a\n")
    with pytest.raises(ValueError):
        tables.load_all(files, read)
    assert spark.table("load_ready.two").count() == 1


def test_pauses_twice_on_one_sink(spark, tmp_path):
    rows = [(i, i % 3, _day(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "idx long, cell long, time timestamp_ntz")
    df.filter("idx < 25").coalesce(1).write.parquet(f"{tmp_path}/in/a")
    source = lambda: jobs.file_stream(spark, f"{tmp_path}/in/*", df.schema, files_per_batch=1)
    assert jobs.pauses(source(), f"{tmp_path}/out", "cell").count() == 25
    df.filter("idx >= 25").coalesce(1).write.parquet(f"{tmp_path}/in/b")
    got = jobs.pauses(source(), f"{tmp_path}/out", "cell")
    assert got.count() == 40 and got.filter("pause_s is null").count() == 3
    assert jobs.pauses(source(), f"{tmp_path}/out", "cell").count() == 40


def test_entropy_tree_of_very_many_classes(spark, monkeypatch):
    many = spark.range(3000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"), (F.col("id") % 1500).alias("y"))
    grown = tree.fit_classification_tree(many, ["x", "z"], "y", max_depth=0)
    root = grown.filter("node = 0").first()
    assert root["n"] == 3000 and root["gain"] > 0 and grown.count() == 3
    few = spark.range(400).select((F.col("id") % 37).cast("double").alias("x"), F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("z"),
                                  F.when(F.col("id") % 37 < 11, "a").when(F.pmod(F.xxhash64("id"), F.lit(50)) < 20, "b").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("y"))
    columns = {r["node"]: r for r in tree.fit_classification_tree(few, ["x", "z"], "y", max_depth=2).collect()}
    monkeypatch.setattr(tree, "CLASS_COLUMNS", 2)
    by_rows = {r["node"]: r for r in tree.fit_classification_tree(few, ["x", "z"], "y", max_depth=2).collect()}
    assert set(columns) == set(by_rows)
    for node, a in columns.items():
        b = by_rows[node]
        assert (a["n"], a["feature"], a["threshold"], a["value"]) == (b["n"], b["feature"], b["threshold"], b["value"])
        assert a["gain"] is None or a["gain"] == pytest.approx(b["gain"])
