"""Registered queries of the operators: equal to their SQL, or of the shape their contract states."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from faultline.llm.queries import ORACLES, QUERIES

COLUMNS = {
    1: {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    2: {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
    3: {"doc_id", "n_shingles", "component_id"}, 4: {"page_id", "host", "path", "rule", "verdict"},
    5: {"doc_id", "start", "n_tokens", "ids_crc32"},
    6: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    7: {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}, 8: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    9: {"doc_id", "held_out", "score", "predicted"}, 10: {"page_id", "url", "text", "n_chars"},
    11: {"doc_id", "n_bytes", "n_tokens", "over_limit"}, 12: {"vec_id", "code", "error", "label_error", "codebooks_sha256"},
    13: {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}
TABLE = {2: "conversations", 4: "pages", 10: "pages", 12: "embeddings", 13: "embeddings"}


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def compare(spark, folder, name):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{'/*.parquet' if Path(f'{folder}/{t}.parquet').is_dir() else ''}')")
    df = QUERIES[name](spark, str(folder))
    cur = con.execute(ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag([tuple(r) for r in df.collect()], df.columns) == bag(cur.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    compare(spark, sf, name)


def test_alias_decisions_equal_sql(spark, tmp_path):
    """Chains, loops and both verdicts in one component, with pages that have no rule of their own."""
    def page(i, url, *links):
        return i, url, "<html>" + "".join(links) + "<p>x</p>"

    canonical = '<link rel="canonical" href="{}">'.format
    moved = '<META http-equiv="refresh" content="0; url={}">'.format
    pages = [
        page(1, "http://a.org/x", canonical("http://b.org/y#top")), page(2, "http://b.org/y", moved("http://c.net/es/1")),
        page(3, "http://d.org/", canonical("http://a.org/x")), page(4, "http://e.org/1", canonical("http://f.com/1")),
        page(5, "http://g.org/1", canonical("http://e.org/1"), moved("http://h.net/fr/2")), page(6, "http://i.org/1", canonical("http://i.org/1")),
        page(7, "http://c.net/es/1"), page(8, "http://www.example.com/en/1", canonical("http://d.org/2")), page(9, "http://d.org/2#a", moved("http://j.net/es/")),
        page(10, "HTTP://EXAMPLE.com/en/2"), (11, None, None), (12, "no url", "<p>"), (13, "", ""), page(14, "http://net/es/x"), page(14, "http://net/es/x"),
        page(15, "http://k.org/?a=1", '<link href="http://c.net/es/1" rel=canonical>'), (16, "http://a.org/x", None),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    compare(spark, tmp_path, "op4_url_aliases")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in QUERIES["op4_url_aliases"](spark, str(tmp_path)).collect()}
    assert got[1] == got[2] == got[3] == got[15] == got[16] == (None, "block")
    assert got[4] == got[5] == got[9] == (None, "allow")  # an explicit allow among the aliases takes precedence
    assert got[10] == ("example.com/en/", "block") and got[8] == ("www.example.com/en/", "allow") and got[11] == (None, "allow")


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_query_covers_its_whole_table(spark, sf, n):
    name = next(q for q in QUERIES if q.startswith(f"op{n}_"))
    df = QUERIES[name](spark, sf)
    assert COLUMNS[n] <= set(df.columns)
    table = spark.read.parquet(f"{sf}/{TABLE.get(n, 'documents')}.parquet")
    expected = table.select("conv_id").distinct().count() + 1 if n == 2 else table.count() * (16 if n == 13 else 1)
    assert df.count() == expected


def test_entry_registers_all(spark):
    names = set(entry.queries())
    assert set(QUERIES) <= names and "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())
