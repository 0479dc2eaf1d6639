"""Trained operators and graph components: held-out accuracy, exact moments, brute-force decoding, defined odd cases."""

import itertools
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import crf, isolation, qda, textstats
from faultline.llm.graph import components
from faultline.llm.queries import QUERIES, quality_model


def labelled(spark, sf, name):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return QUERIES[name](spark, sf).join(labels, "doc_id").toPandas()


def test_classifier_on_held_out_rows(spark, sf):
    got = labelled(spark, sf, "op9_quality_discriminant")
    held = got[got.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() >= 0.97
    assert got.score.between(0, 1).all()


def test_rules_keep_good_rows_and_catch_junk(spark, sf):
    got = labelled(spark, sf, "op6_quality_rules")
    passed = got[~got.base_failed]
    assert passed[passed.quality == 1].kept.mean() >= 0.99 and passed[passed.quality == 0].kept.mean() <= 0.1
    assert not got[got.base_failed].kept.any()


def test_moments_give_the_same_model_as_the_rows(spark, sf):
    counted = textstats.text_counts(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = quality_model(counted, labels)
    rows = counted.filter(~qda.held_out()).join(labels, "doc_id").toPandas()
    x = textstats.features({c: rows[c].to_numpy() for c in textstats.COUNTS})
    parts = [x[rows.quality.to_numpy() == k] for k in (0, 1)]
    direct = qda.from_moments(np.array([len(p) for p in parts], float), np.array([p.sum(0) for p in parts]), np.array([p.T @ p for p in parts]))
    assert np.allclose(model.score(x), direct.score(x), atol=1e-6)


def test_classifier_of_odd_rows(spark):
    rows = [(1, ""), (1, ""), (2, None), (3, "word " * 5000), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "n_words": F.lit(1)})
    counted = textstats.text_counts(docs)
    assert counted.count() == 5
    none = qda.fit(counted.withColumn("quality", F.lit(None).cast("int")))
    assert {r["score"] for r in qda.score_counts(counted, none).collect()} == {0.5}
    one = qda.fit(counted.withColumn("quality", F.lit(1)))
    assert all(0 <= r["score"] <= 1 for r in qda.score_counts(counted, one).collect())
    kept = qda.keep_good(docs, none, 0.3)
    assert kept.schema == docs.schema and kept.count() == 5 and qda.keep_good(docs.limit(0), none, 0.3).count() == 0


def test_forest_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "a b c")], "doc_id long, text string")
    counted = textstats.text_counts(docs).withColumns({"quality": F.lit(None).cast("int"), "anomaly": F.lit("x")})
    forest = isolation.fit(counted)
    scored = isolation.scored(counted, forest)
    assert scored.count() == 3 and isolation.threshold(scored) > 1
    assert isolation.scored(counted.limit(0), forest).count() == 0


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(1)
    good = rng.normal(0, 1, (2000, 4))
    far = np.full((5, 4), 8.0)
    forest = isolation.grow(good, np.full(4, -10.0), np.full(4, 10.0))
    assert forest.score(far).min() > np.quantile(forest.score(good), 0.999)


def test_components_equal_brute_force(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3), (3, None), (7, 9), (7, 9)]
    edges += [(2000, i) for i in range(2001, 2100)]
    label = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(len(edges)):
        before = dict(label)
        for a, b in edges:
            if a is not None and b is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert {r["node"]: r["component"] for r in components(df).collect()} == label
    assert components(df.limit(0)).count() == 0


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(3)
    for n in (1, 2, 6):
        field = crf.Field(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2))
        score = rng.normal(size=n).tolist()

        def value(y):
            return field.first[y[0]] + sum(s for s, k in zip(score, y) if k) + sum(field.step[a, b] for a, b in zip(y, y[1:]))

        assert value(field.viterbi(score)) == pytest.approx(max(value(y) for y in itertools.product((0, 1), repeat=n)))


def test_leaf_blocks_of_broken_pages():
    page = ('<html><head><title>t</title><style>p{}</style><body><nav><ul><li><a href="/x">One</a><li>Two</ul></nav><!-- no --><article><h1>A &am</h1>'
            '<p><b>bold &amp; &eacute;<br>next\n line<p>last&nbsp;one</article><script>var a="<p>";</script><div class="ad x">buy<p>now</div>end')
    got = [(b.text, [t for t, _ in b.above][-1]) for b in crf.leaf_blocks(page)]
    assert got == [("One", "li"), ("Two", "li"), ("A &am", "h1"), ("bold & é next line", "p"), ("last one", "p"), ("buy", "div"), ("now", "p"), ("end", "body")]
    assert [b.text for b in crf.leaf_blocks("a<b>b</b>c <p")] == ["abc <p"] and crf.leaf_blocks("") == crf.leaf_blocks("<p> </p>") == []


@pytest.mark.parametrize("page, texts", [
    ("<script src=//a.com/x/>var x=1;</script><p>ok", ["ok"]), ("<div class=x/>in</div>out", ["in", "out"]),
    ("<datalist><option value=a></datalist><article><p>kept", ["kept"]), ("<svg><path d='M0'/><article><p>kept", ["kept"]),
    ("<svg><foreignObject><p>inside</p></foreignObject></svg><p>after", ["after"]), ("<svg/>a<p>b", ["a", "b"]),
    ("a<select><option>x</select>b", ["a", "b"]), ("<p title=it's>x</p>y > z < w", ["x", "y > z < w"]),
    ("<p title='never closed>x<p>second", ["x", "second"]), ("<head><title>t</title><meta a><p>body", ["body"]), ("x<style>p{}", ["x"]),
])
def test_leaf_blocks_read_markup_as_browsers_do(page, texts):
    assert [b.text for b in crf.leaf_blocks(page)] == texts


@pytest.mark.parametrize("piece", ["<a ", '<a ="', "<a ='<b =\"", "<", "</", "<!--", "<a x='", "&lt;", "<div>a"])
def test_leaf_blocks_take_linear_time(piece):
    started = time.process_time()
    blocks = crf.leaf_blocks(piece * (300_000 // len(piece)))
    assert time.process_time() - started < 10 and all(len(b.above) <= crf.DEEPEST for b in blocks)


def test_main_text_of_pages_without_semantic_tags(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    field = crf.fit(pages)
    sentence = "Thtion of the ingheat and onerth was reading it, ere thonger then ever before in that place. "
    odd = [(1, "u", None), (2, "u", ""), (2, "u", ""), (3, None, "<div><p>" + sentence * 6 + "</p><p>" + sentence * 9 + "</p></div>")]
    got = {r["page_id"]: r["text"] for r in crf.extract(spark.createDataFrame(odd, "page_id long, url string, html string").withColumn("key", F.lit(1)), field).collect()}
    assert got[1] == got[2] == "" and got[3].count("Thtion") == 15
    assert crf.fit(pages.limit(0)).trained is False and crf.extract(pages.limit(0), field).count() == 0
    assert crf.Field(np.zeros(1), np.zeros((2, 2)), np.zeros(2), trained=False).main_text("<p>a<p>b") == "a b"


def test_main_text_is_the_article(spark, sf):
    """The fixture's pages: what stands between the article tags, block by block."""
    import html
    import re

    got = {r["page_id"]: r["text"] for r in QUERIES["op10_crf_main_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside)]
        assert got[r["page_id"]] == " ".join(b for b in blocks if b)
