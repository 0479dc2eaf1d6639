"""The pipeline's stages on the fixture's documents with planted and odd rows, and the whole run."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from faultline.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with copies, a near copy, a shared passage, benchmark texts, NULLs, empties and repeated rows."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in given.collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    long = next(r for r in rows if r[1] and len(r[1].split()) > 300 and r[1].isprintable() is False)
    words = long[1].split(" ")
    near = " ".join(words[:150] + ["changed"] + words[151:])
    passage = " ".join(words[60:130])
    extra = [(900_001, long[1]), (900_002, near), (900_003, "Étonnant. " * 3 + passage + " tout autre chose ici, vraiment."), (900_004, bench[0] + " " + bench[1]),
             (900_005, None), (900_006, ""), (None, "no id at all " * 30), (None, None)]
    made = [(k, t, "en", "planted", len(t or "")) for k, t in extra] + [rows[0], rows[0]]
    return given.unionByName(spark.createDataFrame(made, given.schema)), long, rows


def ids(df):
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in df.select("doc_id").collect())


def test_every_stage_but_the_last_returns_the_columns(spark, docs):
    table = docs[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "byte_level_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, table, SF), name)
        none = stage(spark, table.limit(0), SF)
        assert none.count() == 0
        if name != "byte_level_bpe":
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in table.schema]
            assert set(ids(out)) <= set(ids(table))


def test_near_duplicates_leave_the_smallest(spark, docs):
    table, long, _ = docs
    kept = ids(corpus_pipeline.near_duplicates(spark, table, SF))
    assert (True, 900_001) not in kept and (True, 900_002) not in kept and (True, 900_005) in kept and (True, 900_006) in kept
    smallest = min(r["doc_id"] for r in table.filter("doc_id is not null").collect() if r["text"] == long[1])
    assert (True, smallest) in kept


def test_repeated_passages_are_cut_at_whole_characters(spark, docs):
    table, long, rows = docs
    out = {r["doc_id"]: r for r in corpus_pipeline.repeated_passages(spark, table, SF).collect() if r["doc_id"] is not None}
    cut = out[900_003]
    assert cut["text"].startswith("Étonnant. ") and cut["text"].endswith("tout autre chose ici, vraiment.") and len(cut["text"]) < 120
    assert cut["n_chars"] == len(cut["text"]) and "�" not in cut["text"]
    assert 900_001 not in out and out[900_006]["text"] == ""  # nothing left of the copy; an empty text stays
    first = rows[0]
    assert out[min(r[0] for r in rows)]["text"] == next(r[1] for r in rows if r[0] == min(x[0] for x in rows))


def test_contaminated_documents_go_and_others_stay_as_they_are(spark, docs):
    table = docs[0]
    out = corpus_pipeline.benchmark_passages(spark, table, SF)
    assert (True, 900_004) not in ids(out)
    text = {r["doc_id"]: r["text"] for r in table.collect()}
    assert all(r["text"] == text[r["doc_id"]] for r in out.collect() if r["doc_id"] is not None)
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def words(t):
        return re.findall(rb"[0-9a-z\x80-\xff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode())

    windows = {tuple(w[j:j + 13]) for w in map(words, bench) for j in range(max(len(w) - 12, 0))}
    gone = set()
    for k, t in text.items():
        w = words(t)
        hit = {p + i for p in range(len(w) - 12) if tuple(w[p:p + 13]) in windows for i in range(13)}
        if hit and 20 * len(hit) >= len(w):
            gone.add(k)
    assert {k for k in text} - {r["doc_id"] for r in out.collect()} == gone


def test_the_run_is_its_stages_one_after_the_other(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = corpus_pipeline.stored(stage(spark, table, SF), name)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for r in table.collect():
        coded = np.array(model.encode_ordinary(r["text"] or ""), "<u4").tobytes()
        expected.add((r["doc_id"], len(coded) // 4, hashlib.sha256(coded).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF)
    assert {tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == expected


def test_quality_stage_keeps_good_documents(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, table, sf).select("doc_id").collect()}
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    good, bad = [d for d, q in labels if q == 1], [d for d, q in labels if q == 0]
    assert sum(d in kept for d in good) >= 0.98 * len(good) and sum(d in kept for d in bad) <= 0.05 * len(bad)


def test_near_duplicates_share_four_fifths_of_their_five_word_runs(spark):
    """All pairs by brute force: texts with words changed one apart, so that many lie between this rule and op3's."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 10**6, int(rng.integers(60, 200)))]
        for changes in (0, 1, 2, 2, 3, 4, 6):
            words = list(base)
            for at in rng.choice(len(base), changes, replace=False):
                words[at] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    texts += ["one two three", "one two three", "one two four", ""]

    def runs(text, n):
        words = text.split()
        return {tuple(words[i:i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))}

    def linked(n, part):
        sets = [runs(t, n) for t in texts]
        return {(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j])}

    pairs = linked(5, 80)
    assert len(pairs - linked(3, 90)) > 5
    least = list(range(len(texts)))
    for _ in texts:
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    table = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in enumerate(texts)], spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert [k for _, k in ids(corpus_pipeline.near_duplicates(spark, table, SF))] == [i for i, x in enumerate(least) if x == i]


def _planted(spark, rows):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    return spark.createDataFrame([(k, t, "en", "planted", len(t or "")) for k, t in rows], schema).repartition(3)


def _bag(df):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect()))


def _text(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_only_the_contaminated_row_of_an_id_goes(spark):
    bad = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    assert len(bad.split()) > 13
    clean = [(5, _text("a")), (None, _text("b")), (None, _text("c")), (None, None), (7, _text("d")), (8, bad.split()[0])]
    out = corpus_pipeline.benchmark_passages(spark, _planted(spark, [*clean, (5, bad), (None, bad), (9, bad)]), SF)
    assert _bag(out) == _bag(_planted(spark, clean))


def test_only_the_copy_among_the_rows_of_an_id_goes(spark):
    stay = [(3, _text("a")), (5, _text("b")), (None, _text("c")), (None, _text("d")), (None, None), (None, None), (6, ""), (6, "")]
    go = [(5, _text("a")), (5, _text("a")), (None, _text("a")), (5, _text("b")), (None, _text("c")), (9, _text("b") + " more")]
    assert _bag(corpus_pipeline.near_duplicates(spark, _planted(spark, [*go, *stay]), SF)) == _bag(_planted(spark, stay))


def test_stages_send_texts_in_small_batches(spark):
    seen = []
    probe = corpus_pipeline.stage(lambda spark, docs, sf_dir: seen.append(spark.conf.get(corpus_pipeline.BATCH)))
    before = spark.conf.get(corpus_pipeline.BATCH)
    probe(spark, None, "")
    spark.conf.set(corpus_pipeline.BATCH, 7)
    probe(spark, None, "")
    assert seen == ["1000", "7"] and spark.conf.get(corpus_pipeline.BATCH) == "7"
    spark.conf.set(corpus_pipeline.BATCH, before)
