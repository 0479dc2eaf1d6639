"""Prefix counts against the tokenizers library; vector codes and whitening against plain integers and numpy."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultline.llm import gridcodes, prefixcount, vectors, whitening

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as _file:
    FILE = _file.read()
LIBRARY = Tokenizer.from_str(FILE)
PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'l", "'ve", "'ll", "'", "!", "1", "23", "<|endoftext|>", "<|end", "é", "中", "\u3000", "\xa0",
          "\x1c", "\x85", "𝄞", "ing", "international", " hello", "aaaa", "=====", "\0", "'RE", "\u2028"]


def counts_of(texts):
    return [[len(e.ids) for e in LIBRARY.encode_batch([t[:i + 1] for i in range(len(t))], add_special_tokens=False)] for t in texts]


# ------------------------------------------------------------------------------------------------ 11

def test_counts_of_all_prefixes_equal_the_library():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 2, 5, 12, 40]))) for _ in range(1500)]
    texts += ["", "<|endoftext|>", "<|endoftext|>" * 3, "!!<|endoftext|> x", "a" * 300, " " * 200, "\n" * 77 + "x", "x" + " \n" * 20 + "'re"]
    counter = prefixcount.Counter(FILE)
    assert [c.tolist() for c in counter.documents(texts)] == counts_of(texts)
    assert [c.tolist() for c in counter.documents(["", ""])] == [[], []] and list(counter.documents([])) == []


def test_whole_documents_equal_the_library(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counted = prefixcount.prefix_counts(docs, FILE)
    got = {r["doc_id"]: (r["n_tokens"], r["n_chars"], r["n_bytes"]) for r in counted.collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == {r["doc_id"]: (len(LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids), len(r["text"] or ""), len((r["text"] or "").encode())) for r in rows}


def test_questions_are_answered_from_stored_counts(spark):
    texts = [None, "", "international<|endoftext|> words'll", "a" * 40, "  \n\n b", "international<|endoftext|> words'll"]
    df = spark.createDataFrame([(i // 5 if i != 1 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for c in ("key", "counts", "width", "n_tokens"):
        df = df.withColumn(c, F.lit("clash"))
    counted = prefixcount.prefix_counts(df, FILE)
    rows = counted.select("doc_id", "n_tokens", *[prefixcount.tokens_at(n).alias(f"at{n}") for n in (0, 1, 7, 15, 22, 1000)]).collect()
    expected = []
    for i, t in enumerate(texts):
        c = [0, *counts_of([t or ""])[0]]
        expected.append((i // 5 if i != 1 else None, c[-1], *[c[min(n, len(c) - 1)] for n in (0, 1, 7, 15, 22, 1000)]))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    for budget in (0, 2, 5):
        got = sorted((r["n_chars"], r["kept_chars"]) for r in prefixcount.with_kept_chars(counted, budget).collect())
        want = sorted((len(t or ""), max([i + 1 for i, c in enumerate(counts_of([t or ""])[0]) if c <= budget], default=0)) for t in texts)
        assert got == want
    assert prefixcount.with_kept_chars(prefixcount.prefix_counts(df.limit(0), FILE), 3).count() == 0


def test_a_long_word_takes_linear_time_and_wide_counts():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefghijklmnop") for _ in range(200_000))
    counts = next(prefixcount.Counter(FILE).documents([text]))
    assert counts.max() > 0xFFFF and counts[9_999] == len(LIBRARY.encode(text[:10_000], add_special_tokens=False).ids)
    batch = next(prefixcount._count(FILE)([_batch([text, "ab"])]))
    assert batch.column("width").to_pylist() == [4, 2] and batch.column("n_tokens").to_pylist() == [counts[-1], 1]


def _batch(texts):
    import pyarrow as pa

    return pa.record_batch({"key": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})


def test_words_are_counted_once_and_share_their_prefixes(monkeypatch):
    """Words outlive the segments they come from, and the places that a word shares with the one before it are not looked at again."""
    monkeypatch.setattr(prefixcount, "REMEMBERED", 3)
    counter, seen = prefixcount.Counter(FILE), []
    plain = prefixcount.Merges.apart
    monkeypatch.setattr(prefixcount.Merges, "apart", lambda self, u, t: seen.append((u, t)) or plain(self, u, t))
    one_by_one = prefixcount.Counter(FILE)
    texts = [" ".join(f"inter{a}nation{b}" for b in "abcdefgh") for a in "stuvwxyz"]
    assert [c.tolist() for c in counter.documents(texts)] == counts_of(texts)
    first = len(seen)
    assert [c.tolist() for c in counter.documents(texts[::-1])] == counts_of(texts[::-1]) and len(seen) == first
    for word in dict.fromkeys(" ".join(texts).split()):
        before = list(one_by_one._counted_last[0])
        counts = one_by_one.word(word)
        assert one_by_one._counted_last[0] == word and list(word) != before
        assert counts == counts_of([word])[0]


def test_other_kinds_of_files_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        prefixcount.Counter(file.read())


# ------------------------------------------------------------------------------------------------ 12

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks in plain integers, every entry evaluated."""
    kept = sorted((r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])), key=lambda r: r[0])
    x = [[int(np.floor(4096 * float(c))) for c in v] for _, v, _ in kept]
    width = len(x[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in x]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            at = [near(p, v[p])[1] for v in cut]
            for e in set(at):
                own = [v[p] for v, a in zip(cut, at) if a == e]
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    out, by_label = [], {}
    for (key, _, label), v in zip(kept, cut):
        best = [near(p, v[p]) for p in range(parts)]
        out.append((key, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
        by_label[label] = by_label.get(label, 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted((k, c, e, by_label[label], digest) for k, c, e, label in out)


VECTORS = "vec_id long, embedding array<float>, label int"


def made_vectors(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = [(i, [float(np.float32(c)) for c in np.round(centres[i % 5] + rng.normal(scale=0.3, size=dims), 1)], [0, 0, 1, None][i % 4]) for i in range(n)]
    rows += [(n, None, 0), (n + 1, [float("nan")] * dims, 1), (n + 2, [None] * dims, None), (n + 3, [float("inf")] + [0.0] * (dims - 1), 1), (n + 4, rows[0][1], None)]
    rng.shuffle(rows)
    return [(int(a), b, c) for a, b, c in rows]


@pytest.mark.parametrize("n", [3, 120])
def test_codes_equal_plain_integers(spark, n):
    rows = made_vectors(n, 16)
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("x", "code", "error", "_of")}).repartition(3)
    got = sorted(map(tuple, gridcodes.compress(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))
    assert got == plain_codes(rows)


def test_codes_of_nothing_and_of_repeated_rows(spark):
    assert gridcodes.compress(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(1, [0.5] * 8, 2), (1, [0.5] * 8, 2), (None, [-0.25] * 8, 2), (4, [0.5] * 16, 3)]
    got = gridcodes.compress(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((str(r["vec_id"]), r["error"], r["label_error"]) for r in got) == [("1", 0, 0), ("1", 0, 0), ("None", 0, 0)]
    with pytest.raises(Exception, match="reaches"):
        gridcodes.compress(spark.createDataFrame([(1, [1e30] * 8, 2)], VECTORS))


def test_grid_drops_only_entries_that_are_never_nearest():
    rng = np.random.default_rng(4)
    book = rng.integers(-3000, 3000, (16, 4))
    x = np.concatenate([rng.integers(-4000, 4000, (5000, 4)), book, (book[:8] + book[8:]) // 2])
    all_d = ((x[:, None] - book) ** 2).sum(2)
    for side in (1, 64, 512, 1 << 14):
        grid = gridcodes.Grid(book, side)
        for own, d in zip(np.split(x, [2000]), np.split(all_d, [2000])):
            code, best = grid.assign(np.ascontiguousarray(own))
            assert (code == d.argmin(1)).all() and (best == d.min(1)).all()
        assert side >= 1 << 14 or grid.evaluated < 16 * len(x)


# ------------------------------------------------------------------------------------------------ 13

def numpy_whitening(rows, components=16):
    kept = [(k, v) for k, v, *_ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    sums = [sum(map(int, c)) for c in fit.T]
    deviation = {k: sum((len(fit) * int(c) - s) ** 2 for c, s in zip(v, sums)) for (k, _), v in zip(kept, x)}
    return [k for k, _ in kept], len(fit), e, ((x - 1_000_000) - (fit - 1_000_000).mean(0)) @ u / np.sqrt(e), np.trace(np.cov(fit.T, bias=True)), deviation


@pytest.mark.parametrize("n, dims", [(400, 72), (60, 12), (300, 24)])
def test_whitening_equals_numpy(spark, n, dims):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=dims) * np.linspace(2, 0.3, dims)).tolist(), 0) for i in range(n)]
    rows += [(n + i, rows[i][1], 0) for i in range(30)] + [(-1, None, 0), (-2, [float("nan")] * dims, 0), (-3, [None] * dims, 0)]
    df = spark.createDataFrame(rows, VECTORS.replace("float", "double")).withColumns({c: F.lit("clash") for c in ("x", "n", "dim", "component")}).repartition(3)
    keys, size, e, z, trace, deviation = numpy_whitening(rows)
    k = min(16, dims)
    out = whitening.whiten(df).collect()
    assert len(out) == len(keys) * k and {r["n"] for r in out} == {size} and max(r["identity_error"] for r in out) < 1e-9
    got = np.zeros((len(keys), k))
    place = {key: i for i, key in enumerate(keys)}
    for r in out:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] / (e[r["component"] - 1] / trace) - 1) < 1e-10 and r["deviation"] == deviation[r["vec_id"]]
    sign = np.sign((got * z[:, :k]).sum(0))
    assert np.abs(got * sign - z[:, :k]).max() < 1e-8


def test_whitening_by_filter_cycles_with_few_columns(spark):
    """Guard columns set small, so that several cycles are needed; and eigenvalues that are nearly equal."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=96) * (1 + 0.5 * (np.arange(96) < 6))).tolist(), 0) for i in range(500)]
    df = spark.createDataFrame(rows, VECTORS.replace("float", "double"))
    vectors_, dims = vectors.integer_vectors(df, "embedding", 64, whitening.LIMIT, ["vec_id"])
    fit = vectors_.select("x").distinct()
    model = whitening.leading(fit, dims, whitening.moments(fit, dims), components=4, guard=4)
    _, _, e, _, _, _ = numpy_whitening(rows, 4)
    assert np.abs(model.values / e - 1).max() < 1e-12 and model.residual <= whitening.CERTIFIED and model.passes > 30 and model.identity_error < 1e-11


def test_whitening_of_degenerate_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0), (None, [0.5, 0.25], 0)], VECTORS)
    assert whitening.whiten(one).count() == 0  # a single distinct vector has no variance
    line = spark.createDataFrame([(1, [0.5, 0.25, 0.0], 0), (None, [1.5, 0.25, 0.0], 0), (1, [1.5, 0.25, 0.0], 0)], VECTORS)
    got = whitening.whiten(line).collect()
    assert len(got) == 3 and {r["component"] for r in got} == {1} and sorted(round(abs(r["whitened"]), 12) for r in got) == [1.0, 1.0, 1.0]
    assert {(r["n"], r["deviation"]) for r in got} == {(2, 64 * 64)} and all(r["explained"] == pytest.approx(1) for r in got)
