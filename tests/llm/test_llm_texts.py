"""Operators on texts against plain Python: odd characters, NULL and empty texts, repeated rows, clashing column names."""

import random
import re
import struct
import types
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultline.llm import bpe, chat, decontaminate, fmindex, frames, partenum, repeats, textstats
from faultline.llm.textbytes import chunks, flat

ODD = "ab é\n\t  'sre123.,!  \x1c\x85ÅÉ𝄞中́\0<|>"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def clashing(df):
    return df.withColumns({c: F.lit(7) for c in ("unit", "key", "bucket", "spans", "items", "n_words", "class", "_h", "ids")})


# ------------------------------------------------------------------------------------------------ statistics

def test_counts_equal_plain_python():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n\t#|<\x0b  ß𝄞A!") for _ in range(rng.choice([0, 1, 2, 5, 30, 100]))) for _ in range(400)]
    texts += ["", None, "a a a a a a", "\n\n", "x\nx\n x\nx"]
    batch = pa.record_batch({"text": pa.array(texts)})
    parts = [textstats.counts(d, o) for _, d, o in chunks([batch], "text", 200)]
    got = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    for i, t in enumerate(texts):
        w = words_of(t)
        windows = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        covered = {j + k for j in range(len(w) - 2) if windows[tuple(w[j:j + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        assert (got["n_words"][i], got["word_chars"][i], got["n_symbols"][i], got["n_dup_lines"][i], got["n_repeat_words"][i], got["n_distinct_words"][i]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered), len(set(w)))


# ------------------------------------------------------------------------------------------------ 1

def test_fm_index_finds_every_place():
    rng = np.random.default_rng(2)
    for sigma in (3, 9):
        s = rng.integers(1, sigma, 300)
        index = fmindex.FMIndex(s, sigma, every=5)
        for m in (1, 3, 6):
            patterns = np.unique(rng.integers(1, sigma, (40, m)), axis=0)
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high):
                expected = [i for i in range(len(s) - m + 1) if (s[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, b))) == expected


def phrase_hits(doc, bench, window):
    w, hit, items = re.findall(rb"[0-9a-z\x80-\xff]+", folded(doc).encode()), set(), set()
    for item, text in bench:
        b = re.findall(rb"[0-9a-z\x80-\xff]+", folded(text).encode())
        n = min(window, len(b))
        for j in range(len(b) - n + 1 if b else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == b[j:j + n]:
                    hit |= set(range(p, p + n))
                    items |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination_equals_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 40)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice(["a", "B", "cc", "É", "q1"]) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    bench = [(rng.choice([1, 2, 3, 10, None]), text(rng.choice([0, 1, 2, 4, 9]))) for _ in range(7)] + [(4, None), (5, "")]
    docs = [(i, text(rng.choice([0, 1, 5, 40])) + rng.choice(["", "xx " + (rng.choice(bench)[1] or "")])) for i in range(60)] + [(3, "a B cc"), (None, None), (None, "cc")] * 2
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.find_phrases(df, items, window=5, block_bytes=block_bytes).collect()
    row = lambda k, x: (k is None, k or 0, *x)
    assert sorted(row(r["doc_id"], (r["n_words"], sum(s["n"] for s in r["spans"]), r["items"])) for r in got) == sorted(row(k, phrase_hits(t, bench, 5)) for k, t in docs)
    for r in got:
        ends = [(s["start"], s["end"]) for s in r["spans"]]
        assert ends == sorted(ends) and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert decontaminate.find_phrases(df.limit(0), items).count() == 0
    assert decontaminate.find_phrases(df, items.limit(0)).filter(F.size("spans") > 0).count() == 0


# ------------------------------------------------------------------------------------------------ 2

def test_chat_round_trip(spark):
    texts = ["", "<|im_end|>\n<|im_start|>assistant\nhi", "<\\|x<\\\\|", "<", "|", "a\n\n", None, "%0A%25", "<<||>>"]
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "we%ird\n<r>", None]), rng.choice(texts)) for c in [1, 2, 3, 4, None] for t in range(6)]
    rows += [(5, 0, "user", "only")] + [(6, 1, "assistant", "same")] * 2 + [(7, None, "assistant", "first"), (7, 0, "user", "then")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("row", "parts", "example", "rows")})
    formatted = chat.examples(df)
    back = {}
    for r in formatted.select("conv_id", "example", "target", "text", chat.read_turns(F.col("text")).alias("turns"), chat.trained_text().alias("trained")).collect():
        back.setdefault(r["conv_id"], []).append(r)
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        mine = sorted(back[conv], key=lambda r: r["example"])
        assert [(t["role"], t["text"]) for t in mine[-1]["turns"]] == [(role, text) for *_, role, text in turns]
        spoken = [i for i, t in enumerate(turns) if t[2] == "assistant"]
        assert [r["example"] for r in mine if r["target"]] == spoken
        assert [r["trained"] for r in mine if r["target"]] == [turns[i][3] for i in spoken]
        assert all(r["trained"] == "" for r in mine if not r["target"])
        assert all(r["text"].count("<|im_start|>") == r["example"] + 1 for r in mine)
    assert chat.conversation_digests(chat.examples(df.limit(0))).count() == 0


# ------------------------------------------------------------------------------------------------ 3

def shingle_set(text, n=3):
    w = words_of(folded(text))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("block, hot, words, least_share", [(1024, 16, 3, 90), (4, 2, 3, 90), (1024, 16, 5, 80), (3, 1, 5, 80)])
def test_similarity_join_equals_brute_force(spark, monkeypatch, block, hot, words, least_share):
    """Also where nearly all signatures are hot and blocks hold few sets."""
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "HOT", hot)
    monkeypatch.setattr(partenum, "PARTNERS", 4 * hot)
    rng = random.Random(block)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "the"]
    rows = []
    for i in range(250):
        r = rng.random()
        if r < 0.45 and rows:
            t = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
            t = " ".join(t + rng.choices(vocabulary, k=rng.choice([0, 0, 1, 3])))
        elif r < 0.5:
            t = rng.choice(["", None, " \n", "a", "A", "a b", "a  B"])
        else:
            t = " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 11, 13, 22, 40, 90, 300])))
        rows.append((i + 1, t))
    shared = " ".join(rng.choices(vocabulary, k=40))  # a passage of many documents
    rows += [(300 + i, shared + " " + " ".join(rng.choices(vocabulary, k=12))) for i in range(40)]
    rows += [(7, rows[50][1]), (7, rows[60][1])] + [rows[3]] * 3 + [(None, "lone words here")]
    sets, up = [shingle_set(t, words) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * same >= least_share * (len(sets[i]) + len(sets[j]) - same):
                up[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    expected = sorted((k or 0, len(sets[i]), least.get(find(i), 0)) for i, (k, _) in enumerate(rows))
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in partenum.similar_documents(df, words=words, similar=(least_share, 100)).collect())
    assert got == expected
    assert partenum.similar_documents(df.limit(0)).count() == 0


def test_a_group_of_near_copies_names_few_pairs(spark, monkeypatch):
    """Copies that are near by counts but mostly do not link: the pairs that are written stay below the square of the group."""
    monkeypatch.setattr(partenum, "HOT", 2)
    monkeypatch.setattr(partenum, "SPARSE", 1)
    rows_of, plain = {}, partenum.written

    def counted(df, label="table"):
        out = plain(df, label)
        rows_of[label] = rows_of.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(partenum, "written", counted)
    base = [f"w{i}" for i in range(300)]
    texts = [[f"x{i}" if at in (12 * i + 2, 12 * i + 6, 12 * i + 10) else w for at, w in enumerate(base)] for i in range(25)]
    texts += [[*texts[k][:299], f"y{k}"] for k in range(0, 25, 5)]
    sets, up = [shingle_set(" ".join(t)) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 10 * same >= 9 * (len(sets[i]) + len(sets[j]) - same):
                up = [up[j] if u == up[i] else u for u in up]
    least = {u: min(k for k, v in enumerate(up) if v == u) for u in up}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"], r["component_id"]) for r in partenum.similar_documents(df).collect())
    assert got == [(i, least[up[i]]) for i in range(len(texts))] and 1 < len(least) < len(texts)
    assert rows_of["near"] + rows_of["rest"] < 12 * len(texts)


@pytest.mark.parametrize("least_share", [90, 80])
def test_similar_sets_always_share_a_signature(least_share):
    rng = np.random.default_rng(5)
    for size in (5, 9, 10, 12, 19, 20, 38, 60, 200, 700):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            most = 2 * len(a) * (100 - least_share) // (100 + least_share)
            gone = int(rng.integers(0, most + 1))
            b = np.r_[a[gone:], rng.integers(0, 2**63, int(rng.integers(0, max(most - gone, 0) + 1))).astype(np.uint64)]
            same = len(np.intersect1d(a, b))
            sig, of = partenum.signatures(np.r_[a, b], np.r_[0, len(a), len(a) + len(b)], (least_share, 100))
            if len(b) and 100 * same >= least_share * (len(a) + len(b) - same):
                assert np.intersect1d(sig[of == 0], sig[of == 1]).size


# ------------------------------------------------------------------------------------------------ 5

def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def odd_rows(n=150):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice(ODD) for _ in range(rng.choice([0, 1, 2, 5, 30, 200])))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "<|endoftext|> hi <|endoftext|>"), (1003, "x" * 1000), (1004, " \0abc"), (1005, "\0abc \0abc abc  abc"), (1005, "a")]


def test_token_files_equal_the_library(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(frames, "FRAME_IDS", 100)
    rows = [*odd_rows(), (None, "null id")]
    model = Tokenizer.from_str(tokenizer())
    model.encode_special_tokens = True
    at, expected = 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        expected.append((k, at, len(ids), ids))
        at += len(ids)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    files = frames.write_ids(df, tokenizer(), 0, folder=f"file://{tmp_path}/ids")
    got = sorted(frames.read_ids(files).collect(), key=lambda r: r["start"])
    same_id = [(k, n, crc32(np.array(i, "<u4").tobytes())) for k, _, n, i in expected]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(same_id)
    assert [r["start"] for r in got] == np.r_[0, np.cumsum([r["n_tokens"] for r in got])][:-1].tolist()
    path = next(p for p in sorted(tmp_path.glob("ids/*.zst")) if list(frames.read_documents(f"file://{p}", {1003})))
    (key, _, ids), = frames.read_documents(f"file://{path}", {1003})
    assert ids.tolist() == next(i for k, *_, i in expected if k == 1003)
    whole = zstandard.ZstdDecompressor().stream_reader(path.read_bytes(), read_across_frames=True).read()
    assert len(whole) == 2 * sum(n for k, n in [(k, len(i)) for k, _, i in frames.read_documents(f"file://{path}")])
    assert frames.read_ids(frames.write_ids(df.limit(0), tokenizer(), 0)).count() == 0


def test_reader_decompresses_only_what_is_asked_and_finds_damage(monkeypatch, tmp_path):
    monkeypatch.setattr(frames, "FRAME_IDS", 10)
    with open(tmp_path / "f", "wb") as sink:
        writer = frames.Writer(sink, 2)
        for k in range(20):
            writer.add(k, np.full(7, k, "<u2").tobytes())
        writer.close()
    data = bytearray((tmp_path / "f").read_bytes())
    with open(tmp_path / "f", "rb") as source:
        reader, asked = frames.Reader(source), []
        frame = reader.frame
        monkeypatch.setattr(reader, "frame", lambda i: asked.append(i) or frame(i))
        assert reader.document(9).tolist() == [9] * 7 and asked == [6]
        first = int(reader.at[6])
    with open(tmp_path / "g", "wb") as sink:
        other = zstandard.ZstdCompressor(level=3).compress(np.full(10, 3, "<u2").tobytes())
        data[first:first + len(other)] = other
        sink.write(data)
    with open(tmp_path / "g", "rb") as source, pytest.raises((ValueError, zstandard.ZstdError)):
        frames.Reader(source).document(9)
    assert struct.unpack("<I", data[-4:])[0] == frames.SEEKABLE


# ------------------------------------------------------------------------------------------------ 7

def without_shared(rows, n):
    smallest, texts = {}, [(float("inf") if k is None else k, (t or "").encode()) for k, t in rows]
    for k, b in texts:
        for i in range(len(b) - n + 1):
            smallest[b[i:i + n]] = min(smallest.get(b[i:i + n], float("inf")), k)
    out = []
    for (key, _), (k, b) in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if smallest[b[i:i + n]] < k:
                gone[i:i + n] = b"\1" * n
        out.append((key, bytes(c for c, g in zip(b, gone) if not g), sum(gone), len(re.findall(b"\1+", gone))))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,n,alphabet,unit,hot,some", [(1, 50, "abcdefgh", 1 << 25, 20_000, 150_000), (2, 20, "abé", 4000, 3, 500)])
def test_repeats_equal_brute_force(spark, monkeypatch, seed, n, alphabet, unit, hot, some):
    for name, value in (("UNIT_BYTES", unit), ("HOT", hot), ("SLICE", some)):
        monkeypatch.setattr(repeats, name, value)
    rng = random.Random(seed)
    text = lambda k: "".join(rng.choices(alphabet, k=k))
    passages, rows = [text(rng.choice([n - 1, n, n + 1, n + 10, 3 * n, 6 * n])) for _ in range(10)], []
    for i in range(150):
        r = rng.random()
        if r < 0.08:
            t = rng.choice([None, "", text(n - 1), "a" * 5 * n, "ab" * 3 * n])
        elif r < 0.3 and rows:
            t = list(rng.choice(rows)[1] or "x")
            for _ in range(rng.choice([0, 3])):
                t[rng.randrange(len(t))] = rng.choice(alphabet)
            t = "".join(t)
        else:
            t = "".join(rng.choice([text(rng.choice([0, 5, n // 2, n, 4 * n])), rng.choice(passages), rng.choice(passages)[rng.randrange(9):]]) for _ in range(rng.choice([1, 3, 6])))
        rows.append((i, t))
    rng.shuffle(rows)
    rows += [(5, rows[3][1]), (5, rows[4][1]), (None, rows[7][1]), rows[9]]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    cut = repeats.without_repeats(df, length=n, carry=True)
    assert set(cut.columns) == set(df.columns)
    got = sorted(((r["doc_id"], bytes(r["text"]), sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"])) for r in cut.collect()), key=str)
    assert got == without_shared(rows, n)
    assert repeats.without_repeats(df.limit(0)).count() == 0


def test_intervals_are_the_maximal_repeats():
    rng = random.Random(7)
    for _ in range(20):
        s = "".join(rng.choices("ab", k=40)) + "$"
        order = sorted(range(len(s)), key=lambda i: s[i:])
        lcp = [0] + [next(k for k in range(41) if s[a + k:a + k + 1] != s[b + k:b + k + 1]) for a, b in zip(order, order[1:])]
        left = [ord(s[i - 1]) if i else -1 for i in order]
        found = {(s[order[a]:order[a] + n], b - a + 1) for n, a, b, _ in repeats.prefix_intervals(lcp, left, [0] * len(order), 2)}
        places = {}
        for i in range(40):
            for j in range(i + 2, 41):
                places.setdefault(s[i:j], []).append(i)
        expected = {(x, len(p)) for x, p in places.items() if len(p) > 1 and len({s[i + len(x)] for i in p}) > 1 and (0 in p or len({s[i - 1] for i in p}) > 1)}
        assert found == expected


# ------------------------------------------------------------------------------------------------ 8

def test_bpe_equals_the_library(spark, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(bpe, "REMEMBERED", 500)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = odd_rows()
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.encode_decode(df, ranks, public_tokenizers.PATTERN).collect())
    assert got == Counter((k, np.array(model.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in rows)
    assert bpe.encode_decode(df.limit(0), ranks, public_tokenizers.PATTERN).count() == 0


def test_blocks_of_bpe_stay_small():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    letters = rng.integers(97, 123, (1200, 10_000)).astype(np.uint8)
    letters[:, ::11] = 32
    rows = pa.record_batch({"key": pa.array(range(1200), pa.int64()), "text": pa.array([x.tobytes().decode() for x in letters])})
    blocks = list(bpe._blocks(public_tokenizers.PATTERN, lambda word: word.decode("latin-1"))([rows]))
    assert [k for b in blocks for k in b.column("keys").flatten().to_pylist()] == list(range(1200))
    assert max(b.nbytes for b in blocks) < 6 << 20


def test_frequent_words_of_bpe_are_folded_once(spark):
    """Tasks know the frequent words of a sample from the start, and what they hold changes no result."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, f"zqxwvutter hhgfoobar{i % 7} zqxwvutter\n\u00e9t\u00e9 word{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "key long, text string")
    table, spell = bpe.Ranks(ranks), bpe.speller(ranks)
    words, ids, sizes = bpe._shared(df, public_tokenizers.PATTERN, table, spell)
    assert "zqxwvutter" in words and " zqxwvutter" in words and len(words) == len(set(words))
    assert np.split(ids, np.cumsum(sizes)[:-1])[words.index(" zqxwvutter")].tolist() == model.encode_ordinary(" zqxwvutter")
    held = types.SimpleNamespace(value=(words, ids, sizes))
    blocks = list(bpe._blocks(public_tokenizers.PATTERN, spell, held)([pa.record_batch({"key": [0], "text": [rows[0][1]]})]))
    assert len(blocks[0].column("words")[0]) < len(set(regex.findall(public_tokenizers.PATTERN, rows[0][1])))
    got = {r["key"]: r for r in bpe.encode_decode(df, ranks, public_tokenizers.PATTERN, key="key").collect()}
    assert all(np.frombuffer(got[k]["ids"], "<u4").tolist() == model.encode_ordinary(t) and bytes(got[k]["decoded"]) == t.encode() for k, t in rows)


def test_bpe_with_a_token_no_merge_reaches(spark):
    """A word that is a token is that token, though its parts have no ranks; ties go to the left."""
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"xyz": 258, b"bc": 259}
    df = spark.createDataFrame([(1, "xyz aaaaa abc xyzz")], "doc_id long, text string")
    got = bpe.encode_decode(df, ranks, r"\S+|\s+").first()
    model = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    assert np.frombuffer(got["ids"], "<u4").tolist() == model.encode_ordinary("xyz aaaaa abc xyzz")


def test_flat_reads_slices_and_nulls():
    data, offsets = flat(pa.array(["x", "ab", None, "cd"]).slice(1))
    assert data.tobytes() == b"abcd" and offsets.tolist() == [0, 2, 2, 4]
