"""Benchmark decontamination with an FM-index per shard of training documents.

A shard is a run of documents in a task, closed once it holds SHARD_WORDS words of the phrases' alphabet. Only stretches
of such words as long as the shortest phrase can hold an occurrence; these are indexed, with a separator between them.
All phrases are searched backwards at once, occurrences are located by sampled suffix positions, and the word spans they
cover are merged per document. Phrases are broadcast in blocks of bounded size, one pass over the documents each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.fmindex import FMIndex
from faultline.llm.textbytes import NOT_ALNUM, Rolling, chunks, flat, owners, spans
from faultline.session import written

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20  # of benchmark text broadcast at once
FIRST = 2               # symbols below are the end and the separator


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = spans(~NOT_ALNUM[data], offsets)
    doc, bounds = owners(starts, offsets)
    return Rolling(data, fold_case=True).of(starts, ends), starts, ends, doc, bounds


@dataclass
class Phrases:
    alphabet: np.ndarray                   # sorted word hashes; symbol = index + FIRST
    known: np.ndarray                      # 2**16 flags by the low bits of a hash, to pass over most other words
    by_length: dict[int, np.ndarray]       # distinct windows as symbols
    owners: dict[int, tuple[np.ndarray, np.ndarray]]  # per length: offsets and items of each window
    items: list[str]

    @property
    def shortest(self) -> int:
        return min(self.by_length, default=0)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbol of each word, 0 for words outside the alphabet."""
        out = np.zeros(len(words), np.int64)
        maybe = np.flatnonzero(self.known[(words & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.alphabet, words[maybe]), len(self.alphabet) - 1)
        hit = self.alphabet[at] == words[maybe]
        out[maybe[hit]] = at[hit] + FIRST
        return out


def phrases(items: list[str | None], texts: list[bytes | None], window: int = WINDOW) -> Phrases:
    """All windows of ``window`` consecutive words; an item of fewer words, but not none, is one window."""
    data, offsets = flat(pa.array(texts, pa.large_binary()))
    words, _, _, _, bounds = word_hashes(data, offsets)
    alphabet = np.unique(words)
    known = np.zeros(1 << 16, bool)
    known[(alphabet & np.uint64(0xFFFF)).astype(np.int64)] = True
    symbols = np.searchsorted(alphabet, words) + FIRST
    names = sorted({i for i in items if i is not None})
    number = {name: k for k, name in enumerate(names)}
    found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for item, a, b in zip(items, bounds[:-1], bounds[1:]):
        if b > a:
            size = min(window, b - a)
            rows = np.lib.stride_tricks.sliding_window_view(symbols[a:b], size)
            found.setdefault(int(size), []).append((rows, np.full(len(rows), number.get(item, -1))))
    by_length, owner = {}, {}
    for size, parts in found.items():
        rows, of = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        distinct, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.column_stack([which.ravel(), of]), axis=0)
        pairs = pairs[pairs[:, 1] >= 0]
        by_length[size] = distinct
        owner[size] = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]
    return Phrases(alphabet, known, by_length, owner, names)


class Shard:
    """Stretches of phrase words of a run of documents."""

    def __init__(self, sought: Phrases):
        self.sought, self.parts, self.kept, self.documents = sought, [], 0, 0

    def add(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Takes documents in; returns their numbers of words."""
        words, starts, ends, doc, bounds = word_hashes(data, offsets)
        if self.sought.by_length and len(words):
            symbols = self.sought.symbols(words)
            a, b = spans(symbols > 0, bounds)
            long = b - a >= self.sought.shortest
            a, b = a[long], b[long]
            inside = np.zeros(len(words) + 1, np.int64)
            inside[a] += 1
            inside[b] -= 1
            keep = np.flatnonzero(np.cumsum(inside)[:-1])
            head = np.zeros(len(words), bool)
            head[a] = True
            origin = offsets[doc[keep]]
            self.parts.append((symbols[keep], head[keep], doc[keep] + self.documents, keep - bounds[doc[keep]], starts[keep] - origin, ends[keep] - origin))
            self.kept += len(keep)
        self.documents += len(offsets) - 1
        return np.diff(bounds)

    def hits(self) -> tuple[dict[int, list[dict]], dict[int, list[str]]]:
        """Merged spans and items of the documents that hold a phrase."""
        if not self.kept:
            return {}, {}
        symbols, head, doc, word, start, end = (np.concatenate(x) for x in zip(*self.parts))
        place = np.arange(len(symbols)) + np.cumsum(head) - 1  # each stretch but the first has a separator before it
        text = np.ones(place[-1] + 1, np.int64)
        text[place] = symbols
        origin = np.zeros(len(text), np.int64)
        origin[place] = np.arange(len(symbols))
        index = FMIndex(text, len(self.sought.alphabet) + FIRST)
        first, size, pairs = [], [], []
        for length, patterns in self.sought.by_length.items():
            low, high = index.search(patterns)
            which = np.repeat(np.arange(len(patterns)), high - low)
            if not len(which):
                continue
            rows = np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[which]
            at = origin[index.locate(rows)]
            first.append(at)
            size.append(np.full(len(at), length))
            seen = np.unique(np.column_stack([doc[at], which]), axis=0)  # a window often in a document counts once
            bounds, items = self.sought.owners[length]
            n = bounds[seen[:, 1] + 1] - bounds[seen[:, 1]]
            take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[seen[:, 1]], n)
            pairs.append(np.column_stack([np.repeat(seen[:, 0], n), items[take]]))
        if not first:
            return {}, {}
        first, size = np.concatenate(first), np.concatenate(size)
        order = np.argsort(first, kind="stable")
        first, last = first[order], (first + size)[order]  # word positions of a stretch are consecutive here
        reach = np.maximum.accumulate(last)
        new = np.r_[True, (first[1:] > reach[:-1]) | (doc[first[1:]] != doc[first[:-1]]) | head[np.minimum(reach[:-1], len(head) - 1)] & (first[1:] == reach[:-1])]
        begins = first[new]
        stops = reach[np.r_[np.flatnonzero(new)[1:] - 1, len(first) - 1]]
        covered: dict[int, list[dict]] = {}
        for a, b in zip(begins, stops):
            covered.setdefault(int(doc[a]), []).append({"word": int(word[a]), "n": int(b - a), "start": int(start[a]), "end": int(end[b - 1])})
        held: dict[int, list[str]] = {}
        for d, item in np.unique(np.concatenate(pairs), axis=0):
            held.setdefault(int(d), []).append(self.sought.items[item])
        return covered, held


SPANS = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<word:bigint,n:bigint,start:bigint,end:bigint>>"


def _merged(old: list[dict], new: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted([*old, *new], key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word"] + out[-1]["n"]:
            past = s["word"] + s["n"] > out[-1]["word"] + out[-1]["n"]
            if past:
                out[-1] = out[-1] | {"n": s["word"] + s["n"] - out[-1]["word"], "end": s["end"]}
        else:
            out.append(dict(s))
    return out


def find_phrases(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items): a row for each row of ``docs``.

    ``spans`` are the merged runs of words inside occurrences of any window of any item: first word, number of words,
    and the bytes [start, end) they take in the text. ``items`` are the distinct ids, as strings in order, of items
    with an occurring window. NULL or empty texts and items have no words; an item without id still covers words;
    items that share an id count as one; an empty benchmark finds nothing. Other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    bench = items.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    total = bench.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    current = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    for b in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        sought = docs.sparkSession.sparkContext.broadcast(phrases([r["item"] for r in rows], [r["text"] for r in rows], window))
        more = b + 1 < blocks
        out = f"key {kind}, " + ("text binary, " if more else "") + f"n_words bigint, spans {SPANS_SQL}, items array<string>"
        current = current.mapInArrow(_pass(sought, b > 0, more), out)
        if more:
            current = written(current, "phrases")
    return current.withColumnRenamed("key", key)


def _pass(sought, again: bool, more: bool):
    def run(batches):
        shard, rows, sizes = Shard(sought.value), [], []

        def close():
            covered, held = shard.hits()
            n = shard.documents
            found, items = [covered.get(i, []) for i in range(n)], [held.get(i, []) for i in range(n)]
            if again:
                old_spans = [s or [] for r in rows for s in r.column("spans").to_pylist()]
                old_items = [s or [] for r in rows for s in r.column("items").to_pylist()]
                found = [_merged(a, b) if a else b for a, b in zip(old_spans, found)]
                items = [sorted({*a, *b}) for a, b in zip(old_items, items)]
            keep = ["key", "text"] if more else ["key"]
            whole = pa.Table.from_batches([r.select(keep) for r in rows]).combine_chunks()
            whole = whole.append_column("n_words", pa.array(np.concatenate(sizes)))
            whole = whole.append_column("spans", pa.array(found, SPANS)).append_column("items", pa.array(items, pa.list_(pa.string())))
            return whole.to_batches()

        for part, data, offsets in chunks(batches, "text"):
            sizes.append(shard.add(data, offsets))
            rows.append(part if more or again else part.select(["key"]))
            if shard.kept >= SHARD_WORDS:
                yield from close()
                shard, rows, sizes = Shard(sought.value), [], []
        if rows:
            yield from close()

    return run


def contaminated() -> "F.Column":
    """At least a twentieth of the words, and at least one, lies in a phrase."""
    n_hit = n_hit_words()
    return (n_hit > 0) & (20 * n_hit >= F.col("n_words"))


def n_hit_words() -> "F.Column":
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["n"])
