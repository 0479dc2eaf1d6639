"""Byte-level BPE with Spark higher-order functions.

Documents are split into words (matches of the pattern) and each block of documents names the words that are new to its task.
A fold over each word's bytes then merges, at every step, the leftmost neighbours with the smallest rank; ranks come from a
literal map. Ids are turned back into bytes by concatenating the pieces they stand for. Blocks stay in the task that read
them: nothing is shuffled, a block holds BLOCK_BYTES of text or one document, a task remembers REMEMBERED words.

The most frequent words of a sample of the documents are folded once, before the others, and every task knows them from its
start. They save work and change no result: whatever is not among them is folded by the task that meets it.

The fold works on strings with one character per token, the character FIRST + id. Such characters compare as their ids, so
the smallest merged character is the smallest rank; a word's state is its string and the merged character of each pair of
neighbours.
"""

from __future__ import annotations

import base64
import json
from array import array
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.segments import Segments

BLOCK_BYTES = 2 << 20
REMEMBERED = 200_000  # words of a task after which it starts anew, about 250 bytes each
SAMPLED = 20_000      # documents, a tenth of them at most, whose frequent words are folded once
SHARED = 200_000      # of those words at most
BUCKETS = 1 << 17
FIRST = 0x10000   # beyond the surrogates; room for a million ids
LETTERS_FIRST = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+|"  # a pattern that begins so takes a space and letters as one word
EDGE = "!"        # stands before and after a word and has no rank
DECODED = 1 << 17     # ids turned into bytes at once
REST = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_bytes(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Ranked merges of one word's bytes in plain Python; the fold does the same."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


def murmur3(keys: list[str]) -> np.ndarray:
    """Spark's ``hash`` of strings of two four-byte characters, as signed integers."""
    def turned(x, n):
        return (x << np.uint32(n)) | (x >> np.uint32(32 - n))

    words = np.frombuffer("".join(keys).encode(), "<u4").reshape(-1, 2)
    h = np.full(len(words), 42, np.uint32)
    for k in words.T:
        h = turned(h ^ (turned(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32).astype(np.int64)


def _constant(text: str, kind: str) -> Column:
    """A value given as JSON, the same for all rows."""
    one = SparkSession.active().createDataFrame([(text,)], "v string")
    return one.select(F.from_json("v", kind)).scalar()


class Ranks:
    """The rank map as a literal: two neighbours to the token they make. A Spark map finds its key by a scan, so the literal
    is an array of small maps, dealt out by Spark's hash of the key. It stands in the plan as a scalar subquery, whose one
    value Spark puts in its place when the query starts: written out, it would fill plans and event logs with megabytes."""

    def __init__(self, ranks: dict[bytes, int]):
        made = [(a, b, rank) for token, rank in ranks.items() for i in range(1, len(token))
                if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        keys = [chr(FIRST + a) + chr(FIRST + b) for a, b, _ in made]
        buckets: list[dict[str, str]] = [{} for _ in range(BUCKETS)]
        for bucket, key, (_, _, rank) in zip((murmur3(keys) % BUCKETS).tolist(), keys, made):
            buckets[bucket][key] = chr(FIRST + rank)
        self._pairs = json.dumps(buckets)

    def with_tokens(self, df: DataFrame, words: str, name: str) -> DataFrame:
        """Adds array<string> ``name`` for an array of spelled words: one character per token."""
        df = df.withColumn("_pairs", _constant(self._pairs, "array<map<string,string>>"))
        return df.withColumn(name, F.transform(words, lambda word: _folded(word, F.col("_pairs")))).drop("_pairs")


def speller(ranks: dict[bytes, int]):
    """Words as one character per byte. A word that is a token is that token, also where no merges lead to it."""
    byte = {i: chr(FIRST + ranks[bytes([i])]) for i in range(256)}

    def spell(word: bytes) -> str:
        return word.decode("latin-1").translate(byte) if (whole := ranks.get(word)) is None else chr(FIRST + whole)

    return spell


def _spelled_words(words: list[str], spell) -> pa.Array:
    return pa.array([spell(w.encode()) for w in words], pa.string())


def _ids(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of folded words one after the other, and how many each has."""
    tokens = tokens.to_pylist()
    ids = np.frombuffer("".join(tokens).encode("utf-32-le"), "<u4") - np.uint32(FIRST)
    return ids, np.fromiter(map(len, tokens), np.int64, len(tokens))


def _in_one_row(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _merged(two: Column, pairs: Column) -> Column:
    return F.element_at(F.get(pairs, F.pmod(F.hash(two), F.lit(BUCKETS))), two)


def _folded(word: Column, pairs: Column) -> Column:
    """Ranked merges of a spelled word. Every merge takes two steps of the fold, one that finds its place and one that
    makes it: a value that a step needs more than once is cheaper in the state than evaluated again."""
    n = F.length(word)
    parts = F.concat(F.lit(EDGE), word, F.lit(EDGE))
    made = F.transform(F.sequence(F.lit(1), n + 1), lambda i: _merged(F.substring(parts, i, F.lit(2)), pairs))
    start = F.struct(parts.alias("p"), made.alias("m"), F.lit(None).cast("int").alias("i"))
    return F.aggregate(F.sequence(F.lit(1), 2 * n), start, lambda state, _: _step(state, pairs), lambda state: F.replace(state["p"], F.lit(EDGE), F.lit("")))


def _step(state: Column, pairs: Column) -> Column:
    """``i`` is the place of the next merge: NULL before it is sought, 0 when there is none left. As the string has an edge
    on either side, a pair that can merge has neighbours on both."""
    parts, made, i = state["p"], state["m"], state["i"]
    token = F.element_at(made, i)
    before, after = F.substring(parts, i - 1, F.lit(1)), F.substring(parts, i + 2, F.lit(1))
    found = F.struct(parts.alias("p"), made.alias("m"), F.coalesce(F.array_position(made, F.array_min(made)).cast("int"), F.lit(0)).alias("i"))
    merged = F.struct(
        F.concat(F.substring(parts, F.lit(1), i - 1), token, F.substring(parts, i + 2, F.lit(REST))).alias("p"),
        F.concat(F.slice(made, F.lit(1), i - 2), F.array(_merged(F.concat(before, token), pairs), _merged(F.concat(token, after), pairs)),
                 F.slice(made, i + 2, F.lit(REST))).alias("m"),
        F.lit(None).cast("int").alias("i"))
    return F.when(i == 0, state).when(i.isNull(), found).otherwise(merged)


class _Words:
    """Distinct words of a task's documents, numbered as they come after the shared ones; segments are kept for one block."""

    def __init__(self, pattern: str, shared: list[str]):
        self.split, self.numbers = regex.compile(pattern).findall, dict(zip(shared, range(len(shared))))
        self.letters_first = pattern.startswith(LETTERS_FIRST)
        self.segments = Segments()

    def close(self) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Words of the block's segments, where each segment's begin and end, and the words that are new to the task."""
        words, ends = array("I"), array("q", [0])
        known, numbers = len(self.numbers), self.numbers
        for segment in self.segments.texts():
            plain = self.letters_first and segment.isascii() and segment[:1] == " " and segment[1:].isalpha()
            for word in (segment,) if plain else self.split(segment):
                words.append(numbers.setdefault(word, len(numbers)))
            ends.append(len(words))
        self.segments = Segments()
        return np.array(words), np.array(ends), list(islice(numbers, known, None))


def _frequent(pattern: str):
    """Documents to (word, n): how often a task met a word."""
    def close(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        split, counts = regex.compile(pattern).findall, Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(split(text.as_py() or ""))
                if len(counts) > REMEMBERED:
                    yield close(counts)
                    counts = Counter()
        yield close(counts)

    return run


def _spelled(spell):
    def run(batches):
        for batch in batches:
            words = batch.column("word")
            yield pa.RecordBatch.from_arrays([_in_one_row(words), _in_one_row(_spelled_words(words.to_pylist(), spell))], names=["names", "words"])

    return run


def _shared(source: DataFrame, pattern: str, table: Ranks, spell) -> tuple[list[str], np.ndarray, np.ndarray]:
    """At most SHARED words that a sample holds twice or more, the most frequent ones first; their ids one after the other,
    and how many each has."""
    n = source.count()
    sample = source.sample(min(0.1, SAMPLED / max(n, 1)), seed=1)
    counts = sample.mapInArrow(_frequent(pattern), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    words = counts.orderBy(F.desc("n"), "word").limit(SHARED).select("word").repartition(2 * source.sparkSession.sparkContext.defaultParallelism)
    spelled = words.mapInArrow(_spelled(spell), "names array<string>, words array<string>")
    coded = table.with_tokens(spelled, "words", "tokens").select("names", "tokens").toArrow()
    names, ids, sizes = [], [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
    for batch in coded.to_batches():
        names += batch.column("names").flatten().to_pylist()
        new, n = _ids(batch.column("tokens").flatten())
        ids.append(new)
        sizes.append(n)
    return names, np.concatenate(ids), np.concatenate(sizes)


def _blocks(pattern: str, spell, shared: Broadcast | None = None):
    """Documents to blocks: keys, the numbers of each document's words, and the task's new words as they are spelled. After
    REMEMBERED words numbering starts anew, which ``fresh`` says."""
    names = ["keys", "words", "sizes", "numbers", "fresh"]

    def close(keys, documents, held, fresh):
        words, ends, new = held.close()
        counted, taken = [], []
        for own in documents:
            n = ends[own + 1] - ends[own]
            total = int(n.sum())
            counted.append(total)
            taken.append(words[np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[own], n)])
        keys = pa.concat_arrays(keys)
        return pa.RecordBatch.from_arrays([
            _in_one_row(keys), _in_one_row(_spelled_words(new, spell)),
            pa.array([np.array(counted, "<i8").tobytes()], pa.binary()), pa.array([np.concatenate(taken).astype("<u4").tobytes()], pa.binary()),
            pa.array([fresh])], names=names)

    def run(batches):
        common = shared.value[0] if shared else []
        held, fresh = _Words(pattern, common), True
        keys, documents, size = [], [], 0
        for batch in batches:
            at = 0
            for i, text in enumerate(batch.column("text")):
                text = text.as_py() or ""
                documents.append(np.array(held.segments.of(text) if text else [], np.int32))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield close([*keys, batch.column("key").slice(at, i + 1 - at)], documents, held, fresh)
                    at, keys, documents, size, fresh = i + 1, [], [], 0, len(held.numbers) > len(common) + REMEMBERED
                    if fresh:
                        held = _Words(pattern, common)
            if at < batch.num_rows:
                keys.append(batch.column("key").slice(at))
        if keys:
            yield close(keys, documents, held, fresh)

    return run


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The given stretches of an array, one after the other."""
    return flat[np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)]


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _documents(pieces: list[bytes], shared: Broadcast):
    """Blocks back to documents: ids as unsigned 32-bit little-endian, and the pieces they stand for."""
    def run(batches):
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin, letters = np.cumsum(size) - size, np.frombuffer(b"".join(pieces), np.uint8)
        _, values, n = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                keys = batch.column("keys").slice(row, 1).flatten()
                if batch.column("fresh")[row].as_py():
                    _, values, n = shared.value
                new, m = _ids(batch.column("tokens").slice(row, 1).flatten())
                values, n = np.r_[values, new], np.r_[n, m]
                first = np.cumsum(n) - n
                numbers = np.frombuffer(batch.column("numbers")[row].as_py(), "<u4")
                ends = np.r_[0, np.cumsum(np.frombuffer(batch.column("sizes")[row].as_py(), "<i8"))]
                for at in range(0, len(keys), 64):
                    to = min(at + 64, len(keys))
                    own = numbers[ends[at]:ends[to]]
                    ids = _gather(values, first[own], n[own])
                    cuts = np.r_[0, np.cumsum(n[own])][ends[at:to + 1] - ends[at]]
                    texts = [_gather(letters, begin[part], size[part]) for part in (ids[i:i + DECODED] for i in range(0, len(ids), DECODED))]
                    borders = np.r_[0, np.cumsum(size[ids])][cuts]
                    yield pa.RecordBatch.from_arrays([
                        keys.slice(at, to - at), _binaries(ids, 4 * cuts), _binaries(np.concatenate([np.zeros(0, np.uint8), *texts]), borders)], names=["key", "ids", "decoded"])

    return run


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): for each row its ids as little-endian unsigned 32-bit integers, and their bytes.

    Words are the pattern's matches, encoded separately; there are no special tokens. A NULL or empty text has no ids.
    Repeated rows give repeated rows; other columns are ignored. Every byte must have a rank of its own.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    table, spell = Ranks(ranks), speller(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(_shared(source, pattern, table, spell))
    blocks = source.mapInArrow(_blocks(pattern, spell, shared), f"keys array<{kind}>, words array<string>, sizes binary, numbers binary, fresh boolean")
    coded = table.with_tokens(blocks, "words", "tokens").drop("words")
    return coded.mapInArrow(_documents(pieces, shared), f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    return coded.select(key, (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
