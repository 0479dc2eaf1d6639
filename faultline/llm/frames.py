"""Token ids in files of independent zstandard frames.

Layout of a file: frames of FRAME_IDS ids each (little-endian, two bytes where the vocabulary allows it, else four); a
skippable frame with the documents (ids and lengths); last a skippable frame with the seek table of the zstandard seekable
format: compressed size, decompressed size and checksum (low half of the XXH64 of the content) per frame, then the footer.
Any zstandard reader can decompress a file; this one reads the tail and then only the frames that hold what it wants.

Files hold documents in ascending order, and file after file goes on where the last one ends.
"""

from __future__ import annotations

import os
import struct
import uuid
from array import array
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.segments import cut, kept
from faultline.session import new_path

FRAME_IDS = 1 << 16
SHARD_BYTES = 16 << 20     # text per file
CACHE = 1_200_000          # segments a worker remembers, about 250 bytes each
DOCUMENTS, SEEK_TABLE, SEEKABLE = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by a URI or a local path."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Writer:
    def __init__(self, sink, width: int):
        self.sink, self.width, self.pending, self.size = sink, width, [], 0
        self.table, self.keys, self.lengths = [], [], []
        self.pack = zstandard.ZstdCompressor(level=3)

    def add(self, key: int | None, ids: bytes) -> None:
        """One document; ``ids`` in the file's width."""
        self.keys.append(key)
        self.lengths.append(len(ids) // self.width)
        self.pending.append(ids)
        self.size += len(ids)
        while self.size >= FRAME_IDS * self.width:
            self._frame(FRAME_IDS * self.width)

    def _frame(self, size: int) -> None:
        whole = b"".join(self.pending)
        content, rest = whole[:size], whole[size:]
        packed = self.pack.compress(content)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.sink.write(packed)
        self.pending, self.size = [rest], len(rest)

    def close(self) -> None:
        if self.size:
            self._frame(self.size)
        null = np.array([k is None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        listed = struct.pack("<IQ", self.width, len(keys)) + null.tobytes() + keys.tobytes() + np.array(self.lengths, "<u8").tobytes()
        listed = self.pack.compress(listed)
        seek = b"".join(struct.pack("<III", *row) for row in self.table) + struct.pack("<IBI", len(self.table), 0x80, SEEKABLE)
        self.sink.write(struct.pack("<II", DOCUMENTS, len(listed)) + listed)
        self.sink.write(struct.pack("<II", SEEK_TABLE, len(seek)) + seek)


class Reader:
    """Documents of one file; ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, os.SEEK_END)
        source.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError("no seek table")
        source.seek(end - 9 - 12 * n)
        rows = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        source.seek(int(rows[:, 0].sum()))
        _, listed = struct.unpack("<II", source.read(8))
        content = zstandard.ZstdDecompressor().decompress(source.read(listed))
        self.width, count = struct.unpack_from("<IQ", content)
        null = np.frombuffer(content, np.uint8, count, 12)
        keys = np.frombuffer(content, "<i8", count, 12 + count)
        self.keys = [None if x else int(k) for x, k in zip(null, keys)]
        self.bounds = np.r_[0, np.cumsum(np.frombuffer(content, "<u8", count, 12 + 9 * count).astype(np.int64))]
        self.at, self.ends, self.sums = np.r_[0, np.cumsum(rows[:, 0])], np.r_[0, np.cumsum(rows[:, 1])], rows[:, 2]
        self._held = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._held[0] != i:
            self.source.seek(int(self.at[i]))
            content = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.at[i + 1] - self.at[i])))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} is damaged")
            self._held = (i, content)
        return self._held[1]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document as unsigned 32-bit integers; only its own frames are decompressed."""
        a, b = (int(x) * self.width for x in self.bounds[i:i + 2])
        parts, f = [], int(np.searchsorted(self.ends, a, "right")) - 1
        while a < b:
            stop = min(b, int(self.ends[f + 1]))
            parts.append(self.frame(f)[a - int(self.ends[f]):stop - int(self.ends[f])])
            a, f = stop, f + 1
        return np.frombuffer(b"".join(parts), f"<u{self.width}").astype("<u4")


class Encoder:
    """Ids of texts; remembers up to CACHE distinct segments and encodes them once."""

    def __init__(self, tokenizer: str, width: int, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already fill the cores
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer)
        self.model.encode_special_tokens = True
        self.code, self.end = "H" if width == 2 else "I", end.to_bytes(width, "little")
        self.known: dict[str, bytes] = {}

    def _raw(self, segments: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.model.encode_batch_fast(segments, add_special_tokens=False)]

    def encode(self, text: str | None) -> bytes:
        """The text's ids and the end id, little-endian."""
        if not text:
            return self.end
        first, *rest = cut(text)
        known = self.known
        new = [p for p in set(rest) if p not in known]
        if new:
            if len(known) > CACHE:
                known.clear()
                new = list(set(rest))
            known.update(zip(new, self._raw([" " + p for p in new])))
        return b"".join([*self._raw([first]), *map(known.__getitem__, rest), self.end])


def _largest_id(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(tokenizer).get_vocab(with_added_tokens=True).values(), default=0)


def write_ids(docs: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Encodes all texts and writes them, each with the id ``end`` after it; returns (shard, path, n_docs, n_ids).

    ``tokenizer`` is the content of a tokenizer's json file. Documents are range-partitioned on (key, hash of the text), so
    many rows of one key can be split; a NULL key comes first, repeated rows are repeated documents, a NULL or empty
    text is its end id alone. Strings of special tokens are ordinary text. Other columns are ignored. A task writes its
    file under another name and moves it into place, so a repeated attempt replaces it; an empty table has no files.
    """
    spark = docs.sparkSession
    out = folder or new_path(spark, "tokens")
    source = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    total = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    ranged = source.withColumn("_h", F.xxhash64("text"))
    shards = max(spark.sparkContext.defaultParallelism, total // SHARD_BYTES)
    ranged = ranged.repartitionByRange(shards, "key", "_h").sortWithinPartitions("key", "_h").drop("_h")
    model = spark.sparkContext.broadcast(tokenizer)
    width = 2 if max(_largest_id(tokenizer), end) < 1 << 16 else 4
    name = f"encoder-{sha256(tokenizer.encode()).hexdigest()}-{width}-{end}"

    def run(batches):
        encoder, writer, rows, ids = None, None, 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                if writer is None:
                    encoder = kept(name, lambda: Encoder(model.value, width, end))
                    files, base = open_folder(out)
                    files.create_dir(base, recursive=True)
                    final = f"{base}/shard-{part:07d}.ids.zst"
                    draft = f"{base}/.{part:07d}-{uuid.uuid4().hex}"
                    sink = files.open_output_stream(draft)
                    writer = Writer(sink, width)
                for k, text_ in zip(some.column("key").to_pylist(), some.column("text").to_pylist()):
                    coded = encoder.encode(text_)
                    writer.add(k, coded)
                    rows, ids = rows + 1, ids + len(coded) // width
        if writer is not None:
            writer.close()
            sink.close()
            files.move(draft, final)
            yield pa.RecordBatch.from_pylist([{"shard": part, "path": f"{out}/shard-{part:07d}.ids.zst", "n_docs": rows, "n_ids": ids}])

    # one row per file; collecting them runs the write exactly once
    written_rows = ranged.mapInArrow(run, "shard bigint, path string, n_docs bigint, n_ids bigint").collect()
    return spark.createDataFrame(written_rows, "shard bigint, path string, n_docs bigint, n_ids bigint")


def read_documents(path: str, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(key, position of the first id in the file, ids) of a file's documents, all or those with a wanted key."""
    files, at = open_folder(path)
    with files.open_input_file(at) as source:
        reader = Reader(source)
        for i, k in enumerate(reader.keys):
            if wanted is None or k in wanted:
                yield k, int(reader.bounds[i]), reader.document(i)


def read_ids(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the files; ``start`` counts the ids of all before it."""
    listed = sorted(files.collect(), key=lambda r: r["shard"])
    before = np.r_[0, np.cumsum([r["n_ids"] for r in listed])].tolist()
    spark = files.sparkSession
    places = spark.createDataFrame([(i, r["path"], n) for i, (r, n) in enumerate(zip(listed, before))], "i int, path string, before bigint")

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                rows = []
                for k, at, ids in read_documents(path):
                    rows.append((k, start + at, len(ids), crc32(ids.tobytes())))
                    if len(rows) == 4096:
                        yield _table(rows)
                        rows = []
                yield _table(rows)

    def _table(rows):
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[key, "start", "n_tokens", "ids_crc32"])

    return places.repartition(max(1, len(listed)), "i").mapInArrow(run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
