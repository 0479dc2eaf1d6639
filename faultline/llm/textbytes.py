"""Whole Arrow batches of texts as one byte array: words, hashes and per-document sums without a Python loop per word.

A word is a maximal run of bytes outside a table of separators, and never crosses a document's border. As every byte of
a character beyond ASCII is above 0x7F, the byte tables below cut UTF-8 texts exactly as the character classes they stand for.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from faultline.llm.segments import kept

CHUNK_BYTES = 1 << 20    # text worked on at once; a longer document is a chunk of its own
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def table(inside: Iterable[int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(inside)] = True
    return out


SPACES = table([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])  # after lower-casing
NOT_ALNUM[0x41:0x5B] = False                                                     # A-Z are lower-cased, so they count

_BYTE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_FOLDED = _BYTE.copy()
_FOLDED[0x41:0x5B] = _BYTE[0x61:0x7B]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows one after the other, and the offsets that cut them; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of at most ``limit`` bytes or one document."""
    for batch in batches:
        data, offsets = flat(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
            at = to


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each [offsets[i], offsets[i + 1])."""
    running = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at the documents' borders."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(inside))]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[borders] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    after[borders - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def owners(starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document of each sorted start, and the offsets of the documents among the starts."""
    bounds = np.searchsorted(starts, offsets)
    bounds[-1] = len(starts)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)), bounds


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _P and of its inverse, kept by the process and not in anything that is sent to workers."""
    held = kept("powers", dict)
    if len(held.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        held["up"], held["down"] = (
            np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64) for base in (_P, pow(_P, -1, 2**64)))
    return held["up"][:n], held["down"][:n]


class Rolling:
    """64-bit polynomial hashes of any byte ranges of one chunk."""

    def __init__(self, data: np.ndarray, fold_case: bool = False):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_FOLDED if fold_case else _BYTE)[data] * up[:-1], out=self.sums[1:])

    def raw(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends) + np.uint64(_P) * (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes; windows across documents are the caller's to drop."""
    m = max(0, len(words) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(_P) + words[i:i + m])
    return out


def windows_inside(doc: np.ndarray, n: int) -> np.ndarray:
    """True where n consecutive words belong to one document."""
    m = max(0, len(doc) - n + 1)
    return doc[:m] == doc[n - 1:n - 1 + m]
