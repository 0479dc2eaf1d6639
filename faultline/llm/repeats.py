"""Repeated passages across documents, by enhanced suffix arrays over shared places.

Every 50-byte string names one of its 25-byte strings, the one with the smallest hash, as its anchor; equal strings name the same
one. Anchors that occur in one document only cannot lie in a repeat. For the others, the strings that name an anchor
are suffixes of its context, and contexts meet by anchor. Their suffixes are sorted, the common prefixes of neighbours
make the tree of prefix intervals, scanned with a stack, and an interval whose members have more than one byte to
their left is a maximal repeat with all its occurrences. Contexts end 25 bytes around an anchor, so a longer repeat comes
out as a chain of overlapping ones; what is covered is the same.

Documents are first copied with the number of their unit, a run of UNIT_BYTES. What a unit has to look up lies in a file
of its own, so texts are never shuffled. Equal contexts of a unit are sent once. An anchor with more than HOT occurrences is
dealt out by the 50-byte strings themselves, of which a unit sends each once, so no task gathers a common line.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.frames import open_folder
from faultline.llm.textbytes import Rolling, chunks, mix, owners
from faultline.session import new_path, written

LENGTH = 50
UNIT_BYTES = 32 << 20
BUCKET_BYTES = 4 << 20
HOT = 20_000
SLICE = 150_000          # suffixes sorted at once
LAST = 2**63 - 1         # stands for a NULL id, which no other is smaller than
U = np.uint64


def pack(*arrays: np.ndarray) -> bytes:
    raw = [np.ascontiguousarray(a) for a in arrays]
    head = struct.pack(f"<{len(raw) + 1}I", len(raw), *[a.nbytes for a in raw])
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in raw))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = struct.unpack_from(f"<{len(kinds)}I", raw, 4)
    at, out = 4 + 4 * len(kinds), []
    for kind, size in zip(kinds, sizes):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


class Anchors:
    """Anchors of one chunk: hash, first and last start of the strings that name it, document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        k = length // 2
        wide = length - k + 1  # 25-byte strings in a 50-byte string
        self.rolling = Rolling(data)
        n = len(data)
        if n < length:
            self.hash, self.low, self.high, self.doc = (np.zeros(0, t) for t in (U, np.int64, np.int64, np.int64))
            return
        grams = mix(self.rolling.raw(slice(0, n - k + 1), slice(k, n + 1)))
        value, at, w = grams, np.arange(len(grams), dtype=np.int32), 1

        def join(value, at, step):
            right = value[step:] < value[:-step]  # of equal ones the left
            return np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])

        while 2 * w <= wide:
            value, at = join(value, at, w)
            w *= 2
        if w < wide:
            value, at = join(value, at, wide - w)
        starts = np.arange(n - length + 1)
        doc, _ = owners(starts, offsets)
        doc = doc[:len(starts)]
        valid = np.flatnonzero(starts + length <= offsets[doc + 1])
        at, doc = at[valid], doc[valid]
        head = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]) if len(at) else np.zeros(0, np.int64)
        self.hash = mix(grams[at[head]] ^ U(0x9FB21C651E98DF25))
        self.low, self.high = valid[head], valid[np.r_[head[1:], len(at)] - 1] if len(at) else valid
        self.doc = doc[head]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


def _short(hashes: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` high bytes; the lowest bit is left to say hot."""
    return (hashes >> U(64 - 8 * width) << U(64 - 8 * width)) & ~U(1)


def _key_numbers(column: pa.Array) -> np.ndarray:
    return column.fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)


def _copied(batches):
    """Documents with the number of their unit."""
    unit, size = TaskContext.get().partitionId() << 24, 0
    for rows, data, _ in chunks(batches, "text", 1 << 20):
        yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, unit)), *rows.columns], names=["unit", *rows.schema.names])
        size += len(data)
        if size >= UNIT_BYTES:
            unit, size = unit + 1, 0


def _by_unit(batches, text: str = "text"):
    """(unit, rows, bytes, offsets) of chunks that belong to one unit."""
    for batch in batches:
        units = batch.column("unit").to_numpy()
        cuts = np.r_[0, np.flatnonzero(units[1:] != units[:-1]) + 1, len(units)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                for rows, data, offsets in chunks([batch.slice(a, b - a)], text):
                    yield int(units[a]), rows, data, offsets


def _list_anchors(length: int, buckets: int, width: int):
    """Per unit and bucket: the anchors' hashes, cut to ``width`` high bytes, and in how many documents each is."""
    def close(unit, held):
        hashes = np.concatenate(held)
        order = np.argsort(hashes)
        hashes = hashes[order]
        head = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
        count = np.diff(np.r_[head, len(hashes)])
        hashes = hashes[head]
        cut = np.searchsorted(_bucket(hashes, buckets), np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(cut))
        planes = [hashes[cut[b]:cut[b + 1]].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].T for b in used]
        return pa.RecordBatch.from_arrays([
            pa.array(used.astype(np.int32)), pa.array(np.full(len(used), unit)),
            pa.array([pack(p, np.minimum(count[cut[b]:cut[b + 1]], 2**32 - 1).astype("<u4")) for p, b in zip(planes, used)], pa.binary())], names=["bucket", "unit", "blob"])

    def run(batches):
        now, held = None, []
        for unit, _, data, offsets in _by_unit(batches):
            if held and unit != now:
                yield close(now, held)
                held = []
            now = unit
            found = Anchors(data, offsets, length)
            each = mix(found.hash + found.doc.astype(U) * U(0xD6E8FEB86659FD93))  # an anchor counts once in a document
            order = np.argsort(each)
            once = np.ones(len(each), bool)
            once[order[1:][each[order][1:] == each[order][:-1]]] = False
            held.append(_short(found.hash[once], width))
        if held:
            yield close(now, held)

    return run


def _shared(width: int):
    """Of one bucket's anchors, those in two documents or more, for each unit that has them; the lowest bit says hot."""
    def run(rows: pa.Table) -> pa.Table:
        units = rows.column("unit").to_numpy()
        hashes, counts, source = [], [], []
        for i, blob in enumerate(rows.column("blob").to_pylist()):
            planes, count = unpack(blob, "u1", "<u4")
            full = np.zeros((len(count), 8), np.uint8)
            full[:, :width] = planes.reshape(width, -1).T
            hashes.append(full.view(">u8").ravel().astype(U))
            counts.append(count.astype(np.int64))
            source.append(np.full(len(count), i, np.int32))
        hashes, counts, source = np.concatenate(hashes), np.concatenate(counts), np.concatenate(source)
        order = np.argsort(hashes, kind="stable")
        hashes, counts, source = hashes[order], counts[order], source[order]
        head = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        total = np.add.reduceat(counts, head)
        total = np.repeat(total, np.diff(np.r_[head, len(hashes)]))
        keep = total >= 2
        value, source = (hashes | (total > HOT).astype(U))[keep], source[keep]
        order = np.argsort(source, kind="stable")
        value, source = value[order], source[order]
        cut = np.searchsorted(source, np.arange(len(units) + 1))
        used = np.flatnonzero(np.diff(cut))
        return pa.table({"unit": pa.array(units[used], pa.int64()), "blob": pa.array([pack(value[cut[i]:cut[i + 1]]) for i in used], pa.binary())})

    return run


def _store(folder: str):
    """Writes the blobs of a unit to its file, under another name first; a repeated attempt replaces it."""
    def run(rows: pa.Table) -> pa.Table:
        unit = rows.column("unit")[0].as_py()
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        draft = f"{base}/.{unit}-{TaskContext.get().taskAttemptId()}"
        with files.open_output_stream(draft) as sink:
            for blob in rows.column("blob").to_pylist():
                sink.write(struct.pack("<Q", len(blob)) + blob)
        files.move(draft, f"{base}/{unit}")
        return pa.table({"unit": pa.array([unit], pa.int64())})

    return run


def _load(folder: str, unit: int, *kinds: str) -> list[np.ndarray]:
    files, base = open_folder(folder)
    parts: list[list[np.ndarray]] = []
    if files.get_file_info(f"{base}/{unit}").type == pafs.FileType.File:
        with files.open_input_stream(f"{base}/{unit}") as source:
            while head := source.read(8):
                parts.append(unpack(source.read(struct.unpack("<Q", head)[0]), *kinds))
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _contexts(length: int, buckets: int, folder: str, width: int):
    """Per unit and bucket: distinct contexts of shared anchors, with the smallest and largest document that has each."""
    def close(unit, held):
        hashes, lengths, data, doc, where = (np.concatenate(x) for x in zip(*held))
        at = np.cumsum(lengths) - lengths
        order = np.lexsort((doc, hashes, _bucket(where, buckets)))
        h = hashes[order]
        head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        first, last = doc[order[head]], doc[order[np.r_[head[1:], len(h)] - 1]]
        pick = order[head]
        cut = np.searchsorted(_bucket(where[pick], buckets), np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)):
            some = slice(cut[b], cut[b + 1])
            own = pick[some]
            n = lengths[own]
            take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[own], n)
            yield pa.RecordBatch.from_arrays([
                pa.array([b], pa.int32()), pa.array([unit], pa.int64()),
                pa.array([pack(hashes[own], n.astype("u1"), first[some], last[some], data[take])], pa.binary())], names=["bucket", "unit", "blob"])

    def run(batches):
        now, held, size = None, [], 0
        shared = hot = np.zeros(0, U)
        for unit, rows, data, offsets in _by_unit(batches):
            if unit != now:
                if held:
                    yield from close(now, held)
                    held, size = [], 0
                value = _load(folder, unit, "<u8")[0].astype(U)
                shared, now = np.sort(value), unit
                hot = shared[shared & U(1) == 1] & ~U(1)
                shared = shared & ~U(1)
            found, low, high, doc, is_hot = _known(Anchors(data, offsets, length), shared, hot, width)
            if not len(low):
                continue
            keys = _key_numbers(rows.column("key"))[doc]
            place, low, n, keys = _cut(found, low, high, keys, is_hot, length)
            hashes = found.rolling.of(low, low + n)
            place = np.where(place == 0, hashes, place)
            take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            held.append((hashes, n, data[take], keys, place))
            size += n.sum()
            if size >= 2 * UNIT_BYTES:
                yield from close(now, held)
                held, size = [], 0
        if held:
            yield from close(now, held)

    return run


def _known(found: Anchors, shared: np.ndarray, hot: np.ndarray, width: int):
    """The shared ones of a chunk's anchors: first and last start, document, and whether hot; keeps their hashes."""
    cut = _short(found.hash, width)

    def isin(sorted_: np.ndarray) -> np.ndarray:
        if not len(sorted_):
            return np.zeros(len(cut), bool)
        return sorted_[np.minimum(np.searchsorted(sorted_, cut), len(sorted_) - 1)] == cut

    keep = isin(shared)
    found.hash = found.hash[keep]
    return found, found.low[keep], found.high[keep], found.doc[keep], isin(hot)[keep]


def _cut(found: Anchors, low: np.ndarray, high: np.ndarray, keys: np.ndarray, hot: np.ndarray, length: int):
    """Contexts as (bucket key, start, bytes, document): one for an anchor, or one for each of a hot anchor's strings (key 0)."""
    n = np.where(hot, high - low + 1, 1)
    which = np.repeat(np.arange(len(low)), n)
    shift = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    start = low[which] + shift
    size = np.where(hot[which], length, high[which] - low[which] + length)
    return np.where(hot[which], U(0), found.hash[which]), start, size, keys[which]


def prefix_intervals(lcp: list[int], left: list[int], low: list[int], least: int) -> list[tuple[int, int, int, int]]:
    """Stack scan of an enhanced suffix array: (prefix length, first row, last row, smallest document) of each interval of at
    least ``least`` common bytes whose rows have more than one byte to their left. ``lcp[i]`` belongs to rows i - 1 and i;
    a left of -1 is a border, which differs from everything."""
    out, stack = [], []
    for i in range(1, len(left) + 1):
        now = lcp[i] if i < len(left) else 0
        first, byte, smallest = i - 1, left[i - 1], low[i - 1]
        while stack and now < stack[-1][0]:
            n, begin, held, m = stack.pop()
            byte = held if held == byte else -1
            smallest, first = min(m, smallest), begin
            if byte == -1:
                out.append((n, begin, i - 1, smallest))
        if now >= least:
            if stack and stack[-1][0] == now:
                top = stack[-1]
                top[2] = top[2] if top[2] == byte else -1
                top[3] = min(top[3], smallest)
            else:
                stack.append([now, first, byte, smallest])
    return out


def _smallest(data: np.ndarray, at: np.ndarray, n: np.ndarray, own: np.ndarray, length: int) -> np.ndarray:
    """For each string of each context, in order, the smallest document it occurs in, from the maximal repeats of all contexts."""
    windows = n - length + 1
    base = np.cumsum(windows) - windows
    best = np.repeat(own, windows)
    width = -(-(2 * length - length // 2) // 8) * 8  # the longest context, in whole words
    context = np.repeat(np.arange(len(n)), windows)
    shift = np.arange(len(context)) - base[context]
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    rest = n[context] - shift
    view = np.lib.stride_tricks.sliding_window_view(padded, width)[at[context] + shift].copy()
    view[np.arange(width) >= rest[:, None]] = 0
    keys = view.view(">u8").astype(U)
    order = np.lexsort(tuple(keys[:, c] for c in reversed(range(keys.shape[1]))))
    view, rest, context, shift = view[order], rest[order], context[order], shift[order]
    differ = view[1:] != view[:-1]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    lcp = np.r_[0, np.minimum(lcp, np.minimum(rest[1:], rest[:-1]))]
    near = lcp >= length
    run_start = np.flatnonzero(near & ~np.r_[False, near[:-1]]) - 1
    run_end = np.flatnonzero(near & ~np.r_[near[1:], False]) + 1
    left = np.where(shift > 0, padded[np.maximum(at[context] + shift - 1, 0)], 256).astype(np.int64)
    left[shift == 0] = -1
    groups = []
    for a, b in zip(run_start, run_end):
        for size, first, last, smallest in prefix_intervals([0, *lcp[a + 1:b].tolist()], left[a:b].tolist(), own[context[a:b]].tolist(), length):
            groups.append((size, a + first, a + last, smallest))
    if groups:
        size, first, last, smallest = np.array(groups).T
        rows = last - first + 1
        g = np.repeat(np.arange(len(groups)), rows)
        row = first[g] + np.arange(len(g)) - np.repeat(np.cumsum(rows) - rows, rows)
        spans = size[g] - length + 1
        w = np.repeat(np.arange(len(g)), spans)
        string = base[context[row[w]]] + shift[row[w]] + np.arange(len(w)) - np.repeat(np.cumsum(spans) - spans, spans)
        np.minimum.at(best, string, smallest[g[w]])
    return best


def _resolve(length: int):
    """One bucket's contexts: for each unit, those that a smaller document repeats, with that document per string."""
    def run(rows: pa.Table) -> pa.Table:
        units = rows.column("unit").to_numpy()
        parts = [unpack(b, "<u8", "u1", "<i8", "<i8", "u1") for b in rows.column("blob").to_pylist()]
        source = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        hashes, n, low, high, data = (np.concatenate(x) for x in zip(*parts))
        n = n.astype(np.int64)
        at = np.cumsum(n) - n
        order = np.lexsort((low, hashes))
        head = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(head) - 1      # distinct context of each entry
        pick = order[head]                      # its entry with the smallest document
        windows = n[pick] - length + 1
        base = np.r_[0, np.cumsum(windows)]
        best = np.empty(base[-1], np.int64)
        # equal strings name one anchor, so contexts are taken anchor by anchor, as many as fit
        anchor = _anchor_of(data, at[pick], n[pick], length)
        by = np.argsort(anchor, kind="stable")
        ends = np.r_[np.flatnonzero(anchor[by][1:] != anchor[by][:-1]) + 1, len(by)]
        upto = np.cumsum(windows[by])
        a = 0
        while a < len(by):
            target = (upto[a - 1] if a else 0) + SLICE
            fit = ends[np.searchsorted(ends, np.searchsorted(upto, target, "right"), "right") - 1] if len(ends) else len(by)
            b = int(fit) if fit > a else int(ends[np.searchsorted(ends, a, "right")])
            some = np.sort(by[a:b])
            got = _smallest(data, at[pick[some]], n[pick[some]], low[pick[some]], length)
            w = windows[some]
            best[np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(base[some], w)] = got
            a = b
        least = np.minimum.reduceat(best, base[:-1])
        most = np.maximum.reduceat(best, base[:-1])
        out_units, blobs = [], []
        needed = least[which] < high
        for i in range(len(parts)):
            mine = which[(source == i) & needed]
            if len(mine):
                flat_ = least[mine] == most[mine]
                w = np.where(flat_, 1, windows[mine])
                values = best[np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(base[mine], w)]
                out_units.append(units[i])
                blobs.append(pack(hashes[pick[mine]], w.astype("u1"), values))
        return pa.table({"unit": pa.array(out_units, pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return run


def _anchor_of(data: np.ndarray, at: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Hash of the anchor of each context's first string; contexts lie one after the other in ``data``."""
    k = length // 2
    rolling = Rolling(data)
    grams = np.arange(length - k + 1)
    out = np.empty(len(at), U)
    for a in range(0, len(at), 1 << 16):
        starts = (at[a:a + (1 << 16), None] + grams).ravel()
        out[a:a + (1 << 16)] = mix(rolling.raw(starts, starts + k)).reshape(-1, len(grams)).min(1)
    return out


def _whole_characters(gone: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Removed bytes of characters that are removed whole."""
    if not len(data):
        return gone
    lead = (data & 0xC0) != 0x80
    lead[0] = True
    first = np.flatnonzero(lead)
    return np.repeat(np.logical_and.reduceat(gone, first), np.diff(np.r_[first, len(data)]))


def _cut_out(length: int, folder: str, width: int, anchors: str, whole: bool):
    """Documents without what smaller ones repeat: removed runs as [start, end) bytes, and the bytes that stay."""
    def run(batches):
        now = None
        for unit, rows, data, offsets in _by_unit(batches):
            if unit != now:
                value = np.sort(_load(anchors, unit, "<u8")[0].astype(U))
                hot, shared, now = value[value & U(1) == 1] & ~U(1), value & ~U(1), unit
                hashes, count, smallest = _load(folder, unit, "<u8", "u1", "<i8")
                count = count.astype(np.int64)
                first = np.cumsum(count) - count
                order = np.argsort(hashes)
                hashes, count, first = hashes[order].astype(U), count[order], first[order]
            marks = np.zeros(len(data) + 1, np.int64)
            found, low, high, doc, is_hot = _known(Anchors(data, offsets, length), shared, hot, width)
            if len(low) and len(hashes):
                _, low, n, keys = _cut(found, low, high, _key_numbers(rows.column("key"))[doc], is_hot, length)
                own = found.rolling.of(low, low + n)
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                hit = np.flatnonzero(hashes[at] == own)
                strings = n[hit] - length + 1
                w = np.repeat(np.arange(len(hit)), strings)
                shift = np.arange(len(w)) - np.repeat(np.cumsum(strings) - strings, strings)
                entry = at[hit][w]
                repeated = smallest[first[entry] + np.where(count[entry] > 1, shift, 0)] < keys[hit][w]
                start = (low[hit][w] + shift)[repeated]
                np.add.at(marks, start, 1)
                np.add.at(marks, start + length, -1)
            gone = np.cumsum(marks[:-1]) > 0
            if whole:
                gone = _whole_characters(gone, data)
            kept, spans = [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                out = gone[a:b]
                if out.any():
                    edge = np.flatnonzero(np.diff(np.r_[False, out, False]))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
                    kept.append(data[a:b][~out].tobytes())
                else:
                    spans.append([])
                    kept.append(data[a:b].tobytes())
            names = [c for c in rows.schema.names if c not in ("unit", "text")]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(spans, SPANS), pa.array(kept, pa.binary())], names=[*names, "spans", "text"])

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, carry: bool = False, whole: bool = False) -> DataFrame:
    """(key, spans, text): each row's removed runs, as bytes [start, end) of its text, and the bytes that are left.

    A byte is removed if it lies in a string of ``length`` bytes that also starts in a row with a smaller key; repeats never
    cross rows, and are judged on the texts as given. A NULL text is empty, texts shorter than ``length`` stay whole, rows that
    share a key remove nothing from each other, a NULL key is larger than all others. Other columns are ignored, or come
    along after the key if ``carry``; one named ``spans`` never does. The remaining bytes may start or end inside a
    character, unless ``whole`` keeps every character of which a byte remains.
    """
    extra = [f for f in docs.schema.fields if carry and f.name not in (key, text, "spans")]
    renamed = [T.StructField(f"_{i}", f.dataType) for i, f in enumerate(extra)]
    source = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), *[F.col(f"`{f.name}`").alias(r.name) for f, r in zip(extra, renamed)],
                         F.col(f"`{text}`").cast("binary").alias("text"))
    spark = docs.sparkSession
    fields = [T.StructField("key", T.LongType()), *renamed]
    copied = written(source.mapInArrow(_copied, T.StructType([T.StructField("unit", T.LongType()), *fields, T.StructField("text", T.BinaryType())])), "units")
    total = copied.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(64, total // BUCKET_BYTES)
    width = min(8, math.ceil((math.log2(total + 2) + 10) / 8))  # a chance double of a place is rare, and is told apart later
    anchors, found = new_path(spark, "anchors"), new_path(spark, "repeats")
    texts = copied.select("unit", "key", "text")
    listed = texts.mapInArrow(_list_anchors(length, buckets, width), "bucket int, unit bigint, blob binary")
    shared = listed.groupBy("bucket").applyInArrow(_shared(width), "unit bigint, blob binary")
    shared.groupBy("unit").applyInArrow(_store(anchors), "unit bigint").count()
    contexts = texts.mapInArrow(_contexts(length, buckets, anchors, width), "bucket int, unit bigint, blob binary")
    resolved = contexts.groupBy("bucket").applyInArrow(_resolve(length), "unit bigint, blob binary")
    resolved.groupBy("unit").applyInArrow(_store(found), "unit bigint").count()
    runs = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    cut = copied.mapInArrow(_cut_out(length, found, width, anchors, whole), T.StructType([*fields, T.StructField("spans", runs), T.StructField("text", T.BinaryType())]))
    return cut.select(F.col("key").alias(key), *[F.col(r.name).alias(f.name) for f, r in zip(extra, renamed)], "spans", F.col("text").alias(text))
