"""Jaccard self-join of word shingle sets with PartEnum signatures.

Two sets of at most r shingles with similarity s differ in at most k = 2r(1-s)/(1+s) shingles. The shingle domain is
cut into n1 parts of n2 sub-parts each, with (k2 + 1) * n1 > k, so some part holds at most k2 differences and n2 - k2 of
its sub-parts hold none: of all choices of n2 - k2 sub-parts of all parts, at least one is equal in both sets. The hash of
each choice's content is a signature. k depends on the size, so sets are signed for their own band of sizes
(r / l <= 1 / s) and for the next, and similar sets always share a band. Small k gets more sub-parts and choices (see
``layouts``), as short sets would leave most of three sub-parts empty. Choices without content say little; n1 has one part to
spare, so they are signed only where a set has as many of them as could stand for all agreement.

Pairs that share a signature are compared by counts of their shingles in a few bins, whose distance is never above that of
the sets, and those left exactly. Only links so verified connect sets. Equal sets are one class throughout. A signature of
more than HOT classes gives no pairs but those with its smallest class; what these and all other signatures leave apart
is compared by the counts in blocks, pairs already connected left out. Where most of a block is near, as in groups of near copies,
pairs would grow with the square of the group: such a block gets the whole sets and names only links that connect what
was apart, fewer than it has classes. A unit of documents sends a hot signature's first HOT + 1 classes, so no task holds a hot group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.graph import components
from faultline.llm.textbytes import SPACES, Rolling, chunks, flat, mix, owners, shingles, spans, windows_inside
from faultline.session import small_side, written

WORDS, SIMILAR = 3, (90, 100)
UNIT_BYTES = 12 << 20      # text whose signatures are grouped before they are shuffled
BUCKET_BYTES = 4 << 20     # text per bucket of signatures
HOT = 16                   # classes of a signature up to which all its pairs are named
BLOCK = 1024               # classes of a hot signature compared with as many others in a task
BLOCK_BYTES = 12 << 20     # of their whole sets, on either side
SPARSE = 4                 # pairs that a block of a hot signature may name for each of its classes
PARTNERS = 64              # of a class, compared with it in a task; their whole sets are sent
FEW = 1_000_000            # ids that may be broadcast: 16 MB
U = np.uint64


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document, and their offsets; A-Z lower-cased, words cut at ASCII white space. A text of
    fewer words, but not none, is one shingle."""
    starts, ends = spans(~SPACES[data], offsets)
    doc, bounds = owners(starts, offsets)
    words = Rolling(data, fold_case=True).of(starts, ends)
    inside = windows_inside(doc, n)
    values, of = shingles(words, n)[inside], doc[:len(inside)][inside]
    size = np.diff(bounds)
    for m in range(1, n):
        short = bounds[:-1][size == m]
        if len(short):
            value = np.full(len(short), m, U)
            for i in range(m):
                value = mix(value * U(0x9E3779B97F4A7C15) + words[short + i])
            values, of = np.r_[values, value], np.r_[of, np.flatnonzero(size == m)]
    each = mix(values + of.astype(U) * U(0xD6E8FEB86659FD93))  # equal only for one shingle in one document
    order = np.argsort(each)
    keep = np.ones(len(values), bool)
    keep[order[1:][each[order][1:] == each[order][:-1]]] = False
    values, of = values[keep], of[keep]
    order = np.argsort(of, kind="stable")
    return values[order], np.r_[0, np.cumsum(np.bincount(of, minlength=len(offsets) - 1))]


def set_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on the order."""
    running = np.zeros(len(values) + 1, U)
    np.cumsum(mix(values ^ U(0x5851F42D4C957F2D)), out=running[1:])
    return mix(running[bounds[1:]] - running[bounds[:-1]] + (bounds[1:] - bounds[:-1]).astype(U))


def bands(largest: int, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest size of each band, two past ``largest``."""
    low, high = [1], []
    while len(low) < 3 or low[-3] <= largest:
        high.append(low[-1] * similar[1] // similar[0])
        low.append(high[-1] + 1)
    return np.array(low[:-1]), np.array(high)


def layouts(k: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
    """(which sets, n1, n2, k2) for sets that may differ in k shingles; sets that may not differ are left to the caller."""
    one = [((k == m), np.ones(len(k), np.int64), n2, m) for m, n2 in ((1, 3), (2, 5), (3, 6))]
    return [*one, ((k > 3) & (k <= 12), k // 3 + 2, 5, 2), (k > 12, k // 2 + 2, 3, 1)]


def signatures(values: np.ndarray, bounds: np.ndarray, similar: tuple[int, int] = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) of all sets that are not empty."""
    size = np.diff(bounds)
    doc = np.repeat(np.arange(len(size)), size)
    low, high = bands(int(size.max(initial=1)), similar)
    own = np.searchsorted(low, np.maximum(size, 1), "right") - 1
    first, second, content = mix(values ^ U(0xA0761D6478BD642F)), mix(values ^ U(0xE7037ED1A0B428DB)), mix(values + U(0x8EBC6AF09C88C6E3))
    whole = set_sums(values, bounds)
    out_sig, out_doc = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for band in (own, own + 1):
        k = 2 * high[band] * (similar[1] - similar[0]) // (similar[1] + similar[0])
        tag = mix(band.astype(U) + U(1))
        exact = np.flatnonzero((k == 0) & (size > 0))  # no difference allowed: the whole set is the signature
        out_sig.append(mix(whole[exact] + tag[exact]))
        out_doc.append(exact)
        for mine, parts, n2, k2 in layouts(k):
            mine = mine & (size > 0)
            if not mine.any():
                continue
            parts = np.where(mine, parts, 0)
            at = np.r_[0, np.cumsum(n2 * parts)]
            inside = mine[doc]
            of = doc[inside]
            slot = at[of] + n2 * (first[inside] % parts[of].astype(U)).astype(np.int64) + (second[inside] % U(n2)).astype(np.int64)
            sums = np.zeros(at[-1], U)
            np.add.at(sums, slot, content[inside])
            sums = sums.reshape(-1, n2)
            part_of = np.repeat(np.arange(len(size)), parts)
            part = np.arange(len(part_of)) - np.repeat(at[:-1] // n2, parts)
            chosen = np.column_stack([sums[:, c].sum(1, dtype=U) for c in combinations(range(n2), n2 - k2)])
            empty = chosen == 0
            n_empty = np.bincount(part_of, empty.any(1), len(size))
            sure = parts - k // (k2 + 1)  # parts with at most k2 differences, at least
            vital = (n_empty >= np.maximum(sure, 1))[part_of]
            tagged = mix(tag[part_of] + part.astype(U))
            for j in range(chosen.shape[1]):
                keep = ~empty[:, j] | vital
                out_sig.append(mix(mix(chosen[keep, j] + tagged[keep]) + U(j)))
                out_doc.append(part_of[keep])
    return np.concatenate(out_sig), np.concatenate(out_doc)


def _planes(values: np.ndarray) -> bytes:
    """Sorted 64-bit values byte by byte, so that the equal high bytes pack well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def _count_sketch(values: np.ndarray) -> bytes:
    """Counts of a set's shingles in bins, more of them for larger sets. Their distance is at most the sets' difference, also
    after counts were cut at 255 or neighbouring bins added up."""
    bits = max(4, int(max(len(values) - 1, 0)).bit_length() - 3)
    return np.minimum(np.bincount((mix(values ^ U(0x1D8E4E27C47D124F)) >> U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def _folded(sketch: np.ndarray, bins: int) -> np.ndarray:
    """Counts in fewer bins, along the last axis."""
    return sketch.reshape(*sketch.shape[:-1], bins, -1).sum(-1, dtype=np.int32)


def _measure(n: int):
    """Documents to (key, size, class, sketch)."""
    def run(batches):
        for rows, data, offsets in chunks(batches, "text"):
            values, bounds = shingle_sets(data, offsets, n)
            size = np.diff(bounds)
            sketch = [_count_sketch(values[a:b]) if b > a else None for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([
                rows.column("key"), pa.array(size), pa.array(set_sums(values, bounds).view(np.int64), mask=size == 0), pa.array(sketch, pa.binary())],
                names=["key", "size", "class", "sketch"])

    return run


def _grouped(sig: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (signature, class) in order, each one's place in its signature and the signature's number of classes."""
    order = np.lexsort((classes, sig))
    sig, classes = sig[order], classes[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (classes[1:] != classes[:-1])
    sig, classes = sig[new], classes[new]
    head = np.ones(len(sig), bool)
    head[1:] = sig[1:] != sig[:-1]
    starts = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    return sig, classes, np.arange(len(sig)) - starts[group], np.diff(np.r_[starts, len(sig)])[group]


def _sign(n: int, similar: tuple[int, int], buckets: int, most: int):
    """Documents to (bucket, sigs, classes) per unit. Signatures that are hot in the unit go to a bucket below 0, too, which
    is the unit's own, and only their first ``most`` + 1 classes to the common one, enough to be hot there."""
    def close(sig, classes):
        sig, classes, place, n_classes = _grouped(np.concatenate(sig), np.concatenate(classes))
        hot = n_classes > most
        lone = hot.nonzero()[0]
        if len(lone):
            name = -1 - int(mix(sig[lone[:1]] ^ classes[lone[-1:]])[0] >> U(33))
            yield pa.RecordBatch.from_arrays([
                pa.array([name], pa.int32()), pa.array([_planes(sig[lone])], pa.binary()), pa.array([classes[lone].astype("<u8").tobytes()], pa.binary())], names=["bucket", "sigs", "classes"])
        sig, classes = sig[place <= most], classes[place <= most]
        bucket = ((sig >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
        used, cut = np.unique(bucket, return_index=True)
        cut = np.r_[cut, len(sig)]
        for at in range(0, len(used), 4096):
            mine = range(at, min(at + 4096, len(used)))
            yield pa.RecordBatch.from_arrays([
                pa.array(used[mine.start:mine.stop].astype(np.int32)), pa.array([_planes(sig[cut[i]:cut[i + 1]]) for i in mine], pa.binary()),
                pa.array([classes[cut[i]:cut[i + 1]].astype("<u8").tobytes() for i in mine], pa.binary())], names=["bucket", "sigs", "classes"])

    def run(batches):
        sigs, owner, size, seen = [], [], 0, np.zeros(0, U)
        for rows, data, offsets in chunks(batches, "text"):
            values, bounds = shingle_sets(data, offsets, n)
            classes = set_sums(values, bounds)
            part = np.zeros(len(classes), bool)
            part[np.unique(classes, return_index=True)[1]] = True  # copies within a unit are signed once
            part &= ~np.isin(classes, seen)
            seen = np.r_[seen, classes[part]]
            sig, of = signatures(values[np.repeat(part, np.diff(bounds))], np.r_[0, np.cumsum(np.where(part, np.diff(bounds), 0))], similar)
            sigs.append(sig)
            owner.append(classes[of])
            size += len(data)
            if size >= UNIT_BYTES:
                yield from close(sigs, owner)
                sigs, owner, size, seen = [], [], 0, np.zeros(0, U)
        if sigs:
            yield from close(sigs, owner)

    return run


def _meet(most: int):
    """One bucket's pairs (NULL, a, b) and the classes (sig, class, NULL) of signatures with more than ``most``."""
    def run(rows: pa.Table) -> pa.Table:
        sig, classes, place, n = _grouped(
            np.concatenate([_unplanes(b) for b in rows.column("sigs").to_pylist()]), np.concatenate([np.frombuffer(b, "<u8") for b in rows.column("classes").to_pylist()]))
        hot = n > most
        first = np.arange(len(sig)) - place
        star = np.flatnonzero(hot & (place > 0))
        left, right = [first[star]], [star]
        for step in range(1, most):
            at = np.flatnonzero(~hot & (place >= step))
            left.append(at - step)
            right.append(at)
        a, b = classes[np.concatenate(left)], classes[np.concatenate(right)]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new].view(np.int64), b[new].view(np.int64)
        return pa.table({
            "sig": pa.array(np.r_[np.zeros(len(a), np.int64), sig[hot].view(np.int64)], mask=np.r_[np.ones(len(a), bool), np.zeros(hot.sum(), bool)]),
            "a": np.r_[a, classes[hot].view(np.int64)],
            "b": pa.array(np.r_[b, np.zeros(hot.sum(), np.int64)], mask=np.r_[np.zeros(len(a), bool), np.ones(hot.sum(), bool)])})

    return run


def _near(similar: tuple[int, int]):
    """Pairs whose counts do not rule them out."""
    part, whole = similar

    def run(batches):
        for rows in batches:
            most = (rows.column("size_a").to_numpy() + rows.column("size_b").to_numpy()) * (whole - part) // (whole + part)
            keep = []
            for a, b, limit in zip(rows.column("sketch_a").to_pylist(), rows.column("sketch_b").to_pylist(), most):
                bins = min(len(a), len(b))
                keep.append(int(np.abs(_folded(np.frombuffer(a, np.uint8), bins) - _folded(np.frombuffer(b, np.uint8), bins)).sum()) <= limit)
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block(rows: pa.Table, similar: tuple[int, int]):
    """Classes, components and sizes of a block, and its near partners of one place: larger classes of the other side (any,
    where there is one side) in other components, whose counts do not rule them out."""
    part, whole = similar
    of, size, side, mark = (rows.column(c).to_numpy().copy() for c in ("class", "size", "side", "component"))
    raw = rows.column("sketch").to_pylist()
    bins = min(map(len, raw))
    sketch = np.stack([_folded(np.frombuffer(x, np.uint8), bins) for x in raw])
    inner = side.min() == side.max()

    def partners(i: int) -> np.ndarray:
        j = np.flatnonzero((mark != mark[i]) & (size * part <= size[i] * whole) & (size[i] * part <= size * whole) & (of > of[i]) & (inner | (side != side[i])))
        return j[np.abs(sketch[j] - sketch[i]).sum(1) <= (size[j] + size[i]) * (whole - part) // (whole + part)]

    return of, mark, partners


def _near_in_block(similar: tuple[int, int], sparse: int):
    """Pairs of a block of a hot signature that are near and not connected yet, or the block's name if there are too many."""
    def run(rows: pa.Table) -> pa.Table:
        of, _, partners = _block(rows, similar)
        left, right, n = [], [], 0
        for i in range(len(of)):
            j = partners(i)
            n += len(j)
            if n > sparse * len(of):
                name = rows.select(["sig", "x", "y"]).slice(0, 1)
                return name.append_column("a", pa.nulls(1, pa.int64())).append_column("b", pa.nulls(1, pa.int64()))
            left.append(np.full(len(j), of[i]))
            right.append(of[j])
        return pa.table({"sig": pa.nulls(n, pa.int64()), "x": pa.nulls(n, pa.int32()), "y": pa.nulls(n, pa.int32()),
                         "a": pa.array(np.concatenate(left), pa.int64()), "b": pa.array(np.concatenate(right), pa.int64())})

    return run


def _links_in_block(similar: tuple[int, int]):
    """Exact links that connect all of a block that links, each of two parts that were apart until then."""
    def run(rows: pa.Table) -> pa.Table:
        of, mark, partners = _block(rows, similar)
        sets = [np.frombuffer(b, "<u8") for b in rows.column("shingles").to_pylist()]
        a, b = [], []
        for i in range(len(of)):
            for j in partners(i):
                if mark[j] != mark[i] and _similar(sets[i], sets[j], similar):
                    mark[mark == mark[j]] = mark[i]
                    a.append(of[i])
                    b.append(of[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _similar(a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> bool:
    """Whether two sorted sets link."""
    x, y = (a, b) if len(a) <= len(b) else (b, a)
    same = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return similar[1] * same >= similar[0] * (len(x) + len(y) - same)


def _sets_of(n: int):
    """Whole sets of fetched texts, where they are the class that was asked for."""
    def run(batches):
        for rows, data, offsets in chunks(batches, "text"):
            values, bounds = shingle_sets(data, offsets, n)
            keep = np.flatnonzero(set_sums(values, bounds).view(np.int64) == rows.column("class").to_numpy())
            blobs = [np.sort(values[bounds[i]:bounds[i + 1]]).astype("<u8").tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays([rows.column("class").take(pa.array(keep)), pa.array(blobs, pa.binary())], names=["class", "shingles"])

    return run


def _compare(similar: tuple[int, int]):
    """Exact links of one class, ``a``, with others."""
    def run(rows: pa.Table) -> pa.Table:
        a, classes, blobs = rows.column("a")[0].as_py(), rows.column("class").to_pylist(), rows.column("shingles").to_pylist()
        own = np.frombuffer(blobs[classes.index(a)], "<u8") if a in classes else np.zeros(0, "<u8")
        linked = []
        for b, blob in dict(zip(classes, blobs)).items():
            other = np.frombuffer(blob, "<u8")
            if b != a and len(own) and _similar(own, other, similar):
                linked.append(b)
        return pa.table({"a": pa.array([a] * len(linked), pa.int64()), "b": pa.array(linked, pa.int64())})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs that link. A class's partners go to the class, about PARTNERS of them to a task."""
    crowds = small_side(pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("blocks")).filter("blocks > 1"), "crowds")
    dealt = written(pairs.join(crowds, "a", "left").select("a", "b", F.pmod(F.hash("b"), F.coalesce("blocks", F.lit(1)).cast("int")).alias("block")), "dealt")
    asked = dealt.select("a", "block", F.col("b").alias("class")).unionByName(dealt.select("a", "block", F.col("a").alias("class")).distinct())
    return written(asked.join(sets, "class").groupBy("a", "block").applyInArrow(_compare(similar), "a bigint, b bigint"), "similar")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs that no links connect yet."""
    at_a, at_b = found.select(F.col("node").alias("a"), F.col("component").alias("to_a")), found.select(F.col("node").alias("b"), F.col("component").alias("to_b"))
    return pairs.join(at_a, "a", "left").join(at_b, "b", "left").filter("to_a is null or to_b is null or to_a <> to_b").select("a", "b")


def _whole_sets(names: DataFrame, source: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(class, shingles) of distinct classes, from the text of each one's smallest document."""
    wanted = written(names.join(classes.select("class", "rep"), "class"), "wanted")
    few = wanted.count() <= FEW
    fetched = source.join(F.broadcast(wanted) if few else wanted, F.col("key") == F.col("rep"))
    return written(fetched.select("class", "text").mapInArrow(_sets_of(words), "class bigint, shingles binary"), "sets")


def _links(near: DataFrame, source: DataFrame, classes: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """Links that connect all the pairs that link: first each class with its smallest partner, then what is left apart."""
    near = written(near, "near")
    sets = _whole_sets(near.select(F.col("a").alias("class")).union(near.select("b")).distinct(), source, classes, words)
    some = _verified(written(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first"), sets, similar)
    rest = written(_apart(near, components(some)), "rest")
    return some if rest.isEmpty() else some.unionByName(_verified(rest, sets, similar))


def _links_of_torn(members: DataFrame, source: DataFrame, classes: DataFrame, words: int, similar: tuple[int, int]) -> DataFrame:
    """Links among the classes of hot signatures that are not in one component."""
    sizes = members.groupBy("sig").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    placed = members.join(small_side(sizes, "sizes"), "sig").withColumn("side", F.pmod(F.hash("class"), "blocks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = placed.select("sig", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "class", "component", "size", "sketch")
    judged = blocks.groupBy("sig", "x", "y").applyInArrow(_near_in_block(similar, SPARSE), "sig bigint, x int, y int, a bigint, b bigint")
    judged = written(judged, "judged")
    links = _links(judged.filter("a is not null").select("a", "b").distinct(), source, classes, words, similar)
    crowded = judged.filter("a is null").select("sig", "x", "y")
    if crowded.isEmpty():
        return links
    crowded = written(blocks.join(small_side(crowded, "crowded"), ["sig", "x", "y"]), "dense")
    sets = _whole_sets(crowded.select("class").distinct(), source, classes, words)
    dense = crowded.join(sets, "class").groupBy("sig", "x", "y").applyInArrow(_links_in_block(similar), "a bigint, b bigint")
    return links.unionByName(written(dense, "similar"))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id): a row per row of ``docs``; ``key`` must be integer.

    Two documents link when intersection / union of their sets is at least ``similar`` (numerator, denominator);
    ``component_id`` is the smallest id reachable by links, the own one included. Without words (or NULL) a set is empty and
    linked with nothing. Rows that share an id share no set; each is judged by its own text. A row without
    an id links nothing, but takes the component of rows with the same set. Other columns are ignored.
    """
    part, whole = similar
    source = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    total = source.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(64, total // BUCKET_BYTES)
    each = written(source.mapInArrow(_measure(words), "key bigint, size bigint, class bigint, sketch binary"), "each")
    classes = written(each.filter("size > 0").groupBy("class").agg(
        F.min("key").alias("rep"), F.min("size").alias("size"), F.min("sketch").alias("sketch")).filter("rep is not null"), "classes")
    signed = source.mapInArrow(_sign(words, similar, buckets, HOT), "bucket int, sigs binary, classes binary")
    met = written(signed.groupBy("bucket").applyInArrow(_meet(HOT), "sig bigint, a bigint, b bigint"), "met")

    def side(name):
        return classes.select(F.col("class").alias(name), F.col("size").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    pairs = met.filter("sig is null").select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.filter((F.col("size_a") * part <= F.col("size_b") * whole) & (F.col("size_b") * part <= F.col("size_a") * whole))
    links = _links(pairs.mapInArrow(_near(similar), "a bigint, b bigint"), source, classes, words, similar)
    found = components(links)
    hot = met.filter("sig is not null").select("sig", F.col("a").alias("class")).distinct()
    hot = written(hot.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class")), "hot")
    torn = written(hot.groupBy("sig").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high"), "torn")
    if not torn.isEmpty():
        members = written(hot.join(torn.select("sig"), "sig").join(classes, "class"), "members")
        found = components(links.unionByName(_links_of_torn(members, source, classes, words, similar)))
    joined = classes.join(found.select(F.col("node").alias("class"), "component"), "class").select("class", "rep", "component")
    joined = written(joined, "joined")
    smallest = small_side(joined.groupBy("component").agg(F.min("rep").alias("least")), "least")
    named = joined.join(smallest, "component").select("class", F.col("least").alias("component_id"))
    own = classes.select("class", "rep").join(named, "class", "left").select("class", F.coalesce("component_id", "rep").alias("component_id"))
    linked = each.filter("size > 0").join(own, "class", "left").select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
    return linked.unionByName(each.filter("size = 0").select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.col("key").alias("component_id")))
