"""Vector codes by product quantisation in integers, with memoised grid cells.

Vectors are cut into equal parts, and each part is coded by its nearest codebook entry. The space of a part is cut into a grid;
an entry whose least distance to a cell's box exceeds the greatest distance of another entry is never nearest in that cell.
The first part that falls into a cell finds the entries that are left, a task remembers them by cell, and only those are
evaluated, exactly. The grid changes the work, never a code.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.vectors import integer_vectors, matrices
from faultline.session import small_side, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 27      # components: squared distances over 128 of them stay below 64 bits
CELLS = 1 << 15      # remembered cells of each part in a task, after which it starts anew


class Grid:
    """Entries that can be nearest in each cell of one part's grid; ``codebook`` has a row per entry."""

    def __init__(self, codebook: np.ndarray, side: int):
        self.codebook, self.side, self.known = codebook, side, {}
        self.evaluated = 0

    def _left(self, cells: np.ndarray) -> np.ndarray:
        """For each cell which entries no other one dominates."""
        out = np.empty((len(cells), len(self.codebook)), bool)
        for at in range(0, len(cells), 1024):
            low = cells[at:at + 1024, None, :] * self.side
            high = low + self.side - 1
            nearest = (np.maximum(np.maximum(low - self.codebook, self.codebook - high), 0) ** 2).sum(2)
            farthest = (np.maximum(np.abs(self.codebook - low), np.abs(self.codebook - high)) ** 2).sum(2)
            out[at:at + 1024] = nearest <= farthest.min(1)[:, None]
        return out

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """(row, entry): whether the entry has to be evaluated for the row."""
        if not len(x):
            return np.zeros((0, len(self.codebook)), bool)
        cells = np.ascontiguousarray(x // self.side)
        keys = cells.view(np.dtype((np.void, cells.shape[1] * 8))).ravel()
        _, first, cell = np.unique(keys, return_index=True, return_inverse=True)
        names = [keys[i].tobytes() for i in first]
        new = [i for i, name in enumerate(names) if name not in self.known]
        if len(self.known) + len(new) > CELLS:
            self.known, new = {}, list(range(len(names)))
        for i, left in zip(new, self._left(cells[first[new]])):
            self.known[names[i]] = left.tobytes()
        return np.frombuffer(b"".join([self.known[name] for name in names]), bool).reshape(len(names), -1)[cell]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row, the lower index at a tie, and its squared distance."""
        left = self.candidates(x)
        best, code = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        for e, entry in enumerate(self.codebook):
            rows = np.flatnonzero(left[:, e])
            d = ((x[rows] - entry) ** 2).sum(1)
            self.evaluated += len(rows)
            nearer = d < best[rows]
            best[rows[nearer]], code[rows[nearer]] = d[nearer], e
        return code, best


def _grids(codebooks: np.ndarray) -> list[Grid]:
    """A grid for each part; a cell is half as long as the entries are spread on average (a power of two, rounded down)."""
    spread = [(c.max(0) - c.min(0)).mean() for c in codebooks]
    return [Grid(c, 1 << max(0, int(np.log2(s / 2)) if s >= 2 else 0)) for c, s in zip(codebooks, spread)]


def _sums(codebooks: np.ndarray):
    parts, entries, width = codebooks.shape

    def run(batches):
        grids = _grids(codebooks)
        count, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, x in matrices(batches, parts * width):
            for p in range(parts):
                own = x[:, p * width:(p + 1) * width]
                code, _ = grids[p].assign(own)
                count[p] += np.bincount(code, minlength=entries)
                for e in np.unique(code):
                    sums[p, e] += own[code == e].sum(0)
        used = np.argwhere(count)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(used[:, 0], pa.int32()), "entry": pa.array(used[:, 1], pa.int32()), "n": pa.array(count[tuple(used.T)], pa.int64()),
            "sums": pa.array([sums[p, e] for p, e in used], pa.list_(pa.int64()))})

    return run


def train(vectors: DataFrame, dims: int, key: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position). They start as the parts of the vectors with the smallest keys (NULL last, repeated
    keys in the order of their vectors), as many as there are. Each round every part counts for its nearest entry, and an entry
    moves to the floor of its parts' mean; only sums per entry leave the tasks."""
    width = dims // parts
    first = vectors.orderBy(F.col(f"`{key}`").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([np.frombuffer(r["x"], "<i8") for r in first], np.int64).reshape(len(first), parts, width)
    codebooks = start.transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        partial = vectors.select("x").mapInArrow(_sums(codebooks), "part int, entry int, n bigint, sums array<bigint>")
        each = partial.select("part", "entry", "n", F.posexplode("sums").alias("position", "s"))
        for r in each.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
            codebooks[r["part"], r["entry"], r["position"]] = r["s"] // r["n"]
    return codebooks


def encode(vectors: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """Adds ``code``, two hexadecimal digits for each part, and ``error``, the squared distance to the entries; takes x off."""
    parts, _, width = codebooks.shape
    rest = [c for c in vectors.columns if c != "x"]

    def run(batches):
        grids = _grids(codebooks)
        for batch, x in matrices(batches, parts * width):
            codes, error = np.empty((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                codes[:, p], distance = grids[p].assign(x[:, p * width:(p + 1) * width])
                error += distance
            digits = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c) for c in rest], pa.array([digits[i:i + 2 * parts] for i in range(0, len(digits), 2 * parts)], pa.string()), pa.array(error)],
                names=[*rest, "code", "error"])

    schema = "".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}, " for c in rest)
    return vectors.mapInArrow(run, f"{schema}code string, error bigint")


def codebooks_sha256(codebooks: np.ndarray) -> str:
    """Digest of all components, by part, entry and position, as decimal integers between commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256): a row per row whose vector has finite components only.

    ``label_error`` is the error summed over the rows of the same label, NULL being a label of its own. Repeated rows give
    repeated rows, other columns are ignored, a table without such rows gives an empty one. The vectors' length (see ``integer_vectors``
    for mixed ones) must be a multiple of ``parts``. At most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits for a part")
    vectors, dims = integer_vectors(df, vector, scale, LIMIT, [key, label])
    if dims % parts:
        raise ValueError(f"{dims} components cannot be cut into {parts} parts")
    if not dims:
        schema = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in (key, label))
        return df.sparkSession.createDataFrame([], f"{schema}code string, error bigint, label_error bigint, codebooks_sha256 string")
    codebooks = train(vectors, dims, key, parts, entries, rounds)
    coded = written(encode(vectors, codebooks), "codes")
    sums = small_side(coded.groupBy(F.col(f"`{label}`").alias("_of")).agg(F.sum("error").alias("label_error")), "label-errors")
    out = coded.join(sums, F.col(f"`{label}`").eqNullSafe(F.col("_of"))).drop("_of")
    return out.withColumn("codebooks_sha256", F.lit(codebooks_sha256(codebooks)))
