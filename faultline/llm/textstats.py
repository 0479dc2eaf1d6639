"""Counts of whole texts, taken once and shared by the rule forest and the quality classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.textbytes import SPACES, Rolling, chunks, owners, per_document, shingles, spans, table, windows_inside

SYMBOLS = table(b"[#*$%&|<>]".strip(b"[]"))
UPPER, DIGIT = table(range(0x41, 0x5B)), table(range(0x30, 0x3A))
BARS, SHOUTS, STOPS, COMMAS = table(b"|"), table(b"!?"), table(b".:;"), table(b",")

COUNTS = ["n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words",
          "n_upper", "n_digits", "n_bars", "n_shouts", "n_stops", "n_commas", "n_long_words", "sum_sq_word"]


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """One array per name of COUNTS, a value per document."""
    lead = (data & 0xC0) != 0x80  # the first byte of a character
    inside = ~SPACES[data]
    starts, ends = spans(inside, offsets)
    doc, bounds = owners(starts, offsets)
    n = len(offsets) - 1
    hashes = Rolling(data)
    words = hashes.of(starts, ends)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    size = chars[ends] - chars[starts]

    order = np.lexsort((words, doc))
    same = np.zeros(len(words), bool)
    same[1:] = (words[order][1:] == words[order][:-1]) & (doc[order][1:] == doc[order][:-1])

    inner = windows_inside(doc, 3)
    windows, wdoc = shingles(words, 3)[inner], doc[:len(inner)][inner]
    at = np.lexsort((windows, wdoc))
    twin = (windows[at][1:] == windows[at][:-1]) & (wdoc[at][1:] == wdoc[at][:-1])
    again = np.zeros(len(at), bool)
    again[1:] |= twin
    again[:-1] |= twin
    covered = np.zeros(len(words) + 2, bool)
    first = np.flatnonzero(inner)[at[again]]
    for k in range(3):
        covered[first + k] = True

    line_starts, line_ends = spans(data != 0x0A, offsets)
    held = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=held[1:])
    with_word = held[line_ends] > held[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    ldoc, _ = owners(line_starts, offsets)
    lines = hashes.of(line_starts, line_ends)
    by = np.lexsort((lines, ldoc))
    repeat = (lines[by][1:] == lines[by][:-1]) & (ldoc[by][1:] == ldoc[by][:-1])

    def bytes_in(kind: np.ndarray) -> np.ndarray:
        return per_document(kind[data], offsets)

    return {
        "n_chars": per_document(lead, offsets), "n_words": np.diff(bounds),
        "word_chars": per_document(lead & inside, offsets), "n_symbols": bytes_in(SYMBOLS),
        "n_lines": np.bincount(ldoc, minlength=n), "n_dup_lines": np.bincount(ldoc[by][1:][repeat], minlength=n),
        "n_repeat_words": per_document(covered[:len(words)], bounds), "n_distinct_words": np.diff(bounds) - np.bincount(doc[order][same], minlength=n),
        "n_upper": bytes_in(UPPER), "n_digits": bytes_in(DIGIT), "n_bars": bytes_in(BARS), "n_shouts": bytes_in(SHOUTS),
        "n_stops": bytes_in(STOPS), "n_commas": bytes_in(COMMAS),
        "n_long_words": per_document(size > 12, bounds), "sum_sq_word": per_document(size * size, bounds),
    }


def text_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the COUNTS of each row's whole text, in one pass without a shuffle.

    A NULL text counts as empty: all figures are 0. Repeated rows give repeated rows; other columns are not read.
    """
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("binary").alias("text"))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for rows, data, offsets in chunks(batches, "text"):
            got = counts(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column("key"), *[pa.array(got[c].astype(np.int64)) for c in COUNTS]], names=[key, *COUNTS])

    return source.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def features(counted: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that do not depend on a text's length, on scales where ordinary texts are close to normal; a row per document."""
    c = {k: np.asarray(v, float) for k, v in counted.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars"], 1), np.maximum(c["n_lines"], 1)
    mean = c["word_chars"] / words
    return np.column_stack([
        np.log1p(c["n_words"]), np.log1p(mean), np.sqrt(np.maximum(c["sum_sq_word"] / words - mean**2, 0)),
        np.sqrt(c["n_symbols"] / words), np.sqrt(c["n_dup_lines"] / lines), np.sqrt(c["n_repeat_words"] / words),
        np.log((c["n_distinct_words"] + 1) / (words + 1)), np.sqrt(c["n_upper"] / chars), np.sqrt(c["n_digits"] / chars),
        np.sqrt(c["n_bars"] / words), np.sqrt(c["n_shouts"] / words), np.sqrt(c["n_stops"] / words),
        np.sqrt(c["n_commas"] / words), np.sqrt(c["n_long_words"] / words), np.log1p(c["n_words"] / lines),
    ])


FEATURES = ["log_words", "log_word_length", "word_length_spread", "symbols", "dup_lines", "repeats", "log_distinct", "upper",
            "digits", "bars", "shouts", "stops", "commas", "long_words", "log_line_words"]
