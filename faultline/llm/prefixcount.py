"""Exact token counts of every prefix of a text, by prefix dynamic programming.

The last token of a prefix leads back to a shorter prefix: if the encoding of the first j bytes of a word ends in token u, and
token t stands for bytes j to i, then the encoding of the first i bytes is the one of the first j followed by t exactly when u
and t stay apart when they are merged side by side. One token fits at each place, so one pass over a word's tokens (all of
them, at all places, as an automaton finds them) gives the count at each of its places.

Words are the library's own; a text that ends inside a word, a run of white space, a contraction or a special string is split
as that text is, not as the whole one. Counts are stored for every character, so questions on truncation and budgets are
answered from them, without encoding again: ``tokens_at`` by column functions, ``with_kept_chars`` by a search.
"""

from __future__ import annotations

import gc
import json
import re
import string
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultline.llm.segments import Segments, kept

BLOCK_CHARS = 1 << 20      # text worked on at once, or one document
OUT_BYTES = 2 << 20        # counts in one batch that is handed on
REMEMBERED = 300_000       # segments of text that a worker keeps before it starts anew, about 250 bytes each
WORDS = 400_000            # words that it keeps beyond that, about 250 bytes each
PAIRS = 200_000            # answers on pairs of tokens that a worker keeps
NEVER = 1 << 40
# The pattern of byte-level BPE on ASCII text, and the letters of bytes: printable ones stand for themselves, the
# others for 0x100 and on, in order.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
ASCII_SPELLED = re.compile(ASCII_WORDS.pattern.replace(" ", "\u0120"))
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
BYTES = {chr(LETTERS.get(b, b)): b for b in range(256)}


class Merges:
    """The ranked merges of a byte-level BPE: which tokens exist, and which stay apart side by side."""

    def __init__(self, model: dict):
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        letters = [t for t in model["vocab"] if len(t) == 1]
        if model.get("type") != "BPE" or odd or len(letters) != 256:
            raise ValueError(f"not a plain byte-level BPE: {odd or model.get('type')}")
        number = {t: i for i, t in enumerate(letters)}  # then merges in the order of their ranks, so a larger number is made later
        self._partners: dict[int, dict[int, int]] = {}
        self._parts: list[tuple[int, int]] = [(-1, -1)] * 256
        self._forget()
        self.tokens: list[tuple[str, int]] = [(t, i) for t, i in number.items()]
        sound = [True] * 256
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a not in number or b not in number or a + b in number:
                raise ValueError(f"merge {rank} has unknown parts, or makes a token that another merge makes")
            x, y, t = number[a], number[b], 256 + rank
            number[a + b] = t
            sound.append(sound[x] and sound[y] and self._no_merge(x, y, t))  # else merges of its bytes never lead to it
            self._partners.setdefault(x, {})[y] = t
            self._parts.append((x, y))
            if sound[t]:
                self.tokens.append((a + b, t))

    def _no_merge(self, a: int, b: int, before: int = NEVER) -> bool:
        """Whether no merge earlier than ``before`` joins the end of a and the beginning of b. Looked at backwards in time: the one
        of both pieces at the border that was made later is undone, and each pair that stood there must not have had a merge
        earlier than what happened to it instead. Equal merges are made from left to right."""
        until_a = until_b = before
        while True:
            row = self._partners.get(a)
            if row is not None:
                made = row.get(b, NEVER)
                if made < until_a and made <= until_b and made < before:
                    return False
            if a >= b:
                if a < 256:
                    return True
                until_a, a = a, self._parts[a][1]
            else:
                if b < 256:
                    return True
                until_b, b = b, self._parts[b][0]

    def apart(self, u: int, t: int) -> bool:
        """Whether u and t stay as they are when their bytes are merged side by side; ``after`` and ``never`` keep the answers."""
        if self._answers >= PAIRS:
            self._forget()
        self._answers += 1
        answer = self._no_merge(u, t)
        (self.after if answer else self.never)[u].add(t)
        return answer

    def _forget(self) -> None:
        self.after, self.never, self._answers = defaultdict(set), defaultdict(set), 0


class Counter:
    """Counts of the prefixes of words, pieces of text and documents for one tokenizers file, given as its JSON text."""

    def __init__(self, tokenizer: str):
        spec = json.loads(tokenizer)
        split, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        if spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("only files that split bytes by the library's own pattern are counted")
        if len(added) > 1 or any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in added):
            raise ValueError("only one special string, taken as it stands, is counted")
        self.special = added[0]["content"] if added else None
        self._split = Tokenizer.from_str(tokenizer).pre_tokenizer.pre_tokenize_str
        self._merges = Merges(spec["model"])
        self._automaton = ahocorasick.Automaton()
        for token, number in self._merges.tokens:
            self._automaton.add_word(token, (number, len(token)))
        self._automaton.make_automaton()
        self._within = {self._split(chr(0x100 + i))[0][0][-1] for i in range(64)}  # letters of the bytes that never begin a character
        self._space = self._split(" ")[0][0]
        self._spaces: dict[str, bool] = {}
        self._letters, self._others = set(string.ascii_letters), set()  # characters, as the library has told
        self._spelling = {b: self._split(chr(b))[0][0] for b in range(128)}
        self._words: dict[str, bytes | list[int]] = {}
        self._counted_last: tuple[str, list[int], list[int]] = "", [], []  # the word counted last, its tokens and counts
        self._forget()

    def _forget(self) -> None:
        """Starts anew: segments of text and their words, numbered as they come. Of each segment: where its counts begin in
        the pool, how many there are, the last one, and by how much the count rises at the space that begins the segment after it."""
        self._segments = Segments()
        if len(self._words) > WORDS:
            self._words = {}
        self._pool = np.zeros(0, np.int32)
        self._begins, self._sizes, self._totals, self._steps = (np.zeros(0, np.int64) for _ in range(4))

    def word(self, word: str) -> list[int]:
        """Counts at the end of each character of a word that is spelled in the file's letters."""
        same, before = 0, self._counted_last
        for a, b in zip(word, before[0]):  # what is known of the prefix that the word shares with the one before it
            if a != b:
                break
            same += 1
        rest = [0] * (len(word) - same)
        last, count = before[1][:same] + rest, before[2][:same] + rest + [0]  # by the place of the last letter; a count at place -1 is that of nothing
        merges = self._merges
        after, never, apart = merges.after, merges.never, merges.apart
        for at, (token, size) in self._automaton.iter(word):
            if count[at]:
                continue
            before = at - size
            if before >= 0:
                u = last[before]
                if token not in after[u] and (token in never[u] or not apart(u, token)):
                    continue
            last[at], count[at] = token, count[before] + 1
        del count[-1]
        self._counted_last = word, last, count
        if not word.isascii():
            within = self._within
            count = [c for c, following in zip(count, word[1:] + " ") if following not in within]
        if word in ("'re", "'ve", "'ll"):
            count = [count[0], 2, *count[2:]]  # a text that ends here ends in two words
        return count

    def _is_space(self, word: str) -> bool:
        """Whether a word is white space, which the library tells: white space runs on over a space."""
        if word[-1] < "\x7f":
            return False
        end = len(word) - 1
        while word[end] in self._within:
            end -= 1
        last = word[end:]
        if last not in self._spaces:
            self._spaces[last] = last == self._space or len(self._split(_decode(last) + " ")) == 1
        return self._spaces[last]

    def _first(self, word: str) -> str:
        end = 1
        while end < len(word) and word[end] in self._within:
            end += 1
        return word[:end]

    def _count(self, words: Iterable[str]) -> None:
        """Counts of words that are new, in an order in which neighbours share prefixes."""
        for word in sorted(set(words).difference(self._words)):
            counts = self.word(word)
            self._words[word] = bytes(counts) if len(counts) < 256 else counts

    def _split_up(self, text: str) -> list[str]:
        """The library's words of a segment, in its letters. Plain words and ASCII are split here, as the library would."""
        if text.isascii():
            if text.isprintable():  # only its spaces are spelled otherwise
                text = text.replace(" ", self._space)
                return [text] if text[1:].isalpha() else ASCII_SPELLED.findall(text)
            return [w.translate(self._spelling) for w in ASCII_WORDS.findall(text)]
        chars = set(text[1:] if text[0] == " " else text)
        if not chars <= self._letters:
            for c in chars - self._letters - self._others:
                (self._letters if len(self._split(f"a{c}a")) == 1 else self._others).add(c)
            if not chars <= self._letters:
                return [w for w, _ in self._split(text)]
        spelled = text.encode().decode("latin-1").translate(LETTERS)
        return [spelled]

    def _learn(self) -> None:
        """Counts of the segments that are new: a segment's words one after the other. A word's counts go on from those of the
        words before it, but for white space: a text that ends in the first character behind it has one longer run of it."""
        spans = list(islice(self._segments.numbers, len(self._begins), None))
        if not spans:
            return
        counts_of, is_space, split, space = self._words, self._is_space, self._split_up, self._space
        # a space and letters are one word
        words = [[space + s] if isinstance(s, str) and s.isascii() and s.isalpha() else split(" " + s if isinstance(s, str) else s.decode()) for s in spans]
        self._count(chain.from_iterable(words))
        pool, sizes, steps, large = bytearray(), [], [], []
        for span, own_words in zip(spans, words):
            own, step = counts_of[own_words[0]] if own_words else [], 1
            if len(own_words) > 1 or not span.isalpha():
                own = list(own)
                base = own[-1] if own else 0
                before = own_words[0] if own_words and is_space(own_words[0]) else None
                for word in own_words[1:]:
                    counts, total = counts_of[word], base + counts_of[word][-1]
                    if before is not None and is_space(first := self._first(word)):
                        own.append(base - self.word(before)[-1] + self.word(before + first)[-1])
                        counts = counts[1:]
                    own += [base + c for c in counts]
                    base, before = total, word if is_space(word) else None
                if before is not None:
                    step = self.word(before + space)[-1] - self.word(before)[-1]
            if isinstance(own, bytes):
                pool += own
            elif max(own, default=0) < 256:
                pool += bytes(own)
            else:
                large.append((len(pool), own))
                pool += bytes(len(own))
            sizes.append(len(own))
            steps.append(step)
        sizes = np.array(sizes, np.int64)
        new = np.frombuffer(pool, np.uint8).astype(np.int32)
        for begin, own in large:
            new[begin:begin + len(own)] = own
        ends = np.cumsum(sizes)
        self._begins = np.r_[self._begins, len(self._pool) + ends - sizes]
        self._totals = np.r_[self._totals, np.where(sizes > 0, new[np.maximum(ends, 1) - 1] if len(new) else 0, 0)]
        self._sizes, self._steps = np.r_[self._sizes, sizes], np.r_[self._steps, steps]
        self._pool = np.r_[self._pool, new]

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """A text cut behind each special string: ordinary text, and whether the special string's last character follows. Of
        that string all other characters are ordinary to a text that ends among them."""
        if self.special is None or self.special not in text:
            return [(text, False)]
        *parts, last = text.split(self.special)
        return [*((p + self.special[:-1], True) for p in parts), (last, False)]

    def documents(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Counts at every character of each text."""
        if len(self._segments.numbers) > REMEMBERED:
            self._forget()
        of = self._segments.of
        cut = [[(of(p) if p else [], len(p), special) for p, special in self.pieces(text)] for text in texts]
        self._learn()
        for own in cut:
            yield self._joined(own)

    def _joined(self, own: list[tuple[list[int], int, bool]]) -> np.ndarray:
        parts, base = [], 0
        for numbers, n, special in own:
            if numbers:
                numbers = np.array(numbers)
                total, size = self._totals[numbers], self._sizes[numbers]
                running = np.cumsum(total) - total
                starts = np.cumsum(size) - size
                out = self._pool[np.arange(size.sum()) + np.repeat(self._begins[numbers] - starts, size)] + np.repeat(running + base, size)
                out[starts[1:]] = running[1:] + self._steps[numbers[:-1]] + base
                parts.append(out)
            if special:
                at = n - len(self.special) + 1  # characters before the special string
                base = (int(parts[-1][at - 1]) if at else base) + 1
                parts.append(np.array([base]))
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _decode(word: str) -> str:
    """Text of a word in the file's letters."""
    return bytes(BYTES[c] for c in word).decode()


def _count(tokenizer: str):
    names = ["key", "n_bytes", "n_chars", "n_tokens", "width", "counts"]

    def close(keys: list, texts: list[str], counter: Counter):
        held, size, at = [], 0, 0

        def batch(upto: int) -> pa.RecordBatch:
            own = texts[at:upto]
            width = [4 if c.max(initial=0) > 0xFFFF else 2 for c in held]
            return pa.RecordBatch.from_arrays([
                pa.concat_arrays(keys).slice(at, upto - at), pa.array([len(t.encode()) for t in own], pa.int64()), pa.array([len(c) for c in held], pa.int64()),
                pa.array([int(c[-1]) if len(c) else 0 for c in held], pa.int64()), pa.array(width, pa.int32()),
                pa.array([c.astype(f">u{w}").tobytes() for c, w in zip(held, width)], pa.binary())], names=names)

        for i, counts in enumerate(counter.documents(texts)):
            held.append(counts)
            size += 2 * len(counts)
            if size >= OUT_BYTES or i == len(texts) - 1:
                yield batch(i + 1)
                held, size, at = [], 0, i + 1

    def run(batches):
        before = gc.get_threshold()
        gc.set_threshold(500_000, *before[1:])  # millions of small objects and no cycles: collections would mostly look through them
        counter = kept(f"counter-{hash(tokenizer)}", lambda: Counter(tokenizer))
        keys, texts, size = [], [], 0
        for rows in batches:
            start = 0
            for i, text in enumerate(rows.column("text")):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BLOCK_CHARS:
                    yield from close([*keys, rows.column("key").slice(start, i + 1 - start)], texts, counter)
                    keys, texts, size, start = [], [], 0, i + 1
            if start < rows.num_rows:
                keys.append(rows.column("key").slice(start))
        if texts:
            yield from close(keys, texts, counter)
        gc.set_threshold(*before)

    return run


def prefix_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, width, counts): a row per row of ``docs``.

    ``tokenizer`` is the JSON text of a byte-level BPE file of the tokenizers library. ``counts`` holds, for every character,
    how many tokens the text up to and with it has, as big-endian integers of ``width`` bytes (2, or 4 beyond 65,535 tokens).
    A special string counts as one token, as the library has it by default; a prefix that ends inside it is ordinary text. A
    count can be smaller than the one before it. NULL is an empty text, which has no counts and 0 tokens. Repeated rows give
    repeated rows; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = source.mapInArrow(_count(tokenizer), f"key {kind}, n_bytes bigint, n_chars bigint, n_tokens bigint, width int, counts binary")
    return counted.withColumnRenamed("key", key)


def tokens_at(chars: Column | int) -> Column:
    """Tokens of a counted row's first ``chars`` characters: 0 for none, all of them beyond the text's end."""
    chars = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.col("n_chars"))
    place = ((chars - 1) * F.col("width") + 1).cast("int")
    return F.when(chars <= 0, F.lit(0)).otherwise(F.conv(F.hex(F.substring("counts", place, F.col("width"))), 16, 10)).cast("bigint")


def with_kept_chars(counted: DataFrame, budget: int, name: str = "kept_chars") -> DataFrame:
    """Adds ``name``, the characters of the longest prefix of at most ``budget`` tokens, and takes ``counts`` and ``width`` off."""
    rest = [c for c in counted.columns if c not in ("counts", "width")]

    def run(batches):
        for rows in batches:
            longest = []
            for width, counts in zip(rows.column("width").to_pylist(), rows.column("counts")):
                fits = np.flatnonzero(np.frombuffer(counts.as_py(), f">u{width}") <= budget)
                longest.append(int(fits[-1]) + 1 if len(fits) else 0)
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in rest], pa.array(longest, pa.int64())], names=[*rest, name])

    schema = ", ".join(f"`{c}` {counted.schema[c].dataType.simpleString()}" for c in rest)
    return counted.mapInArrow(run, f"{schema}, `{name}` bigint")
