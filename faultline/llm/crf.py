"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page becomes the sequence of its leaf blocks, each the text between two block borders with the tags and class words
above it. The field scores every block by its features and every pair of neighbours by their labels; Viterbi takes the
best labelling. It is trained on pages that say what their blocks are: every block lies either in an ``article`` or
``main`` element or in an element whose tag or class names page furniture. Each such page is seen twice, once without the
ancestors' features, so that the text features also learn to judge pages with plain markup.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_PAGES, FIT_BLOCKS = 400, 400   # bounds of the training sample: pages, and blocks of each
SIZE = 1 << 14
ROUNDS, RATE, RIDGE = 80, 0.15, 1e-4

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style head noscript template iframe svg object textarea select option canvas audio video math".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}}
CONTENT = frozenset(["article", "main"])
FURNITURE = frozenset("nav header footer aside form menu dialog button".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement banner promo sponsor sponsored cookie cookies consent notice popup modal sidebar menu nav "
    "navigation breadcrumb breadcrumbs share social related comment comments reply replies footer header subscribe newsletter login".split())

RAW = frozenset(["script", "style"])  # their content is text up to their end tag, or to the end of the page
IN_HEAD = frozenset("base link meta noscript script style template title".split())
FOREIGN = frozenset(["svg", "math"])  # a block of HTML ends them where they are not closed
BLOCKS = frozenset("address article aside blockquote body center dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section "
                   "table ul".split())
DEEPEST = 512  # open elements; deeper ones are taken as children of the last one, as browsers do

_MARKUP = re.compile(r"<(?=[!?/a-zA-Z])")
_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_TO_VALUE = re.compile(r"[^>=]*")
_SPACE = re.compile(r"\s*")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    above: tuple[tuple[str, tuple[str, ...]], ...]  # tag and class words of each open element, outermost first
    linked: int                                     # characters inside links


class _Markup:
    """Tags of a page in one scan from left to right. Quotes count where HTML has them count, at the start of an attribute's
    value; once a value's quote, or a tag, never ends, quotes are left out of account for the rest of the page, so that
    nothing is read twice. A tag that does not end is text."""

    def __init__(self, page: str):
        self.page, self.quotes, self.last = page, True, page.rfind(">")

    def tag_end(self, at: int) -> int:
        """Where the tag's ``>`` is, -1 where there is none."""
        page = self.page
        if at > self.last:
            return -1
        place = at
        while self.quotes:
            place = _TO_VALUE.match(page, place).end()
            if place >= len(page):
                self.quotes = False
            elif page[place] == ">":
                return place
            else:
                place = _SPACE.match(page, place + 1).end()
                if page[place:place + 1] in ('"', "'"):
                    place = page.find(page[place], place + 1) + 1
                    self.quotes = place > 0
        return page.find(">", at)

    def __iter__(self):
        """(start, end, name, body): text lies between the end of one and the start of the next. Comments and declarations
        have no name, end tags begin with a slash."""
        page, at = self.page, 0
        while (m := _MARKUP.search(page, at)) is not None:
            start = m.start()
            if page[start + 1] in "!?":
                ending = "-->" if page.startswith("<!--", start) else "]]>" if page.startswith("<![CDATA[", start) else ">"
                end = page.find(ending, start + 2)
                end = len(page) if end < 0 else end + len(ending)
                yield start, end, "", ""
            else:
                name = _NAME.match(page, start + 1)
                end = self.tag_end(name.end()) + 1 if name else 0
                if not end:
                    if start > self.last:
                        return
                    at = start + 1
                    continue
                tag = name[2].lower()
                body = page[name.end():end - 1]
                if not name[1] and tag in RAW:
                    stop = re.compile(rf"</{tag}\s*>", re.I).search(page, end)
                    yield start, stop.end() if stop else len(page), "", ""
                    end = stop.end() if stop else len(page)
                else:
                    yield start, end, name[1] + tag, body
            at = end


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks that hold text, in order, without those below an unseen element. Character references are decoded
    and white space is one space. Unclosed elements end where HTML ends them, the latest with the element around them."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    pending: list[str] = []
    linked = links = unseen = at = 0

    def close() -> None:
        nonlocal linked
        if pending:
            text = "" if unseen else " ".join(entities.unescape("".join(pending)).split())
            if text:
                out.append(Block(text, tuple(stack), linked))
            pending.clear()
        linked = 0

    def words(text: str) -> None:
        nonlocal linked
        if text:
            pending.append(text)
            if links:
                linked += len(text)

    def pop() -> str:
        nonlocal unseen
        tag = stack.pop()[0]
        unseen -= tag in UNSEEN
        return tag

    for start, end, tag, body in _Markup(page):
        words(page[at:start])
        at = end
        if tag == "br":
            pending.append(" ")
        elif tag.lstrip("/") in INLINE:
            if tag in ("a", "/a"):
                links = max(0, links + (1 if tag == "a" else -1))
        elif tag.startswith("/"):
            if any(t == tag[1:] for t, _ in stack):
                close()
                while pop() != tag[1:]:
                    pass
                links = 0
        elif tag:
            close()
            if stack and stack[-1][0] == "head" and tag not in IN_HEAD:  # its end tag may be left out
                pop()
            if tag in BLOCKS and unseen and not any(t == "foreignobject" for t, _ in stack):
                outer = next((i for i, (t, _) in enumerate(stack) if t in FOREIGN), len(stack))
                while len(stack) > outer:
                    pop()
            while stack and stack[-1][0] in CLOSED_BY.get(tag, {"p"}):  # a block also ends an open paragraph
                pop()
            alone = tag in VOID or (tag in FOREIGN and body.endswith("/"))
            if not alone and len(stack) < DEEPEST:
                names = " ".join(a or b or c for a, b, c in _NAMES.findall(body)) if body else ""
                stack.append((tag, tuple(dict.fromkeys(_WORDS.findall(names.lower())))))
                unseen += tag in UNSEEN
    words(page[at:])
    close()
    return out


def known_label(block: Block) -> int | None:
    """1 for text of a marked article, 0 for marked page furniture, None where the markup leaves it open."""
    tags = [t for t, _ in block.above]
    inside = max((i for i, t in enumerate(tags) if t in CONTENT), default=-1)
    other = max((i for i, (t, names) in enumerate(block.above) if t in FURNITURE or not FURNITURE_WORDS.isdisjoint(names)), default=-1)
    if inside >= 0 and other < 0:
        return 1
    if other >= 0 and (inside < 0 or other < inside or tags[other] != "header"):
        return 0
    return None


def _index(feature: str, _memo: dict[str, int] = {}) -> int:  # noqa: B006  a memo of the worker
    if feature not in _memo:
        if len(_memo) > 100_000:
            _memo.clear()
        _memo[feature] = crc32(feature.encode()) % SIZE
    return _memo[feature]


def block_features(blocks: list[Block]) -> tuple[list[list[int]], list[list[int]]]:
    """Per block: indices of its ancestors' features, and of its text's."""
    above, own = [], []
    for i, b in enumerate(blocks):
        names = [f"tag {t}" for t, _ in b.above] + [f"name {w}" for _, ws in b.above for w in ws]
        above.append([_index(x) for x in dict.fromkeys(names)])
        n = len(b.text)
        place = "first" if i == 0 else "last" if i == len(blocks) - 1 else min(3, 4 * i // len(blocks))
        own.append([_index(x) for x in (
            "any", f"parent {b.above[-1][0] if b.above else ''}", f"length {n.bit_length()}", f"links {min(4, 4 * b.linked // max(n, 1))}",
            f"ends {b.text[-1] in '.!?…:;\"'}", f"place {place}", f"spaces {min(6, b.text.count(' ').bit_length())}", f"sign {'©' in b.text or '|' in b.text}")])
    return above, own


@dataclass
class Field:
    weight: np.ndarray      # per feature, for label 1 against label 0
    step: np.ndarray        # 2 x 2, label to next label
    first: np.ndarray       # 2
    trained: bool = True

    def viterbi(self, score: list[float]) -> list[int]:
        """Best labels of a page's blocks, given each block's score for label 1."""
        (a, b), (c, d) = self.step.tolist()
        zero, one = float(self.first[0]), float(self.first[1]) + score[0]
        back = []
        for s in score[1:]:
            from_zero, from_one = (zero + a, one + c), (zero + b, one + d)
            back.append((from_zero[1] > from_zero[0], from_one[1] > from_one[0]))
            zero, one = max(from_zero), max(from_one) + s
        labels = [int(one > zero)]
        for came in reversed(back):
            labels.append(int(came[labels[-1]]))
        return labels[::-1]

    def main_text(self, page: str) -> str:
        blocks = leaf_blocks(page)
        if not blocks:
            return ""
        if not self.trained:
            return " ".join(b.text for b in blocks)
        above, own = block_features(blocks)
        score = [float(self.weight[x + y].sum()) for x, y in zip(above, own)]
        return " ".join(b.text for b, keep in zip(blocks, self.viterbi(score)) if keep)


def train(sequences: list[tuple[list[list[int]], list[int]]], rounds: int = ROUNDS) -> Field:
    """Field that maximises the conditional likelihood of the labels, by Adam on all sequences at once."""
    if not sequences:
        return Field(np.zeros(SIZE), np.zeros((2, 2)), np.zeros(2), trained=False)
    pages, longest = len(sequences), max(len(y) for _, y in sequences)
    label = np.zeros((longest, pages), np.int64)
    alive = np.zeros((longest, pages), bool)
    flat_, place = [], []
    for p, (features, y) in enumerate(sequences):
        label[:len(y), p], alive[:len(y), p] = y, True
        for t, f in enumerate(features):
            flat_ += f
            place += [t * pages + p] * len(f)
    flat_, place = np.array(flat_), np.array(place)
    both = alive[1:] & alive[:-1]
    seen_step = np.zeros((2, 2))
    np.add.at(seen_step, (label[:-1][both], label[1:][both]), 1)
    seen_first = np.bincount(label[0], minlength=2).astype(float)
    w = np.zeros(SIZE + 6)
    m, v = np.zeros_like(w), np.zeros_like(w)
    total = alive.sum()
    for k in range(1, rounds + 1):
        step, first = w[SIZE:SIZE + 4].reshape(2, 2), w[SIZE + 4:]
        score = np.zeros((longest, pages, 2))
        score[..., 1] = np.bincount(place, w[flat_], longest * pages).reshape(longest, pages)
        ahead = np.empty_like(score)
        ahead[0] = first + score[0]
        for t in range(1, longest):
            moved = np.logaddexp(ahead[t - 1][:, :1] + step[0], ahead[t - 1][:, 1:] + step[1]) + score[t]
            ahead[t] = np.where(alive[t][:, None], moved, ahead[t - 1])
        norm = np.logaddexp(ahead[-1][:, 0], ahead[-1][:, 1])
        behind, chance, moves = np.zeros((pages, 2)), np.empty_like(score), np.zeros((2, 2))
        for t in reversed(range(longest)):
            chance[t] = np.exp(ahead[t] + behind - norm[:, None]) * alive[t][:, None]
            if t:
                on = alive[t][:, None]
                into = score[t] + behind
                joint = np.exp(ahead[t - 1][:, :, None] + step + into[:, None, :] - norm[:, None, None]) * on[..., None]
                moves += joint.sum(0)
                behind = np.where(on, np.logaddexp(step[:, 0] + into[:, :1], step[:, 1] + into[:, 1:]), behind)
        wrong = ((label == 1) & alive) - chance[..., 1]
        gradient = np.concatenate([np.bincount(flat_, wrong.ravel()[place], SIZE), (seen_step - moves).ravel(), seen_first - chance[0].sum(0)]) / total - RIDGE * w
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        w = w + RATE * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return Field(w[:SIZE], w[SIZE:SIZE + 4].reshape(2, 2), w[SIZE + 4:])


def labelled_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """(_h, above, own, labels): feature sequences of the pages all of whose blocks have a known label, both labels among
    them, and at most FIT_BLOCKS blocks; ``_h`` orders them by a hash of the page."""
    def run(batches):
        for batch in batches:
            rows = []
            for h, page in zip(batch.column("_h").to_pylist(), batch.column("html").to_pylist()):
                blocks = leaf_blocks(page)
                labels = [known_label(b) for b in blocks] if len(blocks) <= FIT_BLOCKS else []
                if set(labels) == {0, 1}:
                    above, own = block_features(blocks)
                    rows.append({"_h": h, "above": above, "own": own, "labels": labels})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    nested = pa.list_(pa.list_(pa.int32()))
    schema = pa.schema([("_h", pa.int64()), ("above", nested), ("own", nested), ("labels", pa.list_(pa.int32()))])
    source = pages.filter(F.col(f"`{html}`").isNotNull()).select(F.xxhash64(F.col(f"`{html}`")).alias("_h"), F.col(f"`{html}`").alias("html"))
    return source.mapInArrow(run, "_h bigint, above array<array<int>>, own array<array<int>>, labels array<int>")


def fit(pages: DataFrame, html: str = "html", fit_pages: int = FIT_PAGES) -> Field:
    """Field from at most ``fit_pages`` labelled pages, those with the smallest hashes. Without a labelled page nothing
    is learnt, and every block counts as main text."""
    sequences = []
    # hashes spread evenly: of many pages, parse a share that holds the sample many times over; of few, all
    n = pages.count()
    share = min(1.0, 16 * fit_pages / max(n, 1))
    tried = pages.filter(F.xxhash64(F.col(f"`{html}`")) < int(-2**63 + share * (2**64 - 1)) if share < 1 else F.lit(True))
    rows = labelled_pages(tried, html).orderBy("_h").limit(fit_pages).collect()
    if len(rows) < fit_pages and share < 1:
        rows = labelled_pages(pages, html).orderBy("_h").limit(fit_pages).collect()
    for r in rows:
        sequences.append(([a + b for a, b in zip(r["above"], r["own"])], r["labels"]))
        sequences.append((r["own"], r["labels"]))
    return train(sequences)


def extract(pages: DataFrame, field: Field, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text): the blocks labelled main text, in page order, joined by one space; empty if there are none.

    A NULL page is empty. Unclosed elements end where HTML ends them, truncated pages keep what they have; comments, scripts,
    styles and the head are no blocks. Repeated rows give repeated rows; other columns are ignored. Whole pages are read.
    """
    kinds = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in (("key", key), ("url", url)))

    def run(batches):
        for batch in batches:
            texts = [field.main_text(p) if p else "" for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], names=["key", "url", "text"])

    source = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return source.mapInArrow(run, f"{kinds}, text string").withColumnsRenamed({"key": key, "url": url})
