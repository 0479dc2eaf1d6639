"""Texts as sequences of segments that a byte-level BPE pattern never matches across."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

_MORE_SPACE = re.compile(r" (?:\s|\Z)")


def cut(text: str) -> list[str]:
    """Cuts a text before each space that a character other than white space follows; the spaces at the cuts are left out.

    No match of the pattern crosses such a cut, and a segment is split alike wherever it stands: with a space before it, or
    without one at the text's start.
    """
    parts = text.split(" ")
    if _MORE_SPACE.search(text) is None:
        return parts
    joined = [parts[0]]
    for p in parts[1:]:
        if not p or p[0].isspace():
            joined[-1] += " " + p
        else:
            joined.append(p)
    return joined


class Segments:
    """Distinct segments, numbered as they come."""

    def __init__(self):
        self.numbers: dict[str | bytes, int] = {}

    def of(self, text: str) -> list[int]:
        first, *rest = cut(text)
        numbers = self.numbers
        head = numbers.setdefault(first.encode(), len(numbers))  # the only one without its space is known by its bytes
        for p in set(rest).difference(numbers):
            numbers[p] = len(numbers)
        return [head, *map(numbers.__getitem__, rest)]

    def texts(self) -> Iterator[str]:
        """The segments in the order of their numbers."""
        return (s.decode() if isinstance(s, bytes) else " " + s for s in self.numbers)


def kept(name: str, make: Callable[[], object]) -> object:
    """An object for the life of a Python worker, which serves one task after the other."""
    held = sys.modules.setdefault("_faultline_kept", types.ModuleType("_faultline_kept")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]
