"""A bounded table of results, and letter classes by the standard library's Unicode tables."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import cache
from itertools import islice


class Memo(dict):
    """``memo[key]`` is ``make(key)``, kept for keys of up to ``longest`` characters. Two generations
    of up to ``most`` entries: when the new one is full it becomes the old one, and what is used
    again moves over. So frequent keys stay and memory is bounded."""

    def __init__(self, make: Callable, most: int = 120_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.old = make, most, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def many(self, keys: list, make: Callable[[list], list]) -> list:
        """The values of distinct ``keys``; ``make`` makes those that aren't kept, all at once."""
        out = list(map(self.get, keys))
        if None not in out:
            return out
        missing = [i for i, value in enumerate(out) if value is None]
        asked = [keys[i] for i in missing]
        found = list(map(self.old.get, asked))
        made = iter(make([key for key, value in zip(asked, found, strict=True) if value is None]))
        found = [next(made) if value is None else value for value in found]
        for i, value in zip(missing, found, strict=True):
            out[i] = value
        if len(self) + len(asked) > self.most:
            self.old = dict(self)
            self.clear()
        self.update(islice(((key, value) for key, value in zip(asked, found, strict=True) if len(key) <= self.longest), self.most))
        return out


def lowered(text: str) -> str:
    """NFC and lower case by character (a sigma at a word's end is no special case)."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()


@cache
def char_class(major: str) -> str:
    """The characters whose general category begins with ``major``, as ranges for a pattern."""
    spans: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == major:
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: printable Latin-1 stands for
    itself, the others take the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]
