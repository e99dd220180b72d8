"""Texts cut at plain spaces, with one computed value for each distinct chunk.

Byte-level tokenisers start a new piece at any space that has a non-space before and behind it, so
a chunk that begins with such a space is encoded the same wherever it stands; so is a sentence mark
behind letters. Chunks recur, so a worker computes each distinct one once and looks the others up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain
from typing import Any

#: Distinct chunks that a worker remembers; beyond it, it forgets those that the last texts did not have, which changes no result.
REMEMBERED = 1_200_000
#: Marks that are encoded apart from the letters before them.
MARKS = frozenset(".,!?;:")


def letters(word: str) -> bool:
    """Whether all are letters of scripts up to Cyrillic, which every version of Unicode calls letters."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0530")


class _Slots(dict):
    """Numbers of keys, given out as they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number

    def __init__(self, *items: Any):
        super().__init__(*items)
        self.new: list[str] = []


class ChunkMemory:
    """Value of each chunk, computed in bulk by `compute`; values of neighbours are put together by +.

    `words`, if given, computes the values of chunks that are a space and letters, from the letters.
    """

    def __init__(self, compute: Callable[[Sequence[str]], Sequence[Any]], limit: int = REMEMBERED, words: Callable[[Sequence[str]], Sequence[Any]] | None = None):
        self.compute, self.limit = compute, limit
        self.words = words or (lambda letters: compute([" " + w for w in letters]))
        #: chunks with a space before them (left out of the key), and whole or first chunks
        self.inner, self.inner_value = _Slots(), []
        self.other, self.other_value = _Slots(), []

    def values(self, texts: Sequence[str]) -> list[list[Any]]:
        """For each text the values of its chunks, in order; an empty text has none."""
        cut = [t.split(" ") if t else [] for t in texts]
        number = self.inner.__getitem__
        rows = [list(map(number, parts[1:])) for parts in cut]
        self._fill_inner()
        value = self.inner_value
        out: list[list[Any]] = [[value[k] for k in row] for row in rows]
        heads = [[parts[0]] if parts else [] for parts in cut]
        for k, parts in enumerate(cut):
            if parts and (None in out[k] or not parts[0] or parts[0][-1].isspace()):
                heads[k], out[k] = merged(parts), []
        first = [[self.other[p] for p in head] for head in heads]
        self._fill_other()
        head_value = self.other_value
        out = [[head_value[k] for k in head] + row for head, row in zip(first, out, strict=True)]
        self._forget(rows)
        return out

    def _fill_other(self) -> None:
        if self.other.new:
            self.other_value += self.compute(self.other.new)
            self.other.new = []

    def _fill_inner(self) -> None:
        new, self.inner.new = self.inner.new, []
        words, marked, whole = [], [], []
        for p in new:
            if letters(p):
                words.append(p)
            elif p[-1:] in MARKS and letters(p[:-1]):
                marked.append(p)
                self.inner[p[:-1]], self.other[p[-1]]
            elif p and not p[0].isspace() and not p[-1].isspace():
                whole.append(p)
        words += self.inner.new
        self.inner.new = []
        self._fill_other()
        value, number = self.inner_value, self.inner
        value += [None] * (len(number) - len(value))
        for p, v in zip(words, self.words(words), strict=True):
            value[number[p]] = v
        for p, v in zip(whole, self.compute([" " + p for p in whole]), strict=True):
            value[number[p]] = v
        for p in marked:
            value[number[p]] = value[number[p[:-1]]] + self.other_value[self.other[p[-1]]]

    def _forget(self, rows: list[list[int]]) -> None:
        if len(self.inner) > self.limit:
            kept = set(chain.from_iterable(rows))
            keys = [k for k, n in self.inner.items() if n in kept]
            self.inner_value = [self.inner_value[self.inner[k]] for k in keys]
            self.inner = _Slots(zip(keys, range(len(keys)), strict=True))
        if len(self.other) > self.limit:
            self.other, self.other_value = _Slots(), []


def merged(parts: list[str]) -> list[str]:
    """Chunks of a text whose spaces do not all part two non-spaces: such spaces stay inside a chunk."""
    chunks, current = [], parts[0]
    for before, part in zip(parts, parts[1:], strict=False):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            chunks.append(current)
            current = " " + part
        else:
            current += " " + part
    chunks.append(current)
    return chunks
