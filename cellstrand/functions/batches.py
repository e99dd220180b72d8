"""Alignments of a batch as arrays of bytes: aligned columns from CIGARs, bases from MD, and MD written.

All columns of all records of a batch are one array, so numpy goes over a batch and not over a record. The plain
functions beside their callers tell the same record by record; batches with letters beyond ASCII go to these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_OPS = re.compile(r"(\d+)([MIDNSHP=X])")
#: Columns that are held at once, so that a batch of long reads does not fill a worker.
AT_ONCE = 1 << 22
UPPER = np.frombuffer(bytes(range(256)).upper(), dtype=np.uint8)
_DIGIT, _LETTER = (np.array([test(chr(b)) for b in range(128)] + [False] * 128) for test in (str.isdigit, str.isalpha))


class Texts:
    """The bytes of a batch's texts: text k is data[starts[k] : starts[k] + sizes[k]]; null has none."""

    def __init__(self, column: pa.Array):
        own = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
        _, offsets, data = own.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[own.offset : own.offset + len(own) + 1] if len(own) else np.zeros(1, dtype=np.int64)
        # a byte more, so that places without a base can be looked at
        self.data = np.append(np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), np.uint8(0))
        self.known = ~np.asarray(own.is_null())
        self.starts, self.sizes = at[:-1], np.where(self.known, np.diff(at), 0)
        self.ascii = not len(own) or int(self.data[at[0] : at[-1]].max(initial=0)) < 128


@lru_cache(maxsize=4096)
def columns_of(cigar: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of a CIGAR's M, =, X and D columns: the read's base (-1 in deletions), the place behind pos, 2 for a deletion's first column and 1 for its others; and how many bases are inserted."""
    query, place, gone = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int8)]
    q = r = inserted = 0
    for number, op in _OPS.findall(cigar):
        n = int(number)
        if op in "M=XD":
            query.append(np.full(n, -1) if op == "D" else np.arange(q, q + n))
            place.append(np.arange(r, r + n))
            gone.append(np.r_[2, np.ones(n - 1)][:n].astype(np.int8) if op == "D" and n else np.zeros(n, dtype=np.int8))
        q += n * (op in "MIS=X")
        r += n * (op in "MDN=X")
        inserted += n * (op == "I")
    return np.concatenate(query), np.concatenate(place), np.concatenate(gone), inserted


class Columns:
    """The columns of a batch's records: those of record k are as many as sizes[k]."""

    def __init__(self, cigars: pa.Array, deletions: bool):
        coded = cigars.dictionary_encode()
        known = ~np.asarray(cigars.is_null())
        self.code = np.where(known, coded.indices.fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
        found = [columns_of(c) for c in coded.dictionary.to_pylist()] or [columns_of("")]
        if not deletions:
            found = [(q[q >= 0], p[q >= 0], g[q >= 0], n) for q, p, g, n in found]
        own = np.array([len(q) for q, *_ in found])
        self.begin = np.cumsum(own) - own
        self.query, self.place, self.gone = (np.concatenate([f[k] for f in found]) for k in range(3))
        self.sizes = np.where(known, own[self.code], 0)
        #: Bases that a read must have, and bases inserted.
        self.needed = np.array([int(q.max(initial=-1)) + 1 for q, *_ in found])[self.code]
        self.inserted = np.array([f[3] for f in found])[self.code]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each column of some records: its record's number in rows, its number in the record, and its index in query, place and gone."""
        n = self.sizes[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        inside = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
        return owner, inside, self.begin[self.code[rows]][owner] + inside


def parts(rows: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """rows cut so that the sizes of each part sum up to about AT_ONCE; one part at least."""
    total = np.cumsum(sizes[rows]) // AT_ONCE
    return iter(np.split(rows, np.flatnonzero(np.diff(total)) + 1))


def strings(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Texts that stand one after the other, as an array."""
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())


def put_back(values: pa.Array, known: np.ndarray) -> pa.Array:
    """values at the places that are known, null at the others."""
    return values.take(pa.array(np.where(known, np.cumsum(known) - 1, 0), pa.int64(), mask=~known))


def md_texts(owner: np.ndarray, count: int, same: np.ndarray, gone: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of MD of `count` records and their sizes, from columns in order: their record, whether they match, deletions (2 first, 1 others), reference bases."""
    events = np.flatnonzero(~same)
    of = owner[events]
    each = np.bincount(of, minlength=count)
    last = np.cumsum(each) + np.arange(count)
    here = np.arange(len(events)) + of
    passed = np.r_[0, np.cumsum(same)]
    size = len(events) + count
    before, letter, caret, numbered = (np.zeros(size, dtype=k) for k in (np.int64, np.uint8, bool, bool))
    before[here], before[last] = passed[events], passed[np.searchsorted(owner, np.arange(count), side="right")]
    letter[here], caret[here] = ref[events], gone[events] == 2
    numbered[here], numbered[last] = gone[events] != 1, True
    # a record's last number ends where the next record begins
    value = np.diff(before[numbered], prepend=0)
    digits, number = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    number[numbered] = value
    digits[numbered] = 1 + sum((value >= 10**k).astype(np.int64) for k in range(1, len(str(int(value.max(initial=0))))))
    length = digits + caret + (letter > 0)
    start = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), dtype=np.uint8)
    for k in range(int(digits.max(initial=0))):
        some = digits > k
        out[start[some] + digits[some] - 1 - k] = 48 + number[some] // 10**k % 10
    out[(start + digits)[caret]] = ord("^")
    out[(start + digits + caret)[letter > 0]] = letter[letter > 0]
    return out, np.diff(np.r_[0, (start + length)[last]])


def md_letters(md: Texts, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """The replaced bases that MD of some records names: number in rows, column, letter. None if a number is too long to be added up."""
    n = md.sizes[rows]
    owner = np.repeat(np.arange(len(rows)), n)
    inside = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
    text = md.data[md.starts[rows][owner] + inside]
    digit, letter = _DIGIT[text], _LETTER[text]
    kind = digit + 2 * letter
    begins = (inside == 0) | (np.diff(kind, prepend=-1) != 0)
    run = np.cumsum(begins) - 1
    ends = np.r_[np.flatnonzero(begins)[1:], len(text)] - 1
    power = np.where(digit, ends[run] - np.arange(len(text)), 0) if len(text) else np.zeros(0, dtype=np.int64)
    if power.max(initial=0) > 9:
        return None
    # a run of letters behind ^ is a deletion
    first = np.flatnonzero(begins)
    deleted = ((inside[first] > 0) & (text[np.maximum(first - 1, 0)] == ord("^")))[run] if len(text) else np.zeros(0, dtype=bool)
    other = letter & ~deleted
    moved = np.where(digit, (text.astype(np.int64) - 48) * 10**power, other.astype(np.int64))
    passed = np.r_[0, np.cumsum(moved)]
    at = np.flatnonzero(other)
    return owner[at], passed[at] - passed[(np.cumsum(n) - n)[owner[at]]], text[at]
