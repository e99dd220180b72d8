"""Words of texts as 64-bit hashes (white-space words with A-Z lower-cased), and sorted tables of hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

from cellstrand.llm.common import mixed

#: Bytes of a word from which it is hashed by itself and not with the others eight bytes at a time.
LONG = 64
#: Low bits of a hash that give way to its place while it is sorted.
PLACE_BITS = np.uint64(22)
U = np.uint64
#: What a word of so many bytes leaves of eight.
MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=U)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    joined = b" ".join([b"", *texts, bytes(8)]).lower()
    data = np.frombuffer(joined, dtype=np.uint8)[:-8]
    space = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, length = edge[::2], edge[1::2] - edge[::2]
    count = np.diff(np.searchsorted(start, np.r_[1 + np.cumsum(size + 1) - (size + 1), len(data)]))
    # the eight bytes from each place on
    eight = np.ndarray((len(data),), dtype="<u8", buffer=joined, strides=(1,))
    out = combined(length.astype(U), eight[start] & MASK[np.minimum(length, 8)])
    more, done = np.flatnonzero((length > 8) & (length <= LONG)), 8
    while len(more):
        left = length[more] - done
        out[more] = combined(mixed(out[more]), eight[start[more] + done] & MASK[np.minimum(left, 8)])
        more, done = more[left > 8], done + 8
    out = mixed(out)
    for w in np.flatnonzero(length > LONG).tolist():
        out[w] = xxhash.xxh3_64_intdigest(joined[start[w] : start[w] + length[w]])
    return out, count


def combined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    with np.errstate(over="ignore"):
        x = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(31))


def ranked(gram: np.ndarray) -> np.ndarray:
    """Places in order of hash, then of place."""
    if len(gram) < 1 << int(PLACE_BITS):
        key = np.sort((gram >> PLACE_BITS << PLACE_BITS) | np.arange(len(gram), dtype=U))
        place = (key & ((U(1) << PLACE_BITS) - U(1))).astype(np.int64)
        own = gram[place]
        # hashes that differ in their low bits alone would stand mixed
        if not ((own[1:] != own[:-1]) & (key[1:] >> PLACE_BITS == key[:-1] >> PLACE_BITS)).any():
            return place
    return np.argsort(gram, kind="stable")


@dataclass
class Table:
    """Hashes at some places: the places in order of hash, which hash stands there, the distinct ones, ascending, and their counts."""

    place: np.ndarray
    number: np.ndarray
    distinct: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, gram: np.ndarray, where: np.ndarray) -> Table:
        at = np.flatnonzero(where)
        place = at[ranked(gram[at])]
        own = gram[place]
        new = np.r_[True, own[1:] != own[:-1]][: len(own)]
        begin = np.flatnonzero(new)
        return cls(place, np.cumsum(new) - 1, own[begin], np.diff(np.r_[begin, len(own)]))

    def parts(self, parts: int) -> np.ndarray:
        """Where each of `parts` equal ranges of hashes begins among the distinct ones."""
        edge = [U((p << 64) // parts) for p in range(1, parts)]
        return np.r_[0, np.searchsorted(self.distinct, np.array(edge, dtype=U)), len(self.distinct)]
