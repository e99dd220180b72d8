"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece's bytes are the leaves. A leaf holds the rank of the pair that starts at its position, with
the position as tie-break, and an inner node the least of its two children, so that the root is the
leftmost pair of least rank. A merge changes at most three leaves (the merged token, the token that
vanished and the live neighbour before it), each a logarithmic point update. Short pieces are done
many at once, one tree a row; long ones alone.

Defined results: a null or empty text has no tokens and decodes to nothing; texts of any length are
encoded whole; repeated rows and ids give repeated rows; other columns of the table are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.llm.chunks import ChunkMemory
from cellstrand.llm.common import id_and_text, slices, texts_of

#: Longest piece that is encoded in a row of many.
ROW_BYTES = 64
#: Trees built at once; bounds the arrays.
ROWS_AT_ONCE = 8192
NONE = np.int32(2**31 - 1)
#: Distinct chunks that a worker remembers; their values here are larger than plain ids.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines `base64(token) rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairRanks:
    """Rank of two adjacent tokens' concatenation, which is the merged token's id too."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.values = np.array(values, dtype=np.int32)[order]
        self.lookup = dict(zip(keys, values, strict=True))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE where the two do not merge."""
        key = left.astype(np.int64) << 32 | right
        if not len(self.keys):
            return np.full(key.shape, NONE, dtype=np.int32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)


class SegmentTreeBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = PairRanks(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece of any length."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        leaves = 1 << max(1, (n - 1).bit_length())
        token = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, none = self.pairs.lookup, (1 << 62)
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            rank = rank_of.get(token[i] << 32 | token[i + 1])
            if rank is not None:
                tree[leaves + i] = rank << 32 | i
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != none:
            rank, at = tree[1] >> 32, tree[1] & 0xFFFFFFFF
            gone = after[at]
            behind, ahead = before[at], after[gone]
            token[at], after[at], token[gone] = rank, ahead, -1
            changed = [(gone, none)]
            if ahead < n:
                before[ahead] = at
                merged = rank_of.get(rank << 32 | token[ahead])
                changed.append((at, none if merged is None else merged << 32 | at))
            else:
                changed.append((at, none))
            if behind >= 0:
                merged = rank_of.get(token[behind] << 32 | rank)
                changed.append((behind, none if merged is None else merged << 32 | behind))
            for leaf, key in changed:
                node = leaves + leaf
                if tree[node] == key:
                    continue
                tree[node] = key
                node >>= 1
                while node:
                    least = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == least:
                        break
                    tree[node] = least
                    node >>= 1
        return [t for t in token if t >= 0]

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        out: list[list[int] | None] = [None] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = [whole]
            elif len(piece) > ROW_BYTES:
                out[k] = self.encode_piece(piece)
            elif piece:
                by_width.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(k)
            else:
                out[k] = []
        for width, rows in by_width.items():
            for start in range(0, len(rows), ROWS_AT_ONCE):
                part = rows[start : start + ROWS_AT_ONCE]
                for k, ids in zip(part, self._encode_rows([pieces[k] for k in part], width), strict=True):
                    out[k] = ids
        return out

    def _encode_rows(self, pieces: list[bytes], width: int) -> list[list[int]]:
        count = len(pieces)
        sizes = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(count, width)
        place = np.arange(width)
        token = self.byte_ids[text]
        token[place >= sizes[:, None]] = -1
        after = np.tile(place + 1, (count, 1))
        before = np.tile(place - 1, (count, 1))
        tree = np.full((count, 2 * width), NONE, dtype=np.int64)
        paired = place[:-1] < sizes[:, None] - 1
        rank = np.where(paired, self.pairs.of(token[:, :-1], token[:, 1:]), NONE)
        none = np.int64(NONE) * width
        tree[:, width : 2 * width - 1] = np.where(rank == NONE, none, rank.astype(np.int64) * width + place[:-1])
        tree[:, 2 * width - 1] = none
        for node in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        live = np.flatnonzero(tree[:, 1] < none)
        while len(live):
            root = tree[live, 1]
            at, merged = root % width, root // width
            gone = after[live, at]
            ahead, behind = after[live, gone], before[live, at]
            token[live, at], token[live, gone], after[live, at] = merged, -1, ahead
            more = ahead < sizes[live]
            rows, x = live[more], ahead[more]
            before[rows, x] = at[more]
            key = np.full(len(live), none)
            found = self.pairs.of(merged[more], token[rows, x])
            key[more] = np.where(found == NONE, none, found.astype(np.int64) * width + at[more])
            tree[live, width + at] = key
            tree[live, width + gone] = none
            less = behind >= 0
            rows, x = live[less], behind[less]
            found = self.pairs.of(token[rows, x], merged[less])
            tree[rows, width + x] = np.where(found == NONE, none, found.astype(np.int64) * width + x)
            for who, leaf in ((live, at), (live, gone), (rows, x)):
                node = (width + leaf) >> 1
                while len(node) and node[0]:
                    tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
                    node >>= 1
            live = live[tree[live, 1] < none]
        flat, ends = token[token >= 0].tolist(), np.cumsum((token >= 0).sum(1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def encode_chunks(self, chunks: Sequence[str]) -> list[list[int]]:
        """Ids of each chunk: the pattern cuts it, each distinct piece is encoded once."""
        cut = [[p.encode() for p in self.pattern.findall(c)] for c in chunks]
        distinct = list(dict.fromkeys(p for pieces in cut for p in pieces))
        ids = dict(zip(distinct, self.encode_pieces(distinct), strict=True))
        return [[i for p in pieces for i in ids[p]] for pieces in cut]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class Encoded(tuple):
    """(number of ids, their decimal digits joined by commas, decoded bytes) of a piece of text."""

    def __add__(self, other: Encoded) -> Encoded:
        return Encoded((self[0] + other[0], f"{self[1]},{other[1]}", self[2] + other[2]))


class TextEncoder:
    """Ids of whole texts, as their count, decimal digits and decoded bytes chunk by chunk."""

    def __init__(self, bpe: SegmentTreeBpe):
        self.bpe, self.memory = bpe, ChunkMemory(lambda chunks: [self._value(ids) for ids in bpe.encode_chunks(chunks)], REMEMBERED)

    def _value(self, ids: list[int]) -> Encoded:
        return Encoded((len(ids), ",".join(map(str, ids)), self.bpe.decode(ids)))

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        counts, encoded, decoded = [], [], []
        for row in self.memory.values(texts):
            parts = list(zip(*row, strict=True)) or [(), (), ()]
            counts.append(sum(parts[0]))
            encoded.append(hashlib.sha256(",".join(parts[1]).encode()).hexdigest())
            decoded.append(hashlib.sha256(b"".join(parts[2])).hexdigest())
        return counts, encoded, decoded


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> TextEncoder:
    """A worker's encoder; it lives as long as the worker."""
    return TextEncoder(SegmentTreeBpe(read_ranks(path), pattern))


def encoding_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches):
            counts, encoded, decoded = own.digests(texts_of(batch.column(1)))
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(text: Column, path: str, pattern: str) -> Column:
    """Token ids of a text column as array<int>."""

    @F.pandas_udf("array<int>")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path, pattern).bpe
        for part in parts:
            yield pd.Series([[i for chunk in bpe.encode_chunks([t or ""]) for i in chunk] for t in part])

    return ids(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """Bytes of a column of token ids; null for null."""

    @F.pandas_udf("binary")
    def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path, pattern).bpe
        for part in parts:
            yield pd.Series([None if x is None else bpe.decode(x) for x in part])

    return decoded(ids)
