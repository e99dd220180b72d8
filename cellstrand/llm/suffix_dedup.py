"""Suffix-array deduplication of repeated byte strings by a common-prefix-aware distributed merge sort.

Every string of LENGTH bytes that starts anywhere else as well is found, and all bytes that such
strings cover are removed. The suffix array is sparse. Each LENGTH-byte string has an anchor, the
GRAM-byte string in it of least hash, so equal strings have equal anchors at equal offsets; the
starts that share one anchor position form a zone of at most LENGTH - GRAM + 1 starts.

1. Each chunk of documents keeps its zones beside its texts: where they are, the anchor's hash and a
   128-bit cryptographic digest (BLAKE2b) of the zone's bytes. Equal zones of all chunks are made
   one through Spark's shuffle, by that digest; the anchor's hash only groups, and what it groups is
   compared byte by byte. An anchor with one zone that occurs once settles it (nothing repeats), a
   zone that occurs again repeats whole. Distinct zones of one anchor are left: the ends of repeats.
2. For those, one of each, suffixes from the anchor to the zone's end are sorted in each chunk into
   front-coded runs (length of the prefix shared with the suffix before, and the rest), with the text
   before the anchor beside them. A partition merges its runs with a loser tree that carries common
   prefix lengths, so no prefix is compared twice, and gets the suffix array of its part with its
   common prefix lengths. Suffixes that share GRAM bytes are of one anchor; the start d before the
   anchor repeats in zones that share LENGTH - d bytes from the anchor on and d bytes before it, which
   two sorted orders with their common prefix lengths tell for all zones of an anchor at once.
3. Answers go back to the chunk, which removes the bytes.

An anchor with MANY distinct zones or more (a passage that a large part of all documents quotes) does
not go to one partition: the strings of its distinct zones are counted one by one, by digests as
above, each distinct one once a chunk. Rows that are shuffled are as many as zones, whatever the
number of chunks and partitions; no group of rows of one key is longer than there are chunks.

Defined results: null is the empty text; texts shorter than LENGTH are never cut; matches never
cross documents; repeated rows are documents of their own, so copies of at least LENGTH bytes lose
all; ids may be null or repeated; tables may be empty and have any further columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cellstrand.llm import chunkstore
from cellstrand.llm.chunkstore import plain, unplain
from cellstrand.llm.common import bytes_of, cuts, id_and_text, mixed, stored

LENGTH = 200
GRAM = 32
#: Text of a chunk, about.
CHUNK_BYTES = 8 << 20
#: Bytes that are hashed at once, and starts of a text that are taken at once.
SLICE_BYTES = 1 << 20
#: Low bits of a hash that give way to the place in a slice; the same in every slice, so that all choose alike.
PLACE_BITS = np.uint64(22)
#: Distinct zones from which an anchor is counted string by string.
MANY = 32_768
#: Zones that a partition is laid out for.
PART_ZONES = 200_000
#: Starts by zones that are looked at at once.
BLOCK = 2_000_000
#: Parts that the zones of one anchor are dealt to when they learn how many they are.
SALTS = 4

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=U)


@dataclass
class Zones:
    """Zones of a chunk: document row, first and last start, anchor (all within the document), the anchor's hash, and the digest in two halves."""

    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray
    high: np.ndarray
    low: np.ndarray

    FIELDS = ("row", "first", "last", "anchor", "gram", "high", "low")

    def only(self, which: np.ndarray) -> Zones:
        return Zones(*(getattr(self, f)[which] for f in self.FIELDS))

    def table(self) -> pa.Table:
        return pa.table({f: getattr(self, f) for f in self.FIELDS})

    @classmethod
    def read(cls, url: str, chunk: int) -> Zones:
        table = chunkstore.read(f"{url}/zones", chunk)
        return cls(*(table.column(f).to_numpy() for f in cls.FIELDS))

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Of zones in order of anchor and digest: places of the first of each distinct zone, and for each zone which it is."""
        if not len(self.row):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        new = np.r_[True, (np.diff(self.gram) != 0) | (np.diff(self.high) != 0) | (np.diff(self.low) != 0)]
        return np.flatnonzero(new), np.cumsum(new) - 1


def digests_of(data: bytes, begin: list[int], end: list[int]) -> np.ndarray:
    """Rows of two signed halves of the digests of pieces of data."""
    view, digest = memoryview(data), hashlib.blake2b
    return np.frombuffer(b"".join([digest(view[a:b], digest_size=16).digest() for a, b in zip(begin, end, strict=True)]), dtype="<i8").reshape(-1, 2)


def zones_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(segment, first, last, anchor, anchor's hash) of the zones of segments of data; places in data."""
    none = np.empty(0, dtype=np.int64)
    n = len(data)
    if n < length:
        return none, none, none, none, none
    with np.errstate(over="ignore"):
        power, inverse = powers(BASE, n + 1), powers(INVERSE, n + 1)
        total = np.zeros(n + 1, dtype=U)
        np.cumsum((data.astype(U) + U(1)) * power[:n], out=total[1:])
        hashed = mixed((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
    least = (hashed >> PLACE_BITS << PLACE_BITS) | np.arange(len(hashed), dtype=U)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if rest := width - size:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    anchor = (least & ((U(1) << PLACE_BITS) - U(1))).astype(np.int64)
    inside = np.zeros(n + 1, dtype=np.int32)
    long = end - begin >= length
    np.add.at(inside, begin[long], 1)
    np.add.at(inside, end[long] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(inside[: len(anchor)]) > 0)
    if not len(start):
        return none, none, none, none, none
    of, segment = anchor[start], np.searchsorted(begin, start, side="right") - 1
    new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (segment[1:] != segment[:-1])])
    first, last = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    return segment[new], first, last, of[new], hashed[of[new]].view(np.int64)


def segments(table: pa.Table, text: str, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A chunk's texts as (bytes, segment begins, ends, rows, offset in the row), a bounded part at a time.

    A text with more than SLICE_BYTES starts comes in several segments, each with the bytes that its last start needs.
    """
    column = table.column(text)
    held: list[tuple[bytes, int, int]] = []
    size = row = 0

    def out() -> tuple[np.ndarray, ...]:
        ends = np.cumsum([len(p[0]) for p in held])
        return np.frombuffer(b"".join(p[0] for p in held), dtype=np.uint8), np.r_[0, ends[:-1]], ends, np.array([p[1] for p in held]), np.array([p[2] for p in held])

    for part in column.chunks:
        for at in range(0, len(part), 256):
            for content in bytes_of(part.slice(at, 256)):
                for offset in range(0, max(1, len(content) - length + 1), SLICE_BYTES):
                    piece = content[offset : offset + SLICE_BYTES + length - 1]
                    held.append((piece, row, offset))
                    size += len(piece)
                    if size >= SLICE_BYTES:
                        yield out()
                        held, size = [], 0
                row += 1
    if held:
        yield out()


def chunk_zones(table: pa.Table, text: str, length: int, gram: int) -> Zones:
    """Zones of a chunk, in order of anchor and digest."""
    none = np.empty(0, dtype=np.int64)
    parts = [(none,) * len(Zones.FIELDS)]
    for data, begin, end, row, offset in segments(table, text, length):
        segment, first, last, anchor, grams = zones_of(data, begin, end, length, gram)
        if len(segment):
            digest = digests_of(data, first.tolist(), (last + length).tolist())
            shift = offset[segment] - begin[segment]
            parts.append((row[segment], first + shift, last + shift, anchor + shift, grams, digest[:, 0], digest[:, 1]))
    zones = Zones(*(np.concatenate(p) for p in zip(*parts, strict=True)))
    return zones.only(np.lexsort((zones.low, zones.high, zones.gram)))


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share their first `known` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


class LoserTree:
    """Merge of sorted runs of (string, prefix length shared with the one before).

    Each run's head carries the length that it shares with the string put out last. Of two heads the
    one that shares more comes first, without a look at the strings; heads that share the same are
    compared from there on, and the loser then knows what it shares with the winner.
    """

    def __init__(self, runs: list[Iterator[tuple[bytes, int]]]):
        self.runs = runs
        self.leaves = 1 << max(0, (len(runs) - 1).bit_length())
        self.head: list[bytes | None] = [next(r, (None, 0))[0] for r in runs] + [None] * (self.leaves - len(runs))
        self.shared = [0] * self.leaves
        self.loser = [0] * self.leaves
        winner = [0] * (2 * self.leaves)
        for leaf in range(self.leaves):
            winner[self.leaves + leaf] = leaf
        for node in range(self.leaves - 1, 0, -1):
            winner[node], self.loser[node] = self._play(winner[2 * node], winner[2 * node + 1])
        self.first = winner[1]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.shared[a], self.shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        same = common(x, y, p)
        if same == len(x) or (same < len(y) and x[same] < y[same]):
            self.shared[b] = same
            return a, b
        self.shared[a] = same
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        """(run, string, length shared with the string before), in order."""
        while (string := self.head[self.first]) is not None:
            run = self.first
            yield run, string, self.shared[run]
            self.head[run], self.shared[run] = next(self.runs[run], (None, 0))
            node, winner = (self.leaves + run) >> 1, run
            while node:
                winner, self.loser[node] = self._play(winner, self.loser[node])
                node >>= 1
            self.first = winner


def front_coded(strings: list[bytes], before: list[bytes]) -> list[bytes]:
    """A sorted run for exchange: shared lengths, rests, and the (reversed) texts before the anchors."""
    shared = [0, *(common(a, b, 0) for a, b in zip(strings, strings[1:], strict=False))][: len(strings)]
    rest = [s[n:] for s, n in zip(strings, shared, strict=True)]
    return [plain(np.array(shared, dtype=np.uint16)), plain(np.array([len(r) for r in rest], dtype=np.uint16)), plain(np.frombuffer(b"".join(rest), dtype=np.uint8)), plain(np.array([len(b) for b in before], dtype=np.uint16)), plain(np.frombuffer(b"".join(before), dtype=np.uint8))]


def decoded(fields: list[bytes]) -> tuple[list[tuple[bytes, int]], list[bytes]]:
    shared, size = unplain(fields[0], np.uint16).tolist(), unplain(fields[1], np.uint16).tolist()
    rest, left_size, left = unplain(fields[2], np.uint8).tobytes(), unplain(fields[3], np.uint16).tolist(), unplain(fields[4], np.uint8).tobytes()
    out, before, at, at_left, last = [], [], 0, 0, b""
    for n, more, k in zip(shared, size, left_size, strict=True):
        last = last[:n] + rest[at : at + more]
        out.append((last, n))
        before.append(left[at_left : at_left + k])
        at, at_left = at + more, at_left + k
    return out, before


def repeats(right: list[int], before: list[bytes], length: int, gram: int) -> np.ndarray:
    """For zones of one anchor in suffix order, whether the start d before the anchor repeats in another zone.

    right: prefix length shared with the suffix before; before: reversed texts before the anchors.
    For each d, zones that share length - d bytes from the anchor on are neighbours in the one order,
    those that share d bytes before it in the other; zones alike in both repeat each other.
    """
    m = len(before)
    out = np.zeros((m, length), dtype=bool)
    if m == 2:
        low, high = length - right[1], common(before[0], before[1], 0)
        out[:, low : high + 1] = True
        return out
    by_left = sorted(range(m), key=before.__getitem__)
    ordered = np.array([-1, *(common(before[a], before[b], 0) for a, b in zip(by_left, by_left[1:], strict=False))], dtype=np.int32)
    place = np.empty(m, dtype=np.int64)
    place[by_left] = np.arange(m)
    shared = np.array([-1, *right[1:]], dtype=np.int32)
    starts = length - gram + 1
    step = max(1, BLOCK // m)
    for first in range(0, starts, step):
        d = np.arange(first, min(starts, first + step), dtype=np.int32)[:, None]
        key = np.cumsum(shared < length - d, axis=1) * (m + 1) + np.cumsum(ordered < d, axis=1)[:, place]
        order = np.argsort(key, axis=1, kind="stable")
        ranked = np.take_along_axis(key, order, 1)
        same = ranked[:, 1:] == ranked[:, :-1]
        found = np.zeros(key.shape, dtype=bool)
        found[:, 1:] |= same
        found[:, :-1] |= same
        np.put_along_axis(key, order, found, 1)
        out[:, d[:, 0]] = key.T.astype(bool)
    return out


def merged_repeats(runs: list[list[bytes]], length: int, gram: int) -> list[np.ndarray]:
    """For each front-coded run, suffix by suffix, the starts (bits d) that repeat."""
    strings, before = zip(*(decoded(r) for r in runs), strict=True)
    out = [np.zeros((len(s), length), dtype=bool) for s in strings]
    taken = [0] * len(runs)
    group: list[tuple[int, int]] = []
    right: list[int] = []

    def settle() -> None:
        if len(group) > 1:
            found = repeats(right, [before[r][k] for r, k in group], length, gram)
            for (r, k), bits in zip(group, found, strict=True):
                out[r][k] = bits

    for run, _, shared in LoserTree([iter(s) for s in strings]):
        if shared < gram:
            settle()
            group.clear()
            right.clear()
        group.append((run, taken[run]))
        right.append(shared)
        taken[run] += 1
    settle()
    return out


#: What becomes of a distinct zone of a chunk: all of it repeats (SHOWN: and others may repeat parts of it); it is compared; its strings are counted (SPELT: all of it repeats, and others may repeat its strings). The rest: a chunk is there; a string of a chunk repeats.
ALL, SHOWN, COMPARED, SPELT, COUNTED, THERE, STRING = range(7)

ANSWER = "chunk long, k int, code int, places binary, bits binary"
RUN = "part int, chunk long, places binary, f0 binary, f1 binary, f2 binary, f3 binary, f4 binary"
RUN_TYPES = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
RUN_NAMES = ["part", "chunk", "places", "f0", "f1", "f2", "f3", "f4"]


def answered(zones: DataFrame, many: int) -> DataFrame:
    """Stored (chunk, k, gram, code) of the chunks' distinct zones that are not settled as single; zones: (chunk, k, gram, high, low, n)."""
    same = Window.partitionBy("gram", "high", "low")
    counted = zones.withColumn("n", F.sum("n").over(same)).withColumn("nth", F.row_number().over(same.orderBy("chunk", "k")))
    several = counted.where("nth = 1").groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    # the zones of a frequent anchor are dealt by their digests too, and meet a copy of its count there; counts grow with the corpus, so they are not broadcast
    several = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = counted.withColumn("salt", F.pmod("low", F.lit(SALTS)).cast("int")).join(several.hint("merge"), ["gram", "salt"], "left").where("n > 1 or kinds is not null")
    one, hot = F.col("nth") == 1, F.col("kinds") >= many
    code = F.when(F.col("kinds").isNull() | ~one, ALL).when(F.col("n") > 1, F.when(hot, SPELT).otherwise(SHOWN)).when(hot, COUNTED).otherwise(COMPARED)
    return stored(known.select("chunk", "k", "gram", code.alias("code")), "zone-answers")


def removed(docs: DataFrame, finish: Callable[[pa.Table, list[tuple[bytes, np.ndarray]]], pa.Table], schema: StructType | str, text: str = "text", length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, many: int = MANY) -> DataFrame:
    """Apply `finish` to each part of rows with (bytes, whether each byte is removed) of every row's text."""
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def measure(table: pa.Table) -> tuple[int, dict[str, pa.Table]]:
        zones = chunk_zones(table, text, length, gram)
        return len(zones.row), {"zones": zones.table()}

    url, table = chunkstore.store(docs, measure, text, chunk_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                zones = Zones.read(url, chunk)
                at, number = zones.numbers()
                one = zones.only(at)
                count = np.minimum(np.bincount(number, minlength=len(at)), 2)
                yield pa.record_batch([pa.array(np.full(len(at), chunk)), pa.array(np.arange(len(at)), pa.int32()), pa.array(one.gram), pa.array(one.high), pa.array(one.low), pa.array(count, pa.int64())], names=["chunk", "k", "gram", "high", "low", "n"])

    zones = chunkstore.dealt(table.where("size > 0")).mapInArrow(ask, "chunk long, k int, gram long, high long, low long, n long")
    known = answered(zones, many)
    compared = known.where(F.col("code").isin(SHOWN, COMPARED))
    parts = max(slots, -(-compared.count() // PART_ZONES))

    def contents(chunk: int, k: np.ndarray) -> tuple[Zones, list[bytes]]:
        """Some distinct zones of a chunk, and the bytes from the first start to the end of the last string."""
        zones = Zones.read(url, chunk)
        own = zones.only(zones.numbers()[0][k])
        wanted, where = np.unique(own.row, return_inverse=True)
        texts = bytes_of(chunkstore.read(url, chunk, [text]).column(0).take(pa.array(wanted)).combine_chunks())
        return own, [texts[w][a : b + length] for w, a, b in zip(where.tolist(), own.first.tolist(), own.last.tolist(), strict=True)]

    def show(table: pa.Table) -> pa.Table:
        chunk, k = table.column("chunk")[0].as_py(), np.sort(table.column("k").to_numpy())
        own, content = contents(chunk, k)
        left = (own.anchor - own.first).tolist()
        suffix, before = [c[n:] for c, n in zip(content, left, strict=True)], [c[:n][::-1] for c, n in zip(content, left, strict=True)]
        part = (mixed(own.gram.view(U) ^ U(0x5851F42D4C957F2D)) % U(parts)).astype(np.int64).tolist()
        order = sorted(range(len(k)), key=lambda j: (part[j], suffix[j], before[j]))
        ends = [j for j in range(1, len(order)) if part[order[j]] != part[order[j - 1]]]
        told = []
        for a, b in zip([0, *ends], [*ends, len(order)], strict=True):
            run = order[a:b]
            told.append((part[run[0]], chunk, plain(k[run].astype(np.int32)), *front_coded([suffix[j] for j in run], [before[j] for j in run])))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*told, strict=True), RUN_TYPES, strict=True)], names=RUN_NAMES)

    def merge(table: pa.Table) -> pa.Table:
        # the same order of runs whatever order they come in
        table = table.sort_by("chunk")
        runs = [list(r) for r in zip(*(table.column(f"f{k}").to_pylist() for k in range(5)), strict=True)]
        found = [plain(np.packbits(bits, axis=1)) for bits in merged_repeats(runs, length, gram)]
        return pa.table({"chunk": table.column("chunk"), "k": pa.nulls(len(runs), pa.int32()), "code": pa.array([COMPARED] * len(runs), pa.int32()), "places": table.column("places"), "bits": pa.array(found, pa.binary())})

    def strings(chunk: int, k: np.ndarray) -> tuple[Zones, np.ndarray, np.ndarray, np.ndarray]:
        """Some distinct zones' distinct strings: the zones, a digest of each string, and for all starts, zone by zone, which string it is and the start."""
        own, content = contents(chunk, k)
        size = own.last - own.first + 1
        digest = np.concatenate([digests_of(c, range(n), range(length, length + n)) for c, n in zip(content, size.tolist(), strict=True)])
        distinct, number = np.unique(digest, axis=0, return_inverse=True)
        return own, distinct, number.reshape(-1), np.repeat(own.first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)

    def spell(table: pa.Table) -> pa.Table:
        chunk, k = table.column("chunk")[0].as_py(), np.sort(table.column("k").to_numpy())
        _, distinct, number, _ = strings(chunk, k)
        n = np.minimum(np.bincount(number, minlength=len(distinct)), 2)
        return pa.table({"chunk": np.full(len(distinct), chunk), "k": np.arange(len(distinct), dtype=np.int32), "high": np.ascontiguousarray(distinct[:, 0]), "low": np.ascontiguousarray(distinct[:, 1]), "n": n.astype(np.int64)})

    def cut(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        rows, zones = chunkstore.read(url, chunk), Zones.read(url, chunk)
        at, number = zones.numbers()
        k, code = table.column("k").to_numpy(zero_copy_only=False), table.column("code").to_numpy()
        whole = np.zeros(len(at), dtype=bool)
        whole[k[np.isin(code, (ALL, SHOWN, SPELT)) & ~np.isnan(k.astype(float))].astype(np.int64)] = True
        every = whole[number]
        row, first, last = [zones.row[every]], [zones.first[every]], [zones.last[every]]
        for places, bits in zip(table.column("places").to_pylist(), table.column("bits").to_pylist(), strict=True):
            if bits is not None:
                place = unplain(places, np.int32).astype(np.int64)
                found = np.unpackbits(unplain(bits, np.uint8).reshape(len(place), -1), axis=1)[:, :length].astype(bool)
                # a compared zone that does not repeat whole occurs once: the distinct one is the zone itself
                found[whole[place]] = False
                j, before = np.nonzero(found)
                own = at[place[j]]
                row.append(zones.row[own])
                first.append(zones.anchor[own] - before)
                last.append(zones.anchor[own] - before)
        if (again := k[code == STRING].astype(np.int64)).size:
            spelt = np.sort(k[np.isin(code, (SPELT, COUNTED))].astype(np.int64))
            own, distinct, which, start = strings(chunk, spelt)
            often = np.zeros(len(distinct), dtype=bool)
            often[again] = True
            row.append(np.repeat(own.row, own.last - own.first + 1)[often[which]])
            first.append(start[often[which]])
            last.append(start[often[which]])
        return finish_chunk(rows, np.concatenate(row), np.concatenate(first), np.concatenate(last), text, length, finish)

    def answer(rows: DataFrame, code) -> DataFrame:
        return rows.select("chunk", "k", code.alias("code"), F.lit(None).cast("binary").alias("places"), F.lit(None).cast("binary").alias("bits"))

    runs = chunkstore.by(compared, "chunk").applyInArrow(show, RUN)
    merged = chunkstore.by(runs, "part").applyInArrow(merge, ANSWER)
    spelt = chunkstore.by(known.where(F.col("code").isin(SPELT, COUNTED)), "chunk").applyInArrow(spell, "chunk long, k int, high long, low long, n long")
    again = spelt.withColumn("n", F.sum("n").over(Window.partitionBy("high", "low"))).where("n > 1")
    there = answer(table.withColumn("k", F.lit(None).cast("int")), F.lit(THERE))
    found = answer(known, F.col("code")).unionByName(merged).unionByName(answer(again, F.lit(STRING))).unionByName(there)
    return chunkstore.by(found, "chunk").applyInArrow(cut, schema)


def finish_chunk(rows: pa.Table, row: np.ndarray, first: np.ndarray, last: np.ndarray, text: str, length: int, finish: Callable[[pa.Table, list[tuple[bytes, np.ndarray]]], pa.Table]) -> pa.Table:
    """The rows with their repeated bytes; strings repeat at all starts from first to last of a row."""
    order = np.argsort(row, kind="stable")
    row, first, last = row[order], first[order], last[order]
    out, done = [], 0
    for batch in rows.to_batches():
        for a, b in cuts(batch.column(text)):
            piece = pa.Table.from_batches([batch.slice(a, b - a)])
            contents = bytes_of(piece.column(text).combine_chunks())
            at = np.searchsorted(row, np.arange(done, done + len(contents) + 1))
            marked = []
            for k, content in enumerate(contents):
                change = np.zeros(len(content) + 1, dtype=np.int32)
                own = slice(at[k], at[k + 1])
                np.add.at(change, first[own], 1)
                np.add.at(change, last[own] + length, -1)
                marked.append((content, np.cumsum(change[:-1]) > 0))
            out.append(finish(piece, marked))
            done += len(contents)
    return pa.concat_tables(out)


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    def finish(piece: pa.Table, marked: list[tuple[bytes, np.ndarray]]) -> pa.Table:
        told = []
        for content, gone in marked:
            kept = np.frombuffer(content, dtype=np.uint8)[~gone].tobytes()
            told.append((len(content), int(gone.sum()), int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=np.int8(0)) == 1)), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*told, strict=True))
        return pa.table({"doc_id": piece.column("doc_id"), "n_bytes": pa.array(columns[0], pa.int64()), "n_removed": pa.array(columns[1], pa.int64()), "n_spans": pa.array(columns[2], pa.int64()), "kept_sha256": pa.array(columns[3], pa.string())})

    return removed(id_and_text(docs), finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", **options)


def without_repeats(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs with the repeated bytes taken out of every text; characters that are cut through go whole. Null stays null."""

    def finish(piece: pa.Table, marked: list[tuple[bytes, np.ndarray]]) -> pa.Table:
        at = piece.schema.get_field_index(text)
        null = piece.column(at).is_null().to_pylist()
        kept = [None if n else c if not g.any() else np.frombuffer(c, dtype=np.uint8)[~g].tobytes().decode("utf-8", "ignore").encode() for n, (c, g) in zip(null, marked, strict=True)]
        return piece.set_column(at, piece.schema.field(at), pa.array(kept, pa.binary()).cast(piece.schema.field(at).type))

    return removed(docs, finish, docs.schema, text, **options)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT r, k, substr(h, 8000 * k + 1, 8400) AS piece FROM (SELECT r, h, unnest(range(0, (len(h) + 7999) // 8000)) AS k FROM d)),
s AS (SELECT r, 4000 * k + j AS i, md5(substr(piece, 2 * j + 1, 400)) AS str FROM (SELECT r, k, piece, unnest(range(0, least(4000, len(piece) // 2 - 199))) AS j FROM p)),
o AS (SELECT str FROM s GROUP BY 1 HAVING count(*) > 1),
g AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 200 THEN 0 ELSE 1 END AS new FROM s SEMI JOIN o USING (str)),
n AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS span FROM g),
x AS (SELECT r, span, min(i) AS a, max(i) + 200 AS b FROM n GROUP BY 1, 2),
e AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM x),
k AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM e JOIN d USING (r) GROUP BY 1)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
