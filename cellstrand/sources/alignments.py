"""SAM text and BAM files as tables of one schema."""

from __future__ import annotations

import gzip
import io
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from cellstrand.functions import batches
from cellstrand.functions.alignment import FIRST, REVERSE, SECOND, reference_end
from cellstrand.session import pushes
from cellstrand.sources import bam_index
from cellstrand.sources.files import listed, open_at, open_input

SCHEMA = "idx bigint, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string, tags map<string,string>, tag_types map<string,string>"

_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "map<string,string>": pa.map_(pa.string(), pa.string())}
ARROW = pa.schema([(name, _KINDS[kind]) for name, kind in (c.split(" ") for c in SCHEMA.split(", "))])
#: Unpacked bytes of records that leave a reader at once.
READ_BYTES = 1 << 20

# Fixed values of the file format.
CIGAR_LETTERS = "MIDNSHP=X"
BASE_LETTERS = "=ACMGRSVTWYHKDBN"
BASES = np.frombuffer(BASE_LETTERS.encode(), dtype=np.uint8)
TAG_NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Records of SAM text; split and parsed by Spark. Positions from 0; `*` of a reference is null.

    `tags` has the values as text, `tag_types` the letter of each: A, i, f, Z, H or B, and in BAM files also c C s S I for integers.
    """
    lines = spark.read.text(path).where(~F.startswith(F.col("value"), F.lit("@")) & (F.col("value") != ""))
    f = lines.select(F.monotonically_increasing_id().alias("idx"), F.split("value", "\t").alias("f"))
    rest = F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0)))
    def tag_parts(at: int, size: int) -> Column:
        pair = F.transform(rest, lambda t: F.struct(F.substr(t, F.lit(1), F.lit(2)).alias("key"), F.substr(t, F.lit(at), F.lit(size)).alias("value")))
        return F.map_from_entries(pair)

    # as long as any text can be
    tags, types = tag_parts(6, 2**31 - 1), tag_parts(4, 1)

    def field(k: int):
        return F.get("f", F.lit(k))

    return f.select(
        "idx", field(0).alias("qname"), field(1).cast("int").alias("flag"), F.nullif(field(2), F.lit("*")).alias("rname"), (field(3).cast("int") - 1).alias("pos"), field(4).cast("int").alias("mapq"), field(5).alias("cigar"),
        field(6).alias("rnext"), (field(7).cast("int") - 1).alias("pnext"), field(8).cast("int").alias("tlen"), field(9).alias("seq"), field(10).alias("qual"), tags.alias("tags"), types.alias("tag_types"),
    )


def sam_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines; few, and needed by writers."""
    return [r.value for r in spark.read.text(path).where(F.startswith(F.col("value"), F.lit("@"))).collect()]


def bam_header(path: str) -> tuple[str, list[tuple[str, int]]]:
    with gzip.GzipFile(fileobj=open_input(path)) as data:
        return _header(io.BufferedReader(data))


def _header(data: io.BufferedReader) -> tuple[str, list[tuple[str, int]]]:
    if data.read(4) != b"BAM\x01":
        raise ValueError("not a BAM file")
    text = data.read(struct.unpack("<i", data.read(4))[0]).rstrip(b"\0").decode()
    references = []
    for _ in range(struct.unpack("<i", data.read(4))[0]):
        name = data.read(struct.unpack("<i", data.read(4))[0])[:-1].decode()
        references.append((name, struct.unpack("<i", data.read(4))[0]))
    return text, references


def _tags(data: bytes) -> tuple[dict[str, str], dict[str, str]]:
    """Values of a record's tags as text, and their types. A value of type B begins with the type of its numbers."""
    out: dict[str, str] = {}
    types: dict[str, str] = {}
    at = 0
    while at + 3 <= len(data):
        tag, kind = data[at : at + 2].decode(), chr(data[at + 2])
        types[tag] = kind
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            out[tag], at = data[at:end].decode(), end + 1
        elif kind == "A":
            out[tag], at = chr(data[at]), at + 1
        elif kind == "B":
            inner, count = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            values = struct.unpack_from(f"<{count}{TAG_NUMBERS[inner]}", data, at + 5)
            out[tag] = ",".join([inner, *(map(_short, values) if inner == "f" else map(str, values))])
            at += 5 + count * struct.calcsize(TAG_NUMBERS[inner])
        else:
            (value,) = struct.unpack_from(f"<{TAG_NUMBERS[kind]}", data, at)
            out[tag] = _short(value) if kind == "f" else str(value)
            at += struct.calcsize(TAG_NUMBERS[kind])
    return out, types


def _short(value: float) -> str:
    """The shortest text that a four-byte number can be read back from."""
    return str(np.float32(value))


#: Bytes of a file that a partition is laid out for.
SPLIT_BYTES = 32 << 20
#: Bits of a record's place in its unpacked block, which are 16 but for the last ones, as no record has less than 36 bytes, and of
#: its block's place in the file; the file's number stands before them.
PLACE_BITS, SPARED_BITS, BLOCK_BITS = 11, 5, 40
#: Records in a row that must look like records where a range begins within a file.
PROOF = 8


def _block_size(head: bytes) -> int | None:
    """Size of the blocked-gzip block that begins with these 18 bytes, if one does."""
    if len(head) == 18 and head[:4] == b"\x1f\x8b\x08\x04" and head[10:16] == b"\x06\x00BC\x02\x00":
        return struct.unpack_from("<H", head, 16)[0] + 1
    return None


class Blocks:
    """The blocks of a blocked-gzip file from some place on, as one stream of bytes that knows in which block each begins."""

    def __init__(self, file: BinaryIO, size: int, at: int):
        self.file, self.size, self.at = file, size, at
        #: begins of blocks in the file, and their begins in `held`
        self.places: list[tuple[int, int]] = []
        self.held, self.taken = bytearray(), 0

    @staticmethod
    def first_from(file: BinaryIO, size: int, at: int) -> int:
        """Where the first block at or behind `at` begins: a block that another, or the end, follows."""
        while at < size:
            file.seek(at)
            window = file.read(1 << 17)
            found = window.find(b"\x1f\x8b\x08\x04")
            while found >= 0:
                place = at + found
                if step := _block_size(window[found : found + 18]):
                    file.seek(place + step)
                    if place + step == size or _block_size(file.read(18)):
                        return place
                found = window.find(b"\x1f\x8b\x08\x04", found + 1)
            at += len(window) - 17 if at + len(window) < size else len(window)
        return size

    def fill(self, wanted: int) -> bool:
        """Hold at least `wanted` bytes that are not taken; False at the end of the file."""
        while len(self.held) - self.taken < wanted and self.at < self.size:
            self.file.seek(self.at)
            head = self.file.read(18)
            step = _block_size(head)
            if step is None:
                raise ValueError("not a blocked gzip file")
            data = zlib.decompress(self.file.read(step - 18)[:-8], -15)
            self.places = [p for k, p in enumerate(self.places) if k + 1 == len(self.places) or self.places[k + 1][1] > self.taken]
            if self.taken > 1 << 20:
                del self.held[: self.taken]
                self.places, self.taken = [(f, h - self.taken) for f, h in self.places], 0
            self.places.append((self.at, len(self.held)))
            self.held += data
            self.at += step
        return len(self.held) - self.taken >= wanted

    def place(self) -> tuple[int, int]:
        """Where in the file the block begins that the next byte to be taken is in, and the byte's place in it."""
        held, block = max((held, place) for place, held in self.places if held <= self.taken)
        return block, self.taken - held

    def peek(self, skip: int, n: int) -> bytes:
        return bytes(self.held[self.taken + skip : self.taken + skip + n])


def _like_a_record(blocks: Blocks, skip: int, references: int) -> int | None:
    """Bytes of the record that seems to begin `skip` bytes on; None if none does, 0 at the end of the file."""
    if not blocks.fill(skip + 36):
        return 0 if len(blocks.held) - blocks.taken == skip else None
    size, ref, pos, name_size, _, _, ops, _, bases, next_ref, next_pos, _ = struct.unpack("<iiiBBHHHiiii", blocks.peek(skip, 36))
    if not (-1 <= ref < references and -1 <= next_ref < references and pos >= -1 and next_pos >= -1 and name_size > 0 and bases >= 0):
        return None
    if size < 32 + name_size + 4 * ops + (bases + 1) // 2 + bases or size > 1 << 28 or not blocks.fill(skip + 36 + name_size):
        return None
    name = blocks.peek(skip + 36, name_size)
    return 4 + size if name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) else None


def _to_first_record(blocks: Blocks, references: int) -> bool:
    """Take bytes up to where PROOF records, or all up to the end, follow each other; False if none begins."""
    while blocks.fill(1):
        skip, seen = 0, 0
        while seen < PROOF and (step := _like_a_record(blocks, skip, references)):
            skip, seen = skip + step, seen + 1
        if seen == PROOF or (seen and step == 0):
            return True
        blocks.taken += 1
    return False


def _entered(file: BinaryIO, size: int, references: int, start: int, end: int, skipped: int) -> Blocks | None:
    """Blocks from start on, up to the first record taken; None if none begins before `end`. `skipped`: the header's bytes besides its text."""
    if start == 0:
        blocks = Blocks(file, size, 0)
        # the text's own size, as it may be padded
        blocks.fill(8)
        skip = struct.unpack("<i", blocks.peek(4, 4))[0] + skipped
        blocks.fill(skip)
        blocks.taken += skip
        return blocks
    blocks = Blocks(file, size, Blocks.first_from(file, size, start))
    return blocks if blocks.at < end and _to_first_record(blocks, references) else None


def _bodies(path: str, references: int, start: int = 0, end: int | None = None, first: int | None = None, stop: int | None = None, skipped: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(virtual offset, body) of the records that begin in the blocks from start to end; a last offset with an empty body says where they end.

    `first` is the virtual offset of the first record where it is known, `stop` the one to stop at, `skipped` the header's bytes.
    """
    file, size = open_at(path)
    with file:
        if first is not None:
            blocks = Blocks(file, size, first >> 16)
            blocks.fill((first & 0xFFFF) + 1)
            blocks.taken += first & 0xFFFF
        else:
            blocks = _entered(file, size, references, start, size if end is None else end, skipped)
            if blocks is None:
                return
        while blocks.fill(4):
            block, place = blocks.place()
            if end is not None and block >= end or stop is not None and block << 16 | place >= stop:
                yield block << 16 | place, b""
                return
            length = struct.unpack("<i", blocks.peek(0, 4))[0]
            if not blocks.fill(4 + length):
                raise ValueError(f"{path}: the last record is cut off")
            body = blocks.peek(4, length)
            blocks.taken += 4 + length
            yield block << 16 | place, body
        yield blocks.at << 16, b""


def _skipped(references: list[tuple[str, int]]) -> int:
    """Bytes of a header besides its text."""
    return 12 + sum(9 + len(name.encode()) for name, _ in references)


def places(path: str, start: int, end: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(reference, start, end, virtual offset, next one's) of the records that begin in the blocks from start to end."""
    references = bam_header(path)[1]
    before: tuple[int, int, int, int] | None = None
    for offset, body in _bodies(path, len(references), start, end, skipped=_skipped(references)):
        if before:
            yield *before, offset
        if body:
            ref, pos, name_size, _, _, ops = struct.unpack_from("<iiBBHH", body)
            sizes = struct.unpack_from(f"<{ops}I", body, 32 + name_size)
            before = ref, pos, pos + max(1, sum(c >> 4 for c in sizes if CIGAR_LETTERS[c & 15] in "MDN=X")), offset


@lru_cache(1 << 14)
def _cigar(ops: bytes) -> str:
    return "".join(f"{c >> 4}{CIGAR_LETTERS[c & 15]}" for (c,) in struct.iter_unpack("<I", ops)) or "*"


def bam_records(path: str, only: str | None = None, ordinal: int = 0, start: int = 0, end: int | None = None, first: int | None = None, stop: int | None = None) -> Iterator[tuple]:
    """Records of a BAM file that begin in its blocks from start to end, in file order, of one reference if wanted.

    idx orders the records of all files: the file's number, the block's place in it, the record's place in the block.
    """
    header = bam_header(path)[1]
    references = [name for name, _ in header]
    for offset, body in _bodies(path, len(references), start, end, first, stop, _skipped(header)):
        if not body:
            return
        ref = struct.unpack_from("<i", body)[0]
        if only is None or ref >= 0 and references[ref] == only:
            yield _record(references, ordinal, offset, body)


def _record(references: list[str], ordinal: int, offset: int, body: bytes) -> tuple:
    ref, pos, name_size, mapq, _, ops, flag, bases, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", body)
    rname = references[ref] if ref >= 0 else None
    at = 32 + name_size
    qname = body[32 : at - 1].decode()
    cigar = _cigar(body[at : at + 4 * ops])
    at += 4 * ops
    half = body[at : at + (bases + 1) // 2]
    seq = "".join(BASE_LETTERS[b >> 4] + BASE_LETTERS[b & 15] for b in half)[:bases] or "*"
    at += len(half)
    raw = body[at : at + bases]
    qual = "*" if not raw or raw[0] == 255 else bytes(q + 33 for q in raw).decode()
    rnext = "*" if next_ref < 0 else "=" if next_ref == ref else references[next_ref]
    idx = (ordinal << BLOCK_BITS | offset >> 16) << PLACE_BITS | (offset & 0xFFFF) >> SPARED_BITS
    return idx, qname, flag, rname, pos, mapq, cigar, rnext, next_pos, tlen, seq, qual, *_tags(body[at + bases :])


def bam_batches(path: str, only: str | None = None, ordinal: int = 0, start: int = 0, end: int | None = None, first: int | None = None, stop: int | None = None) -> Iterator[pa.RecordBatch]:
    """What bam_records tells, for all records of some unpacked bytes at once."""
    header = bam_header(path)[1]
    references = [name for name, _ in header]
    if only is not None and only not in references:
        return
    file, size = open_at(path)
    with file:
        if first is not None:
            blocks = Blocks(file, size, first >> 16)
            blocks.fill((first & 0xFFFF) + 1)
            blocks.taken += first & 0xFFFF
        else:
            blocks = _entered(file, size, len(references), start, size if end is None else end, _skipped(header))
        wanted = READ_BYTES
        while blocks is not None:
            more = blocks.fill(wanted)
            raw = bytes(memoryview(blocks.held)[blocks.taken :])
            at, begins = 0, []
            while at + 4 <= len(raw) and (step := 4 + int.from_bytes(raw[at : at + 4], "little")) <= len(raw) - at:
                begins.append(at)
                at += step
            own = np.array(begins, dtype=np.int64)
            files, held = np.array(blocks.places or [(0, 0)], dtype=np.int64).T
            which = np.searchsorted(held, blocks.taken + own, side="right") - 1
            offset = files[which] << 16 | blocks.taken + own - held[which]
            over = np.zeros(len(own), dtype=bool)
            if end is not None:
                over |= offset >> 16 >= end
            if stop is not None:
                over |= offset >= stop
            ended = bool(over.any())
            if not more and not ended and at + 4 <= len(raw):
                raise ValueError(f"{path}: the last record is cut off")
            use = ~over
            if ended:
                use[int(over.argmax()) :] = False
            ends = np.r_[own[1:], at][: len(own)]
            data = np.frombuffer(raw, dtype=np.uint8)
            if only is not None:
                use &= _field(data, own + 4, "<i4") == references.index(only)
            if use.any():
                yield _batch_at(raw, data, own[use], ends[use], offset[use], references, ordinal)
            if ended or not more:
                return
            blocks.taken += at
            # a record may be larger
            wanted = READ_BYTES if begins else 2 * len(raw)


def _batch_at(raw: bytes, data: np.ndarray, at: np.ndarray, ends: np.ndarray, offset: np.ndarray, references: list[str], ordinal: int) -> pa.RecordBatch:
    """Records that begin and end at these places of the unpacked bytes."""
    ref, pos, bases, next_ref, pnext, tlen = (_field(data, at + skip, "<i4").astype(np.int64) for skip in (4, 8, 20, 24, 28, 32))
    name, mapq = data[at + 12].astype(np.int64), data[at + 13]
    ops, flag = (_field(data, at + skip, "<u2").astype(np.int64) for skip in (16, 18))
    cigar_at = at + 36 + name
    seq_at = cigar_at + 4 * ops
    qual_at = seq_at + (bases + 1) // 2
    tags_at = qual_at + bases

    def steps(own: np.ndarray) -> np.ndarray:
        return np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)

    def texts(letters: np.ndarray, own: np.ndarray) -> pa.Array:
        """letters of texts of these sizes, * for those of none."""
        out = np.full(int(np.maximum(own, 1).sum()), ord("*"), dtype=np.uint8)
        out[np.repeat(np.cumsum(np.maximum(own, 1)) - np.maximum(own, 1), own) + steps(own)] = letters
        return batches.strings(out, np.maximum(own, 1))

    known = np.where((bases > 0) & (data[np.minimum(qual_at, len(data) - 1)] != 255), bases, 0)
    names = data[np.repeat(at + 36, np.maximum(name - 1, 0)) + steps(np.maximum(name - 1, 0))]
    quality = data[np.repeat(qual_at, known) + steps(known)]
    if (name < 1).any() or (tags_at > ends).any() or names.max(initial=0) > 127 or quality.max(initial=0) > 94:
        # letters beyond ASCII, or no record of the format
        rows = [_record(references, ordinal, int(o), raw[a + 4 : e]) for o, a, e in zip(offset.tolist(), at.tolist(), ends.tolist(), strict=True)]
        *plain, tags, types = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, k) for c, k in zip([*plain, *([list(m.items()) for m in c] for c in (tags, types))], ARROW.types, strict=True)], schema=ARROW)
    step = steps(bases)
    pair = data[np.repeat(seq_at, bases) + step // 2]
    letters = BASES[np.where(step % 2, pair & 15, pair >> 4)]
    cigars = [_cigar(raw[a:b]) for a, b in zip(cigar_at.tolist(), seq_at.tolist(), strict=True)]
    coded = pa.array([raw[a:b] for a, b in zip(tags_at.tolist(), ends.tolist(), strict=True)], pa.binary()).dictionary_encode()
    told = [_tags(x) for x in coded.dictionary.to_pylist()]
    maps = [pa.array([list(x[k].items()) for x in told], ARROW.types[-1]).take(coded.indices) for k in (0, 1)]
    of = pa.array([*references, "*", "="], pa.string())
    mate = np.where(next_ref < 0, len(references), np.where(next_ref == ref, len(references) + 1, next_ref))
    idx = (ordinal << BLOCK_BITS | offset >> 16) << PLACE_BITS | (offset & 0xFFFF) >> SPARED_BITS
    small = [pa.array(x, pa.int32()) for x in (flag, pos, mapq, pnext, tlen)]
    columns = [pa.array(idx, pa.int64()), batches.strings(names, name - 1), small[0], of.take(pa.array(ref, mask=ref < 0)), small[1], small[2], pa.array(cigars, pa.string()), of.take(pa.array(mate)), small[3], small[4]]
    return pa.record_batch([*columns, texts(letters, bases), texts(quality + 33, known), *maps], schema=ARROW)


class BamReader(DataSourceReader):
    """Ranges of blocks of each file, of all references or of one between two positions.

    Where an index lies beside a file, only ranges that it names for them are opened; elsewhere all blocks
    are read, and records of other references are left out. Spark applies all filters again.
    """

    def __init__(self, paths: list[str], split: int = SPLIT_BYTES, reach: int | None = None, only: str | None = None, until: int = 1 << 29):
        self.paths, self.split, self.only = paths, split, only
        #: positions from .. to (not itself) that records begin at; `reach` instead of `low` for records that end behind it
        self.low, self.high, self.reach = 0, until, reach

    def _ranges(self, path: str) -> list[tuple[int, int]] | None:
        """Virtual offsets of what is wanted, by the file's index; None without one."""
        index = bam_index.load(path) if self.only is not None else None
        if index is None:
            return None
        names = [name for name, _ in bam_header(path)[1]]
        if self.only not in names:
            return []
        return index.ranges(names.index(self.only), self.low if self.reach is None else self.reach, self.high)

    def partitions(self) -> list[InputPartition]:
        out = []
        for ordinal, path in enumerate(self.paths):
            file, size = open_at(path)
            file.close()
            named = self._ranges(path)
            if named is None:
                out += [(path, ordinal, start, min(start + self.split, size), None, None) for start in range(0, max(size, 1), self.split)]
                continue
            for low, high in named:
                cuts = [*range(low >> 16, max((high >> 16) + 1, (low >> 16) + 1), self.split), (high >> 16) + 1]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    out.append((path, ordinal, a, b, low if a == low >> 16 else None, high))
        # a source without any partition is none that Spark plans
        return [InputPartition(p) for p in out or [(self.paths[0], 0, 0, 0, None, 0)]]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path, ordinal, start, end, first, stop = partition.value
        if start < end:
            yield from bam_records(path, self.only, ordinal, start, end, first, stop)


class PushedBamReader(BamReader):
    """Takes over a filter on one reference, and bounds of the position."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("rname",):
                self.only = f.value
            elif getattr(f, "attribute", None) == ("pos",):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.low = max(self.low, int(f.value) + isinstance(f, GreaterThan))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.high = min(self.high, int(f.value) + (not isinstance(f, LessThan)))
            yield f


class InBatches:
    """A reader's records as record batches, which Spark takes over without looking at each."""

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, ordinal, start, end, first, stop = partition.value
        if start < end:
            yield from bam_batches(path, self.only, ordinal, start, end, first, stop)


class BatchReader(InBatches, BamReader):
    pass


class PushedBatchReader(InBatches, PushedBamReader):
    pass


class BamSource(DataSource):
    """`bam`: options path, files by commas or wild cards; split, the bytes of a file that one task reads; push, whether filters are taken over.

    Of one reference only: only, its name; reach, a position that records must end behind; until, one that they begin before.
    """

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:
        kind = PushedBatchReader if self.options.get("push") == "true" else BatchReader
        bounds = {k: int(self.options[k]) for k in ("reach", "until") if self.options.get(k) is not None}
        return kind(listed(self.options["path"]), int(self.options.get("split", SPLIT_BYTES)), only=self.options.get("only"), **bounds)


def bam(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("path", path).option("split", split).option("push", pushes(spark)).load()


def fetched(spark: SparkSession, path: str, rname: str, start: int = 0, end: int | None = None, split: int = SPLIT_BYTES) -> DataFrame:
    """Records that overlap [start, end) of a reference; where an index lies beside the file, only blocks that can hold them are read."""
    spark.dataSource.register(BamSource)
    bounds = {"reach": start} | ({} if end is None else {"until": end})
    rows = spark.read.format("bam").options(path=path, split=split, push=pushes(spark), only=rname, **bounds).load()
    rows = rows.where((F.col("rname") == rname) & (F.greatest(reference_end(F.col("pos"), F.col("cigar")), F.col("pos") + 1) > start))
    return rows if end is None else rows.where(F.col("pos") < end)


MATE = "struct<rname:string,pos:int,aend:int,reverse:boolean,blocks:array<struct<start:int,end:int>>>"
PAIR_SCHEMA = f"qname string, m1 {MATE}, m2 {MATE}"
_OPS = re.compile(r"(\d+)([MIDNSHP=X])")


def grouped_by_name(path: str) -> bool:
    """Whether a BAM file's header says that records of one name follow each other."""
    first = bam_header(path)[0].split("\n", 1)[0].split("\t")
    return first[0] == "@HD" and bool({"SO:queryname", "GO:query"} & set(first))


def name_runs(path: str, start: int, end: int) -> Iterator[list[tuple]]:
    """Records of one name that follow each other, for the names of a range of blocks.

    A range leaves its first name to the range before it, which goes on behind its own end until the
    name of the first record there is complete. So a name that goes over a border, or over a whole
    range, is one run of one range.
    """
    run: list[tuple] = []
    foreign, last = start > 0, False
    for record in bam_records(path, start=start):
        if run and record[1] != run[0][1]:
            if not foreign:
                yield run
            if last:
                return
            run, foreign = [], False
        run.append(record)
        last = last or record[0] >> PLACE_BITS >= end
    if run and not foreign:
        yield run


def mate_of(record: tuple) -> tuple:
    """A record as MATE says."""
    at, blocks = record[4], []
    for number, op in _OPS.findall(record[6]):
        if op in "MDN=X":
            if op == "M":
                blocks.append((at, at + int(number)))
            at += int(number)
    return record[3], record[4], at, bool(record[2] & REVERSE), blocks


#: Unpacked bytes whose records are paired at once.
PAIRED_BYTES = 1 << 22


def _name_begins(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which records, of names data[at : at + sizes], have another name than the one before."""
    other = np.diff(sizes, prepend=-1) != 0
    same = np.flatnonzero(~other)
    if len(same):
        own = sizes[same]
        begin = np.cumsum(own) - own
        step = np.arange(own.sum()) - np.repeat(begin, own)
        differs = data[np.repeat(at[same], own) + step] != data[np.repeat(at[same - 1], own) + step]
        other[same] = np.bitwise_or.reduceat(differs, begin)
    return other


@lru_cache(1 << 14)
def _shape(ops: bytes) -> tuple[int, list[tuple[int, int]]]:
    """Where a CIGAR's reference ends, and its blocks, from its begin."""
    *_, at, _, blocks = mate_of((0, "", 0, None, 0, 0, _cigar(ops)))
    return at, blocks


def _mates(data: np.ndarray, at: np.ndarray, names: pa.Array) -> pa.StructArray:
    """Records that begin at these places, as MATE says."""
    ref, pos = (_field(data, at + skip, "<i4") for skip in (4, 8))
    begin, ops = at + 36 + data[at + 12], _field(data, at + 16, "<u2").astype(np.int64)
    shapes = [_shape(data[a : a + 4 * n].tobytes()) for a, n in zip(begin.tolist(), ops.tolist(), strict=True)]
    sizes = np.array([len(b) for _, b in shapes], dtype=np.int64)
    edges = np.array([e for _, b in shapes for e in b], dtype=np.int64).reshape(-1, 2) + np.repeat(pos.astype(np.int64), sizes)[:, None]
    edges = pa.StructArray.from_arrays([pa.array(edges[:, k], pa.int32()) for k in (0, 1)], ["start", "end"])
    blocks = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), edges)
    ends = pa.array(pos + np.array([span for span, _ in shapes], dtype=np.int64), pa.int32())
    reverse = pa.array((_field(data, at + 18, "<u2") & REVERSE) != 0)
    return pa.StructArray.from_arrays([names.take(pa.array(ref, mask=ref < 0)), pa.array(pos, pa.int32()), ends, reverse, blocks], ["rname", "pos", "aend", "reverse", "blocks"])


def _field(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    return data[at[:, None] + np.arange(np.dtype(kind).itemsize)].view(kind)[:, 0]


def _pairs_at(data: np.ndarray, at: np.ndarray, begins: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """Pairs among the records that begin at these places and whose names begin at the records `begins`."""
    sizes = np.diff(np.r_[begins, len(at)])
    one = begins[sizes == 2]
    flags = [_field(data, at[k] + 18, "<u2") for k in (one, one + 1)]
    first, second = ([(f & bit) != 0 for f in flags] for bit in (FIRST, SECOND))
    use = (first[0] != first[1]) & (second[0] != second[1])
    one, led, seconds = one[use], first[0][use], second[0][use]
    start, size = at[one] + 36, data[at[one] + 12].astype(np.int64) - 1
    qname = pa.array([data[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist(), strict=True)], pa.binary()).cast(pa.string())
    mates = [_mates(data, at[np.where(k, one, one + 1)], names) for k in (led, seconds)]
    return pa.record_batch([qname, *mates], names=["qname", "m1", "m2"])


def paired(path: str, start: int, end: int, at_once: int = PAIRED_BYTES) -> Iterator[pa.RecordBatch]:
    """What name_runs and mate_of tell of a range, for all records of some unpacked bytes at once."""
    header = bam_header(path)[1]
    names = pa.array([name for name, _ in header], pa.string())
    file, size = open_at(path)
    with file:
        blocks = _entered(file, size, len(header), start, end, _skipped(header))
        foreign, wanted = start > 0, at_once
        while blocks is not None:
            more = blocks.fill(wanted)
            raw = bytes(memoryview(blocks.held)[blocks.taken :])
            at, places = 0, []
            while at + 4 <= len(raw) and (step := 4 + int.from_bytes(raw[at : at + 4], "little")) <= len(raw) - at:
                places.append(at)
                at += step
            if not more and at + 4 <= len(raw):
                raise ValueError(f"{path}: the last record is cut off")
            data, own = np.frombuffer(raw, dtype=np.uint8), np.array(places, dtype=np.int64)
            begins = np.flatnonzero(_name_begins(data, own + 36, data[own + 12].astype(np.int64))) if places else own
            whole = len(begins) - more
            if more and whole < 1:
                # a name may go on
                wanted = 2 * len(raw)
                continue
            # the name of the first record behind the range is its last
            border = min((held for block, held in blocks.places if block >= end), default=len(blocks.held)) - blocks.taken
            behind = int(np.searchsorted(own, border))
            last = int(np.searchsorted(begins, behind, side="right")) - 1 if behind < len(own) else whole
            used = min(whole, last + 1)
            stop = begins[used] if used < len(begins) else len(own)
            runs = begins[int(foreign) : used]
            if len(runs):
                yield _pairs_at(data, own[runs[0] : stop], runs - runs[0], names)
            if not more or last < whole:
                return
            blocks.taken += int(own[begins[whole]])
            foreign, wanted = False, at_once


class PairReader(DataSourceReader):
    def __init__(self, paths: list[str], split: int):
        self.paths, self.split = paths, split

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            file, size = open_at(path)
            file.close()
            out += [InputPartition((path, start, min(start + self.split, size))) for start in range(0, max(size, 1), self.split)]
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for run in name_runs(*partition.value):
            first, second = ([r for r in run if r[2] & bit] for bit in (FIRST, SECOND))
            if len(run) == 2 and len(first) == len(second) == 1:
                yield run[0][1], mate_of(first[0]), mate_of(second[0])


class BatchPairReader(PairReader):
    """The same as record batches."""

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from paired(*partition.value)


class PairSource(DataSource):
    """`bam_pairs`: options path, files by commas or wild cards whose records are grouped by name, and split."""

    @classmethod
    def name(cls) -> str:
        return "bam_pairs"

    def schema(self) -> str:
        return PAIR_SCHEMA

    def reader(self, schema) -> PairReader:
        return BatchPairReader(listed(self.options["path"]), int(self.options.get("split", SPLIT_BYTES)))


def bam_pairs(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    """One row for each name that has exactly one first and one second mate, of files grouped by name; no shuffle.

    A file whose header does not say that it is grouped is an error. A name is looked for in one file only.
    """
    for one in listed(path):
        if not grouped_by_name(one):
            raise ValueError(f"{one}: its header does not say that records are grouped by name")
    spark.dataSource.register(PairSource)
    return spark.read.format("bam_pairs").option("path", path).option("split", split).load()
