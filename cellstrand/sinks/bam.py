"""BAM files: records with typed tags, parts of whole blocks written by tasks, coordinate order with an index."""

from __future__ import annotations

import io
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.functions import batches
from cellstrand.session import qualified
from cellstrand.sinks.files import NUMBER, TEXT_TAGS, joined, remove
from cellstrand.sources import bam_index
from cellstrand.sources.alignments import BASE_LETTERS, CIGAR_LETTERS, TAG_NUMBERS
from cellstrand.sources.files import file_system, make_folder

COLUMNS = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual", "tags", "tag_types"]


@lru_cache(1 << 14)
def tag_bytes(tag: str, value: str, kind: str | None) -> bytes:
    """A tag as the format stores it: A, f, Z, H, B and the integers c C s S i I by their type; without a type, numbers are integers and all else is text."""
    if kind is None:
        kind = "i" if tag not in TEXT_TAGS and re.match(NUMBER, value) else "Z"
    head = tag.encode() + kind.encode()
    if kind in "ZH":
        return head + value.encode() + b"\0"
    if kind == "A":
        return head + value.encode("latin-1")
    if kind == "f":
        return head + struct.pack("<f", float(value))
    if kind == "B":
        inner, *values = value.split(",")
        numbers = [float(v) if inner == "f" else int(v) for v in values]
        return head + inner.encode() + struct.pack(f"<i{len(numbers)}{TAG_NUMBERS[inner]}", len(numbers), *numbers)
    number = int(value)
    if kind == "i" and number >= 1 << 31:
        # text files have one letter for all integers
        return tag.encode() + b"I" + struct.pack("<I", number)
    return head + struct.pack(f"<{TAG_NUMBERS[kind]}", number)


@lru_cache(1 << 14)
def _ops(cigar: str) -> tuple[int, ...]:
    return tuple((int(n) << 4) | CIGAR_LETTERS.index(op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar))


@lru_cache(1 << 14)
def _span(ops: tuple[int, ...]) -> int:
    return sum(n >> 4 for n in ops if CIGAR_LETTERS[n & 15] in "MDN=X")


def reference_end(pos: int, ops: Sequence[int]) -> int:
    """Where a record ends on its reference; it has one base at least."""
    return max(pos + 1, pos + _span(tuple(ops)))


def bam_record(references: dict[str, int], qname: str, flag: int, rname: str | None, pos: int, mapq: int, cigar: str, rnext: str, pnext: int, tlen: int, seq: str, qual: str, tags: dict[str, str], tag_types: dict[str, str] | None = None) -> bytes:
    ops = _ops(cigar)
    ref = references.get(rname, -1) if rname else -1
    next_ref = ref if rnext == "=" else references.get(rnext, -1)
    bases = "" if seq == "*" else seq
    codes = [max(BASE_LETTERS.find(b), 0) if b in BASE_LETTERS else 15 for b in bases.upper()]
    half = bytes((a << 4) | b for a, b in zip(codes[::2], [*codes[1::2], 0], strict=False))
    quality = b"\xff" * len(bases) if qual == "*" else bytes(ord(q) - 33 for q in qual)
    types = tag_types or {}
    more = b"".join(tag_bytes(tag, value, types.get(tag)) for tag, value in tags.items())
    name = qname.encode() + b"\0"
    place = index_bin(pos, reference_end(pos, ops))
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), mapq, place, len(ops), flag, len(bases), next_ref, pnext, tlen) + name + struct.pack(f"<{len(ops)}I", *ops) + half + quality + more
    return struct.pack("<i", len(body)) + body


#: The four bits of a base by its letter, in either case; 15 for other letters.
BASE_CODES = np.array([BASE_LETTERS.find(c) if (c := chr(b).upper()) in BASE_LETTERS else 15 for b in range(128)] + [15] * 128, dtype=np.uint8)
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("next_ref", "<i4"), ("pnext", "<i4"), ("tlen", "<i4")])
PLAIN = ("qname", "flag", "pos", "mapq", "cigar", "pnext", "tlen", "seq", "qual")


class Records(NamedTuple):
    """Records of a batch one behind the other, and each one's size, reference, start and end."""

    data: np.ndarray
    sizes: np.ndarray
    ref: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _coded(column: pa.Array, of: Callable[[str | None], Any]) -> tuple[list, np.ndarray]:
    """What `of` makes of each distinct text, and which one a row has."""
    coded = column.dictionary_encode(null_encoding="encode")
    return [of(x) for x in coded.dictionary.to_pylist()], coded.indices.to_numpy()


def _tags_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tags without a type, where each row's begin, and their sizes."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    keys, values = (x.slice(offsets[0], offsets[-1] - offsets[0]) for x in (column.keys, column.items))
    entries, which = _coded(pc.binary_join_element_wise(keys, values, "\t"), lambda x: tag_bytes(*x.split("\t", 1), None))
    lengths = np.array([len(x) for x in entries], dtype=np.int64)
    data = np.frombuffer(b"".join(entries), dtype=np.uint8)
    begin, own = (np.cumsum(lengths) - lengths)[which], lengths[which]
    at = np.r_[0, np.cumsum(own)]
    flat = data[np.repeat(begin - at[:-1], own) + np.arange(at[-1])]
    known = np.asarray(column.is_valid())
    first = at[offsets[:-1] - offsets[0]]
    return flat, first, np.where(known, at[offsets[1:] - offsets[0]] - first, 0)


def bam_records(references: dict[str, int], batch: pa.RecordBatch) -> Records | None:
    """What bam_record makes of each row of COLUMNS; None where a row has what only that tells (types of tags, letters beyond ASCII, numbers that do not fit)."""
    of = {name: batch.column(name) for name in COLUMNS}
    if any(of[c].null_count for c in PLAIN) or of["tag_types"].null_count < len(batch) or of["tags"].items.null_count:
        return None
    texts = {c: batches.Texts(of[c]) for c in ("qname", "seq", "qual")}
    number = {c: of[c].to_numpy().astype(np.int64) for c in ("flag", "pos", "mapq", "pnext", "tlen")}
    name, seq, qual = texts["qname"], texts["seq"], texts["qual"]
    if not all(x.ascii for x in texts.values()) or name.sizes.max(initial=0) > 254 or any(((number[c] < 0) | (number[c] >= most)).any() for c, most in (("flag", 1 << 16), ("mapq", 256))):
        return None
    ops, which = _coded(of["cigar"], _ops)
    if any(len(x) >= 1 << 16 for x in ops):
        return None
    spans = np.array([_span(x) for x in ops], dtype=np.int64)[which]
    end = np.maximum(number["pos"] + 1, number["pos"] + spans)
    found, at = _coded(of["rname"], lambda x: references.get(x, -1) if x else -1)
    ref = np.array(found, dtype=np.int64)[at]
    found, at = _coded(of["rnext"], lambda x: -2 if x == "=" else references.get(x, -1))
    next_ref = np.array(found, dtype=np.int64)[at]
    next_ref = np.where(next_ref == -2, ref, next_ref)

    def is_star(x: batches.Texts) -> np.ndarray:
        return (x.sizes == 1) & (x.data[np.minimum(x.starts, len(x.data) - 1)] == ord("*"))

    bases = np.where(is_star(seq), 0, seq.sizes)
    unknown = is_star(qual)
    qualities = np.where(unknown, bases, qual.sizes)
    tags, tags_at, tags_size = _tags_of(of["tags"])
    cigars = np.frombuffer(b"".join(struct.pack(f"<{len(x)}I", *x) for x in ops), dtype=np.uint8)
    cigar_sizes = np.array([4 * len(x) for x in ops], dtype=np.int64)
    cigar_at, cigar_size = (np.cumsum(cigar_sizes) - cigar_sizes)[which], cigar_sizes[which]
    parts = np.array([np.full(len(batch), HEAD.itemsize), name.sizes + 1, cigar_size, (bases + 1) // 2, qualities, tags_size])
    sizes = parts.sum(axis=0)
    begin = np.cumsum(sizes) - sizes
    places = begin + np.cumsum(parts, axis=0) - parts
    out = np.zeros(int(sizes.sum()), dtype=np.uint8)

    def steps(own: np.ndarray) -> np.ndarray:
        return np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)

    def put(k: int, data: np.ndarray, at: np.ndarray, own: np.ndarray) -> None:
        step = steps(own)
        out[np.repeat(places[k], own) + step] = data[np.repeat(at, own) + step]

    head = np.zeros(len(batch), dtype=HEAD)
    last = end - 1
    place = np.zeros(len(batch), dtype=np.int64)
    for shift, first in reversed(BINS):
        place = np.where(number["pos"] >> shift == last >> shift, first + (number["pos"] >> shift), place)
    told = {"size": sizes - 4, "ref": ref, "name": name.sizes + 1, "bin": place & 0xFFFF, "ops": cigar_size // 4, "bases": bases, "next_ref": next_ref}
    for field in HEAD.names:
        head[field] = told[field] if field in told else number[field]
    out[begin[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(-1, HEAD.itemsize)
    put(1, name.data, name.starts, name.sizes)
    put(2, cigars, cigar_at, cigar_size)
    for odd in (0, 1):
        own = (bases + 1 - odd) // 2
        step = steps(own)
        out[np.repeat(places[3], own) + step] |= BASE_CODES[seq.data[np.repeat(seq.starts + odd, own) + 2 * step]] << (0 if odd else 4)
    known = np.where(unknown, 0, qualities)
    step = steps(known)
    letters = qual.data[np.repeat(qual.starts, known) + step]
    if len(letters) and letters.min() < 33:
        return None
    out[np.repeat(places[4], known) + step] = letters - 33
    blank = qualities - known
    out[np.repeat(places[4], blank) + steps(blank)] = 0xFF
    put(5, tags, tags_at, tags_size)
    return Records(out, sizes, ref, number["pos"], end)


#: Levels of the format's bins: bits of a bin's width, and the first bin's number.
BINS = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))


def index_bin(start: int, end: int) -> int:
    """Smallest bin of the format's five-level scheme that holds [start, end)."""
    last = end - 1
    for shift, first in BINS:
        if start >> shift == last >> shift:
            return (first + (start >> shift)) & 0xFFFF
    return 0


def packed_block(data: bytes) -> bytes:
    """One block of blocked gzip."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    content = deflate.compress(data) + deflate.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(content) + 25) + content + struct.pack("<II", zlib.crc32(data), len(data))


END_BLOCK = packed_block(b"")
BLOCK = 60_000


def header_blocks(head: str, references: Sequence[tuple[str, int]]) -> bytes:
    text = head.encode()
    start = b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(references))
    for name, size in references:
        start += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", size)
    return b"".join(packed_block(start[k : k + BLOCK]) for k in range(0, len(start), BLOCK))


class Part:
    """A part of a file while it is written: records in whole blocks, and where each begins."""

    def __init__(self, out: pa.NativeFile, begin: int = 0):
        self.out, self.held, self.done = out, io.BytesIO(), 0
        #: where each block begins in the file, `begin` being the first
        self.blocks = [begin]
        #: reference, start, end, place in the unpacked part of each record, one after the other
        self.records = array("q")
        self.n = self.unplaced = 0

    def add(self, record: bytes) -> None:
        ref, pos, name_size, _, _, ops = struct.unpack_from("<iiBBHH", record, 4)
        at = 36 + name_size
        self.records.extend((ref, pos, reference_end(pos, struct.unpack_from(f"<{ops}I", record, at)), self.done + self.held.tell()))
        self.n, self.unplaced = self.n + 1, self.unplaced + (ref < 0)
        self._hold(record)

    def add_all(self, records: Records) -> None:
        """The records of a batch, in order."""
        begin = self.done + self.held.tell() + np.cumsum(records.sizes) - records.sizes
        self.records.frombytes(np.column_stack([records.ref, records.start, records.end, begin]).astype(np.int64).tobytes())
        self.n, self.unplaced = self.n + len(begin), self.unplaced + int((records.ref < 0).sum())
        self._hold(records.data.tobytes())

    def _hold(self, data: bytes) -> None:
        self.held.write(data)
        if self.held.tell() >= BLOCK:
            data = self.held.getvalue()
            whole = len(data) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._put(data[k : k + BLOCK])
            self.held = io.BytesIO()
            self.held.write(data[whole:])

    def _put(self, data: bytes) -> None:
        block = packed_block(data)
        self.out.write(block)
        self.blocks.append(self.blocks[-1] + len(block))
        self.done += len(data)

    def close(self) -> None:
        if self.held.tell():
            self._put(self.held.getvalue())

    def index(self) -> pa.RecordBatch:
        found = np.array(self.records, dtype=np.int64).reshape(-1, 4)
        place = np.r_[found[:, 3], self.done]
        # all blocks but the last are full, so a place tells its block
        nth = np.minimum(place // BLOCK, len(self.blocks) - 1)
        ended = place == self.done
        nth[ended] = len(self.blocks) - 1
        offset = np.array(self.blocks, dtype=np.int64)[nth] << 16 | np.where(ended, 0, place % BLOCK)
        return bam_index.piece(found[:, 0], found[:, 1], found[:, 2], offset[:-1], offset[1:])


TOLD = f"part string, size long, n long, unplaced long, piece array<struct<{', '.join(c.replace(' ', ':') for c in bam_index.SCHEMA.split(', '))}>>"


def _written(alignments: DataFrame, references: Sequence[tuple[str, int]], folder: str, indexed: bool, whole: tuple[bytes, bytes] | None) -> list:
    """Write a part of each partition of alignments, as they are dealt and ordered; what the tasks tell of them, in order.

    With `whole`, the bytes before and behind it, each part is a file of its own.
    """
    number = {name: k for k, (name, _) in enumerate(references)}
    suffix = ".bgzf" if whole is None else ".bam"
    missing = [c for c in COLUMNS if c not in alignments.columns]
    rows = alignments.withColumns({c: F.lit(None).cast("map<string,string>") for c in missing if c == "tag_types"}).select(COLUMNS)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, (fs, inner) = TaskContext.get(), file_system(folder)
        name = f"part-{task.partitionId():06d}{suffix}"
        hidden = f"{inner}/.{name}.{task.taskAttemptId()}"
        begin, tail = whole or (b"", b"")
        with fs.open_output_stream(hidden, compression=None) as out:
            out.write(begin)
            part = Part(out, len(begin))
            for batch in given:
                if (made := bam_records(number, batch)) is not None:
                    part.add_all(made)
                    continue
                for *fields, tags, types in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    part.add(bam_record(number, *fields, dict(tags or ()), dict(types or ())))
            part.close()
            out.write(tail)
        fs.move(hidden, f"{inner}/{name}")
        pieces = part.index().to_pylist() if indexed else []
        if indexed and whole is not None:
            own = bam_index.Index(len(number))
            own.add(tuple(r.values()) for r in pieces)
            own.unplaced = part.unplaced
            bam_index.save(own, f"{folder}/{name}")
        kind = pa.struct([("ref", pa.int32()), ("bin", pa.int32()), ("window", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])
        told = {"part": [name], "size": [part.blocks[-1] + len(tail)], "n": [part.n], "unplaced": [part.unplaced]}
        yield pa.record_batch([pa.array(told["part"]), *(pa.array(told[c], pa.int64()) for c in ("size", "n", "unplaced")), pa.array([pieces if whole is None else []], pa.list_(kind))], names=[*told, "piece"])

    remove(folder)
    fs, inner = file_system(folder)
    fs.create_dir(inner, recursive=True)
    told = sorted(rows.mapInArrow(run, TOLD).collect(), key=lambda r: r.part)
    seen = {f.base_name: f.size for f in fs.get_file_info(pafs.FileSelector(inner)) if f.base_name.startswith("part-") and f.base_name.endswith(suffix)}
    if seen != {r.part: r.size for r in told}:
        raise OSError(f"{folder} holds {len(seen)} parts, but tasks have written {len(told)}: it is no folder that all machines share")
    return told


def bam(alignments: DataFrame, head: str, references: list[tuple[str, int]], path: str, single: bool = True, ordered: bool = False) -> None:
    """Records in order of idx as one BAM file; each task writes a part of whole blocks, and the parts are put behind each other.

    With ordered=True records are taken as they are dealt and ordered already, so that columns which follow from others need not be shuffled.

    With single=False `path` is a folder of BAM files in order, one of each task, and nothing passes through one machine.
    """
    _save(alignments if ordered else alignments.orderBy("idx"), head, references, path, False, single)


def sorted_bam(alignments: DataFrame, head: str, references: list[tuple[str, int]], path: str, single: bool = True) -> None:
    """Records by coordinate, in the order of the header's references, those without a reference last, with an index beside the file.

    Tasks sort ranges of (reference, position, idx), so records that share a place are spread too. The
    index is made while parts are written; a part's offsets are moved by the size of those before it.
    """
    order = alignments.sparkSession.createDataFrame([(name, k) for k, (name, _) in enumerate(references)], "rname string, ref_number int")
    # as many rows as the header has references
    placed = alignments.join(F.broadcast(order), "rname", "left")
    rows = placed.orderBy(F.asc_nulls_last("ref_number"), "pos", "idx")
    _save(rows, sorted_header(head), references, path, True, single)


def sorted_header(head: str) -> str:
    """The header, saying that records are sorted by coordinate."""
    lines = head.splitlines()
    if lines and lines[0].startswith("@HD"):
        fields = [f for f in lines[0].split("\t") if not f.startswith(("SO:", "GO:", "SS:"))]
        lines[0] = "\t".join([*fields, "SO:coordinate"])
    else:
        lines.insert(0, "@HD\tVN:1.6\tSO:coordinate")
    return "".join(f"{x}\n" for x in lines)


def _save(rows: DataFrame, head: str, references: list[tuple[str, int]], path: str, indexed: bool, single: bool) -> None:
    path = qualified(rows.sparkSession, path)
    start = header_blocks(head, references)
    if not single:
        _written(rows, references, path, indexed, (start, END_BLOCK))
        return
    folder = f"{path}.parts"
    told = _written(rows, references, folder, indexed, None)
    make_folder(path)
    joined(folder, path, start, ".bgzf", END_BLOCK)
    if indexed:
        # entries are bounded by the references' length, not by the records
        index, base = bam_index.Index(len(references)), len(start)
        for r in told:
            index.add((x.ref, x.bin, x.window, x.low + (base << 16), x.high + (base << 16)) for x in r.piece)
            index.unplaced += r.unplaced
            base += r.size
        bam_index.save(index, path)
