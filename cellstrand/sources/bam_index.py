"""The index of a coordinate-sorted BAM file: bins, linear index and virtual offsets, written beside the file as `.bai`.

A virtual offset is the place of a block in the file and a place in the unpacked block, as one number.
Every record lies in the smallest bin of a five-level scheme that holds all of it; a bin has chunks of
the file, from one virtual offset to another. The linear index has, for each window of 16,384 bases,
where the first record that reaches into it begins. All of it is bounded by the length of the
references and the number of the file's parts, not by the number of records: chunks of a bin that are
less than a block apart are one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from cellstrand.sources.files import file_system, open_input

# Fixed values of the file format.
MAGIC = b"BAI\x01"
WINDOW_BITS, LEVELS = 14, 5
#: First bin of each level, from the whole reference down.
FIRST_BIN = [(8**level - 1) // 7 for level in range(LEVELS + 1)]

#: Columns of an index in pieces; offsets are virtual. `bin` is null in rows of the linear index, `window` in those of bins.
SCHEMA = "ref int, bin int, window int, low long, high long"


def bins_of_records(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest bin that holds each [start, end)."""
    out = np.zeros(len(start), dtype=np.int64)
    for level in range(1, LEVELS + 1):
        shift = WINDOW_BITS + 3 * (LEVELS - level)
        inside = start >> shift == (end - 1) >> shift
        out[inside] = FIRST_BIN[level] + (start[inside] >> shift)
    return out


def bins_over(start: int, end: int) -> Iterator[int]:
    """All bins that can hold a record that overlaps [start, end)."""
    for level in range(LEVELS + 1):
        shift = WINDOW_BITS + 3 * (LEVELS - level)
        yield from range(FIRST_BIN[level] + (start >> shift), FIRST_BIN[level] + ((end - 1) >> shift) + 1)


def _joined(chunks: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Chunks in order, those that are less than a block apart put together."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(chunks):
        if out and low >> 16 <= (out[-1][1] >> 16) + 0xFFFF:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def piece(ref: np.ndarray, start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """The index of some records in file order, by SCHEMA; records without a reference (-1) have none."""
    placed = ref >= 0
    ref, start, end, low, high = (x[placed] for x in (ref, start, end, low, high))
    rows: list[tuple[int, int | None, int | None, int, int]] = []
    bins = bins_of_records(start, np.maximum(end, start + 1))
    order = np.lexsort((low, bins, ref))
    cuts = np.flatnonzero(np.r_[True, (np.diff(ref[order]) != 0) | (np.diff(bins[order]) != 0)]) if len(order) else np.empty(0, dtype=np.int64)
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[a:b]
        rows += [(int(ref[own[0]]), int(bins[own[0]]), None, x, y) for x, y in _joined(zip(low[own].tolist(), high[own].tolist(), strict=True))]
    first: dict[tuple[int, int], int] = {}
    windows = zip(ref.tolist(), (start >> WINDOW_BITS).tolist(), ((np.maximum(end, start + 1) - 1) >> WINDOW_BITS).tolist(), low.tolist(), strict=True)
    for r, w, last, offset in windows:
        for k in range(w, last + 1):
            if offset < first.get((r, k), 1 << 63):
                first[r, k] = offset
    rows += [(r, None, w, offset, offset) for (r, w), offset in first.items()]
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["ref", "bin", "window", "low", "high"])


class Index:
    """Bins and windows of each reference."""

    def __init__(self, references: int):
        self.bins: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(references)]
        self.windows: list[dict[int, int]] = [{} for _ in range(references)]
        self.unplaced = 0

    def add(self, rows: Iterable[tuple[int, int | None, int | None, int, int]]) -> None:
        """Rows of `piece` with offsets of the whole file."""
        for ref, of_bin, window, low, high in rows:
            if window is None:
                self.bins[ref].setdefault(of_bin, []).append((low, high))
            else:
                self.windows[ref][window] = min(low, self.windows[ref].get(window, low))

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<i", len(self.bins))]
        for bins, windows in zip(self.bins, self.windows, strict=True):
            out.append(struct.pack("<i", len(bins)))
            for k in sorted(bins):
                chunks = _joined(bins[k])
                out.append(struct.pack("<Ii", k, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks))
            count = max(windows, default=-1) + 1
            offsets = np.zeros(count, dtype="<u8")
            for w, offset in windows.items():
                offsets[w] = offset
            # a window that no record reaches into has what the one before it has
            out.append(struct.pack("<i", count) + np.maximum.accumulate(offsets).tobytes())
        return b"".join([*out, struct.pack("<Q", self.unplaced)])

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        if data[:4] != MAGIC:
            raise ValueError("not an index of a BAM file")
        (count,), at = struct.unpack_from("<i", data, 4), 8
        out = cls(count)
        for ref in range(count):
            (bins,), at = struct.unpack_from("<i", data, at), at + 4
            for _ in range(bins):
                k, chunks = struct.unpack_from("<Ii", data, at)
                ends = struct.unpack_from(f"<{2 * chunks}Q", data, at + 8)
                at += 8 + 16 * chunks
                # bins beyond the scheme hold other writers' statistics
                if k < (8 ** (LEVELS + 1) - 1) // 7:
                    out.bins[ref][k] = list(zip(ends[::2], ends[1::2], strict=True))
            (windows,), at = struct.unpack_from("<i", data, at), at + 4
            out.windows[ref] = dict(enumerate(struct.unpack_from(f"<{windows}Q", data, at)))
            at += 8 * windows
        if at + 8 <= len(data):
            (out.unplaced,) = struct.unpack_from("<Q", data, at)
        return out

    def ranges(self, ref: int, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
        """Ranges of virtual offsets that hold every record of a reference that overlaps [start, end)."""
        own, start = self.bins[ref], max(0, start)
        if end is None:
            end = (max(self.windows[ref], default=0) + 1) << WINDOW_BITS
        if end <= start:
            return []
        least = self.windows[ref].get(start >> WINDOW_BITS, 0)
        chunks = [c for k in bins_over(start, end) for c in own.get(k, ())]
        return _joined((max(low, least), high) for low, high in chunks if high > least)


def index_path(path: str) -> str | None:
    """The index that lies beside a file, if one does."""
    fs, inner = file_system(path)
    for there, url in ((f"{inner}.bai", f"{path}.bai"), (f"{inner.removesuffix('.bam')}.bai", f"{path.removesuffix('.bam')}.bai")):
        if fs.get_file_info(there).type == pafs.FileType.File:
            return url
    return None


def load(path: str) -> Index | None:
    """The index beside a BAM file; None if there is none."""
    own = index_path(path)
    if own is None:
        return None
    with open_input(own) as data:
        return Index.from_bytes(data.read())


def save(index: Index, path: str) -> None:
    """Write the index of the BAM file at path beside it."""
    fs, inner = file_system(path)
    with fs.open_output_stream(f"{inner}.bai", compression=None) as out:
        out.write(index.to_bytes())


def build(spark: SparkSession, path: str, split: int) -> Index:
    """Index a BAM file that is sorted by coordinate, its ranges of blocks in parallel, and write it beside the file.

    A file that is not sorted is an error.
    """
    from cellstrand.sources.alignments import bam_header, open_at, places

    references = bam_header(path)[1]
    file, size = open_at(path)
    file.close()
    starts = [(k, k * split, min((k + 1) * split, size)) for k in range(-(-size // split))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = np.array(list(places(path, start, end)), dtype=np.int64).reshape(-1, 5)
                ref = np.where(found[:, 0] < 0, np.int64(1) << 40, found[:, 0])
                keys = list(zip(ref.tolist(), found[:, 1].tolist(), strict=True))
                if any(a > b for a, b in zip(keys, keys[1:], strict=False)):
                    raise ValueError(f"{path} is not sorted by coordinate")
                own = piece(*found.T)
                # a range's first and last place, for the order between ranges, and what it has without a reference
                told = [(int(ref[k]), None, None, int(found[k, 1]), int((found[:, 0] < 0).sum())) for k in (0, -1)] if len(found) else []
                rows = own.to_pylist()
                yield pa.record_batch(
                    [pa.array([nth] * (len(rows) + len(told)), pa.int32()), *(pa.array([r[c] for r in rows] + [t[j] for t in told], kind) for j, (c, kind) in enumerate((("ref", pa.int64()), ("bin", pa.int32()), ("window", pa.int32()), ("low", pa.int64()), ("high", pa.int64()))))],
                    names=["nth", "ref", "bin", "window", "low", "high"],
                )

    ranges: DataFrame = spark.createDataFrame(starts, "nth int, start long, end long").repartition(max(1, len(starts)), "nth")
    rows = ranges.mapInArrow(run, "nth int, ref long, bin int, window int, low long, high long").collect()
    index = Index(len(references))
    index.add((r.ref, r.bin, r.window, r.low, r.high) for r in rows if r.bin is not None or r.window is not None)
    ends: dict[int, list] = {}
    for r in rows:
        if r.bin is None and r.window is None:
            ends.setdefault(r.nth, []).append(((r.ref, r.low), r.high))
    order = [ends[k] for k in sorted(ends)]
    if any(a[1][0] > b[0][0] for a, b in zip(order, order[1:], strict=False)):
        raise ValueError(f"{path} is not sorted by coordinate")
    index.unplaced = sum(x[0][1] for x in order)
    save(index, path)
    return index
