"""FASTA references as windows of their contigs.

A first pass finds the title lines, ranges of bytes in parallel; from them, and the length of a contig's
first line, follows where every base stands, so that tasks read windows from anywhere in a file. Lines
of a contig but the last must be equally long; where they are not, reading is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cellstrand.sources.files import listed, open_at

#: Bases of a window, and windows that a task reads at once.
WINDOW, RUN = 1 << 14, 64
SPLIT_BYTES = 64 << 20
#: A longer reference is not broadcast.
BROADCAST_BYTES = 64 << 20
#: Longest title line.
TITLE_BYTES = 1 << 16


@dataclass(frozen=True)
class Contig:
    """Where a contig's bases are: the first one's place in the file, bases, bases of a line, bytes of a line."""

    path: str
    name: str
    begin: int
    size: int
    bases: int
    width: int

    def read(self, start: int, end: int) -> str:
        """Bases [start, end), in capitals."""
        end = min(end, self.size)
        if end <= start:
            return ""

        def place(k: int) -> int:
            return self.begin + k // self.bases * self.width + k % self.bases

        file, _ = open_at(self.path)
        with file:
            file.seek(place(start))
            raw = file.read(place(end - 1) + 1 - place(start))
        own = raw.replace(b"\n", b"").replace(b"\r", b"")
        if len(own) != end - start or b">" in own:
            raise ValueError(f"{self.path}: lines of {self.name} are not equally long")
        return own.decode("ascii").upper()


def _titles(path: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """(begin, end, name) of the title lines that begin in a range of bytes."""
    base = max(0, start - 1)
    file, _ = open_at(path)
    with file:
        file.seek(base)
        data = file.read(end - base)
        # a title follows on a line end, or begins the file
        begins = [m.start() + 1 for m in re.finditer(rb"\n>", data)]
        if start == 0 and data.startswith(b">"):
            begins.insert(0, 0)
        for at in begins:
            stop = data.find(b"\n", at)
            if stop < 0:
                file.seek(base + at)
                line = file.read(TITLE_BYTES).split(b"\n")[0]
            else:
                line = data[at:stop]
            yield base + at, base + at + len(line) + 1, (line[1:].decode().split(None, 1) or [""])[0]


def contigs(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> list[Contig]:
    """The contigs of files (by commas or wild cards), in order; a few numbers of each reach the driver."""
    every = []
    for one in listed(path):
        file, size = open_at(one)
        with file:
            if file.read(2) == b"\x1f\x8b":
                raise ValueError(f"{one}: a packed reference cannot be read in windows")
        every += [(one, start, min(start + split, size), size) for start in range(0, size, split)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in batch.column(0).to_pylist():
                found = list(_titles(*every[nth][:3]))
                yield pa.record_batch([pa.array([nth] * len(found), pa.int64()), *(pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string())))], names=["nth", "title", "begin", "name"])

    if not every:
        return []
    rows = sorted(map(tuple, spark.range(0, len(every), 1, len(every)).mapInArrow(run, "nth long, title long, begin long, name string").collect()))
    out = []
    for k, (nth, _, begin, name) in enumerate(rows):
        one, size = every[nth][0], every[nth][3]
        end = rows[k + 1][1] if k + 1 < len(rows) and every[rows[k + 1][0]][0] == one else size
        file, _ = open_at(one)
        with file:
            file.seek(begin)
            head = file.read(min(end - begin, 1 << 20))
            file.seek(max(begin, end - 4))
            tail = file.read(min(4, end - begin))
        line, _, more = head.partition(b"\n")
        width = len(line) + 1 if more or head.endswith(b"\n") else len(head) + 1
        bases = len(line.rstrip(b"\r"))
        ends = width - bases
        held = end - begin - (len(tail) - len(tail.rstrip(b"\r\n")))
        out.append(Contig(one, name, begin, held // width * bases + min(held % width, bases) if bases else 0, max(bases, 1), max(width, ends, 1)))
    return out


def windows(spark: SparkSession, path: str, window: int = WINDOW, split: int = SPLIT_BYTES) -> DataFrame:
    """(rname, window, bases) of all contigs of FASTA files."""
    known = contigs(spark, path, split)
    runs = [(k, first) for k, c in enumerate(known) for first in range(0, -(-c.size // window), RUN)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in batch.column(0).to_pylist():
                k, first = runs[nth]
                own = known[k]
                bases = own.read(first * window, (first + RUN) * window)
                cut = [bases[p : p + window] for p in range(0, len(bases), window)]
                yield pa.record_batch([pa.array([own.name] * len(cut), pa.string()), pa.array(range(first, first + len(cut)), pa.int64()), pa.array(cut, pa.string())], names=["rname", "window", "bases"])

    found = spark.range(0, len(runs), 1, max(1, len(runs))).mapInArrow(run, "rname string, window long, bases string")
    # the optimizer knows the number of runs and not their bases
    return found if sum(c.size for c in known) <= BROADCAST_BYTES else found.hint("merge")
