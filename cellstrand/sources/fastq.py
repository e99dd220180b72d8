"""FASTQ files, single or as triplets read in step, in ranges of bytes that many tasks read at once.

Plain files and blocked gzip can be entered anywhere: a range begins with the first record whose title
follows on a line end in the range, and ends with the record that begins behind it. A first pass counts
the records of each range, so that the number of every range's first record is known by a prefix sum
over the ranges. For triplets the ranges of the first file are the tasks; of the other two files a task
opens the range that holds the record of the same number, and skips what is before it. Other gzip files
can be read from their beginning only: such a file, or a set of three that has one, is one task.
"""

from __future__ import annotations

import io
import json
import zlib
from collections.abc import Iterator
from itertools import islice
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, LessThan, LessThanOrEqual

from cellstrand.session import pushes, shared_dir
from cellstrand.sources.alignments import Blocks, _block_size
from cellstrand.sources.files import file_system, listed, open_at, open_input, open_text

READ = "struct<id:string,desc:string,seq:string,qual:string>"
SCHEMA = "file string, idx bigint, id string, desc string, seq string, qual string"
ARROW = pa.schema([(name, pa.int64() if kind == "bigint" else pa.string()) for name, kind in (c.split(" ") for c in SCHEMA.split(", "))])
#: Bits of a record's number in its set of files.
SET_BITS = 40
PAIR_SCHEMA = f"idx bigint, r1 {READ}, r2 {READ}"
TRIPLET_SCHEMA = f"idx bigint, lig {READ}, umi {READ}, bio {READ}"
#: Bytes of a file that a task is laid out for.
SPLIT_BYTES = 64 << 20
#: Tasks of a pass over ranges; each reads several that follow each other where there are more.
MOST_TASKS = 256
#: Records that leave a reader at once.
BATCH = 4096
Record = tuple[str, str, str, str]


def _record(path: str, title: str, sequence: str, plus: str, quality: str) -> Record:
    """(id, description, sequence, qualities); the description is the whole title line."""
    if not title.startswith("@") or not plus.startswith("+") or len(sequence) != len(quality):
        raise ValueError(f"{path}: not a FASTQ record: {title[:60]!r}")
    name = title[1:]
    return (name.split(None, 1) or [""])[0], name, sequence, quality


def records(path: str) -> Iterator[Record]:
    """All records of a file, from its beginning."""
    with open_text(path) as lines:
        while title := lines.readline():
            if title.strip():
                yield _record(path, title.rstrip("\r\n"), *(lines.readline().rstrip("\r\n") for _ in range(3)))


def kind_of(path: str) -> str:
    """plain, blocked (gzip in blocks) or gzip."""
    file, size = open_at(path)
    with file:
        head = file.read(18)
    if _block_size(head):
        return "blocked"
    return "gzip" if head[:2] == b"\x1f\x8b" else "plain"


def file_ranges(path: str, split: int = SPLIT_BYTES) -> list[tuple[int, int]]:
    """Ranges of bytes that tasks can read a file in; one for a file that cannot be entered."""
    file, size = open_at(path)
    file.close()
    if kind_of(path) == "gzip":
        return [(0, size)]
    return [(start, min(start + split, size)) for start in range(0, max(size, 1), split)]


class _Range(io.RawIOBase):
    """Bytes of a file from a place on, unpacked; `limit` of them belong to the range, which is known at the latest when they are read."""

    def __init__(self, file: BinaryIO, size: int, start: int, end: int, blocked: bool):
        self.file, self.size, self.end, self.blocked = file, size, end, blocked
        self.at = Blocks.first_from(file, size, start) if blocked and start else start
        self.limit = None if blocked else end - start
        self.given, self.held = 0, memoryview(b"")
        file.seek(self.at)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        if not self.blocked:
            data = self.file.read(len(buffer))
            buffer[: len(data)] = data
            return len(data)
        while not self.held:
            if self.at >= self.end and self.limit is None:
                self.limit = self.given
            if self.at >= self.size:
                return 0
            head = self.file.read(18)
            step = _block_size(head)
            if step is None:
                raise ValueError("not a blocked gzip file")
            self.held = memoryview(zlib.decompress(self.file.read(step - 18)[:-8], -15))
            self.at += step
        n = min(len(buffer), len(self.held))
        buffer[:n] = self.held[:n]
        self.held = self.held[n:]
        self.given += n
        return n


def _lines_of_records(path: str, start: int, end: int) -> Iterator[tuple[bytes, bytes, bytes, bytes]]:
    """The four lines of each record whose title follows on a line end in the range, or begins the file.

    A title is a line with @ two lines before one with +: qualities may begin with @ too, but what
    stands two lines behind them is a sequence.
    """
    file, size = open_at(path)
    with file:
        raw = _Range(file, size, start, end, kind_of(path) == "blocked")
        lines = io.BufferedReader(raw, 1 << 18)
        at = len(lines.readline()) if start else 0
        ahead: list[bytes] = []
        if start:
            while True:
                while len(ahead) < 3 and (line := lines.readline()):
                    ahead.append(line)
                if len(ahead) < 3:
                    return
                if ahead[0].startswith(b"@") and ahead[2].startswith(b"+"):
                    break
                at += len(ahead.pop(0))
        while True:
            title = ahead.pop(0) if ahead else lines.readline()
            if not title or (raw.limit is not None and at > raw.limit):
                return
            at += len(title)
            if not title.strip():
                continue
            rest = [ahead.pop(0) if ahead else lines.readline() for _ in range(3)]
            at += sum(map(len, rest))
            yield title, *rest


def ranged_records(path: str, start: int, end: int, skip: int = 0) -> Iterator[Record]:
    """Records of a range but the first `skip`; it goes on behind the range's end if it is asked for more."""
    if kind_of(path) == "gzip":
        yield from islice(records(path), skip, None)
        return
    for four in islice(_lines_of_records(path, start, end), skip, None):
        yield _record(path, *(x.decode().rstrip("\r\n") for x in four))


def counted_ranges(spark: SparkSession, paths: list[str], split: int = SPLIT_BYTES) -> dict[str, list[tuple[int, int, int, int]]]:
    """(start, end, records before, records) of each range of each file; one number for each range reaches the driver."""
    every = [(path, *r) for path in dict.fromkeys(paths) for r in file_ranges(path, split)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in batch.column(0).to_pylist():
                path, start, end = every[nth]
                own = records(path) if kind_of(path) == "gzip" else _lines_of_records(path, start, end)
                yield pa.record_batch([pa.array([nth], pa.int64()), pa.array([sum(1 for _ in own)], pa.int64())], names=["nth", "n"])

    counts = spark.range(0, len(every), 1, min(len(every), MOST_TASKS)).mapInArrow(run, "nth long, n long").collect()
    out: dict[str, list[tuple[int, int, int, int]]] = {}
    for nth, n in sorted(map(tuple, counts)):
        path, start, end = every[nth]
        own = out.setdefault(path, [])
        own.append((start, end, own[-1][2] + own[-1][3] if own else 0, n))
    return out


#: A task: the set's number, how many records are before it, how many it has (none: all), and for each file where it opens it and what it skips.
Task = tuple[int, int, int | None, list[tuple[str, int, int, int]]]


def planned(spark: SparkSession, sets: list[tuple[str, ...]], split: int = SPLIT_BYTES) -> list[Task]:
    """Tasks that read the files of each set in step."""
    splittable = [k for k, files in enumerate(sets) if all(kind_of(f) != "gzip" for f in files) and len(file_ranges(files[0], split)) > 1]
    ranges = counted_ranges(spark, [f for k in splittable for f in sets[k]], split) if splittable else {}
    out: list[Task] = []
    for k, files in enumerate(sets):
        if k not in splittable:
            out.append((k, 0, None, [(f, 0, open_at(f)[1], 0) for f in files]))
            continue
        begins = [np.array([r[2] for r in ranges[f]]) for f in files]
        # in step to the end of the shortest
        total = min(ranges[f][-1][2] + ranges[f][-1][3] for f in files)
        for start, end, before, n in ranges[files[0]]:
            n = min(n, total - before)
            if n > 0:
                opened = [int(np.searchsorted(b, before, side="right")) - 1 for b in begins]
                out.append((k, before, n, [(f, *ranges[f][j][:2], before - ranges[f][j][2]) for f, j in zip(files, opened, strict=True)]))
    return out


class Limited(DataSourceReader):
    """Takes a limit on idx over, so that reading stops there; Spark still applies it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)) and f.attribute == ("idx",):
                bound = int(f.value) - isinstance(f, LessThan)
                self.most = bound if self.most is None else min(self.most, bound)
            yield f


class StepReader(DataSourceReader):
    """Tasks of a plan, each of which reads the files of a set in step; idx goes on from 1 in each set, with the set's number in its high bits."""

    most: int | None = None

    def __init__(self, plan: str, check_ids: bool = False):
        with open_input(plan) as data:
            self.tasks: list[Task] = json.load(data)
        self.check_ids = check_ids

    def partitions(self) -> list[InputPartition]:
        wanted = [t for t in self.tasks if self.most is None or (t[0] << SET_BITS) + t[1] < self.most]
        return [InputPartition(t) for t in wanted or [(0, 0, 0, [])]]

    def rows(self, task: Task) -> Iterator[tuple[int, tuple[Record, ...]]]:
        ordinal, before, n, files = task
        base = (ordinal << SET_BITS) + before
        if self.most is not None:
            n = min(self.most - base if n is None else n, self.most - base)
        # ranges of the other files may end before this one's
        own = [ranged_records(path, start, open_at(path)[1], skip) for path, start, _, skip in files]
        # in step, to the end of the shortest
        for idx, several in enumerate(islice(zip(*own, strict=False), None if n is None else max(0, n)), base + 1):
            if self.check_ids and len({name.split("/")[0] for name, *_ in several}) > 1:
                raise ValueError(f"records {idx - (ordinal << SET_BITS)} of {[f[0] for f in files]} have other ids: {[name for name, *_ in several]}")
            yield idx, several


class FastqReader(StepReader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for idx, (record,) in self.rows(partition.value):
            yield (partition.value[3][0][0], idx, *record)


class BatchReader(FastqReader):
    """The same as record batches, which Spark takes over without looking at each record; a partition has tasks that follow each other."""

    def partitions(self) -> list[InputPartition]:
        tasks = [p.value for p in super().partitions()]
        size = -(-len(tasks) // MOST_TASKS)
        return [InputPartition(tasks[k : k + size]) for k in range(0, len(tasks), size)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for task in partition.value:
            rows = super().read(InputPartition(task))
            while part := list(islice(rows, BATCH)):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*part, strict=True), ARROW.types, strict=True)], schema=ARROW)


class TripletReader(StepReader):
    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for idx, three in self.rows(partition.value):
            yield (idx, *three)


class LimitedFastqReader(Limited, BatchReader):
    pass


class LimitedTripletReader(Limited, TripletReader):
    pass


class FastqSource(DataSource):
    """`fastq`: options plan, where the tasks are written (see `fastq`), and push, whether a limit is taken over."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        kind = LimitedFastqReader if self.options.get("push") == "true" else BatchReader
        return kind(self.options["plan"])


class TripletSource(DataSource):
    """`fastq_triplet`: options plan, push and check_ids; idx orders the records, from 1."""

    @classmethod
    def name(cls) -> str:
        return "fastq_triplet"

    def schema(self) -> str:
        return TRIPLET_SCHEMA

    def reader(self, schema) -> TripletReader:
        kind = LimitedTripletReader if self.options.get("push") == "true" else TripletReader
        return kind(self.options["plan"], self.options.get("check_ids") == "true")


class PairSource(TripletSource):
    """`fastq_pair`: the same of two files."""

    @classmethod
    def name(cls) -> str:
        return "fastq_pair"

    def schema(self) -> str:
        return PAIR_SCHEMA


def _plan(spark: SparkSession, tasks: list[Task]) -> str:
    """Where tasks are written, on storage that the driver's planner and all machines share."""
    url = shared_dir(spark, "fastq")
    fs, inner = file_system(url)
    fs.create_dir(inner, recursive=True)
    with fs.open_output_stream(f"{inner}/tasks.json", compression=None) as out:
        out.write(json.dumps(tasks).encode())
    return f"{url}/tasks.json"


def fastq(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> DataFrame:
    """Records of files (by commas or wild cards), numbered from 1 in each file."""
    spark.dataSource.register(FastqSource)
    tasks = [(0, *rest) for _, *rest in planned(spark, [(p,) for p in listed(path)], split)]
    return spark.read.format("fastq").option("plan", _plan(spark, tasks)).option("push", pushes(spark)).load()


def _in_step(spark: SparkSession, source: type[TripletSource], files: list[str], partitions: int | None, check_ids: bool, split: int) -> DataFrame:
    paths = [listed(p) for p in files]
    if len({len(p) for p in paths}) > 1:
        raise ValueError(f"as many files of each kind are needed: {paths}")
    spark.dataSource.register(source)
    tasks = planned(spark, list(zip(*paths, strict=True)), split)
    rows = spark.read.format(source.name()).option("plan", _plan(spark, tasks)).option("push", pushes(spark)).option("check_ids", str(check_ids).lower()).load()
    return rows.repartition(partitions) if partitions and len(tasks) < partitions else rows


def triplets(spark: SparkSession, first: str, second: str, third: str, partitions: int | None = None, check_ids: bool = False, split: int = SPLIT_BYTES) -> DataFrame:
    """Triplets of files read in step (by commas or wild cards, as many of each).

    Where fewer tasks than `partitions` read them, rows are dealt over so many for what follows.
    """
    return _in_step(spark, TripletSource, [first, second, third], partitions, check_ids, split)


def pairs(spark: SparkSession, first: str, second: str, partitions: int | None = None, check_ids: bool = False, split: int = SPLIT_BYTES) -> DataFrame:
    """Pairs of files read in step: idx, r1, r2."""
    return _in_step(spark, PairSource, [first, second], partitions, check_ids, split)
