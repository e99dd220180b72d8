"""A table's rows in chunks below the cluster's shared folder, which later stages read by name.

Operators whose stages ask a distributed table and get an answer back keep the rows here instead
of shuffling the texts again with each question. A chunk is a Parquet file, written under a
temporary name and renamed when whole; a row's place in its chunk identifies it, so null or
repeated document ids do no harm. A lost executor's task reads its chunk anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame, GroupedData

from cellstrand.llm.common import slices, spread, stored
from cellstrand.session import shared_dir
from cellstrand.sources.files import file_system

Measure = Callable[[pa.Table], tuple[int, dict[str, pa.Table]]]


def number_of(partition: int, count: int) -> int:
    return partition << 24 | count


def put_table(fs: pafs.FileSystem, folder: str, chunk: int, attempt: int, table: pa.Table) -> None:
    name = f"{folder}/.{chunk}.{attempt}"
    with fs.open_output_stream(name) as out:
        pq.write_table(table, out, compression="zstd", use_dictionary=False)
    fs.move(name, f"{folder}/{chunk}.parquet")


def store(docs: DataFrame, measure: Measure, text: str = "text", most: int = 12 << 20, kept: list[str] | None = None) -> tuple[str, DataFrame]:
    """Write docs, or the columns `kept`, in chunks; the folder, and a stored table (chunk, size) with the number that `measure` gives each chunk.

    Tables that `measure` returns by name are kept beside the chunk. A text longer than `most` is a chunk of its own or ends one.
    """
    url = shared_dir(docs.sparkSession, "chunks")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, path = file_system(url)
        fs.create_dir(path, recursive=True)
        held: list[pa.RecordBatch] = []
        size = count = 0

        def put() -> pa.RecordBatch:
            chunk, table = number_of(task.partitionId(), count), pa.Table.from_batches(held)
            put_table(fs, path, chunk, task.taskAttemptId(), table if kept is None else table.select(kept))
            n, beside = measure(table)
            for name, more in beside.items():
                fs.create_dir(f"{path}/{name}", recursive=True)
                put_table(fs, f"{path}/{name}", chunk, task.taskAttemptId(), more)
            return pa.record_batch([pa.array([chunk], pa.int64()), pa.array([n], pa.int64())], names=["chunk", "size"])

        for piece in slices(batches, at):
            held.append(piece)
            size += pc.sum(pc.binary_length(piece.column(at))).as_py() or 0
            if size >= most:
                yield put()
                held, size, count = [], 0, count + 1
        if held:
            yield put()

    return url, stored(docs.mapInArrow(run, "chunk long, size long"), "chunk-table")


def read(url: str, chunk: int, columns: list[str] | None = None) -> pa.Table:
    """A chunk's rows; of `url/name` the table of that name beside it."""
    # what the chunk before left in the allocator goes back first
    pa.default_memory_pool().release_unused()
    fs, path = file_system(url)
    with fs.open_input_file(f"{path}/{chunk}.parquet") as source:
        return pq.read_table(source, columns=columns)


def dealt(table: DataFrame) -> DataFrame:
    """The chunks' names, a few to a task."""
    return spread(table.select("chunk"), "chunk")


def by(rows: DataFrame, key: str) -> GroupedData:
    """rows grouped by a key whose groups are much work however small their rows are, so that adaptive execution does not put many in one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key).groupBy(key)


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes of their differences; ascending ones pack best."""
    step = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(-1, step.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def plain(values: np.ndarray) -> bytes:
    """Integers in no order, compressed as they are."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), dtype=np.uint8)
    step = np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)
    return np.cumsum(step, dtype=dtype)


def unplain(data: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31), dtype=dtype)
