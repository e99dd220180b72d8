"""Helpers shared by the text operators: columns, Arrow slices, hashing and shared storage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstrand.session import shared_dir

#: Rows that a kernel handles at once; bounds a worker's memory whatever Arrow batch size the session uses.
SLICE_ROWS = 512
#: Bytes of text after which a slice ends early, so that runs of very long texts stay bounded too.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def cuts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of at most SLICE_ROWS rows and about SLICE_BYTES of text."""
    lengths = np.nan_to_num(np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.float64)).astype(np.int64)
    group = np.cumsum(lengths) // SLICE_BYTES
    start = 0
    while start < len(lengths):
        end = min(start + SLICE_ROWS, int(np.searchsorted(group, group[start], side="right")))
        yield start, end
        start = end


def slices(batches: Iterable[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches cut by the length of their texts."""
    for batch in batches:
        for start, end in cuts(batch.column(text)):
            yield batch.slice(start, end - start)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column, null read as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null read as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.large_binary()).to_pylist()]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as one byte array and the n+1 offsets of its rows; null is empty."""
    rows = bytes_of(column)
    offsets = np.zeros(len(rows) + 1, dtype=np.int64)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return np.frombuffer(b"".join(rows), dtype=np.uint8), offsets


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that text operators read; whatever else a table has is not looked at."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def kept_rows(docs: DataFrame, keep: Callable[[list[str]], np.ndarray], text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose texts `keep` says to keep; in place, no shuffle."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            yield batch.filter(pa.array(keep(texts_of(batch.column(at)))))

    return docs.mapInArrow(run, docs.schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


#: Tasks for each shuffle partition of the session at most, where rows of a small table are much work each.
WAVES = 16


def spread(table: DataFrame, key: str, waves: int = WAVES) -> DataFrame:
    """The rows of a table that names pieces of work, dealt by key: about one to a task while they are few, and never to more than `waves` tasks a slot.

    A task does its rows one after another, so its memory is that of one piece however many there are.
    """
    slots = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(max(slots, min(table.count(), waves * slots)), key)


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written to shared storage and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
