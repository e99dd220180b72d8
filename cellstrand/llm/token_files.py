"""Flat token files: unsigned integers of all documents, and 64-bit document offsets, memory-mapped.

A dataset is a folder of shards `00000.ids` (little-endian unsigned integers, nothing else),
`00000.off` (n+1 little-endian int64: where each document begins, and the end) and `00000.doc`
(n int64 document ids), in ascending order of document id over all shards. A shard's base, the
tokens of all shards before it, is a prefix sum over the shards' token counts.

Shards are written by executors to the cluster's shared folder, under a temporary name first and
renamed when whole, so a repeated or speculative task leaves the same bytes. Local folders are
mapped; other stores, reached through pyarrow's file systems, are read shard by shard.

Shards are as many as the texts' size asks for, at least as many as the session's shuffle partitions;
ids are written while texts are encoded, so a task holds one slice of texts and a few numbers for each
document. Rows are dealt by ranges of document id, then of a hash of the text, then of their place, so
that many rows of one id, or without one, are spread over shards too.

Defined results: a null or empty text is a document of the end id alone; a null document id sorts
first; rows that share an id stay separate documents, ordered by a hash of their texts; the strings of
the tokenizer's own special tokens become their ids where they stand in a text, as the library does
it; other columns are not read; an empty table gives an empty dataset.
"""

from __future__ import annotations

import gc
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellstrand.llm.chunks import ChunkMemory
from cellstrand.llm.common import id_and_text, slices, spread, stored, texts_of
from cellstrand.llm.token_counts import byte_of_letter
from cellstrand.operators.whitelist import estimated_bytes
from cellstrand.session import shared_dir
from cellstrand.sources.files import file_system

NO_ID = np.int64(-(2**63))


#: Bytes of a table, as the optimizer estimates them, that a shard is laid out for.
SHARD_BYTES = 32 << 20
#: An estimate beyond this is none.
UNKNOWN_BYTES = 1 << 50


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts as the bytes of the file format, as the library encodes them without special tokens of its own adding.

    Distinct chunks are encoded once in a worker. A text that holds an added token's string goes to the library whole.
    """

    def __init__(self, path: str, dtype: str):
        self.own, self.memory = tokenizer(path), memory(path, dtype)
        self.code = CODES[dtype]
        self.added = [t.content for t in self.own.get_added_tokens_decoder().values()]

    def rows(self, texts: list[str]) -> list[bytes]:
        special = {k for k, t in enumerate(texts) if any(a in t for a in self.added)}
        out = [b"".join(row) for row in self.memory.values([t if k not in special else "" for k, t in enumerate(texts)])]
        for k in special:
            out[k] = array(self.code, self.own.encode(texts[k], add_special_tokens=False).ids).tobytes()
        return out


#: array's letters for the file's types.
CODES = {"<u2": "H", "<u4": "I"}


@lru_cache(maxsize=2)
def memory(path: str, dtype: str) -> ChunkMemory:
    """A worker's ids of distinct chunks, as the bytes of the file format."""
    own = tokenizer(path)
    letter = {b: c for c, b in byte_of_letter().items()}
    letters = {b: letter[b] for b in range(256)}
    model, identity = own.model.tokenize, attrgetter("id")
    code = CODES[dtype]

    def words(letters_only: Sequence[str]) -> list[bytes]:
        """A space and letters are one piece, which goes to the library's model at once."""
        space, out = letters[32], []
        for w in letters_only:
            out.append(array(code, map(identity, model(space + (w if w.isascii() else w.encode().decode("latin-1").translate(letters))))).tobytes())
        return out

    def compute(chunks: Sequence[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for e in own.encode_batch_fast(list(chunks), add_special_tokens=False)]

    return ChunkMemory(compute, words=words)


def width(vocabulary: int, end_id: int) -> str:
    """The narrowest unsigned integer that holds every id."""
    return "<u2" if max(vocabulary - 1, end_id) < 1 << 16 else "<u4"


class Shard:
    """The three files of a shard while they are written, under names of one attempt; they get their own when they are whole."""

    def __init__(self, url: str, shard: int, attempt: str):
        self.fs, self.folder = file_system(url)
        self.fs.create_dir(self.folder, recursive=True)
        self.shard, self.attempt = shard, attempt
        self.ids = self.fs.open_output_stream(self._hidden("ids"))

    def _hidden(self, kind: str) -> str:
        return f"{self.folder}/.{self.shard:05d}.{kind}.{self.attempt}"

    def close(self, offsets: np.ndarray, docs: np.ndarray) -> None:
        self.ids.close()
        for kind, content in (("off", offsets.astype("<i8")), ("doc", docs.astype("<i8"))):
            with self.fs.open_output_stream(self._hidden(kind)) as out:
                out.write(content.tobytes())
        for kind in ("ids", "off", "doc"):
            self.fs.move(self._hidden(kind), f"{self.folder}/{self.shard:05d}.{kind}")


def _get(url: str, name: str, dtype: str) -> np.ndarray:
    fs, path = file_system(url)
    if isinstance(fs, pafs.LocalFileSystem):
        if not fs.get_file_info(f"{path}/{name}").size:
            return np.empty(0, dtype)
        return np.memmap(f"{path}/{name}", dtype=dtype, mode="r")
    with fs.open_input_stream(f"{path}/{name}") as content:
        return np.frombuffer(content.read(), dtype=dtype)


def shard_count(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    size = estimated_bytes(docs)
    if size > UNKNOWN_BYTES:
        size = id_and_text(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))


def write(docs: DataFrame, url: str, path: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write all documents; (shard, base, n_docs, n_tokens) of each shard, in order.

    One shuffle deals the texts by ranges of document id. The shards' counts are stored as a table.
    """
    spark = docs.sparkSession
    dtype = width(tokenizer(path).get_vocab_size(with_added_tokens=True), end_id)
    end = np.array([end_id], dtype=dtype).tobytes()
    step = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        number, own = task.partitionId(), Encoder(path, dtype)
        shard: Shard | None = None
        ids: list[np.ndarray] = []
        sizes: list[int] = []
        # nothing here is cyclic, and the memory's many objects are dear to look through again and again
        gc.disable()
        try:
            for batch in slices(batches):
                shard = shard or Shard(url, number, f"{task.stageId()}-{task.taskAttemptId()}")
                ids.append(batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False))
                rows = [row + end for row in own.rows(texts_of(batch.column(1)))]
                sizes += [len(r) // step for r in rows]
                shard.ids.write(b"".join(rows))
        finally:
            gc.enable()
        if shard is not None:
            offsets = np.zeros(len(sizes) + 1, dtype="<i8")
            np.cumsum(sizes, out=offsets[1:])
            shard.close(offsets, np.concatenate(ids))
            yield pa.record_batch([pa.array([number], pa.int32()), pa.array([len(sizes)], pa.int64()), pa.array([int(offsets[-1])], pa.int64())], names=["shard", "n_docs", "n_tokens"])

    # in the order of these, rows that are alike in id and text come in any order: the files are the same
    order = ["doc_id", F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = id_and_text(docs).select("*", *[c.alias(f"order{k}") for k, c in enumerate(order[1:])])
    order = ["doc_id", "order0", "order1"]
    told = rows.repartitionByRange(shard_count(docs, shard_bytes), *order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, "shard int, n_docs long, n_tokens long")
    return based(stored(told, "shards")).withColumn("dtype", F.lit(dtype))


#: Shards of a run, whose tokens are added up first.
RUN_SHARDS = 1 << 12


def based(told: DataFrame, run_shards: int = RUN_SHARDS) -> DataFrame:
    """(shard, base, n_docs, n_tokens): the tokens of all shards before each.

    A prefix sum in two levels: over the runs of `run_shards` shards, of which there are few, and
    over the shards within a run.
    """
    runs = told.withColumn("run", F.floor(F.col("shard") / run_shards))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("run").agg(F.sum("n_tokens").alias("n"))
    ahead = sums.select("run", F.coalesce(F.sum("n").over(before.orderBy("run")), F.lit(0)).alias("ahead"))
    within = F.coalesce(F.sum("n_tokens").over(before.partitionBy("run").orderBy("shard")), F.lit(0))
    return runs.withColumn("within", within).join(F.broadcast(ahead), "run").select("shard", (F.col("ahead") + F.col("within")).alias("base"), "n_docs", "n_tokens")


#: Documents whose numbers are put out at once.
READ_ROWS = 1 << 14


def read(shards: DataFrame, url: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base, _, _, dtype in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, offsets, docs = _get(url, f"{shard:05d}.ids", dtype), _get(url, f"{shard:05d}.off", "<i8"), _get(url, f"{shard:05d}.doc", "<i8")
                for first in range(0, len(docs), READ_ROWS):
                    own, at = docs[first : first + READ_ROWS], offsets[first : first + READ_ROWS + 1]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    yield pa.record_batch([pa.array(own, pa.int64(), mask=own == NO_ID), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread(shards, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document(url: str, shard: int, row: int, dtype: str = "<u2") -> np.ndarray:
    """Ids of one document of a shard, mapped and not copied."""
    offsets = _get(url, f"{shard:05d}.off", "<i8")
    return _get(url, f"{shard:05d}.ids", dtype)[offsets[row] : offsets[row + 1]]


def round_trip(docs: DataFrame, path: str, end_id: int, url: str | None = None) -> DataFrame:
    """Write documents as token files (below the shared folder, if no url is given) and read them back."""
    url = url or shared_dir(docs.sparkSession, "tokens")
    return read(write(docs, url, path, end_id), url)
