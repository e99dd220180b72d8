"""Benchmark decontamination by a distributed positional inverted index.

`build` indexes the training table once: its documents are dealt to shards of about SHARD_BYTES of
text, and each shard keeps, on shared storage, its terms with their counts, the places of all its
words sorted by term (the postings), and where its documents begin. Nothing in it depends on a
benchmark; any number of benchmarks are searched in a stored index, which holds no texts.

A window of benchmark words is found in a shard by taking its terms from the rarest there to the most
frequent: the postings of the first, less the term's offset in the window, are candidate starts, and
every further list, shifted by its own offset, is intersected with what is left. A match that would
cross two documents is none. Postings of terms that the benchmark has not are not looked at. Shards
are of equal size whatever their terms, so a term or passage that is in a third of all documents is
spread as the documents are; postings are not shuffled.

The benchmark's windows are made on executors, in blocks of about BLOCK_BYTES of its texts (or one
item), and kept on shared storage; a task holds one block at a time. Neither texts nor windows come to
the driver.

Defined results: null or empty texts have no words and no hits; items without words, or with a null
id, have no window; rows of one item id count as one item; rows that share a document id stay
separate; other columns are not read (`clean` keeps them); texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.llm import chunkstore
from cellstrand.llm.common import bytes_of, cuts, id_and_text
from cellstrand.session import shared_dir
from cellstrand.sources.files import file_system

#: Words of a window.
WINDOW = 10
#: Text of a shard, and bytes of benchmark text whose windows are searched at once, about.
SHARD_BYTES, BLOCK_BYTES = 12 << 20, 1 << 20

#: ASCII letters and digits, and all bytes of other characters, are of words; A-Z lower-cased.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Numbers(dict):
    """Numbers of words, given out as they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


@dataclass
class Windows:
    """Distinct windows of a block of items: the block's terms, the windows' term numbers (-1 behind the end) and lengths, and the items that hold each."""

    terms: pa.Array
    term: np.ndarray
    length: np.ndarray
    item_at: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, bytes]], size: int = WINDOW) -> Windows:
        numbers = Numbers()
        rows, held = [], []
        for item, text in items:
            word = np.array([numbers[w] for w in words_of(text)], dtype=np.int32)
            if not len(word):
                continue
            row = np.lib.stride_tricks.sliding_window_view(word, size) if len(word) >= size else np.pad(word, (0, size - len(word)), constant_values=-1)[None]
            rows.append(row)
            held.append(np.full(len(row), item))
        if not rows:
            none = np.empty(0, dtype=np.int64)
            return cls(pa.array([], pa.binary()), np.empty((0, size), dtype=np.int32), none, np.zeros(1, dtype=np.int64), none)
        term, window = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([window.reshape(-1), np.concatenate(held)], 1), axis=0)
        at = np.searchsorted(pairs[:, 0], np.arange(len(term) + 1))
        return cls(pa.array(list(numbers), pa.binary()), term, (term >= 0).sum(1), at, np.ascontiguousarray(pairs[:, 1]))

    def tables(self) -> dict[str, pa.Table]:
        width = self.term.shape[1]
        term = pa.FixedSizeListArray.from_arrays(pa.array(self.term.reshape(-1)), width)
        item = pa.ListArray.from_arrays(pa.array(self.item_at.astype(np.int32)), pa.array(self.item))
        return {"terms": pa.table({"term": self.terms}), "windows": pa.table({"term": term, "item": item})}

    @classmethod
    def read(cls, url: str, block: int) -> Windows:
        windows = chunkstore.read(f"{url}/windows", block).combine_chunks()
        item, term = windows.column("item").combine_chunks(), windows.column("term").combine_chunks()
        values = term.flatten().to_numpy().reshape(len(term), -1)
        return cls(chunkstore.read(f"{url}/terms", block).column("term").combine_chunks(), values, (values >= 0).sum(1), np.r_[0, np.cumsum(pc.list_value_length(item).to_numpy())].astype(np.int64), item.flatten().to_numpy())


@lru_cache(maxsize=1)
def windows_of(url: str, block: int) -> Windows:
    return Windows.read(url, block)


def prepared(benchmark: DataFrame, size: int = WINDOW, most: int = BLOCK_BYTES) -> tuple[str, list[int]]:
    """The windows of all items, in blocks on shared storage: the folder and the blocks' numbers."""
    url = shared_dir(benchmark.sparkSession, "benchmark")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        held = [(i, t) for batch in batches for i, t in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1)), strict=True)]
        if not held:
            return
        fs, path = file_system(url)
        for name, table in Windows.of(held, size).tables().items():
            fs.create_dir(f"{path}/{name}", recursive=True)
            chunkstore.put_table(fs, f"{path}/{name}", task.partitionId(), task.taskAttemptId(), table)
        yield pa.record_batch([pa.array([task.partitionId()], pa.int32())], names=["block"])

    made = items.repartition(max(1, -(-total // most)), F.xxhash64("item_id", "text")).mapInArrow(run, "block int").collect()
    return url, sorted(r.block for r in made)


class Shard:
    """Postings of some terms in a shard: their counts, and their places by term, ascending; where documents begin."""

    def __init__(self, count: np.ndarray, place: np.ndarray, n_words: np.ndarray):
        self.n_words, self.begin = n_words, np.r_[0, np.cumsum(n_words)].astype(np.int64)
        self.end = int(self.begin[-1])
        self.count, self.first = count, np.r_[0, np.cumsum(count)].astype(np.int64)
        #: term * end + place, ascending
        self.postings = np.repeat(np.arange(len(count)), count) * self.end + place

    @classmethod
    def read(cls, url: str, shard: int, terms: pa.Array) -> Shard:
        """A stored shard's postings of the given terms, numbered as given."""
        own = chunkstore.read(f"{url}/terms", shard)
        found = pc.fill_null(pc.index_in(terms, value_set=own.column("term").combine_chunks()), -1).to_numpy()
        size = own.column("count").to_numpy()
        first = np.cumsum(size) - size
        count = np.where(found >= 0, size[found] if len(size) else 0, 0).astype(np.int64)
        begin = np.where(found >= 0, first[found] if len(size) else 0, 0)
        at = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        place = chunkstore.read(f"{url}/places", shard).column("place").to_numpy()[at].astype(np.int64)
        return cls(count, place, chunkstore.read(f"{url}/sizes", shard).column("n_words").to_numpy())

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the postings of each term hold the place."""
        if not len(self.postings):
            return np.zeros(len(term), dtype=bool)
        key = term * self.end + place
        at = np.minimum(np.searchsorted(self.postings, key), len(self.postings) - 1)
        return (self.postings[at] == key) & (place >= 0) & (place < self.end)

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of every window: the window's number and its first place."""
        none = np.empty(0, dtype=np.int64)
        if not len(windows.term) or not len(self.postings):
            return none, none
        inside = windows.term >= 0
        count = np.where(inside, self.count[windows.term], np.iinfo(np.int64).max)
        live = np.flatnonzero(count.min(1) > 0)
        rare = np.argsort(count[live], axis=1, kind="stable")
        term, length = windows.term[live].astype(np.int64), windows.length[live]
        offset = rare[:, 0]
        lead = term[np.arange(len(live)), offset]
        size = self.count[lead]
        row = np.repeat(np.arange(len(live)), size)
        within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        start = self.postings[self.first[lead][row] + within] - lead[row] * self.end - offset[row]
        last = start + length[row] - 1
        kept = (start >= 0) & (last < self.end)
        kept[kept] = self.document(start[kept]) == self.document(last[kept])
        row, start = row[kept], start[kept]
        for k in range(1, windows.term.shape[1]):
            offset = rare[row, k]
            ends = k >= length[row]
            kept = ends | self.has(np.where(ends, 0, term[row, offset]), start + offset)
            row, start = row[kept], start[kept]
        return live[row], start

    def near(self, terms: list[int], width: int) -> np.ndarray:
        """Places of the rarest of `terms` that have each other term within `width` words, in the same document."""
        order = sorted(set(terms), key=lambda t: (self.count[t], t))
        own = self.postings[self.first[order[0]] : self.first[order[0] + 1]] - order[0] * self.end
        document = self.document(own)
        for t in order[1:]:
            other = self.postings[self.first[t] : self.first[t + 1]] - t * self.end
            low = np.maximum(own - width, self.begin[document])
            high = np.minimum(own + width, self.begin[document] + self.n_words[document] - 1)
            kept = np.searchsorted(other, low) < np.searchsorted(other, high, side="right")
            own, document = own[kept], document[kept]
        return own

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, place, side="right") - 1


def shard_tables(table: pa.Table, text: str) -> dict[str, pa.Table]:
    """What a shard keeps of its documents: terms with counts, places by term, and the documents' sizes."""
    numbers = Numbers()
    term, sizes = [np.empty(0, dtype=np.int64)], []
    for part in table.column(text).chunks:
        for a, b in cuts(part):
            rows = [words_of(t) for t in bytes_of(part.slice(a, b - a))]
            sizes += [len(r) for r in rows]
            term.append(np.fromiter((numbers[w] for r in rows for w in r), dtype=np.int64, count=sum(map(len, rows))))
    every = np.concatenate(term)
    end = max(1, len(every))
    postings = np.sort(every * end + np.arange(len(every)))
    place = (postings % end).astype(np.uint32 if end < 1 << 32 else np.int64)
    return {
        "terms": pa.table({"term": pa.array(list(numbers), pa.binary()), "count": np.bincount(every, minlength=len(numbers))}),
        "places": pa.table({"place": place}),
        "sizes": pa.table({"n_words": np.array(sizes, dtype=np.int64)}),
    }


@dataclass
class Index:
    """A stored index: the shards' folder, their table (chunk, size), and the columns kept of each document."""

    url: str
    shards: DataFrame
    kept: list[str]


def build(docs: DataFrame, text: str = "text", kept: list[str] | None = None, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index all documents; `kept`: the columns to keep of each (its id only, unless given)."""
    kept = ["doc_id"] if kept is None else kept
    url, shards = chunkstore.store(docs, lambda table: (table.num_rows, shard_tables(table, text)), text, shard_bytes, kept)
    return Index(url, shards, kept)


def found_in(index_url: str, shard: int, benchmark_url: str, blocks: list[int]) -> tuple[np.ndarray, np.ndarray, dict[int, set[int]]]:
    """Of a shard's documents: numbers of words and of words hit, and the items that each holds a window of."""
    n_words = chunkstore.read(f"{index_url}/sizes", shard).column("n_words").to_numpy()
    covered = np.zeros(int(n_words.sum()), dtype=bool)
    items: dict[int, set[int]] = {}
    for block in blocks:
        windows = windows_of(benchmark_url, block)
        own = Shard.read(index_url, shard, windows.terms)
        window, start = own.phrases(windows)
        change = np.zeros(own.end + 1, dtype=np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + windows.length[window], -1)
        covered |= np.cumsum(change[:-1]) > 0
        size = np.diff(windows.item_at)[window]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        item = windows.item[np.repeat(windows.item_at[window], size) + within]
        for d, i in np.unique(np.stack([np.repeat(own.document(start), size), item], 1), axis=0).tolist():
            items.setdefault(d, set()).add(i)
    total = np.r_[0, np.cumsum(covered)]
    ends = np.cumsum(n_words)
    return n_words, total[ends] - total[ends - n_words], items


def report(docs: DataFrame | Index, benchmark: DataFrame, size: int = WINDOW, most: int = BLOCK_BYTES, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document, of a table or of its index."""
    index = docs if isinstance(docs, Index) else build(id_and_text(docs), **options)
    url, blocks = prepared(benchmark, size, most)
    index_url = index.url

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n_words, n_hit, found = found_in(index_url, shard, url, blocks)
                items = [sorted(map(str, found.get(d, ()))) for d in range(len(n_words))]
                digest = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
                ids = chunkstore.read(index_url, shard, ["doc_id"]).column(0).combine_chunks().cast(pa.int64())
                yield pa.record_batch(
                    [ids, pa.array(n_words), pa.array(n_hit.astype(np.int64)), pa.array([len(i) for i in items], pa.int64()), pa.array(digest, pa.string()), pa.array(n_hit > 0)],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return chunkstore.dealt(index.shards).mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = BLOCK_BYTES, **options) -> DataFrame:
    """docs, all columns, without the rows whose text holds a window of the benchmark."""
    index = build(docs, kept=docs.columns, **options)
    url, blocks = prepared(benchmark, size, most)
    index_url = index.url

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                n_hit = found_in(index_url, shard, url, blocks)[1]
                yield from chunkstore.read(index_url, shard).filter(pa.array(n_hit == 0)).to_batches()

    return chunkstore.dealt(index.shards).mapInArrow(run, docs.schema)


def near_matches(docs: DataFrame | Index, queries: list[str], width: int, **options) -> DataFrame:
    """doc_id, query (its index), word: where all words of a query stand within `width` words of its rarest."""
    index = docs if isinstance(docs, Index) else build(id_and_text(docs), **options)
    url, numbers = index.url, Numbers()
    split = [[numbers[w] for w in words_of(q.encode())] for q in queries]
    terms = list(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                own = Shard.read(url, shard, pa.array(terms, pa.binary()))
                ids = chunkstore.read(url, shard, ["doc_id"]).column(0).combine_chunks().cast(pa.int64())
                for k, words in enumerate(split):
                    place = own.near(words, width) if words else np.empty(0, dtype=np.int64)
                    document = own.document(place)
                    yield pa.record_batch([ids.take(pa.array(document)), pa.array([k] * len(place), pa.int32()), pa.array(place - own.begin[document], pa.int64())], names=["doc_id", "query", "word"])

    return chunkstore.dealt(index.shards).mapInArrow(run, "doc_id long, query int, word long")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest(CASE WHEN len(ws) > 10 THEN list_transform(range(1, len(ws) - 8), lambda i: array_to_string(ws[i:i + 9], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS win FROM b),
ks AS (SELECT DISTINCT k FROM bw),
dp AS (SELECT doc_id, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM d CROSS JOIN ks WHERE len(ws) >= k),
o AS (SELECT dp.doc_id, dp.i, dp.k, bw.item_id FROM (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win FROM dp) dp JOIN bw ON bw.k = dp.k AND bw.win = dp.win),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY 1)
SELECT d.doc_id, coalesce(len(d.ws), 0)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
