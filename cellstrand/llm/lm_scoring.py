"""Stupid-backoff scores, computed relationally over the corpus itself, each text left out of its own counts.

Texts are stored in chunks. Every chunk sends each of its distinct n-grams, once and with its count,
to the partition of the count table that the n-gram's hash names; there all chunks' counts are added
up and the totals are joined back to the chunks that asked, in the order asked, so an answer is a
byte or so an n-gram. Each chunk then sums the scores of its n-grams document by document. However
frequent an n-gram, a partition gets one row of it from each chunk.

Words and pairs of words are asked for first. Of longer n-grams only those are asked for whose first
and last n-1 words both occur in other documents, as the chunk knows by then; no other can occur there.

Relations are packed: a row between a chunk and a partition holds all n-grams that go there, as sorted
hashes with their counts, since a row for each would take several times the disk that is allowed. A
partition is a range of hashes, so that a chunk's sorted n-grams fall into partitions as they stand.
Rows are chunks by partitions, but never more than n-grams; above some 0.2 TB chunk_bytes and
part_grams should grow with the corpus.

Score of a word w after the words before it, with counts c' that leave the document itself out:
c'(h w) / c'(h) for the longest history h of at most order - 1 words with c'(h w) > 0, times ALPHA
for each word that h was shortened by; without any, ALPHA^... * c'(w) / N', where N' counts the
words of other documents, and an unseen word counts 1 / (N' + 1). n-grams are told apart by 64 bits.

Defined results: null, empty and blank texts have no words and score 0; texts are read whole; rows
that are equal are separate documents, so each sees the others; a null id is kept; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.llm import chunkstore
from cellstrand.llm.chunkstore import packed, plain, unpacked, unplain
from cellstrand.llm.common import bytes_of, id_and_text, slices
from cellstrand.llm.wordhash import Table, combined, word_hashes

ALPHA = 0.4
ORDER = 3
#: Text of a chunk, about, and n-grams that a partition of the count table is laid out for.
CHUNK_BYTES = 10 << 20
PART_GRAMS = 1_500_000


def words_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents of a chunk in a row, and the number of words of each."""
    words, size = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
    for batch in slices(table.to_batches()):
        w, s = word_hashes(bytes_of(batch.column(1)))
        words.append(w)
        size.append(s)
    return np.concatenate(words), np.concatenate(size)


def grams(words: np.ndarray, document: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1, 2, ..., order the hashes of the n-grams that end at each word; 0 where the document has too few words before."""
    out = [np.where(words == 0, np.uint64(1), words)]
    for n in range(2, order + 1):
        longer = np.zeros(len(words), dtype=np.uint64)
        if len(words) >= n:
            inside = document[n - 1 :] == document[: len(words) - n + 1]
            pair = combined(out[-1][:-1][n - 2 :], words[n - 1 :])
            longer[n - 1 :] = np.where(inside, np.where(pair == 0, np.uint64(1), pair), np.uint64(0))
        out.append(longer)
    return out


def others(table: Table, corpus: np.ndarray, document: np.ndarray) -> np.ndarray:
    """At each place of the chunk the count of its n-gram in the corpus less that in its own document; 0 where it was not asked for."""
    out = np.zeros(len(document), dtype=np.int64)
    if len(table.place):
        own = document[table.place]
        new = np.r_[True, (table.number[1:] != table.number[:-1]) | (own[1:] != own[:-1])]
        begin = np.flatnonzero(new)
        out[table.place] = corpus[table.number] - np.diff(np.r_[begin, len(own)])[np.cumsum(new) - 1]
    return out


ASK = "part int, chunk long, n int, gram binary, count binary"
ANSWER = "chunk long, part int, n int, count binary"


def asks(chunk: int, n: int, table: Table, parts: int) -> Iterator[tuple]:
    at = table.parts(parts)
    count = np.minimum(table.count, np.iinfo(np.int32).max).astype(np.int32)
    for p in np.flatnonzero(np.diff(at)).tolist():
        yield p, chunk, n, packed(table.distinct[at[p] : at[p + 1]]), plain(count[at[p] : at[p + 1]])


def ask_batch(told: list[tuple]) -> pa.Table:
    columns = list(zip(*told, strict=True)) or [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["part", "chunk", "n", "gram", "count"])


def answers_of(table: pa.Table, n: int) -> np.ndarray:
    """The totals that came back to a chunk for its distinct n-grams of one order, ascending."""
    told = sorted((p, c) for p, m, c in zip(table.column("part").to_pylist(), table.column("n").to_pylist(), table.column("count").to_pylist(), strict=True) if m == n)
    return np.concatenate([np.empty(0, dtype=np.int64), *(unpacked(c, np.int64) for _, c in told)])


def added_up(table: pa.Table) -> pa.Table:
    """A partition's totals, sent back to each chunk in the order in which it asked."""
    n, gram, count = table.column("n").to_pylist(), table.column("gram").to_pylist(), table.column("count").to_pylist()
    answer: list[bytes] = [b""] * len(n)
    for level in sorted(set(n)):
        rows = [k for k in range(len(n)) if n[k] == level]
        own = [unpacked(gram[k], np.uint64) for k in rows]
        distinct, where = np.unique(np.concatenate(own), return_inverse=True)
        sums = np.bincount(where, weights=np.concatenate([unplain(count[k], np.int32) for k in rows]), minlength=len(distinct)).astype(np.int64)
        ends = np.cumsum([len(g) for g in own])
        for k, a, b in zip(rows, [0, *ends[:-1]], ends, strict=True):
            answer[k] = packed(sums[where[a:b]])
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "n": table.column("n"), "count": pa.array(answer, pa.binary())})


class Chunk:
    """Words, n-grams and, as they become known, counts in other documents of a chunk."""

    def __init__(self, rows: pa.Table, order: int):
        self.words, self.size = words_in(rows)
        self.document = np.repeat(np.arange(len(self.size)), self.size)
        self.gram = grams(self.words, self.document, order)
        self.others: list[np.ndarray] = []

    def table(self, n: int) -> Table:
        """The n-grams (n from 0) that are asked for, once those of one word less are known, from the third order on."""
        where = self.gram[n] != 0
        if n >= 2:
            where[1:] &= (self.others[n - 1][1:] > 0) & (self.others[n - 1][:-1] > 0)
        return Table.of(self.gram[n], where)

    def learn(self, told: pa.Table, orders: int) -> Chunk:
        for n in range(orders):
            self.others.append(others(self.table(n), answers_of(told, n), self.document))
        return self

    def log_scores(self, total: int, alpha: float) -> np.ndarray:
        rest = total - self.size[self.document]
        value = np.where(self.others[0] > 0, self.others[0] / np.maximum(rest, 1), 1 / (rest + 1))
        for n in range(1, len(self.others)):
            with_history = self.gram[n] != 0
            history = np.zeros(len(self.words), dtype=np.int64)
            history[1:] = self.others[n - 1][:-1]
            seen = with_history & (self.others[n] > 0)
            value = np.where(seen, self.others[n] / np.maximum(history, 1), np.where(with_history, alpha * value, value))
        return np.bincount(self.document, weights=np.log(value), minlength=len(self.size)) if len(self.words) else np.zeros(len(self.size))


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, chunk_bytes: int = CHUNK_BYTES, part_grams: int = PART_GRAMS) -> DataFrame:
    """doc_id, n_words and log_score (natural logarithm of the product of scores) of every text."""
    spark = docs.sparkSession

    def measure(rows: pa.Table) -> tuple[int, dict[str, pa.Table]]:
        return sum(len(t.split()) for batch in rows.to_batches() for t in bytes_of(batch.column(1))), {}

    url, chunks = chunkstore.store(id_and_text(docs), measure, most=chunk_bytes)
    total = chunks.agg(F.sum("size")).first()[0] or 0
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(slots, -(-total * min(order, 2) // part_grams))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                own = Chunk(chunkstore.read(url, chunk), min(order, 2))
                for n in range(min(order, 2)):
                    yield from ask_batch(list(asks(chunk, n, own.table(n), parts))).to_batches()

    def longer(n: int) -> Callable[[pa.Table], pa.Table]:
        """What a chunk asks of n + 1 words, by the answers for n."""

        def run(told: pa.Table) -> pa.Table:
            chunk = told.column("chunk")[0].as_py()
            own = Chunk(chunkstore.read(url, chunk), n + 1).learn(told, n)
            return ask_batch(list(asks(chunk, n, own.table(n), parts)))

        return run

    def summed(told: pa.Table) -> pa.Table:
        rows = chunkstore.read(url, told.column("chunk")[0].as_py())
        own = Chunk(rows, order).learn(told, order)
        return pa.table({"doc_id": rows.column(0), "n_words": pa.array(own.size), "log_score": pa.array(own.log_scores(total, alpha) + 0.0)})

    def by_chunk(known: list[DataFrame], f: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        """f of all answers of each chunk; the first ones are shuffled once for all that read them."""
        if len(known) == 1:
            return chunkstore.by(known[0], "chunk").applyInArrow(f, schema)
        rest = known[1]
        for more in known[2:]:
            rest = rest.unionByName(more)

        def both(one: pa.Table, other: pa.Table) -> pa.Table:
            return f(pa.concat_tables([one, other]))

        return chunkstore.by(known[0], "chunk").cogroup(chunkstore.by(rest, "chunk")).applyInArrow(both, schema)

    told = chunkstore.dealt(chunks.where("size > 0")).mapInArrow(ask, ASK)
    known = [chunkstore.by(told, "part").applyInArrow(added_up, ANSWER)]
    for n in range(2, order):
        known.append(chunkstore.by(by_chunk(known, longer(n), ASK), "part").applyInArrow(added_up, ANSWER))
    scored = by_chunk(known, summed, "doc_id long, n_words long, log_score double")

    def no_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                ids = chunkstore.read(url, chunk).column(0).combine_chunks()
                yield pa.record_batch([ids, pa.array(np.zeros(len(ids), dtype=np.int64)), pa.array(np.zeros(len(ids)))], names=["doc_id", "n_words", "log_score"])

    return scored.unionByName(chunkstore.dealt(chunks.where("size = 0")).mapInArrow(no_words, "doc_id long, n_words long, log_score double"))


ORACLE = r"""
WITH w AS (
  SELECT r, doc_id, i, words[i] AS w FROM (
    SELECT row_number() OVER () AS r, doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM (
      SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents))),
d AS (SELECT doc_id, w, i, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS v, lag(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
t AS (SELECT count(*) AS t FROM d),
u AS (SELECT w, count(*) AS c FROM d GROUP BY 1),
ud AS (SELECT doc_id, w, count(*) AS c FROM d GROUP BY 1, 2),
b AS (SELECT v, w, count(*) AS c FROM d WHERE v IS NOT NULL GROUP BY 1, 2),
bd AS (SELECT doc_id, v, w, count(*) AS c FROM d WHERE v IS NOT NULL GROUP BY 1, 2, 3),
g AS (SELECT x, v, w, count(*) AS c FROM d WHERE x IS NOT NULL GROUP BY 1, 2, 3),
gd AS (SELECT doc_id, x, v, w, count(*) AS c FROM d WHERE x IS NOT NULL GROUP BY 1, 2, 3, 4),
o AS (
  SELECT d.doc_id, d.v, d.x, t.t - n.n AS rest, u.c - ud.c AS c1, uv.c - uvd.c AS h1, coalesce(b.c - bd.c, 0) AS c2, bh.c - bhd.c AS h2, coalesce(g.c - gd.c, 0) AS c3
  FROM d CROSS JOIN t JOIN n USING (doc_id) JOIN u ON u.w = d.w JOIN ud ON ud.doc_id = d.doc_id AND ud.w = d.w
  LEFT JOIN b ON b.v = d.v AND b.w = d.w LEFT JOIN bd ON bd.doc_id = d.doc_id AND bd.v = d.v AND bd.w = d.w
  LEFT JOIN u uv ON uv.w = d.v LEFT JOIN ud uvd ON uvd.doc_id = d.doc_id AND uvd.w = d.v
  LEFT JOIN g ON g.x = d.x AND g.v = d.v AND g.w = d.w LEFT JOIN gd ON gd.doc_id = d.doc_id AND gd.x = d.x AND gd.v = d.v AND gd.w = d.w
  LEFT JOIN b bh ON bh.v = d.x AND bh.w = d.v LEFT JOIN bd bhd ON bhd.doc_id = d.doc_id AND bhd.v = d.x AND bhd.w = d.v),
s AS (
  SELECT doc_id, CASE WHEN c3 > 0 THEN c3::DOUBLE / h2 ELSE CASE WHEN x IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END
    * CASE WHEN c2 > 0 THEN c2::DOUBLE / h1 ELSE CASE WHEN v IS NULL THEN 1.0::DOUBLE ELSE 0.4::DOUBLE END * CASE WHEN c1 > 0 THEN c1::DOUBLE / rest ELSE 1.0::DOUBLE / (rest + 1) END END END AS s FROM o)
SELECT documents.doc_id, coalesce(n.n, 0)::BIGINT AS n_words, round(coalesce(q.q, 0), 4) AS log_score
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, sum(ln(s)) AS q FROM s GROUP BY 1) q USING (doc_id)
"""
