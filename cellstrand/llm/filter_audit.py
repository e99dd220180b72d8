"""What five text filters remove, in every order that they can be applied in.

A document fails some of the filters A to E; which ones is a mask of five bits, so a part of the
corpus is a histogram of 32 counts. What the filters do in an order is linear in that histogram: for
each outcome a matrix of 32 masks by 600 (120 orders of five steps) says which masks count at which
step. Histograms of all documents, of good and of toxic ones are stacked as rows and multiplied with
these matrices; nothing is filtered 120 times.

The filters: A: fewer than 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals A-Z > 5 *
code points; D: holds one of #$%&*|; E: identical to the text of a lesser doc_id. Words are maximal
runs of bytes other than white space of ASCII, case-sensitive.

One scan gives each text its mask of A to D and a digest of 128 bits, which stands for the text in E.
Rows are counted by (document, digest, part) before they meet the labels, and only texts that occur
in several rows are looked up again, in joins that adaptive execution can split; counts by part and
mask are aggregated on both sides of the shuffle, so a part or a text of a third of all rows is small.

Defined results: a null or empty text has no words and fails A alone, and E where an equal text (null
is empty) has a lesser id; rows without an id are equal to none and none is less than them, so they
never fail E; rows that share an id count each, and do not fail E by each other; of several labels of
a document any that says so counts, null or absent ones say nothing; a null part is the empty string;
other columns are not read; an empty table has no parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.llm.common import bytes_of, slices, stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
MASKS = 1 << STEPS
#: Counts of `audit`, in the order that they are put out.
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, b"#$%&*|"

_ALL = bytes(range(256))
_NOT_CAPITAL = bytes(b for b in _ALL if not 65 <= b <= 90)
_CONTINUES = bytes(range(0x80, 0xC0))
_NOT_SYMBOL = bytes(b for b in _ALL if b not in SYMBOLS)


def mask_of(text: bytes) -> int:
    """Bits 0 to 3: whether the text fails A to D."""
    words = text.split()
    few = len(words) < FEWEST_WORDS
    same = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    capitals = 100 * len(text.translate(None, _NOT_CAPITAL)) > MOST_CAPITALS * len(text.translate(None, _CONTINUES))
    symbols = bool(text.translate(None, _NOT_SYMBOL))
    return few | same << 1 | capitals << 2 | symbols << 3


def outcome_matrices() -> dict[str, np.ndarray]:
    """Masks by (order, step) for kept, removed, redundant and unique, and by filter for removed over all orders."""
    out = {name: np.zeros((MASKS, len(ORDERS) * STEPS), dtype=np.int64) for name in ("kept", "removed", "redundant", "unique")}
    masks = np.arange(MASKS)
    for k, order in enumerate(ORDERS):
        before = np.zeros(MASKS, dtype=bool)
        for step, letter in enumerate(order):
            bit = FILTERS.index(letter)
            fails = (masks >> bit & 1).astype(bool)
            at = k * STEPS + step
            out["removed"][:, at] = fails & ~before
            out["redundant"][:, at] = fails & before
            out["unique"][:, at] = masks == 1 << bit
            before |= fails
            out["kept"][:, at] = ~before
    return out


def column_filters() -> np.ndarray:
    """The filter, as a number, of each of the 600 columns."""
    return np.array([FILTERS.index(letter) for order in ORDERS for letter in order])


def masked(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part, mask of A to D, digest of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            texts = bytes_of(batch.column(2))
            mask = pa.array([mask_of(t) for t in texts], pa.int32())
            digest = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(1), mask, digest], names=["doc_id", "part", "mask", "digest"])

    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), part.alias("part"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with good and toxic, 0 or 1."""
    says = [F.max(F.coalesce((F.col(f"`{name}`") == 1).cast("int"), F.lit(0))).alias(alias) for name, alias in (("quality", "good"), ("toxic", "toxic"))]
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*says).where("good + toxic > 0")
    # stored, so that both sides of the join are plain exchanges, which adaptive execution can split
    flags = stored(told, "labels")
    # rows without an id match nothing; by their digests they are spread instead of meeting in one task
    no_id = F.col("doc_id").isNull()
    keyed = rows.withColumns({"key": F.when(no_id, F.xxhash64("digest")).otherwise(F.col("doc_id")), "no_id": no_id})
    flags = flags.select(F.col("doc_id").alias("key"), F.lit(False).alias("no_id"), "good", "toxic")
    joined = keyed.join(flags, ["key", "no_id"], "left").drop("key", "no_id")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")})


def histograms(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """part, mask (all five filters), n, good, toxic: counts of documents; at most 32 rows a part."""
    rows = masked(docs, part_col).groupBy("doc_id", "digest", "part").agg(F.first("mask").alias("mask"), F.count(F.lit(1)).alias("n"))
    rows = stored(labelled(rows, labels), "masked")
    seen = rows.where(F.col("doc_id").isNotNull())
    first = stored(seen.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"), "first")
    again = seen.join(first, "digest").where(F.col("doc_id") > F.col("first"))

    def counts(df: DataFrame, mask: Column, sign: int) -> DataFrame:
        n = F.lit(sign) * F.col("n")
        return df.groupBy("part", mask.alias("mask")).agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("good"), F.sum(n * F.col("toxic")).alias("toxic"))

    fails_e = F.col("mask").bitwiseOR(F.lit(MASKS >> 1))
    moved = [counts(rows, F.col("mask"), 1), counts(again, F.col("mask"), -1), counts(again, fails_e, 1)]
    every = moved[0].unionByName(moved[1]).unionByName(moved[2])
    return every.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


#: Parts whose 600 rows each are put out at once.
PARTS_AT_ONCE = 64


def outcomes(histogram: DataFrame) -> DataFrame:
    """part, filter_order, step and COUNTS from (part, mask, n, good, toxic)."""
    by_part = histogram.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, filters = outcome_matrices(), column_filters()
        orders, steps = [o for o in ORDERS for _ in range(STEPS)], np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))
        width = len(filters)
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS_AT_ONCE):
                own = batch.slice(start, PARTS_AT_ONCE)
                parts, cells = own.column(0).to_pylist(), own.column(1)
                at = np.repeat(np.arange(len(parts)), cells.value_lengths().to_numpy())
                flat = cells.flatten()
                stacked = np.zeros((3, len(parts), MASKS), dtype=np.int64)
                for k, name in enumerate(("n", "good", "toxic")):
                    stacked[k, at, flat.field("mask").to_numpy()] = flat.field(name).to_numpy()
                n = stacked[0]
                removed = stacked @ matrix["removed"]
                of_filter = np.stack([removed[0][:, filters == f].sum(1) for f in range(STEPS)], 1)
                values = [n @ matrix["kept"], removed[0], n @ matrix["redundant"], n @ matrix["unique"], removed[1], removed[2], of_filter[:, filters]]
                columns = [pa.array(np.repeat(np.array(parts, dtype=object), width), pa.string()), pa.array(orders * len(parts), pa.string()), pa.array(np.tile(steps, len(parts)))]
                yield pa.record_batch(columns + [pa.array(v.reshape(-1)) for v in values], names=["part", "filter_order", "step", *COUNTS])

    return by_part.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source") -> DataFrame:
    """One row for each part, order and step: what is kept, removed, redundant, unique, lost, and the filter's sum over orders."""
    return outcomes(histograms(docs, labels, part_col))


ORACLE = """
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
failing AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails
  FROM worded),
marked AS (
  SELECT f.part, f.fails, count(*) AS n,
    count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.quality = 1)) AS good,
    count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND l.toxic = 1)) AS toxic
  FROM failing f GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, s::INT AS step, filter_order[s] AS own, filter_order[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
judged AS (
  SELECT m.*, filter_order, step, own, contains(fails, own) AS hit, regexp_matches(fails, '[' || before || '0]') AS gone
  FROM marked m, steps),
told AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND hit), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE NOT gone AND hit), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told
"""
