"""Exact top-k search for the largest integer inner product, by a pivot-distance index.

Components become floor(scale * x). Every vector gets one more coordinate that makes all of them
equally long, and a query is stretched to that length; then the largest inner product is the nearest
vector, and distances obey the triangle inequality. A vector's key is its nearest pivot and its
distance from it. The index holds vectors in the order of their keys; the distances of a pivot are
divided into rings, and a pivot's ring is an annulus, of which the directory keeps the least and the
largest distance.

A query at distance d from a pivot is at least max(low - d, d - high, 0) away from all that an annulus
holds. It takes annuli in the order of that bound, a first helping and then GROWTH times as many rows
each time; an annulus whose bound allows no score as high as the query's k-th best so far is never
opened, and a query stops when none is left. Bounds have a margin for rounding, scores are exact.

The directory has at most PIVOTS * RINGS entries and is all that grows neither with rows nor with
queries; it and the pivots are broadcast. Rows of an annulus are worked on in slabs, queries in
blocks, so an annulus that holds a third of all rows, or that every query asks, is many tasks' work.
Vectors that spread evenly in many dimensions are all about equally far from every pivot: then few
annuli can be left unopened, and the work is queries times rows in blocks.

Defined results: vectors that are null or hold null or non-finite components take no part; shorter
vectors count as padded with zeros, so an empty one scores 0 with all; components beyond the range of
long are its ends, and so are scores; a row without an id is a candidate, behind others of its score,
and asks nothing; rows that share an id are candidates each and queries each, with a whole list, and
only a query's own row is not among its candidates; other columns are not read; without other rows a
query has no result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellstrand.llm.common import stored

#: Pivots and rings of a pivot, at most: the bound of the directory. Few rows have fewer rings, so that an annulus is worth a message.
PIVOTS, RINGS = 64, 512
LEAST_RINGS, RING_ROWS = 32, 1024
#: Rows that pivots are drawn from, by least hash, at most, and rounds of moving them to their rows' middle.
SAMPLE, ROUNDS = 2048, 4
#: Rows of a slab and queries of a block, at most, about, and rows below which a slab is not divided to give work to all slots.
SLAB_ROWS, QUERY_BLOCK, LEAST_SLAB = 16_384, 4096, 512
#: Rows of the first helping, and how much more each further one has.
FIRST_ROWS, GROWTH = 2048, 16
#: Queries whose scores are held at once.
QUERIES_AT_ONCE = 32
LONG = np.iinfo(np.int64)


def integers(vectors: DataFrame, is_query: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, asks and whole: the integer components of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), vector.alias("given"))
    fine = F.forall("given", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("given").isNotNull() & fine).select("vec_id", "asks", F.transform("given", lambda x: F.floor(F.lit(float(scale)) * x)).alias("whole"))


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """Lists of integers as rows of one width."""
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), dim), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass
class Space:
    """What all tasks know of the vectors: width, greatest length, type of stored components, pivots."""

    dim: int
    longest: float
    dtype: str
    pivots: np.ndarray
    rings: int = RINGS

    @property
    def exact_in_double(self) -> bool:
        """Whether no product of two vectors, nor any of its partial sums, leaves the integers that a double holds."""
        return self.longest**2 < 2**52

    def lifted(self, whole: np.ndarray) -> np.ndarray:
        points = whole.astype(np.float64)
        square = np.einsum("ij,ij->i", points, points)
        return np.concatenate([points, np.sqrt(np.maximum(0.0, self.longest**2 - square))[:, None]], 1)

    def stretched(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries as points on the sphere of the lifted vectors, and how long they were."""
        points = whole.astype(np.float64)
        length = np.linalg.norm(points, axis=1)
        points = points * (self.longest / np.maximum(length, 1e-300))[:, None]
        return np.concatenate([points, np.zeros((len(points), 1))], 1), length

    def distances(self, points: np.ndarray) -> np.ndarray:
        """points x pivots; all points and pivots are as long as `longest`, but for rounding and pivots inside the sphere."""
        square = (points**2).sum(1)[:, None] + (self.pivots**2).sum(1)[None] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(0.0, square))

    def ring_of(self, distance: np.ndarray) -> np.ndarray:
        return np.minimum(self.rings - 1, (distance * (self.rings / (2 * self.longest))).astype(np.int64))

    def best_score(self, length: float, bound: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product of a query with all that is `bound` or further away, with a margin for rounding."""
        return length * (self.longest - bound**2 / (2 * self.longest)) + 1 + 1e-6 * length * self.longest

    def read(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), dtype=self.dtype).reshape(len(blobs), self.dim).astype(np.int64)

    def scores(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products."""
        if self.exact_in_double:
            return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
        exact = queries.astype(object) @ rows.astype(object).T
        return np.clip(exact, int(LONG.min), int(LONG.max)).astype(np.int64).reshape(len(queries), len(rows))


def middles(points: np.ndarray, count: int) -> np.ndarray:
    """At most `count` pivots: spread-out points of a sample, moved to the middle of the points that they are nearest to."""
    points = np.unique(points, axis=0)
    chosen = [0]
    away = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(points)) and away.max() > 0:
        # the square root of the rank keeps far outliers from taking all places
        chosen.append(int(np.argsort(away)[-max(1, len(points) // 64)]) if away[np.argsort(away)[-max(1, len(points) // 64)]] > 0 else int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    pivots = points[chosen]
    for _ in range(ROUNDS):
        nearest = ((points**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * points @ pivots.T).argmin(1)
        held = np.bincount(nearest, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, nearest, points)
        pivots = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], pivots)
    return pivots


def space_of(rows: DataFrame, pivots: int = PIVOTS) -> Space | None:
    """Width and length over all rows, pivots from at most SAMPLE of them; None without rows."""
    square = F.aggregate("whole", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = F.array_max(F.transform("whole", lambda x: F.abs(x.cast("double"))))
    told = rows.agg(F.max(F.size("whole")).alias("dim"), F.max(F.sqrt(square)).alias("longest"), F.max(most).alias("most"), F.count(F.lit(1)).alias("n")).first()
    if told.dim is None:
        return None
    dtype = next((d for d, limit in (("<i2", 2**15), ("<i4", 2**31)) if (told.most or 0.0) < limit), "<i8")
    rings = min(RINGS, max(LEAST_RINGS, told.n // (pivots * RING_ROWS)))
    space = Space(int(told.dim), max(1.0, float(told.longest)), dtype, np.zeros((1, int(told.dim) + 1)), rings)
    picked = rows.orderBy(F.xxhash64("vec_id", "whole")).limit(SAMPLE).select("whole").collect()
    sample = padded(pa.array([r.whole for r in picked], pa.list_(pa.int64())), space.dim)
    space.pivots = middles(space.lifted(sample), pivots)
    return space


def indexed(rows: DataFrame, space: Space) -> DataFrame:
    """annulus, distance, row, vec_id, asks, vector: all rows in the order of their keys, stored.

    The order ends with the row's number, so that very many equal vectors are dealt to many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLAB_ROWS):
                own = batch.slice(start, SLAB_ROWS)
                whole = padded(own.column("whole"), space.dim)
                away = space.distances(space.lifted(whole))
                pivot = away.argmin(1)
                distance = away[np.arange(len(pivot)), pivot]
                annulus = pivot * RINGS + space.ring_of(distance)
                vector = pa.array([v.tobytes() for v in whole.astype(space.dtype)], pa.binary())
                yield pa.record_batch([pa.array(annulus), pa.array(distance), own.column("row"), own.column("vec_id"), own.column("asks"), vector], names=["annulus", "distance", "row", "vec_id", "asks", "vector"])

    keyed = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, "annulus long, distance double, row long, vec_id long, asks boolean, vector binary")
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["annulus", "distance", "row"]
    return stored(keyed.repartitionByRange(slots, *order).sortWithinPartitions(*order), "annuli")


class Directory:
    """The annuli: pivot, least and largest distance, rows."""

    def __init__(self, table: list[tuple[int, float, float, int]]):
        rows = sorted(table)
        self.annulus = np.array([r[0] for r in rows], dtype=np.int64)
        self.low, self.high = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        self.n = np.array([r[3] for r in rows], dtype=np.int64)
        self.pivot = self.annulus // RINGS

    def helpings(self) -> list[tuple[int, int]]:
        """Ranges of rows, in a query's order, that its helpings begin in."""
        ends = [0, FIRST_ROWS]
        while ends[-1] < self.n.sum():
            ends.append(ends[-1] * GROWTH)
        return list(zip(ends[:-1], ends[1:], strict=True))

    def asked(self, space: Space, away: np.ndarray, length: float, threshold: int | None, helping: tuple[int, int]) -> np.ndarray:
        """Places of the annuli that a query opens in a helping, nearest first."""
        own = away[self.pivot]
        bound = np.maximum(0.0, np.maximum(self.low - own, own - self.high))
        order = np.argsort(bound, kind="stable")
        before = np.cumsum(self.n[order]) - self.n[order]
        picked = order[(before >= helping[0]) & (before < helping[1])]
        if threshold is None:
            return picked
        return picked[space.best_score(length, bound[picked]) >= threshold]


def best_of_slab(rows: pa.Table, queries: pa.Table, space: Space, k: int) -> pa.Table:
    """The k best rows of a slab for each query of a block, none below the query's threshold."""
    ids, row = rows.column("vec_id").fill_null(int(LONG.max)).to_numpy(), rows.column("row").to_numpy()
    points, asking = space.read(rows.column("vector").to_pylist()), space.read(queries.column("vector").to_pylist())
    least = queries.column("threshold").fill_null(int(LONG.min)).to_numpy()
    query_row = queries.column("row").to_numpy()
    who, where, what = [], [], []
    for a in range(0, len(asking), QUERIES_AT_ONCE):
        scores = space.scores(asking[a : a + QUERIES_AT_ONCE], points)
        for q in range(len(scores)):
            place = np.flatnonzero((scores[q] >= least[a + q]) & (row != query_row[a + q]))
            own = scores[q][place]
            if len(place) > k:
                near = own >= np.partition(own, len(own) - k)[len(own) - k]
                place, own = place[near], own[near]
            order = np.lexsort((row[place], ids[place], ~own))[:k]
            who.append(np.full(len(order), a + q))
            where.append(place[order])
            what.append(own[order])
    who, where = (np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (who, where))
    score = np.concatenate([np.empty(0, dtype=np.int64), *what])
    query_id = queries.column("vec_id").take(pa.array(who))
    return pa.table({"query_row": query_row[who], "query_id": query_id, "row": row[where], "vec_id": rows.column("vec_id").take(pa.array(where)), "score": score})


FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def search(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, opened: list[int] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query row with all other rows.

    `opened`, if given, gets the pairs of a query and an annulus of each helping.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, is_query, scale, id_col, vector_col)
    space = space_of(rows, pivots)
    if space is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = indexed(rows, space)
    annuli = index.groupBy("annulus").agg(F.min("distance").alias("low"), F.max("distance").alias("high"), F.count(F.lit(1)).alias("n"))
    # PIVOTS times RINGS entries at most
    directory = Directory([tuple(r) for r in annuli.collect()])
    sent = spark.sparkContext.broadcast((space, directory))
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slab_rows = min(SLAB_ROWS, max(LEAST_SLAB, int(directory.n.sum()) // (4 * slots)))
    slabs = np.maximum(1, -(-directory.n // slab_rows))
    queries = stored(index.where("asks").select("row", "vec_id", "vector"), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    kept = spark.createDataFrame([], FOUND)

    def asking(helping: tuple[int, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, book = sent.value
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    points, length = own.stretched(own.read(part.column("vector").to_pylist()))
                    away = own.distances(points)
                    threshold = part.column("threshold").to_pylist()
                    places = [book.asked(own, away[q], float(length[q]), threshold[q], helping) for q in range(len(away))]
                    which = np.repeat(np.arange(len(places)), [len(p) for p in places])
                    place = np.concatenate([np.empty(0, dtype=np.int64), *places])
                    # one message for each slab of an annulus
                    several = slabs[place]
                    which, place, slab = np.repeat(which, several), np.repeat(place, several), np.arange(several.sum()) - np.repeat(np.cumsum(several) - several, several)
                    yield pa.record_batch([pa.array(book.annulus[place]), pa.array(slab), *(part.column(c).take(pa.array(which)) for c in ("row", "vec_id", "vector", "threshold"))], names=["annulus", "slab", "row", "vec_id", "vector", "threshold"])

        return run

    # an entry for each annulus that has several slabs, so no more than the directory holds
    several = spark.createDataFrame([(a, n) for a, n in zip(directory.annulus.tolist(), slabs.tolist(), strict=True) if n > 1], "annulus long, slabs long")
    slab = F.pmod(F.xxhash64("row"), F.coalesce("slabs", F.lit(1)))
    slabbed = index.join(F.broadcast(several), "annulus", "left").select("annulus", slab.alias("slab"), "row", "vec_id", "vector")

    for helping in directory.helpings():
        bar = kept.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("threshold")) if "rank" in kept.columns else None
        waiting = queries.join(bar, "row", "left") if bar is not None else queries.withColumn("threshold", F.lit(None).cast("long"))
        asked = waiting.repartition(slots, "row").mapInArrow(asking(helping), "annulus long, slab long, row long, vec_id long, vector binary, threshold long")
        asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "asked")
        if opened is not None:
            opened.append(asked.select("annulus", "row").distinct().count())
        keys = ["annulus", "slab", "block"]
        # under names of its own: both sides of the cogroup come from `asked`
        wanted = asked.select(*[F.col(c).alias(c) for c in keys]).distinct()
        copies = slabbed.join(wanted, ["annulus", "slab"])

        def near(rows: pa.Table, queries: pa.Table) -> pa.Table:
            return best_of_slab(rows, queries, sent.value[0], k)

        found = copies.repartition(slots, *keys).groupBy(*keys).cogroup(asked.repartition(slots, *keys).groupBy(*keys)).applyInArrow(near, FOUND)
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
        both = found.unionByName(kept.select(*found.columns))
        kept = stored(both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
    return kept.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.row AS query_row, q.vec_id AS query_id, r.row, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM whole q JOIN whole r ON q.row <> r.row WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id NULLS LAST, row)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
