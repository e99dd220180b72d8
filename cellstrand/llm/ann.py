"""Approximate nearest neighbours by a forest of random-projection trees, for the largest inner product.

Vectors get one more coordinate that makes all of them equally long, which turns the largest inner
product into the nearest direction. Each tree cuts space by random directions at the median of a
bounded sample. All trees are searched together through one priority queue of nodes: the cost of a
node is how unlikely a neighbour of the query lies there (the sum over its path of minus the log
probability of the side taken), and leaves are taken, cheapest first over all trees, until they hold
a certain share of the sample. That share is fitted: on some rows of the sample, whose nearest
others in the sample are known, it is the least that finds RECALL of them.

Every row is indexed: it is dealt to the leaf that it has in each tree. A part of the work is a run of
leaves of one tree with about PART_ROWS rows; a leaf with more is dealt to several parts. A query goes
to the parts that hold leaves it takes, and is multiplied with the rows of those leaves only; each
part puts out the best of them by their exact inner product in double precision. A part that very many
queries ask is worked on in blocks of QUERY_BLOCK of them. Vectors that spread evenly in all
directions need a large share of the leaves, clustered ones a small one.

Defined results: vectors that are null or zero, hold null or non-finite components or have not the
most frequent dimension (the lesser of equally frequent ones) take no part, nor do rows with a null
id; equal scores go to the smaller id; rows that share an id are separate candidates and separate
queries, each with a whole list, and only a query's own row is not among its candidates; without
other rows a query has no neighbours; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from cellstrand.llm.common import stored

TREES = 4
#: Rows that the trees are cut on, at most, and rows of it in a leaf, about.
SAMPLE = 8192
LEAF = 32
#: Part of the nearest rows that the share of rows looked at is fitted to find, and queries it is fitted on.
RECALL, TRIALS = 0.95, 128
#: Weight of a query's distance from a cut, in standard deviations of the rows there.
STEER = 0.5
#: Rows of a part at most, about, and queries that a part works on at once.
PART_ROWS, QUERY_BLOCK = 50_000, 16_384
#: Rows below which a part is not divided further to give work to all slots.
LEAST_ROWS = 4096
#: Queries whose scores are held at once.
QUERIES_AT_ONCE = 64


class Forest:
    def __init__(self, sample: np.ndarray, longest: float, trees: int = TREES, leaf: int = LEAF, share: float = 1.0, seed: int = 5):
        self.longest, self.share, self.dim = longest, share, sample.shape[1]
        self.depth = max(0, int(math.log2(max(1, len(sample) / leaf))))
        rng = np.random.default_rng(seed)
        inner = (1 << self.depth) - 1
        self.direction = rng.normal(size=(trees, inner, self.dim + 1))
        self.direction /= np.linalg.norm(self.direction, axis=2, keepdims=True)
        self.cut, self.spread = np.zeros((trees, inner)), np.ones((trees, inner))
        points = self.lifted(sample)
        for t in range(trees):
            node = np.zeros(len(points), dtype=np.int64)
            for level in range(self.depth):
                height = self._heights(t, node, points)
                for k in range((1 << level) - 1, (2 << level) - 1):
                    if len(own := height[node == k]):
                        self.cut[t, k], self.spread[t, k] = np.median(own), max(float(own.std()), 1e-12)
                node = 2 * node + 1 + (height > self.cut[t, node])
        place = self.leaves(sample)
        self.weight = np.stack([np.bincount(p, minlength=1 << self.depth) for p in place])
        self.members = [[np.flatnonzero(p == k) for k in range(1 << self.depth)] for p in place]
        self.size = len(sample)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        square = np.einsum("ij,ij->i", vectors, vectors)
        return np.concatenate([vectors, np.sqrt(np.maximum(0.0, self.longest**2 - square))[:, None]], 1)

    def _heights(self, tree: int, node: np.ndarray, points: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", points, self.direction[tree][node])

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree."""
        points = self.lifted(vectors)
        out = np.zeros((len(self.cut), len(vectors)), dtype=np.int64)
        for t in range(len(self.cut)):
            for _ in range(self.depth):
                out[t] = 2 * out[t] + 1 + (self._heights(t, out[t], points) > self.cut[t, out[t]])
        return out - ((1 << self.depth) - 1)

    def walk(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) of all leaves, in the order that the search of one query takes them."""
        point = np.append(query / max(np.linalg.norm(query), 1e-300) * self.longest, 0.0)
        away = STEER * (self.direction @ point - self.cut) / self.spread / math.sqrt(2)
        right = [[-math.log(max(0.5 * math.erfc(-z), 1e-300)) for z in row] for row in away.tolist()]
        left = [[-math.log(max(0.5 * math.erfc(z), 1e-300)) for z in row] for row in away.tolist()]
        inner = away.shape[1]
        queue = [(0.0, t, 0) for t in range(len(self.cut))]
        while queue:
            cost, t, node = heapq.heappop(queue)
            if node >= inner:
                yield t, node - inner
            else:
                heapq.heappush(queue, (cost + left[t][node], t, 2 * node + 1))
                heapq.heappush(queue, (cost + right[t][node], t, 2 * node + 2))

    def taken(self, query: np.ndarray) -> np.ndarray:
        """trees x leaves: whether the search of one query takes the leaf."""
        took = np.zeros((len(self.cut), 1 << self.depth), dtype=bool)
        covered = np.zeros(self.size, dtype=bool)
        for t, leaf in self.walk(query):
            took[t, leaf] = True
            covered[self.members[t][leaf]] = True
            if covered.sum() >= self.share * self.size:
                break
        return took

    def fit_share(self, sample: np.ndarray, nearest: int, recall: float = RECALL, trials: int = TRIALS) -> None:
        """Set the share to the least that finds `recall` of the nearest others of some sample rows."""
        before: list[float] = []
        for one in np.unique(np.linspace(0, len(sample) - 1, trials).astype(np.int64)).tolist():
            score = sample @ sample[one]
            score[one] = -np.inf
            wanted = np.zeros(len(sample), dtype=bool)
            wanted[np.argsort(-score, kind="stable")[: min(nearest, len(sample) - 1)]] = True
            covered = np.zeros(len(sample), dtype=bool)
            for t, leaf in self.walk(sample[one]):
                own = self.members[t][leaf]
                found = own[wanted[own]]
                before += [covered.mean()] * len(found)
                wanted[found] = False
                if not wanted.any():
                    break
                covered[own] = True
        self.share = float(np.quantile(before, recall, method="higher")) + 1e-9 if before else 1.0


def valid(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id long, embedding array<double>, asks boolean) of the rows that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine & F.exists("embedding", lambda x: x != 0))


def fit(rows: DataFrame, k: int, trees: int = TREES, share: float | None = None, sample: int = SAMPLE) -> Forest | None:
    """A forest from the `sample` valid rows of the most frequent dimension of least hash of the id; None without any.

    Of n rows a query's k nearest are, in the sample of s rows, its k * s / n nearest, and at least one.
    """
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    told = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(square)).alias("longest")).orderBy(F.desc("n"), "dim").first()
    if told is None:
        return None
    picked = rows.where(F.size("embedding") == told.dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").collect()
    own = np.array([r.embedding for r in picked])
    forest = Forest(own, float(told.longest), trees)
    if share is None:
        forest.fit_share(own, max(1, round(k * len(own) / told.n)))
    else:
        forest.share = share
    return forest


class Parts:
    """Which part each leaf of each tree belongs to; a leaf with many rows has several, from the first on."""

    def __init__(self, rows: np.ndarray, part_rows: int):
        self.first, self.several = np.zeros(rows.shape, dtype=np.int64), np.ones(rows.shape, dtype=np.int64)
        part = 0
        for t, of_tree in enumerate(rows):
            held = 0
            for leaf, n in enumerate(of_tree.tolist()):
                if held and held + n > part_rows:
                    part, held = part + 1, 0
                self.first[t, leaf], self.several[t, leaf] = part, max(1, -(-n // part_rows))
                held += n
                if n > part_rows:
                    part, held = part + int(self.several[t, leaf]), 0
            part += 1
        self.count = part


def dealt_rows(forest: Forest, parts: Parts, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(part, row, vec_id, leaf, vector) of rows (row, vec_id, vector, ...), once for each tree."""
    row = batch.column("row").to_numpy()
    place = forest.leaves(vectors_of(batch.column("vector"), forest.dim))
    trees = np.arange(len(place))[:, None]
    part = parts.first[trees, place] + (row * 0x9E3779B1 >> 7) % parts.several[trees, place]
    take = pa.array(np.tile(np.arange(len(row)), len(place)))
    leaf = trees * parts.first.shape[1] + place
    return pa.record_batch([pa.array(part.reshape(-1)), batch.column("row").take(take), batch.column("vec_id").take(take), pa.array(leaf.reshape(-1).astype(np.int32)), batch.column("vector").take(take)], names=["part", "row", "vec_id", "leaf", "vector"])


def dealt_queries(forest: Forest, parts: Parts, batch: pa.RecordBatch) -> pa.RecordBatch:
    """(part, row, vec_id, leaves, vector) of queries, once for each part that holds leaves that the query takes."""
    part, which, leaves = [], [], []
    for k, query in enumerate(vectors_of(batch.column("vector"), forest.dim)):
        tree, leaf = np.nonzero(forest.taken(query))
        first, several = parts.first[tree, leaf], parts.several[tree, leaf]
        code = (tree * parts.first.shape[1] + leaf).astype(np.int32)
        for p in np.unique(first).tolist():
            own = first == p
            for more in range(int(several[own].max())):
                part.append(p + more)
                which.append(k)
                # the parts behind the first hold rows of the divided leaf only
                leaves.append(code[own if not more else own & (several > 1)].tobytes())
    take = pa.array(which, pa.int64())
    return pa.record_batch([pa.array(part, pa.int64()), batch.column("row").take(take), batch.column("vec_id").take(take), pa.array(leaves, pa.binary()), batch.column("vector").take(take)], names=["part", "row", "vec_id", "leaves", "vector"])


def vectors_of(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dim)


def best_of(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of a row of scores (minus infinity: no candidate) and all that come near the k-th."""
    place = np.flatnonzero(score > -np.inf)
    if len(place) <= k:
        return place
    own = score[place]
    least = np.partition(own, len(own) - k)[len(own) - k]
    return place[own >= least - 1e-9 * max(1.0, abs(least))]


def nearest_in_part(rows: pa.Table, queries: pa.Table, dim: int, k: int) -> tuple[pa.Table, int]:
    """The best of a part's rows for each query, among the rows of the leaves that it takes; and how many products that took."""
    rows = rows.sort_by([("leaf", "ascending"), ("vec_id", "ascending"), ("row", "ascending")])
    leaf, row, ids = rows.column("leaf").to_numpy(), rows.column("row").to_numpy(), rows.column("vec_id").to_numpy()
    points, query, query_row = vectors_of(rows.column("vector"), dim), vectors_of(queries.column("vector"), dim), queries.column("row").to_numpy()
    leaves = [np.frombuffer(x, dtype=np.int32) for x in queries.column("leaves").to_pylist()]
    begin = np.flatnonzero(np.r_[True, np.diff(leaf) != 0]) if len(leaf) else np.empty(0, dtype=np.int64)
    runs = list(zip(leaf[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(leaf)], strict=False))
    products, out = 0, []
    for a in range(0, len(query), QUERIES_AT_ONCE):
        own = query[a : a + QUERIES_AT_ONCE]
        takers: dict[int, list[int]] = {}
        for q, taken in enumerate(leaves[a : a + QUERIES_AT_ONCE]):
            for x in taken.tolist():
                takers.setdefault(x, []).append(q)
        score = np.full((len(own), len(points)), -np.inf)
        for x, low, high in runs:
            if who := takers.get(x):
                score[who, low:high] = own[who] @ points[low:high].T
                products += len(who) * (high - low)
        for q in range(len(own)):
            score[q, row == query_row[a + q]] = -np.inf
            best = best_of(score[q], k)
            exact = (points[best] * own[q]).sum(1)
            order = np.lexsort((row[best], ids[best], -exact))[:k]
            out.append((a + q, best[order], exact[order]))
    which = np.repeat([q for q, _, _ in out], [len(b) for _, b, _ in out]).astype(np.int64)
    place = np.concatenate([np.empty(0, dtype=np.int64), *(b for _, b, _ in out)])
    scores = np.concatenate([np.empty(0), *(e for _, _, e in out)])
    query_id = queries.column("vec_id").to_numpy()
    return pa.table({"query_row": query_row[which], "query_id": query_id[which], "row": row[place], "vec_id": ids[place], "score": scores}), products


NEAR = "query_row long, query_id long, row long, vec_id long, score double"


def search(vectors: DataFrame, is_query: Column, k: int = 20, trees: int = TREES, share: float | None = None, part_rows: int = PART_ROWS, block: int = QUERY_BLOCK, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row among all other rows."""
    spark = vectors.sparkSession
    given = valid(vectors, is_query)
    forest = fit(given, k, trees, share, sample)
    if forest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(forest)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            points = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, own.dim)
            blob = np.ascontiguousarray(points, dtype="<f8").tobytes()
            step = own.dim * 8
            place = own.leaves(points).T.astype(np.int32)
            yield pa.record_batch([batch.column("row"), batch.column("vec_id"), batch.column("asks"), pa.array([blob[n : n + step] for n in range(0, len(blob), step)], pa.binary()), pa.array(list(place), pa.list_(pa.int32()))], names=["row", "vec_id", "asks", "vector", "place"])

    # kept once: the number of a row is its identity in all that follows
    numbered = given.where(F.size("embedding") == forest.dim).withColumn("row", F.monotonically_increasing_id())
    indexed = stored(numbered.select("row", "vec_id", "asks", "embedding").mapInArrow(index, "row long, vec_id long, asks boolean, vector binary, place array<int>"), "vectors")
    held = np.zeros((trees, 1 << forest.depth), dtype=np.int64)
    # trees times leaves numbers at most
    for t, leaf, n in indexed.select(F.posexplode("place").alias("tree", "leaf")).groupBy("tree", "leaf").agg(F.count(F.lit(1))).collect():
        held[t, leaf] = n
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = Parts(held, min(part_rows, max(LEAST_ROWS, int(held.sum()) // (2 * slots))))

    def to_parts(deal: Callable[[Forest, Parts, pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    yield deal(sent.value, parts, batch.slice(start, 1024))

        return run

    asked = indexed.where("asks").repartition(slots, "row").mapInArrow(to_parts(dealt_queries), "part long, row long, vec_id long, leaves binary, vector binary")
    asked = stored(asked, "queries")
    blocks = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    asked = asked.join(blocks, "part").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")).drop("blocks")
    rows = indexed.mapInArrow(to_parts(dealt_rows), "part long, row long, vec_id long, leaf int, vector binary")
    rows = rows.join(blocks, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    dim = forest.dim

    def near(rows: pa.Table, queries: pa.Table) -> pa.Table:
        return nearest_in_part(rows, queries, dim, k)[0]

    def by_part(df: DataFrame) -> GroupedData:
        return df.repartition(max(slots, parts.count), "part", "block").groupBy("part", "block")

    found = by_part(rows).cogroup(by_part(asked)).applyInArrow(near, NEAR)
    # a row that is found in several trees has the same score in each, hence the same rank
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).dropDuplicates(["query_row", "rank"])
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
