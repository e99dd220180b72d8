"""Jaccard metric-space join of word-shingle sets: pivots, Voronoi regions and triangle-inequality windows.

Documents with the same set are one class. Two classes link when their sets' Jaccard similarity is
at least THRESHOLD_PERCENT, i.e. their distance 1 - J, which is a metric, is at most r.

1. A count table partitioned by ranges of shingle hashes tells each class how many classes have each
   of its shingles. A class with more than the allowed part of shingles that nobody else has is alone.
2. In a metric space of which most points are at distance 1 from each other, pivots alone part
   nothing. So lower bounds on the distance part it first: classes that share none of the rarest
   shingles that a link needs (ordered by count, then hash), and classes of which one has less than
   THRESHOLD_PERCENT of the other's size, are further apart than r. Blocks are what is left connected.
3. A block is joined recursively. Documents' distances to a few pivots are computed. Each belongs to
   the region of its nearest pivot, and is a guest in a region j where a neighbour may live: if its
   distance to pivot j is at most 2r more than to its own, and at most r more than the region's
   radius. Documents within r of pivot j are linked to it, hence to each other. Only the outer ones,
   and inner ones within the window (distance to the pivot at least the least outer one's less r),
   go on to the next level. In small regions, and once in those that pivots do not part, a distance is
   computed only if no lower bound forbids a link: the difference of the distances to any pivot is
   at most r, sizes allow it, and they share one of the shingles that are rarest in the region.

Blocks up to BLOCK_WEIGHT shingles are joined within a task; larger ones are split by the same rule
over the cluster, level by level. A block whose regions together have about as many pairs as itself is not
split further, but compared once, slice against slice, up to SLICES of them; what is larger is split first by the shingles that are rarest in the block, so that a class is
sent a bounded number of times. Links are put out as spanning forests, never as all pairs of a group. Shingles and sets are told apart by 64 bits;
counts stop at 65,535, which changes the order of shingles only, for all classes alike.

Defined results: null, empty and blank texts have no shingles and are alone; a text with fewer than
SHINGLE words has one shingle; the component is the least document id that is linked, null ids
do not count and rows with null ids get the component of their text; repeated rows are linked; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellstrand.llm import chunkstore
from cellstrand.llm.chunkstore import packed, plain, unpacked, unplain
from cellstrand.llm.common import bytes_of, cuts, id_and_text, mixed, stored
from cellstrand.llm.components import components
from cellstrand.llm.wordhash import Table, combined, ranked, word_hashes

SHINGLE = 5
THRESHOLD_PERCENT = 75
RADIUS = 1 - THRESHOLD_PERCENT / 100
NEAR = 1e-9
CHUNK_BYTES = 5 << 20
#: Shingles that a partition of the count table is laid out for, and beyond which a block is work for several tasks.
PART_SHINGLES = 750_000
BLOCK_WEIGHT = 500_000
#: Slices up to which a block that pivots do not part is compared slice against slice; each class is sent so many times. A larger one is split by rarity, which sends each as many times as it has rare shingles.
SLICES = 64
PIVOTS, LEAF, LEVELS = 6, 16, 2
#: Pairs within all regions together, as a part of a block's own pairs, beyond which pivots have not parted it.
PARTED = 0.7
U = np.uint64


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in a row, and the n+1 offsets."""
    words, count = word_hashes(texts)
    document = np.repeat(np.arange(len(texts)), count)
    begin = np.cumsum(count) - count
    if not len(words):
        return np.empty(0, dtype=U), np.zeros(len(texts) + 1, dtype=np.int64)
    rolled = words
    for k in range(1, size):
        if len(words) <= k:
            rolled = words[:0]
            break
        rolled = combined(rolled[: len(words) - k], words[k:])
    whole = np.arange(len(rolled)) + size <= (begin + count)[document[: len(rolled)]]
    owner, value = document[: len(rolled)][whole], rolled[whole]
    short = np.flatnonzero((count > 0) & (count < size))
    few = []
    for d in short.tolist():
        h = np.array([count[d]], dtype=U)
        for w in words[begin[d] : begin[d] + count[d]]:
            h = combined(h, np.array([w], dtype=U))
        few.append(h[0])
    owner, value = np.r_[owner, short], np.r_[value, np.array(few, dtype=U)]
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    place = ranked(value)
    again = (value[place][1:] == value[place][:-1]) & (owner[place][1:] == owner[place][:-1])
    once = np.ones(len(value), dtype=bool)
    once[place[1:][again]] = False
    owner, value = owner[once], value[once]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def chunk_sets(table: pa.Table, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sets of (some) rows of a chunk, a bounded part at a time."""
    column = table.column("text") if rows is None else table.column("text").take(pa.array(rows))
    values, sizes = [np.empty(0, dtype=U)], [np.empty(0, dtype=np.int64)]
    for part in column.chunks:
        for a, b in cuts(part):
            value, at = shingle_sets(bytes_of(part.slice(a, b - a)))
            values.append(value)
            sizes.append(np.diff(at))
    return np.concatenate(values), np.r_[0, np.cumsum(np.concatenate(sizes))]


def set_digests(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set; sets of other content get other digests but for chance."""
    with np.errstate(over="ignore"):
        first, second = np.r_[U(0), np.cumsum(mixed(value), dtype=U)], np.r_[U(0), np.cumsum(mixed(value ^ U(0xA0761D6478BD642F)), dtype=U)]
        return combined(first[at[1:]] - first[at[:-1]], second[at[1:]] - second[at[:-1]] + np.diff(at).astype(U))


class Forest:
    """Union-find; its edges so far are a spanning forest."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((x, y))


class Sets:
    """Sets of a block: shared shingles in a row with offsets, and whole sizes."""

    def __init__(self, value: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.number, self.at, self.size = np.unique(value, return_inverse=True)[1], at, size
        self.mark = np.zeros(int(self.number.max()) + 1 if len(value) else 1, dtype=bool)
        #: distances computed so far
        self.distances = 0

    def places(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of some members' shingles, and how many each has."""
        length = self.at[members + 1] - self.at[members]
        return np.repeat(self.at[members] - (np.cumsum(length) - length), length) + np.arange(length.sum()), length

    def to(self, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of others from one, and whether they link."""
        own = self.number[self.at[one] : self.at[one + 1]]
        self.mark[own] = True
        self.distances += len(others)
        place, length = self.places(others)
        hit = np.r_[0, np.cumsum(self.mark[self.number[place]])]
        ends = np.cumsum(length)
        both = hit[ends] - hit[ends - length]
        self.mark[own] = False
        union = self.size[one] + self.size[others] - both
        return 1 - both / np.maximum(union, 1), 100 * both >= THRESHOLD_PERCENT * union


def regions(distance: np.ndarray, linked: np.ndarray) -> Iterator[np.ndarray]:
    """For each pivot (row) what its region takes to the next level, as places in the columns."""
    own = distance.argmin(0)
    nearest = distance.min(0)
    for j in range(len(distance)):
        home = own == j
        if not home.any():
            continue
        guest = ~home & (distance[j] <= nearest + 2 * RADIUS + NEAR) & (distance[j] <= distance[j][home].max() + RADIUS + NEAR)
        here = home | guest
        outer = here & ~linked[j]
        if outer.any():
            yield np.flatnonzero(outer | (here & linked[j] & (distance[j] >= distance[j][outer].min() - RADIUS - NEAR)))


def join_block(sets: Sets, members: np.ndarray, forest: Forest) -> None:
    """Link all members of a block that are near each other; recursion over regions."""
    waiting = [members]
    while waiting:
        region = waiting.pop()
        if len(region) < 2 or len({forest.find(x) for x in region.tolist()}) == 1:
            continue
        if len(region) <= LEAF:
            compare(sets, region, forest)
            continue
        pivots = [0]
        distance, linked = (x[None] for x in sets.to(region[0], region))
        for _ in range(PIVOTS - 1):
            far = int(distance.min(0).argmax())
            if distance[:, far].min() == 0:
                break
            d, k = sets.to(region[far], region)
            pivots.append(far)
            distance, linked = np.vstack([distance, d]), np.vstack([linked, k])
        for p, near in zip(pivots, linked, strict=True):
            for x in region[near].tolist():
                forest.link(int(region[p]), x)
        parts = [np.setdiff1d(part, pivots) for part in regions(distance, linked)]
        if sum(len(part) ** 2 for part in parts) > PARTED * len(region) ** 2:
            # once, and not once for each region that has nearly all
            part = np.setdiff1d(np.arange(len(region)), pivots)
            compare(sets, region[part], forest, distance[:, part])
        else:
            waiting += [region[part] for part in parts]


def compare(sets: Sets, region: np.ndarray, forest: Forest, distance: np.ndarray | None = None) -> None:
    """Link all members of a region that are near each other, by the distances that no lower bound makes needless.

    distance: of all members from some pivots.
    """
    place, length = sets.places(region)
    member, number = np.repeat(np.arange(len(region)), length), sets.number[place]
    shingle, number = np.unique(number, return_inverse=True)
    count = np.bincount(number)
    # of the shingles at hand a link needs THRESHOLD_PERCENT of the whole set: it has one of the others and one more
    spare = length - -(-THRESHOLD_PERCENT * sets.size[region] // 100)
    order = np.lexsort((number, count[number], member))
    rank = np.arange(len(member)) - np.repeat(np.cumsum(length) - length, length)
    kept = order[(rank <= np.repeat(spare, length)) & (count[number[order]] > 1)]
    by_shingle = kept[np.argsort(number[kept], kind="stable")]
    begin = np.searchsorted(number[by_shingle], np.arange(len(shingle) + 1))
    first = np.searchsorted(member[kept], np.arange(len(region) + 1))
    holders, size = member[by_shingle], sets.size[region]
    there = np.zeros(len(region), dtype=bool)
    for x in range(len(region)):
        lists = [holders[begin[s] : begin[s + 1]] for s in number[kept[first[x] : first[x + 1]]].tolist()]
        if not lists:
            continue
        there[np.concatenate(lists)] = True
        near = np.flatnonzero(there[x + 1 :]) + x + 1
        there[:] = False
        near = near[100 * np.minimum(size[near], size[x]) >= THRESHOLD_PERCENT * np.maximum(size[near], size[x])]
        if distance is not None and len(near):
            near = near[(np.abs(distance[:, near] - distance[:, [x]]) <= RADIUS + NEAR).all(0)]
        own = forest.find(int(region[x]))
        near = np.array([y for y in near.tolist() if forest.find(int(region[y])) != own], dtype=np.int64)
        if len(near):
            for y in region[near[sets.to(int(region[x]), region[near])[1]]].tolist():
                forest.link(int(region[x]), y)


def sets_of_rows(blobs: list[bytes], sizes: list[int]) -> Sets:
    parts = [unpacked(b, U) for b in blobs]
    return Sets(np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64), np.array(sizes, dtype=np.int64))


ITEMS = "kind int, key long, n long, weight long, part int, chunk long, a binary, b binary, c binary"
ITEM_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
EDGE, SET, PREFIX = range(3)


def batch_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def classes_of(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[str, DataFrame]:
    """The chunk folder, and a stored (chunk, row, doc_id, n, key) of every document; docs: doc_id, text and any more columns."""

    url, table = chunkstore.store(docs, lambda rows: (rows.num_rows, {}), most=chunk_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                rows = chunkstore.read(url, chunk)
                value, at = chunk_sets(rows)
                key = set_digests(value, at).view(np.int64)
                yield pa.record_batch([pa.array([chunk] * rows.num_rows, pa.int64()), pa.array(np.arange(rows.num_rows)), rows.column("doc_id").combine_chunks().cast(pa.int64()), pa.array(np.diff(at)), pa.array(key)], names=["chunk", "row", "doc_id", "n", "key"])

    return url, stored(chunkstore.dealt(table).mapInArrow(run, "chunk long, row long, doc_id long, n long, key long"), "classes")


def candidates(url: str, owned: DataFrame, parts: int) -> DataFrame:
    """Stored items: sets of the classes that may link, edges between some of them, and prefix shingles by part.

    owned: (chunk, row, key, n), one row for each class.
    """

    def asked(rows: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, Table, np.ndarray]:
        chunk = rows.column("chunk")[0].as_py()
        own = rows.filter(pc.is_valid(rows.column("row"))).sort_by("row")
        value, at = chunk_sets(chunkstore.read(url, chunk), own.column("row").to_numpy())
        shingles = Table.of(value, np.ones(len(value), dtype=bool))
        return chunk, own.column("key").to_numpy(), value, at, shingles, shingles.parts(parts)

    def ask(rows: pa.Table) -> pa.Table:
        chunk, _, _, _, own, begin = asked(rows)
        count = np.minimum(own.count, 65535).astype(np.uint16)
        told = [(p, chunk, packed(own.distinct[begin[p] : begin[p + 1]]), plain(count[begin[p] : begin[p + 1]])) for p in np.flatnonzero(np.diff(begin)).tolist()]
        return batch_of(told, ["part", "chunk", "a", "b"], [pa.int32(), pa.int64(), pa.binary(), pa.binary()])

    def add_up(table: pa.Table) -> pa.Table:
        shingle = [unpacked(x, U) for x in table.column("a").to_pylist()]
        _, where = np.unique(np.concatenate(shingle), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([unplain(x, np.uint16) for x in table.column("b").to_pylist()]))
        total = np.minimum(total, 65535).astype(np.uint16)
        ends = np.cumsum([len(s) for s in shingle])
        out = [plain(total[where[x:y]]) for x, y in zip([0, *ends[:-1]], ends, strict=True)]
        size = table.num_rows
        return pa.table({"chunk": table.column("chunk"), "row": pa.nulls(size, pa.int64()), "key": pa.nulls(size, pa.int64()), "part": table.column("part"), "answer": pa.array(out, pa.binary())})

    def pick(rows: pa.Table) -> pa.Table:
        chunk, key, value, at, own, begin = asked(rows)
        told = dict(zip(rows.column("part").to_pylist(), rows.column("answer").to_pylist(), strict=True))
        spread = np.concatenate([np.empty(0, dtype=np.uint16), *(unplain(told[p], np.uint16) for p in np.flatnonzero(np.diff(begin)).tolist())])
        number = np.empty(len(value), dtype=np.int64)
        number[own.place] = own.number
        count = spread[number].astype(np.int64)
        # the order of all shingles: by count, then by hash
        rarity = np.empty(len(spread), dtype=np.int64)
        rarity[np.argsort(spread, kind="stable")] = np.arange(len(spread))
        size = np.diff(at)
        document = np.repeat(np.arange(len(size)), size)
        alone = np.bincount(document[count == 1], minlength=len(size))
        # a link of a set of n needs ceil(0.75 n) common shingles: so many of its others may be alone
        spare = size - -(-THRESHOLD_PERCENT * size // 100)
        live = (alone <= spare) & (size > 0)
        by_rarity = np.argsort(document << 32 | rarity[number])
        rank = np.arange(len(value)) - np.repeat(at[:-1], size)
        in_prefix = np.zeros(len(value), dtype=bool)
        in_prefix[by_rarity] = rank <= np.repeat(spare, size)
        in_prefix &= (count > 1) & live[document]
        out: list[tuple] = []
        shared = count > 1
        for d in np.flatnonzero(live).tolist():
            kept = np.sort(value[at[d] : at[d + 1]][shared[at[d] : at[d + 1]]])
            out.append((SET, int(key[d]), int(size[d]), len(kept), None, None, packed(kept), None, None))
        forest = Forest(len(size))
        places = np.flatnonzero(in_prefix)
        places = places[np.lexsort((size[document[places]], value[places]))]
        of, shingle = document[places], value[places]
        same = (shingle[1:] == shingle[:-1]) & (100 * size[of][:-1] >= THRESHOLD_PERCENT * size[of][1:])
        for x, y in zip(of[:-1][same].tolist(), of[1:][same].tolist(), strict=True):
            forest.link(x, y)
        out += [(EDGE, int(key[x]), int(key[y]), 0, None, None, None, None, None) for x, y in forest.edges]
        # one row for each prefix shingle and run of sizes that is linked in the chunk
        first = np.flatnonzero(np.r_[True, ~same][: len(places)])
        last = np.r_[first[1:], len(places)] - 1
        ends = Table(first, first, shingle[first], first).parts(parts)
        for p in np.flatnonzero(np.diff(ends)).tolist():
            a, b = first[ends[p] : ends[p + 1]], last[ends[p] : ends[p + 1]]
            out.append((PREFIX, None, None, None, p, chunk, packed(shingle[a]), plain(key[of[a]]), plain(np.stack([size[of[a]], size[of[b]]]))))
        return batch_of(out, ["kind", "key", "n", "weight", "part", "chunk", "a", "b", "c"], ITEM_TYPES)

    asks = chunkstore.by(owned.select("chunk", "row", "key"), "chunk").applyInArrow(ask, "part int, chunk long, a binary, b binary")
    answers = chunkstore.by(asks, "part").applyInArrow(add_up, "chunk long, row long, key long, part int, answer binary")
    mine = owned.select("chunk", "row", "key", F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("answer"))
    return stored(chunkstore.by(mine.unionByName(answers), "chunk").applyInArrow(pick, ITEMS), "items")


def prefix_edges(items: DataFrame) -> DataFrame:
    """Edges (a, b) between groups that share a prefix shingle and whose sizes allow a link: a spanning forest from each part."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        value = np.concatenate([unpacked(x, U) for x in table.column("a").to_pylist()])
        key = np.concatenate([unplain(x, np.int64) for x in table.column("b").to_pylist()])
        low, high = np.concatenate([unplain(x, np.int64).reshape(2, -1) for x in table.column("c").to_pylist()], axis=1)
        keys, number = np.unique(key, return_inverse=True)
        order = np.lexsort((low, value))
        value, low, high, number = value[order], low[order], high[order], number[order]
        alike = value[1:] == value[:-1]
        largest = np.maximum.accumulate(np.cumsum(np.r_[True, ~alike]) << 32 | high) & 0xFFFFFFFF
        same = alike & (100 * largest[:-1] >= THRESHOLD_PERCENT * low[1:])
        forest = Forest(len(keys))
        for x, y in zip(number[:-1][same].tolist(), number[1:][same].tolist(), strict=True):
            forest.link(x, y)
        return batch_of([(int(keys[x]), int(keys[y])) for x, y in forest.edges], ["a", "b"], [pa.int64(), pa.int64()])

    return chunkstore.by(items.where(F.col("kind") == PREFIX).select("part", "chunk", "a", "b", "c"), "part").applyInArrow(run, "a long, b long")


def joined_in_tasks(rows: DataFrame, parts: int) -> DataFrame:
    """Links (a, b) within blocks; rows (block, key, n, blob), each block within BLOCK_WEIGHT."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("key", "ascending")])
        block, key = table.column("block").to_numpy(), table.column("key").to_numpy()
        ends = np.r_[np.flatnonzero(np.diff(block)) + 1, len(block)]
        out: list[tuple[int, int]] = []
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            if b - a < 2:
                continue
            own = table.slice(int(a), int(b - a))
            sets, forest = sets_of_rows(own.column("blob").to_pylist(), own.column("n").to_pylist()), Forest(int(b - a))
            join_block(sets, np.arange(b - a), forest)
            out += [(int(key[a + x]), int(key[a + y])) for x, y in forest.edges]
        return batch_of(out, ["a", "b"], [pa.int64(), pa.int64()])

    return chunkstore.by(rows.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts))), "part").applyInArrow(run, "a long, b long")


def split_once(large: DataFrame, sets: DataFrame, level: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One level of the distributed recursion: links to pivots, the members (block, key, weight) of the next level's regions, and those of blocks that pivots have not parted, as they were."""
    weight = large.groupBy("block").agg(F.sum("weight").alias("total"))
    pivots = large.groupBy("block").agg(F.array(*[F.min(F.struct(F.xxhash64("key", F.lit(level * PIVOTS + j)).alias("h"), "key"))["key"] for j in range(PIVOTS)]).alias("p"))
    pivots = stored(pivots.select("block", F.array_distinct("p").alias("p")), "pivots")
    salts = F.ceil(F.col("total") / limit).cast("int")
    spread = weight.withColumn("salts", salts)
    of_pivot = sets.select(F.col("key").alias("pivot_key"), F.col("n").alias("pivot_n"), F.col("blob").alias("pivot_blob"))
    docs = large.join(spread.select("block", "salts"), "block").withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int")).join(sets, "key").select("block", "salt", "key", "weight", "n", "blob")
    stood = pivots.select(F.col("block").alias("pivot_block"), F.explode("p").alias("pivot_key")).join(of_pivot, "pivot_key").join(spread.select(F.col("block").alias("pivot_block"), "salts"), "pivot_block")
    stood = stood.withColumn("pivot_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("pivot_block", "pivot_salt", "pivot_key", "pivot_n", "pivot_blob")

    def measure(rows: pa.Table, at: pa.Table) -> pa.Table:
        names, types = ["block", "key", "weight", "pivot", "distance", "linked"], [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]
        if not rows.num_rows or not at.num_rows:
            return batch_of([], names, types)
        at = at.sort_by("pivot_key")
        k = at.num_rows
        own = sets_of_rows(at.column("pivot_blob").to_pylist() + rows.column("blob").to_pylist(), at.column("pivot_n").to_pylist() + rows.column("n").to_pylist())
        found = [own.to(j, np.arange(k, k + rows.num_rows)) for j in range(k)]
        distance, linked = np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)
        return pa.table([rows.column("block"), rows.column("key"), rows.column("weight"), pa.array([at.column("pivot_key").to_pylist()] * rows.num_rows, types[3]), pa.array(distance.tolist(), types[4]), pa.array(linked.tolist(), types[5])], names=names)

    schema = "block long, key long, weight long, pivot array<long>, distance array<double>, linked array<boolean>"
    measured = stored(docs.groupBy("block", "salt").cogroup(stood.groupBy("pivot_block", "pivot_salt")).applyInArrow(measure, schema), "distances")
    each = measured.select("block", "key", "weight", F.array_min("distance").alias("nearest"), F.expr("array_position(distance, array_min(distance)) - 1").alias("own"), F.posexplode(F.arrays_zip("pivot", "distance", "linked")).alias("j", "z"))
    each = each.select("block", "key", "weight", "nearest", "own", "j", F.col("z.pivot").alias("pivot"), F.col("z.distance").alias("d"), F.col("z.linked").alias("linked"))
    links = each.where("linked and key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    radius = each.where("own = j").groupBy("block", "j").agg(F.max("d").alias("radius"))
    here = each.join(radius, ["block", "j"]).where(F.col("key") != F.col("pivot")).where((F.col("own") == F.col("j")) | ((F.col("d") <= F.col("nearest") + 2 * RADIUS + NEAR) & (F.col("d") <= F.col("radius") + RADIUS + NEAR)))
    least = here.where("not linked").groupBy("block", "j").agg(F.min("d").alias("least"))
    after = here.join(least, ["block", "j"]).where(~F.col("linked") | (F.col("d") >= F.col("least") - RADIUS - NEAR))
    after = stored(after.select(F.col("block").alias("whole"), F.xxhash64("block", "j", F.lit(level)).alias("block"), "key", "weight"), "regions")
    pairs = after.groupBy("whole", "block").agg(F.sum("weight").cast("double").alias("w")).groupBy("whole").agg(F.sum(F.col("w") * F.col("w")).alias("pairs"))
    unparted = weight.join(pairs, F.col("block") == F.col("whole")).where(F.col("pairs") > PARTED * F.col("total").cast("double") * F.col("total")).select("block")
    parted = after.join(unparted.withColumnRenamed("block", "whole"), "whole", "left_anti").select("block", "key", "weight")
    return links, parted, large.join(unparted, "block", "left_semi").select("block", "key", "weight")


def split_by_rarity(large: DataFrame, sets: DataFrame, level: int) -> DataFrame:
    """Members (block, key, weight) of new blocks: those that share one of the shingles that are rarest in their block, as many as a link needs."""
    rows = large.join(sets, "key").select("block", "key", "weight", "n", "blob")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, blob in enumerate(batch.column("blob").to_pylist()):
                shingles = unpacked(blob, U).view(np.int64)
                take = pa.array(np.full(len(shingles), k))
                yield pa.record_batch([*(batch.column(c).take(take) for c in ("block", "key", "weight", "n")), pa.array(shingles)], names=["block", "key", "weight", "n", "shingle"])

    each = rows.mapInArrow(spread, "block long, key long, weight long, n long, shingle long")
    counts = each.groupBy("block", "shingle").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    each = each.join(counts, ["block", "shingle"])
    own = Window.partitionBy("block", "key")
    # those that nobody else has come first
    rank = F.col("weight") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("count", "shingle"))
    spare = F.col("weight") - F.ceil(F.col("n") * THRESHOLD_PERCENT / 100)
    kept = each.withColumn("rank", rank).where(F.col("rank") <= spare + 1)
    return kept.select(F.xxhash64("block", "shingle", F.lit(level)).alias("block"), "key", "weight")


def compared_in_slices(large: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """Links within blocks that nothing parts: each slice of a block against each, in bounded tasks."""
    spread = large.groupBy("block").agg(F.ceil(2 * F.sum("weight") / limit).cast("int").alias("salts"))
    rows = large.join(spread, "block").withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts")).cast("int"))
    twice = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select(F.xxhash64("block", F.least("salt", "other"), F.greatest("salt", "other")).alias("slice"), "key")
    rows = twice.join(sets, "key").select("slice", "key", "n", "blob")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        key = table.column("key").to_pylist()
        sets, forest = sets_of_rows(table.column("blob").to_pylist(), table.column("n").to_pylist()), Forest(len(key))
        join_block(sets, np.arange(len(key)), forest)
        return batch_of([(key[x], key[y]) for x, y in forest.edges], ["a", "b"], [pa.int64(), pa.int64()])

    return rows.groupBy("slice").applyInArrow(run, "a long, b long")


def links_in_blocks(members: DataFrame, sets: DataFrame, slots: int, limit: int = BLOCK_WEIGHT, levels: int = LEVELS, slices: int = SLICES) -> DataFrame:
    """Links (a, b) of a spanning forest of each block; members (block, key, weight), sets (key, n, blob)."""
    found: list[DataFrame] = []
    small: list[DataFrame] = []

    def sized(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members with their block's weight, and those of blocks above the limit; the others are kept."""
        own = stored(rows.join(rows.groupBy("block").agg(F.sum("weight").alias("total")), "block"), "members")
        small.append(own.where(F.col("total") <= limit).select("block", "key", "weight"))
        return own, own.where(F.col("total") > limit).select("block", "key", "weight")

    waiting, left = members, members.limit(0)
    for level in range(levels):
        _, large = sized(waiting)
        waiting = None
        if large.isEmpty():
            break
        links, waiting, whole = split_once(large, sets, level, limit)
        found.append(links)
        left = left.unionByName(whole)
    # what pivots have not parted: by rarity where it is very large, and what is left after that
    own, large = sized(left if waiting is None else left.unionByName(waiting))
    if not large.isEmpty():
        most = limit * (slices // 2)
        found.append(compared_in_slices(own.where((F.col("total") > limit) & (F.col("total") <= most)).select("block", "key", "weight"), sets, limit))
        _, large = sized(split_by_rarity(own.where((F.col("total") > limit) & (F.col("total") > most)).select("block", "key", "weight"), sets, levels))
        if not large.isEmpty():
            found.append(compared_in_slices(large, sets, limit))
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    total = rows.agg(F.sum("weight")).first()[0] or 0
    found.append(joined_in_tasks(rows.join(sets, "key").select("block", "key", "n", "blob"), max(slots, -(-total // limit))))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def components_of(url: str, rows: DataFrame, part_shingles: int = PART_SHINGLES, block_weight: int = BLOCK_WEIGHT, levels: int = LEVELS, slices: int = SLICES) -> DataFrame:
    """(key, component, first) of every class: its component, and the component's first row, as (no id, doc_id, chunk, row)."""
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "chunk", "row"))
    classes = stored(rows.where("n > 0").groupBy("key").agg(F.min(F.struct("chunk", "row")).alias("at"), F.max("n").alias("n"), first.alias("first")).select("key", "at.chunk", "at.row", "n", "first"), "owners")
    total = classes.agg(F.sum("n")).first()[0] or 0
    items = candidates(url, classes.select("chunk", "row", "key", "n"), max(slots, -(-total // part_shingles)))
    sets = items.where(F.col("kind") == SET).select("key", "n", "weight", F.col("a").alias("blob"))
    near = components(items.where(F.col("kind") == EDGE).select(F.col("key").alias("a"), F.col("n").alias("b")).unionByName(prefix_edges(items)))
    blocks = near.select(F.col("component").alias("block"), F.col("node").alias("key")).unionByName(near.select(F.col("component").alias("block"), F.col("component").alias("key")).distinct())
    members = blocks.join(sets.select("key", "weight"), "key").select("block", "key", "weight")
    linked = components(links_in_blocks(members, sets.select("key", "n", "blob"), slots, block_weight, levels, slices))
    named = classes.select("key", "first").join(linked, F.col("key") == F.col("node"), "left").select("key", "first", F.coalesce("component", "key").alias("component"))
    return named.select("key", "component").join(named.groupBy("component").agg(F.min("first").alias("first")), "component").select("key", "component", "first")


def join(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, **options) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    url, rows = classes_of(id_and_text(docs), chunk_bytes)
    of_class = components_of(url, rows, **options).select("key", F.col("first.doc_id").alias("component_id"))
    with_words = rows.where("n > 0").join(of_class, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return with_words.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def representatives(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, **options) -> DataFrame:
    """docs, all columns, with one row of each group: that of least id (of rows without ids only if all have none). Texts without words all stay."""
    url, rows = classes_of(docs, chunk_bytes)
    schema = docs.schema
    firsts = components_of(url, rows, **options).select("first").distinct().select("first.chunk", "first.row")

    def keep(table: pa.Table) -> pa.Table:
        return chunkstore.read(url, table.column("chunk")[0].as_py()).take(table.column("row").sort())

    return chunkstore.by(firsts.unionByName(rows.where("n = 0").select("chunk", "row")), "chunk").applyInArrow(keep, schema)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 75 * (nx.n + ny.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT a, min(b) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.a = d.doc_id
"""
