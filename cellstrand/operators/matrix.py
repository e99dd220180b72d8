"""Count tables merged into a sparse matrix, its annotation and the barcode rank curve."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

THRESHOLDS = (10_000, 5_000, 1_000, 100)
HIGHLIGHT_ABOVE = 1_000


def merged(tables: Sequence[DataFrame]) -> DataFrame:
    """(barcode, feature, n) of all tables; a table of another feature kind, or a pair given twice, is an error."""
    kinds = {t.columns[1] for t in tables}
    if len(kinds) != 1:
        raise ValueError(f"count tables of different features cannot be merged: {sorted(kinds)}")
    same = [t.select("barcode", F.col(t.columns[1]).alias("feature"), F.col("unique_umi_count").cast("long").alias("n")) for t in tables]
    both = reduce(DataFrame.unionByName, same).groupBy("barcode", "feature").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("times"))
    once = F.when(F.col("times") > 1, F.raise_error(F.concat(F.lit("counted twice: "), "barcode", F.lit(" "), "feature")).cast("long")).otherwise(F.col("n"))
    return both.select("barcode", "feature", once.alias("n"))


def numbered(rows: DataFrame, keys: Sequence[Column], name: str, splits: int = 256) -> DataFrame:
    """rows with their ordinal, from 1, in the order of keys (unique, ascending), without one task that has all.

    Split points are the keys of the `splits` rows of least hash; rows are numbered within the ranges
    between them, and a range's base is a prefix sum over the ranges' sizes, of which there are few.
    """
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    picked = rows.select(key.alias("key")).orderBy(F.xxhash64("key")).limit(splits).orderBy("key").collect()
    points = list(dict.fromkeys(tuple(r.key) for r in picked))
    types = rows.select(key.alias("key")).schema["key"].dataType.fields

    def found(low: int, high: int) -> Column:
        """How many points are at most the key, by halves; comparing with each point is most of the work otherwise."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(points[middle], types, strict=True)]
        within = values[0] <= keys[0] if len(keys) == 1 else F.struct(*values) <= key
        return F.when(within, found(middle + 1, high)).otherwise(found(low, middle))

    bucket = found(0, len(points))
    placed = rows.withColumns({"_key": key, "_bucket": bucket})
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    base = sizes.select("_bucket", F.coalesce(F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return placed.withColumn("_within", within).join(F.broadcast(base), "_bucket").withColumn(name, F.col("_base") + F.col("_within")).drop("_key", "_bucket", "_within", "_base")


def coordinates(counts: DataFrame) -> DataFrame:
    """(row, col, value) of the nonzero counts: features by row, barcodes by column, from 1."""
    present = counts.where("n <> 0")
    rows = numbered(counts.select("feature").distinct(), [F.col("feature")], "row")
    cols = numbered(counts.select("barcode").distinct(), [F.col("barcode")], "col")
    return present.join(rows, "feature").join(cols, "barcode").select("row", "col", F.col("n").alias("value"))


def cell_annotation(counts: DataFrame) -> DataFrame:
    return counts.groupBy("barcode").agg(F.count_if(F.col("n") > 0).alias("genes_detected"), F.sum("n").alias("total_counts"))


def feature_annotation(counts: DataFrame) -> DataFrame:
    return counts.groupBy("feature").agg(F.count_if(F.col("n") > 0).alias("cells_expressed"))


def rank_curve(cells: DataFrame) -> DataFrame:
    """(rank, barcode, total_counts, highlight): cells by total, the largest first, from 0; ties by barcode."""
    ranked = numbered(cells.select("barcode", "total_counts"), [-F.col("total_counts"), F.col("barcode")], "rank")
    return ranked.select((F.col("rank") - 1).alias("rank"), "barcode", "total_counts", (F.col("total_counts") > HIGHLIGHT_ABOVE).alias("highlight"))


def threshold_counts(cells: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """(threshold, cells): cells with more than so many counts."""
    counts = cells.agg(*[F.count_if(F.col("total_counts") > t).alias(str(t)) for t in thresholds])
    rows = F.array(*[F.struct(F.lit(t).cast("long").alias("threshold"), F.col(f"`{t}`").alias("cells")) for t in thresholds])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def pivoted(counts: DataFrame, barcodes: Sequence[str]) -> DataFrame:
    """A dense view of a few barcodes: one column each, 0 where there is no count."""
    return counts.groupBy("feature").agg(*[F.coalesce(F.sum(F.when(F.col("barcode") == b, F.col("n"))), F.lit(0)).alias(b) for b in barcodes])
