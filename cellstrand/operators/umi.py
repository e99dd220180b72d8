"""Counting and deduplication by UMI."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def umi_counts(reads: DataFrame, cell: str = "barcode", feature: str = "gene_id", umi: str = "umi") -> DataFrame:
    """Distinct UMIs of each cell and feature.

    Distinct triples come first, partly before the shuffle, so a very frequent cell or UMI is cut
    down where it is read.
    """
    distinct = reads.groupBy(cell, feature, umi).agg(F.lit(1).alias("one"))
    return distinct.groupBy(cell, feature).agg(F.count(umi).alias("unique_umi_count"))


def cells_with(counts: DataFrame, least: int, cell: str = "barcode", count: str = "unique_umi_count") -> DataFrame:
    """Counts of the cells whose total is at least `least`."""
    if least <= 1:
        return counts
    kept = counts.groupBy(cell).agg(F.sum(count).alias("total")).where(F.col("total") >= least).select(cell)
    return counts.join(kept, cell, "left_semi")


def exact_dedup(alignments: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first alignment of each key by `order`."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return alignments.withColumn("nth", first).where("nth = 1").drop("nth")




def clusters_of(umis: list[str], counts: list[int]) -> list[str]:
    """Head of each UMI's directional cluster.

    From the most frequent UMI on, a UMI takes in every one that differs at one base and has at most
    half its count plus one half, and these take in others in turn. Neighbours are looked up by
    replacing bases, so the work grows with the number of UMIs and not with its square.
    """
    of = dict(zip(umis, counts, strict=True))
    head: dict[str, str] = {}
    for umi in sorted(of, key=lambda u: (-of[u], u)):
        if umi in head:
            continue
        head[umi], waiting = umi, [umi]
        while waiting:
            one = waiting.pop()
            for k in range(len(one)):
                for base in "ACGTN":
                    near = one[:k] + base + one[k + 1 :]
                    if near in of and near not in head and of[one] >= 2 * of[near] - 1:
                        head[near] = umi
                        waiting.append(near)
    return [head[u] for u in umis]


def directional_clusters(reads: DataFrame, keys: list[str], umi: str = "umi") -> DataFrame:
    """keys, umi, n (reads) and umi_group: the head of the UMI's cluster among the UMIs of its keys.

    Reads are counted before they are grouped, so a group holds distinct UMIs only, which for one
    cell and position are at most 4 to the power of their length.
    """
    counts = reads.where(F.col(umi).isNotNull()).groupBy(*keys, umi).agg(F.count(F.lit(1)).alias("n"))
    schema = counts.select(*keys, umi, "n", F.col(umi).alias("umi_group")).schema

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.assign(umi_group=clusters_of(rows[umi].tolist(), rows["n"].tolist()))[schema.names]

    return counts.groupBy(*keys).applyInPandas(cluster, schema)
