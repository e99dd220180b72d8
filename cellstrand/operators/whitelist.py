"""One-mismatch correction dictionaries, as tables (variant, original)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.functions.sequence import BASES

#: Bytes of a dictionary up to which it is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20


def variants(whitelist: DataFrame, sequence: str, *carried: str) -> DataFrame:
    """(variant, original) and carried columns: every entry with any one base replaced, each variant of an entry once."""
    entries = whitelist.where(F.col(sequence).isNotNull()).select(F.col(sequence).alias("original"), *carried)
    place = F.explode(F.sequence(F.lit(1), F.length("original")))
    at = entries.where(F.length("original") > 0).select("original", *carried, place.alias("k"))
    spread = at.select("original", *carried, "k", F.explode(F.array(*map(F.lit, BASES))).alias("base"))
    # the entry itself arises at each position; it is kept for the first only, so no distinct is needed
    kept = spread.where((F.col("base") != F.substr("original", F.col("k"), F.lit(1))) | (F.col("k") == 1))
    changed = F.concat(F.substr("original", F.lit(1), F.col("k") - 1), F.col("base"), F.substr("original", F.col("k") + 1, F.length("original")))
    return kept.select(changed.alias("variant"), "original", *carried)


def correction_dictionary(whitelist: DataFrame, sequence: str, dedup: bool = False) -> DataFrame:
    """(variant, original) without variants that two or more entries reach.

    Entries are counted, not distinct sequences: unless `dedup`, a repeated entry loses all of its variants.
    """
    # repeats are counted before they are spread, so that their variants are made once
    times = F.lit(1) if dedup else F.col("times")
    entries = whitelist.groupBy(sequence).agg(F.count(F.lit(1)).alias("times")).withColumn("times", times)
    return variants(entries, sequence, "times").groupBy("variant").agg(F.sum("times").alias("n"), F.min("original").alias("original")).where("n = 1").select("variant", "original")


def correction_file(whitelist: DataFrame, sequence: str) -> DataFrame:
    """The dictionary as it is kept in a file: entries deduplicated, ordered by variant."""
    return correction_dictionary(whitelist, sequence, dedup=True).orderBy("variant").select(F.col("variant").alias("barcode_1bp_substitution"), F.col("original").alias("original_barcode"))


def looked_up(reads: DataFrame, sequence: Column, dictionary: DataFrame, found: str) -> DataFrame:
    """reads with column `found`: the original that the sequence stands for, or null.

    The dictionary, (variant, original), has each variant once.
    """
    own = dictionary.select(F.col("variant").alias(f"{found}_variant"), F.col("original").alias(found))
    return reads.join(small(own), sequence == F.col(f"{found}_variant"), "left").drop(f"{found}_variant")


def small(table: DataFrame) -> DataFrame:
    """A table that is broadcast if its size is within BROADCAST_BYTES by the optimizer's estimate."""
    return F.broadcast(table) if estimated_bytes(table) <= BROADCAST_BYTES else table


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's upper estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
