"""Counters of read classes as a table, zero classes and a total included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

TOTAL = "total_reads_processed"


def class_summary(reads: DataFrame, classes: Sequence[str], read_class: str = "read_class") -> DataFrame:
    """(read_class, count, percent) in the order of `classes`, then the total; percent is null without reads.

    One pass and one row: every class is a conditional count, so nothing is shuffled by class.
    """
    counts = reads.agg(*[F.count_if(F.col(read_class) == c).alias(f"n{k}") for k, c in enumerate(classes)])
    total = sum((F.col(f"n{k}") for k in range(1, len(classes))), F.col("n0"))
    rows = [F.struct(F.lit(k).alias("k"), F.lit(c).alias("read_class"), F.col(f"n{k}").alias("count"), total.alias("total")) for k, c in enumerate(classes)]
    rows.append(F.struct(F.lit(len(classes)).alias("k"), F.lit(TOTAL).alias("read_class"), total.alias("count"), total.alias("total")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.read_class", "r.count", percent(F.col("r.count"), F.col("r.total")).alias("percent"))


def percent(count, total):
    """count / total * 100, in this order; null if there is nothing."""
    return F.try_divide(count.cast("double"), total.cast("double")) * 100.0


def observed(reads: DataFrame, classes: Sequence[str], name: str, read_class: str = "read_class") -> tuple[DataFrame, Observation]:
    """reads that count their classes while they are written, without a second pass."""
    seen = Observation(name)
    return reads.observe(seen, *[F.count_if(F.col(read_class) == c).alias(c) for c in classes]), seen


def summary_of(spark: SparkSession, counts: dict[str, int], classes: Sequence[str]) -> DataFrame:
    """The table of `class_summary` from counters that are known."""
    total = sum(counts[c] for c in classes)
    rows = [(c, counts[c]) for c in classes] + [(TOTAL, total)]
    return spark.createDataFrame([(c, n, n / total * 100.0 if total else None) for c, n in rows], "read_class string, count long, percent double")
