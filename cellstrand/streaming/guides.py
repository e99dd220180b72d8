"""Guide counting over a stream of reads; an extension of the batch command."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.operators import reads


def streaming_counts(stream: DataFrame, ligation: DataFrame, rt: DataFrame, inner_i7: DataFrame, guides: DataFrame, time: str = "ts", late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """(window, barcode, sgrna_name, unique_umi_count) of a stream of (idx, r1, r2, r3, time).

    The dictionaries are static and broadcast. Repeats of a UMI in a window are dropped, whichever batch
    they come in; the state of a window goes, and its counts come out, when the watermark has passed it.
    """
    timed = stream.withWatermark(time, late)
    classified = reads.classified_guides(timed.select("idx", "r1", "r2", "r3", time), ligation, rt, inner_i7, guides, carried=(time,))
    cells = classified.where(F.col("read_class") == "passed").select(F.window(time, window).alias("window"), F.concat("i7", F.lit("."), "ligation", "rt").alias("barcode"), F.col("guide").alias("sgrna_name"), "umi")
    once = cells.dropDuplicates(["window", "barcode", "sgrna_name", "umi"])
    return once.groupBy("window", "barcode", "sgrna_name").agg(F.count(F.lit(1)).alias("unique_umi_count"))
