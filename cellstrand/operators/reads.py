"""Demultiplexing and trimming of RNA reads, and classification of guide reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellstrand.functions import sequence as seq
from cellstrand.operators.whitelist import looked_up, small

RNA_CLASSES = ("filtered_no_ligation_barcode", "filtered_no_RT_barcode", "filtered_too_short", "passed_all_filters")
GUIDE_CLASSES = ("filtered_constant_region", "filtered_ligation_barcode", "filtered_inner_i7", "filtered_RT_barcode", "filtered_sgrna", "passed")
DISCOVERY_CLASSES = tuple(c for c in GUIDE_CLASSES if c != "filtered_sgrna")


@dataclass(frozen=True)
class RnaLayout:
    """Where the fields of an RNA read triplet are, from 0, half open."""

    ligation: tuple[int, int] = (0, 10)
    umi: tuple[int, int] = (0, 8)
    rt: tuple[int, int] = (8, 18)
    insert_from: int = 18
    least_poly_t: int = 5
    adapter: str = seq.ADAPTER
    adapter_mismatches: int = 0
    longer_than: int = 20


@dataclass(frozen=True)
class GuideLayout:
    """Where the fields of a guide read triplet are: first, second and third read."""

    umi: tuple[int, int] = (0, 8)
    rt: tuple[int, int] = (8, 18)
    constant_1: tuple[int, int] = (18, 28)
    inner_i7: tuple[int, int] = (0, 10)
    constant_2: tuple[int, int] = (10, 20)
    guide: tuple[int, int] = (35, 55)
    ligation: tuple[int, int] = (0, 10)


def demultiplexed(triplets: DataFrame, ligation: DataFrame, rt: DataFrame, random_n: DataFrame, layout: RnaLayout = RnaLayout()) -> DataFrame:
    """Corrected, trimmed and named read pairs with their read_class.

    triplets: structs lig, umi, bio of (id, desc, seq, qual) and idx. The lookups are chained
    broadcast joins in the scan's stage; trimming is expressions on sequence and quality alike.
    The result has idx, read_class, ligation, rt, umi_sequence, r1 and r2 (name, desc, seq, qual).
    """
    reads = looked_up(triplets, seq.piece(F.col("lig.seq"), *layout.ligation), ligation, "ligation")
    reads = looked_up(reads, seq.piece(F.col("umi.seq"), *layout.rt), rt, "rt")
    known = random_n.select(F.col("sequence").alias("random_n")).distinct()
    reads = reads.join(small(known), F.col("rt") == F.col("random_n"), "left")
    cut = reads.withColumns({"s1": seq.rest(F.col("umi.seq"), layout.insert_from), "q1": seq.rest(F.col("umi.qual"), layout.insert_from)})
    poly_t = F.when(F.col("random_n").isNull(), seq.poly_t_length(F.col("s1"), layout.least_poly_t)).otherwise(0)
    cut = cut.withColumn("t", poly_t).withColumns({"s1": seq.rest(F.col("s1"), F.col("t")), "q1": seq.rest(F.col("q1"), F.col("t"))})
    cut = cut.withColumn("n1", seq.before_within(F.col("s1"), layout.adapter, layout.adapter_mismatches)).withColumn("n2", seq.before(F.col("bio.seq"), seq.reverse_complement(F.col("rt"))))
    umi = seq.piece(F.col("umi.seq"), *layout.umi)
    long = (F.col("n1") > layout.longer_than) & (F.col("n2") > layout.longer_than)
    read_class = F.when(F.col("ligation").isNull(), RNA_CLASSES[0]).when(F.col("rt").isNull(), RNA_CLASSES[1]).when(~long, RNA_CLASSES[2]).otherwise(RNA_CLASSES[3])

    def out(name: str, description: str, s, q, n):
        return F.struct(seq.composed_name(F.col("ligation"), F.col("rt"), umi, F.col(name)).alias("name"), F.col(description).alias("desc"), F.substr(s, F.lit(1), n).alias("seq"), F.substr(q, F.lit(1), n).alias("qual"))

    return cut.select(
        "idx", read_class.alias("read_class"), "ligation", "rt", umi.alias("umi_sequence"),
        out("umi.id", "umi.desc", F.col("s1"), F.col("q1"), F.col("n1")).alias("r1"),
        out("bio.id", "bio.desc", F.col("bio.seq"), F.col("bio.qual"), F.col("n2")).alias("r2"),
    )


def classified_guides(reads: DataFrame, ligation: DataFrame, rt: DataFrame, inner_i7: DataFrame, guides: DataFrame | None, layout: GuideLayout = GuideLayout(), n_reads: int | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """Guide reads (idx, r1, r2, r3: sequences) with their fields and the first filter that each fails.

    Without `guides` no guide lookup is made and the guide's sequence is kept as read. Columns named
    in `carried` are kept as they are.
    """
    if n_reads:
        reads = reads.where(F.col("idx") <= n_reads)
    r1, r2, r3 = F.col("r1"), F.col("r2"), F.col("r3")
    found = looked_up(reads, seq.piece(r3, *layout.ligation), ligation, "ligation")
    found = looked_up(found, seq.piece(r2, *layout.inner_i7), inner_i7, "i7")
    found = looked_up(found, seq.piece(r1, *layout.rt), rt, "rt")
    guide = seq.piece(r2, *layout.guide)
    constant = seq.within_one(seq.piece(r1, *layout.constant_1), seq.CONSTANT_1) & seq.within_one(seq.piece(r2, *layout.constant_2), seq.CONSTANT_2)
    read_class = F.when(~constant, GUIDE_CLASSES[0]).when(F.col("ligation").isNull(), GUIDE_CLASSES[1]).when(F.col("i7").isNull(), GUIDE_CLASSES[2]).when(F.col("rt").isNull(), GUIDE_CLASSES[3])
    if guides is not None:
        found = looked_up(found, guide, guides, "guide")
        read_class = read_class.when(F.col("guide").isNull(), GUIDE_CLASSES[4])
    else:
        found = found.withColumn("guide", guide)
    return found.select("idx", read_class.otherwise("passed").alias("read_class"), "ligation", "i7", "rt", "guide", seq.piece(r1, *layout.umi).alias("umi"), *carried)


def guide_cells(classified: DataFrame, sample: str = "", annotation: DataFrame | None = None) -> DataFrame:
    """(barcode, sgrna_name, umi) of the reads that passed; annotation: (gRNA_seq, names), each sequence once."""
    passed = classified.where(F.col("read_class") == "passed")
    name = F.col("guide")
    if annotation is not None:
        passed = passed.join(small(annotation.select(F.col("gRNA_seq").alias("known_guide"), "names")), F.col("guide") == F.col("known_guide"), "left")
        name = F.coalesce("names", "guide")
    return passed.select("idx", F.concat(F.lit(sample), "i7", F.lit("."), "ligation", "rt").alias("barcode"), name.alias("sgrna_name"), "umi")


def discovered_guides(classified: DataFrame) -> DataFrame:
    """(sgrna_seq, read_count, percent_of_passed_reads) of passed reads; the most frequent first, then the first seen."""
    counts = classified.where(F.col("read_class") == "passed").groupBy(F.col("guide").alias("sgrna_seq")).agg(F.count(F.lit(1)).alias("read_count"), F.min("idx").alias("first_idx"))
    # with both columns the total is made from the exchange that the counts come from, so reads are classified once
    passed = counts.agg(F.struct(F.sum("read_count").alias("n"), F.min("first_idx").alias("first_idx"))).scalar().getField("n")
    return counts.orderBy(F.desc("read_count"), "first_idx").select("sgrna_seq", "read_count", (F.col("read_count") / passed * 100.0).alias("percent_of_passed_reads"))
