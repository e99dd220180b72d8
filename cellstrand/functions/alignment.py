"""Column expressions on alignments: flags, CIGAR blocks, strands, distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND = (1 << k for k in range(8))
SECONDARY, FAILED, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048

#: Mapped pairs in the expected direction, of the plus and the minus strand.
FLAGS_PLUS, FLAGS_MINUS = (99, 163), (83, 147)


def has_bits(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == bits


def lacks_bits(flag: Column, bits: int) -> Column:
    return flag.bitwiseAND(F.lit(bits)) == 0


def well_mapped(flag: Column, mapq: Column, least: int = 30) -> Column:
    """Properly paired, both mapped, primary, passed, no duplicate, at least this mapping quality."""
    none_of = UNMAPPED | MATE_UNMAPPED | SECONDARY | FAILED | DUPLICATE
    return (mapq >= least) & has_bits(flag, PROPER) & lacks_bits(flag, none_of)


def blocks(pos: Column, cigar: Column, kinds: tuple[str, ...] = ("M",)) -> Column:
    """array<struct<start, end>> of the aligned (M) blocks, or those of other `kinds` besides, from 0, half open; null or `*` has none.

    A CIGAR of one aligned block, the most frequent by far, does not go through the walk over operations.
    """
    whole = one_block(cigar)
    single = F.array(F.struct(pos.cast("int").alias("start"), (pos.cast("int") + whole).alias("end")))
    ops = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    start = F.struct(pos.cast("int").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(state: Column, op: Column) -> Column:
        size, kind = F.regexp_extract(op, r"^(\d+)", 1).cast("int"), F.right(op, F.lit(1))
        end = state["at"] + size
        moved = F.when(kind.isin("M", "D", "N", "=", "X"), end).otherwise(state["at"])
        block = F.struct(state["at"].alias("start"), end.alias("end"))
        return F.struct(moved.alias("at"), F.when(kind.isin(*kinds), F.concat(state["out"], F.array(block))).otherwise(state["out"]).alias("out"))

    return F.when(whole.isNotNull(), single).otherwise(F.aggregate(ops, start, step)["out"])


def one_block(cigar: Column) -> Column:
    """Length of a CIGAR that is a single aligned block, otherwise null."""
    return F.when(F.coalesce(cigar, F.lit("")).rlike(r"^\d+M$"), F.substr(cigar, F.lit(1), F.length(cigar) - 1).try_cast("int"))


def reference_end(pos: Column, cigar: Column) -> Column:
    """End on the reference, half open."""
    ops = F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    whole = one_block(cigar)
    return pos.cast("int") + F.when(whole.isNotNull(), whole).otherwise(F.aggregate(ops, F.lit(0), lambda n, op: n + op.cast("int")))


def fragment_strand(first_reverse: Column, second_reverse: Column, library: str = "reverse") -> Column:
    """`+` or `-` of a fragment, `.` where the mates do not tell or the library has no strand."""
    if library == "none":
        return F.lit(".")
    if library != "reverse":
        raise ValueError(f"library strandedness {library!r} is not supported; use 'reverse' or 'none'")
    return F.when(first_reverse & ~second_reverse, "+").when(~first_reverse & second_reverse, "-").otherwise(".")


def mapping_text(name: Column, chrom1: Column, start1: Column, end1: Column, chrom2: Column, start2: Column, end2: Column) -> Column:
    return F.format_string("%s READ1 chr%s:%s-%s READ2 chr%s:%s-%s", name, chrom1, *(c.cast("string") for c in (start1, end1)), chrom2, *(c.cast("string") for c in (start2, end2)))


def end_site(strand: Column, start: Column, end: Column) -> Column:
    """Transcript end: its end on the plus strand, its start on the minus strand, null otherwise."""
    return F.when(strand == "+", end).when(strand == "-", start)


def end_distance(strand: Column, site: Column, start1: Column, end1: Column, start2: Column, end2: Column) -> Column:
    """Signed distance of a fragment from a transcript end; negative if it reaches beyond."""
    return F.when(strand == "+", site - F.greatest(end1, end2)).when(strand == "-", F.least(start1, start2) - site)
