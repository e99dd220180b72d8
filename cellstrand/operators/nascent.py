"""Detection of nascent reads by T-to-C conversions."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.functions import alignment as aln
from cellstrand.functions import batches

CLASSES = ("skipped_wrong_flag", "skipped_no_md_tag", "skipped_no_qualities", "no_mismatches", "tc_ratio_below_threshold", "nascent_reads_classified")
PAIRS = "array<struct<query_pos:int,ref_pos:int,ref_base:string>>"

_OPS = re.compile(r"(\d+)([MIDNSHP=X])")
_MD = re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")


def aligned(pos: int, cigar: str, md: str, sequence: str) -> list[tuple[int, int, str]]:
    """(query position, reference position, reference base) of all aligned columns, from 0.

    The reference base is the read's own where MD says that they match, otherwise MD's.
    """
    columns: list[tuple[int, int]] = []
    query = 0
    for size, op in _OPS.findall(cigar):
        n = int(size)
        if op in "M=X":
            columns += zip(range(query, query + n), range(pos, pos + n), strict=True)
        if op in "MIS=X":
            query += n
        if op in "MDN=X":
            pos += n
    base = [sequence[q : q + 1] for q, _ in columns]
    at = 0
    for same, _, other in _MD.findall(md):
        if same:
            at += int(same)
        elif other:
            if at < len(base):
                base[at] = other
            at += 1
    return [(q, r, b.upper()) for (q, r), b in zip(columns, base, strict=True)]


def letters(columns: batches.Columns, rows: np.ndarray, own: batches.Texts, md: batches.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Of all aligned columns of some records: the record's number in rows, the index in columns, and the reference base (0 if the read has none). None if MD has a number that no read is as long as."""
    owner, _, at = columns.of(rows)
    query = columns.query[at]
    base = batches.UPPER[own.data[np.where(query < own.sizes[rows][owner], own.starts[rows][owner] + query, -1)]]
    replaced = batches.md_letters(md, rows)
    if replaced is None:
        return None
    of, place, letter = replaced
    size = columns.sizes[rows]
    inside = place < size[of]
    base[((np.cumsum(size) - size)[of] + place)[inside]] = batches.UPPER[letter[inside]]
    return owner, at, base


def pairs_of(pos: pa.Array, cigars: pa.Array, mds: pa.Array, sequences: pa.Array) -> pa.Array:
    """aligned of a batch."""
    kind = pa.list_(pa.struct([("query_pos", pa.int32()), ("ref_pos", pa.int32()), ("ref_base", pa.string())]))
    own, md = batches.Texts(sequences), batches.Texts(mds)
    columns = batches.Columns(cigars, deletions=False)
    known = own.known & md.known & ~np.asarray(cigars.is_null()) & ~np.asarray(pos.is_null())
    starts = pos.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = []
    for rows in batches.parts(np.flatnonzero(known), columns.sizes) if own.ascii and md.ascii else [None]:
        found = None if rows is None else letters(columns, rows, own, md)
        if found is None:
            texts = zip(*[x.to_pylist() for x in (pos, cigars, mds, sequences)], strict=True)
            return pa.array([None if None in row else [{"query_pos": q, "ref_pos": r, "ref_base": b} for q, r, b in aligned(*row)] for row in texts], kind)
        owner, at, base = found
        some = base > 0
        fields = [pa.array(columns.query[at], pa.int32()), pa.array(starts[rows][owner] + columns.place[at], pa.int32()), batches.strings(base[some], some.astype(np.int64))]
        out.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(columns.sizes[rows])], pa.int32()), pa.StructArray.from_arrays(fields, ["query_pos", "ref_pos", "ref_base"])))
    return batches.put_back(pa.concat_arrays(out), known)


def aligned_pairs(pos: Column, cigar: Column, md: Column, sequence: Column) -> Column:
    """array<struct<query_pos, ref_pos, ref_base>>; null where an input is null."""

    @F.arrow_udf(PAIRS)
    def pairs(p: pa.Array, c: pa.Array, m: pa.Array, s: pa.Array) -> pa.Array:
        return pairs_of(p, c, m, s)

    return pairs(pos, cigar, md, sequence)


COUNTED = "struct<targets:int,hits:array<int>>"


def conversions(flag: int, pos: int, cigar: str, md: str, sequence: str, qual: str, quality_above: int) -> tuple[int, list[int]]:
    """Aligned target bases (T, or A on the minus strand) above a quality, and the reference positions of those that were converted."""
    target, changed = ("T", "C") if flag in aln.FLAGS_PLUS else ("A", "G")
    targets = [(q, r) for q, r, base in aligned(pos, cigar, md, sequence) if base == target and ord(qual[q]) - 33 > quality_above]
    return len(targets), [r for q, r in targets if sequence[q].upper() == changed]


def conversions_of(flags: pa.Array, pos: pa.Array, cigars: pa.Array, mds: pa.Array, sequences: pa.Array, quals: pa.Array, quality_above: int) -> list[pa.Array]:
    """conversions of a batch: targets and hits; none where the flag is null."""
    own, md, qual = batches.Texts(sequences), batches.Texts(mds), batches.Texts(quals)
    columns = batches.Columns(cigars, deletions=False)
    known = ~np.asarray(flags.is_null())
    flag, starts = (x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (flags, pos))
    plus = np.isin(flag, aln.FLAGS_PLUS)
    targets, hits = np.zeros(len(known), dtype=np.int64), []
    converted = np.zeros(len(known), dtype=np.int64)
    whole = known & own.known & md.known & qual.known & (columns.needed <= own.sizes) & (columns.needed <= qual.sizes)
    # what is not whole is left to the plain function, which tells what is wrong with it
    for rows in batches.parts(np.flatnonzero(known), columns.sizes) if own.ascii and md.ascii and qual.ascii and (whole == known).all() else [None]:
        found = None if rows is None else letters(columns, rows, own, md)
        if found is None:
            texts = zip(*[x.to_pylist() for x in (flags, pos, cigars, mds, sequences, quals)], strict=True)
            plain = [(0, []) if row[0] is None else conversions(*row, quality_above) for row in texts]
            return [pa.array([n for n, _ in plain], pa.int32()), pa.array([h for _, h in plain], pa.list_(pa.int32()))]
        owner, at, base = found
        query, forward = columns.query[at], plus[rows][owner]
        target = (base == np.where(forward, ord("T"), ord("A"))) & (qual.data[qual.starts[rows][owner] + query].astype(np.int64) - 33 > quality_above)
        changed = target & (batches.UPPER[own.data[own.starts[rows][owner] + query]] == np.where(forward, ord("C"), ord("G")))
        targets[rows], converted[rows] = (np.bincount(owner[x], minlength=len(rows)) for x in (target, changed))
        hits.append((starts[rows][owner] + columns.place[at])[changed])
    offsets = pa.array(np.r_[0, np.cumsum(converted)], pa.int32())
    return [pa.array(targets, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hits), pa.int32()))]


def counted(flag: Column, pos: Column, cigar: Column, md: Column, sequence: Column, qual: Column, quality_above: int) -> Column:
    """struct<targets, hits> of each record; null where the flag is null."""

    @F.arrow_udf(COUNTED)
    def count(f: pa.Array, p: pa.Array, c: pa.Array, m: pa.Array, s: pa.Array, q: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(conversions_of(f, p, c, m, s, q, quality_above), ["targets", "hits"])

    # not to be run again by a filter that the optimizer moves below it
    return count.asNondeterministic()(flag, pos, cigar, md, sequence, qual)


def scored(alignments: DataFrame, snps: DataFrame, quality_above: int = 45) -> DataFrame:
    """alignments (idx identifies a record) with read_class so far, t_count and tc_count.

    Targets are counted record by record, in one pass. Conversions, a few a read, are exploded to be held
    against the SNP list (chrom, pos from 1, ref, alt), which is joined by its keys, and one aggregation
    by idx counts those that are not listed and puts the records together again; of the other columns
    it carries only those that are asked for.
    """
    plus, minus = F.col("flag").isin(*aln.FLAGS_PLUS), F.col("flag").isin(*aln.FLAGS_MINUS)
    md, usable = F.col("tags")["MD"], F.col("qual").isNotNull() & (F.col("qual") != "*")
    fit = F.when(~(plus | minus), CLASSES[0]).when(md.isNull(), CLASSES[1]).when(~usable, CLASSES[2])
    rows = alignments.withColumn("read_class", fit)
    rows = rows.withColumn("found", counted(F.when(F.col("read_class").isNull(), F.col("flag")), F.col("pos"), F.col("cigar"), md, F.col("seq"), F.col("qual"), quality_above))
    rows = rows.withColumn("t_count", F.col("found.targets")).withColumn("hits", F.col("found.hits")).drop("found")
    kept = [c for c in rows.columns if c not in ("idx", "hits")]
    listed = snps.select(F.col("chrom").alias("snp_chrom"), (F.col("pos") - 1).cast("int").alias("snp_pos"), F.col("ref").alias("snp_ref"), F.col("alt").alias("snp_alt")).distinct()
    each = rows.select("*", F.explode_outer("hits").alias("hit"))
    # records without a conversion have keys of their own, so that they do not meet in one task
    place = F.coalesce("hit", -1 - F.pmod(F.xxhash64("idx"), F.lit(1 << 30)).cast("int"))
    same = (F.col("rname") == F.col("snp_chrom")) & (place == F.col("snp_pos")) & (F.when(plus, "T").otherwise("A") == F.col("snp_ref")) & (F.when(plus, "C").otherwise("G") == F.col("snp_alt"))
    judged = each.join(listed, same, "left")
    own = F.count_if(F.col("hit").isNotNull() & F.col("snp_pos").isNull())
    return judged.groupBy("idx").agg(*[F.first(c).alias(c) for c in kept], own.alias("tc_count")).select(*[c for c in rows.columns if c != "hits"], "tc_count")


def verdict(t_count: Column, tc_count: Column, least_ratio: float = 0.3, least_count: int = 1) -> Column:
    """Class of a read from its counts."""
    nascent = (tc_count >= least_count) & (tc_count / t_count >= least_ratio)
    return F.when(t_count == 0, CLASSES[3]).otherwise(F.when(nascent, CLASSES[5]).otherwise(CLASSES[4]))


def classified(alignments: DataFrame, snps: DataFrame, quality_above: int = 45, least_ratio: float = 0.3, least_count: int = 1) -> DataFrame:
    """alignments with read_class, t_count and tc_count."""
    rows = scored(alignments, snps, quality_above)
    return rows.withColumn("read_class", F.coalesce("read_class", verdict(F.col("t_count"), F.col("tc_count"), least_ratio, least_count)))


def nascent_records(alignments: DataFrame, classes: DataFrame) -> DataFrame:
    """All records, of whatever flag, of the names that have a nascent read."""
    return alignments.join(classes.where(F.col("read_class") == CLASSES[5]).select("qname").distinct(), "qname", "left_semi")
