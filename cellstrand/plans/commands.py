"""The nine commands, each a plan from input files to output files."""

from __future__ import annotations

import logging
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstrand.functions import sequence as seq
from cellstrand.operators import genomics, matrix, mismatches, multigene, nascent, reads, summary, trimming, umi, whitelist
from cellstrand.session import qualified
from cellstrand.sinks import bam as bam_sink
from cellstrand.sinks import files as sinks
from cellstrand.sources import alignments as aln
from cellstrand.sources import fasta, fastq, tables


log = logging.getLogger("cellstrand")

#: Fixed value: the adapter that sequencing libraries of this kind end in.
ILLUMINA_ADAPTER = "AGATCGGAAGAGC"


def barcode(spark: SparkSession, ligation_reads: str, umi_reads: str, biological_reads: str, output_basename: str, ligation_file: str, rt_file: str, random_n_file: str, check_ids: bool = False, adapter_max_mismatches: int = 0) -> DataFrame:
    """Demultiplexed R1 and R2 FASTQ and the summary; returns the summary. check_ids: triplets of other ids are an error."""
    layout = reads.RnaLayout(adapter_mismatches=adapter_max_mismatches)
    output_basename = qualified(spark, output_basename)
    triplets = fastq.triplets(spark, ligation_reads, umi_reads, biological_reads, spark.sparkContext.defaultParallelism, check_ids)
    found = reads.demultiplexed(triplets, tables.dictionary(spark, ligation_file), tables.dictionary(spark, rt_file), tables.sequences(spark, random_n_file), layout)
    # the input is read once: classes are counted while what passed is written, and both mates come from that
    kept = f"{output_basename}.demultiplexed.parts"
    found, seen = summary.observed(found, reads.RNA_CLASSES, "demultiplexed")
    found.where(F.col("read_class") == reads.RNA_CLASSES[-1]).select("idx", "r1", "r2").write.mode("overwrite").parquet(kept)
    passed = spark.read.parquet(kept).orderBy("idx")
    for mate in ("r1", "r2"):
        sinks.fastq(passed, mate, f"{output_basename}.{mate.upper()}.parts")
        sinks.joined(f"{output_basename}.{mate.upper()}.parts", f"{output_basename}.{mate.upper()}.fastq.gz", suffix=".gz")
    out = summary.summary_of(spark, seen.get, reads.RNA_CLASSES)
    sinks.tsv(out, f"{output_basename}-summary.tsv")
    sinks.remove(kept)
    return out


def trim(spark: SparkSession, r1: str, r2: str, output_basename: str, adapter: str = ILLUMINA_ADAPTER, adapter2: str = "A" * 8, three_prime_clip_r1: int = 1, three_prime_clip_r2: int = 0, stringency: int = 3, quality: int = 20, error_rate: float = 0.1, length: int = 20) -> DataFrame:
    """R1 and R2 FASTQ without adapters, poly-A and ends of low quality, and the summary; pairs with a mate of fewer than `length` bases are dropped."""
    output_basename = qualified(spark, output_basename)
    pairs = fastq.pairs(spark, r1, r2, spark.sparkContext.defaultParallelism, check_ids=True)
    hows = [trimming.Trim(a, quality, stringency, error_rate, clip) for a, clip in ((adapter, three_prime_clip_r1), (adapter2, three_prime_clip_r2))]
    kept = f"{output_basename}.trimmed.parts"
    found, seen = summary.observed(trimming.trimmed(pairs, *hows, length), trimming.CLASSES, "trimmed")
    mates = [F.struct(F.col(f"{m}.id").alias("name"), *[F.col(f"{m}.{c}") for c in ("desc", "seq", "qual")]).alias(m) for m in ("r1", "r2")]
    found.where(F.col("read_class") == trimming.CLASSES[-1]).select("idx", *mates).write.mode("overwrite").parquet(kept)
    passed = spark.read.parquet(kept).orderBy("idx")
    for k, mate in enumerate(("r1", "r2"), 1):
        sinks.fastq(passed, mate, f"{output_basename}.{mate.upper()}.parts")
        sinks.joined(f"{output_basename}.{mate.upper()}.parts", f"{output_basename}.{mate.upper()}_val_{k}.fq.gz", suffix=".gz")
    out = summary.summary_of(spark, seen.get, trimming.CLASSES)
    sinks.tsv(out, f"{output_basename}-trimming-summary.tsv")
    sinks.remove(kept)
    return out


def tagged(alignments: DataFrame, on_bad_name: str = "error") -> DataFrame:
    """alignments with cell (CB) and raw UMI (UR) tags from the name; names without three parts fail, or are skipped."""
    parts = F.split("qname", ",")
    good = F.size(parts) == 3
    if on_bad_name == "skip":
        alignments = alignments.where(F.size(parts) >= 2)
        name = F.col("qname")
    else:
        name = F.when(good, F.col("qname")).otherwise(F.raise_error(F.concat(F.lit("read name without cell, UMI and id: "), F.col("qname"))).cast("string"))
    new = F.create_map(F.lit("CB"), seq.cell_of_name(name), F.lit("UR"), seq.umi_of_name(name))
    old = F.map_filter(F.coalesce("tags", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: ~k.isin("CB", "UR"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    types = F.coalesce("tag_types", empty) if "tag_types" in alignments.columns else empty
    types = F.map_concat(F.map_filter(types, lambda k, v: ~k.isin("CB", "UR")), F.create_map(F.lit("CB"), F.lit("Z"), F.lit("UR"), F.lit("Z")))
    return alignments.withColumns({"tags": F.map_concat(old, new), "tag_types": types})


def load_alignments(spark: SparkSession, path: str) -> DataFrame:
    return aln.sam(spark, path) if path.endswith(".sam") else aln.bam(spark, path)


def save_alignments(spark: SparkSession, records: DataFrame, like: str, path: str, by_coordinate: bool = False) -> None:
    """Records with the header of another alignment file, as SAM or BAM by name; BAM by coordinate, with an index, if wanted."""
    if like.endswith(".sam"):
        head = aln.sam_header(spark, like)
        fields = [dict(f.split(":", 1) for f in line.split("\t")[1:]) for line in head if line.startswith("@SQ")]
        text, references = "".join(f"{h}\n" for h in head), [(f["SN"], int(f["LN"])) for f in fields]
    else:
        text, references = aln.bam_header(like)
    if path.endswith(".sam"):
        sinks.sam(records, text.splitlines(), path)
    else:
        (bam_sink.sorted_bam if by_coordinate else bam_sink.bam)(records, text, references, path)


def sort(spark: SparkSession, input_file: str, output_file: str) -> None:
    """A BAM file in order of coordinates, and its index."""
    if not output_file.endswith(".bam"):
        raise ValueError(f"only BAM files are sorted and indexed: {output_file}")
    save_alignments(spark, load_alignments(spark, input_file), input_file, output_file, by_coordinate=True)


def calmd(spark: SparkSession, input_file: str, reference: str, output_file: str) -> None:
    """Records with MD and NM made anew from a FASTA reference."""
    records = load_alignments(spark, input_file)
    save_alignments(spark, mismatches.with_md(records, fasta.windows(spark, reference)), input_file, output_file)


def warn_of_processes(wanted: int) -> None:
    if wanted > 1:
        log.warning("num_processes %d has no effect: tasks are as many as the session's cores", wanted)


def tag(spark: SparkSession, input_file: str, output_file: str, num_processes: int = 1) -> None:
    """num_processes is accepted; parallelism is the session's."""
    warn_of_processes(num_processes)
    save_alignments(spark, tagged(load_alignments(spark, input_file)), input_file, output_file)


def index(spark: SparkSession, input_gtf: str, output: str) -> None:
    """features (partitioned by type), tes and gene_names as Parquet below output."""
    rows = tables.gtf(spark, input_gtf)
    if lost := rows.where(F.col("strand") == ".").count():
        log.warning("%d rows of %s have no strand and are left out", lost, input_gtf)
    features, tes, names = genomics.annotation(rows)
    features.write.mode("overwrite").partitionBy("feature_type").parquet(f"{output}/features")
    tes.write.mode("overwrite").parquet(f"{output}/tes")
    names.write.mode("overwrite").parquet(f"{output}/gene_names")


def count(spark: SparkSession, input_bam: str, index_file: str, output_dir: str, sample_name: str, multigene_reads: str = "discard", primer_type: str = "shortdT", library_strandedness: str = "reverse", read_subset: int | None = None, count_introns: bool = False, collapse_by_gene_name: bool = False, drop_unassigned: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read assignments and UMI counts; primer_type is accepted and has no effect. drop_unassigned: reads without a gene are not counted."""
    genomics.check_policy(multigene_reads)
    if primer_type != "shortdT":
        log.warning("primer_type %s has no effect", primer_type)
    features, tes, names = (spark.read.parquet(f"{index_file}/{t}") for t in ("features", "tes", "gene_names"))
    # mates that follow each other need no shuffle to meet
    paired = not read_subset and not input_bam.endswith(".sam") and all(map(aln.grouped_by_name, aln.listed(input_bam)))
    records = aln.bam_pairs(spark, input_bam) if paired else load_alignments(spark, input_bam)
    if read_subset:
        # the first names in file order
        first = records.groupBy("qname").agg(F.min("idx").alias("first")).orderBy("first").limit(read_subset)
        records = records.join(first.select("qname"), "qname", "left_semi")
    found = genomics.assigned(records, features, tes, library_strandedness, multigene_reads, count_introns, paired)
    barcode_of = F.concat(F.lit(f"{sample_name}."), seq.cell_of_name(F.col("qname")))
    cell_and_umi = [barcode_of.alias("barcode"), seq.umi_of_name(F.col("qname")).alias("umi")]
    assignment = found.select(*cell_and_umi, "gene_id", "mapped_feature", "mapping")
    feature = "gene_name" if collapse_by_gene_name else "gene_id"
    if multigene_reads in genomics.LISTED:
        # names stand for ids before molecules are dealt out: a list of ids of one name is that name alone
        listed = found.select("qname", *cell_and_umi, "gene_id", "genes")
        listed = listed.where(~F.startswith(F.col("gene_id"), F.lit("_"))) if drop_unassigned else listed
        listed = multigene.by_name(listed, names) if collapse_by_gene_name else listed
        counts = multigene.RESOLVED[multigene_reads](multigene.classes(listed)).withColumnRenamed("gene_id", feature)
    else:
        counted = assignment.where(~F.startswith(F.col("gene_id"), F.lit("_"))) if drop_unassigned else assignment
        counted = counted.join(names, "gene_id") if collapse_by_gene_name else counted
        counts = umi.umi_counts(counted, feature=feature)
    counts = counts.orderBy("barcode", feature)
    sinks.tsv(assignment, os.path.join(output_dir, f"{sample_name}-read_assignment.tsv"))
    sinks.tsv(counts, os.path.join(output_dir, f"{sample_name}-unique_umi_count.tsv"))
    return assignment, counts


def merge(spark: SparkSession, count_files: str, output_basename: str) -> None:
    """Matrix, annotation of cells and features, and the rank curve (plotted where a plotting library is)."""
    given = [tables.counts(spark, p) for p in count_files.split(",")]
    feature = given[0].columns[1]
    counts = matrix.merged(given)
    cells, features = matrix.cell_annotation(counts).orderBy("barcode"), matrix.feature_annotation(counts).orderBy("feature")
    sinks.matrix_market(matrix.coordinates(counts), features.count(), cells.count(), f"{output_basename}gene_counts.mtx")
    sinks.tsv(cells, f"{output_basename}cell_annotation.tsv")
    sinks.tsv(features.withColumnRenamed("feature", feature), f"{output_basename}gene_annotation.tsv")
    curve = matrix.rank_curve(cells)
    sinks.tsv(curve.orderBy("rank"), f"{output_basename}barcode_rank.tsv")
    sinks.rank_plot(curve, matrix.threshold_counts(cells), f"{output_basename}barcode_rank_plot.png")


def slam(spark: SparkSession, input_bam: str, output_bam: str, snp_vcf: str | None = None, min_base_quality: int = 45, min_tc_ratio: float = 0.3, min_tc_count: int = 1, num_processes: int = 1) -> DataFrame:
    """Records of nascent names, and the counters; without a SNP list no conversion is excluded. num_processes is accepted, parallelism is the session's."""
    warn_of_processes(num_processes)
    if min_base_quality >= 41:
        log.warning("only bases of a quality above %d count; many sequencers give none", min_base_quality)
    records = load_alignments(spark, input_bam)
    snps = tables.snp_file(spark, snp_vcf) if snp_vcf else spark.createDataFrame([], "chrom string, pos int, ref string, alt string")
    folder = f"{qualified(spark, output_bam)}.{uuid.uuid4().hex}.parts"
    try:
        nascent.classified(records, snps, min_base_quality, min_tc_ratio, min_tc_count).select("qname", "read_class").write.mode("overwrite").parquet(f"{folder}/classes")
        classes = spark.read.parquet(f"{folder}/classes")
        kept = nascent.nascent_records(records, classes)
        save_alignments(spark, kept, input_bam, output_bam)
        counted = {r.read_class: r["count"] for r in summary.class_summary(classes, nascent.CLASSES).collect()}
        rows = [("total_reads_processed", counted[summary.TOTAL]), *((c, counted[c]) for c in nascent.CLASSES), ("total_reads_written", kept.count())]
    finally:
        sinks.remove(folder)
    out = spark.createDataFrame(rows, "read_class string, count long")
    stem = output_bam[:-4] if output_bam.endswith((".bam", ".sam")) else output_bam
    sinks.tsv(out, f"{stem}-slam-summary.tsv")
    return out


def guide_dictionaries(spark: SparkSession, ligation_file: str, rt_file: str, inner_i7_file: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dictionaries of a guide run. The inner i7 file is a list (column barcode, repeats lose their variants) or a dictionary."""
    i7 = tables.tsv(spark, inner_i7_file)
    i7 = whitelist.correction_dictionary(i7, "barcode") if "barcode" in i7.columns else tables.dictionary(spark, inner_i7_file)
    return tables.dictionary(spark, ligation_file), tables.dictionary(spark, rt_file), i7


def guide_reads(spark: SparkSession, r1: str, r2: str, r3: str) -> DataFrame:
    """(idx, r1, r2, r3) sequences, dealt over all tasks."""
    three = fastq.triplets(spark, r1, r2, r3, spark.sparkContext.defaultParallelism)
    return three.select("idx", F.col("lig.seq").alias("r1"), F.col("umi.seq").alias("r2"), F.col("bio.seq").alias("r3"))


def guides(spark: SparkSession, r1: str, r2: str, r3: str, ligation_file: str, rt_file: str, inner_i7_file: str, sgrna_file: str, output_dir: str, sample_name: str, annotation_file: str | None = None, min_umi_threshold: int = 1, n_reads: int | None = None) -> tuple[DataFrame, DataFrame]:
    """UMI counts of guides per cell, and the summary."""
    found = reads.classified_guides(guide_reads(spark, r1, r2, r3), *guide_dictionaries(spark, ligation_file, rt_file, inner_i7_file), tables.dictionary(spark, sgrna_file), n_reads=n_reads)
    cells = reads.guide_cells(found, sample_name, tables.guide_names(spark, annotation_file) if annotation_file else None)
    counts = umi.cells_with(umi.umi_counts(cells, feature="sgrna_name"), min_umi_threshold)
    classes = summary.class_summary(found, reads.GUIDE_CLASSES)
    # cells, and the guides of each, as they are first seen
    seen = cells.groupBy("barcode", "sgrna_name").agg(F.min("idx").alias("guide_first"))
    seen = seen.join(seen.groupBy("barcode").agg(F.min("guide_first").alias("cell_first")), "barcode")
    in_order = counts.join(seen, ["barcode", "sgrna_name"]).orderBy("cell_first", "guide_first").select(*counts.columns)
    sinks.tsv(in_order, os.path.join(output_dir, f"{sample_name}-sgrna_count.tsv"))
    sinks.tsv(classes, os.path.join(output_dir, f"{sample_name}-sgrna_summary.tsv"))
    return counts, classes


def discover(spark: SparkSession, r1: str, r2: str, r3: str, ligation_file: str, rt_file: str, inner_i7_file: str, output_dir: str, sample_name: str, n_reads: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Sequences at the guide's place with their reads, and the summary."""
    found = reads.classified_guides(guide_reads(spark, r1, r2, r3), *guide_dictionaries(spark, ligation_file, rt_file, inner_i7_file), None, n_reads=n_reads)
    discovery, classes = reads.discovered_guides(found), summary.class_summary(found, reads.DISCOVERY_CLASSES)
    sinks.tsv(discovery, os.path.join(output_dir, f"{sample_name}-sgrna_discovery.tsv"))
    sinks.tsv(classes, os.path.join(output_dir, f"{sample_name}-sgrna_discovery_summary.tsv"))
    return discovery, classes


def build_dictionary(spark: SparkSession, input_file: str, sequence_column: str, output_file: str) -> DataFrame:
    """The one-mismatch dictionary of a whitelist."""
    out = whitelist.correction_file(tables.tsv(spark, input_file), sequence_column)
    sinks.tsv(out, output_file)
    return out
