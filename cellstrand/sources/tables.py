"""Tables of text: dictionaries, lists, annotation, SNPs and counts; all read by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GTF_SCHEMA = "chrom string, source string, feature string, gtf_start int, gtf_end int, score string, strand string, frame string, attributes string"


def tsv(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """A table with a header line; all columns are strings unless a schema is given."""
    reader = spark.read.option("sep", "\t").option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(variant, original) of a correction file; the last line of a variant counts."""
    rows = tsv(spark, path).select(F.col("barcode_1bp_substitution").alias("variant"), F.col("original_barcode").alias("original"))
    return rows.where("variant is not null and original is not null").withColumn("line", F.monotonically_increasing_id()).groupBy("variant").agg(F.max_by("original", "line").alias("original"))


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """(sequence) of a list without header, one a line."""
    return spark.read.text(path).select(F.trim("value").alias("sequence")).where("sequence <> ''")


def guide_names(spark: SparkSession, path: str) -> DataFrame:
    """(gRNA_seq, names); the last line of a sequence counts."""
    rows = tsv(spark, path).withColumn("line", F.monotonically_increasing_id())
    return rows.groupBy("gRNA_seq").agg(F.max_by("names", "line").alias("names"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """(feature, chrom, start, end, strand, gene_id, transcript_id, gene_name, line); starts from 0, half open."""
    lines = spark.read.option("sep", "\t").option("comment", "#").option("quote", "\u0000").schema(GTF_SCHEMA).csv(path)

    def attribute(name: str):
        found = F.regexp_extract("attributes", rf'(?:^|;)\s*{name} "([^"]*)"', 1)
        return F.when(F.col("attributes").rlike(rf'(?:^|;)\s*{name} "'), found).alias(name)

    return lines.select("feature", "chrom", (F.col("gtf_start") - 1).alias("start"), F.col("gtf_end").alias("end"), "strand", attribute("gene_id"), attribute("transcript_id"), attribute("gene_name"), F.monotonically_increasing_id().alias("line"))


def snps(lines: DataFrame) -> DataFrame:
    """(chrom, pos from 1, ref, alt) of lines `value`: blank, comment and short lines and those without a number are skipped."""
    fields = F.split(F.trim("value"), "\t")
    rows = lines.where((F.trim("value") != "") & ~F.startswith(F.col("value"), F.lit("#"))).select(fields.alias("f")).where(F.size("f") >= 4)
    parsed = rows.select(F.get("f", F.lit(0)).alias("chrom"), F.get("f", F.lit(1)).try_cast("int").alias("pos"), F.upper(F.get("f", F.lit(2))).alias("ref"), F.upper(F.get("f", F.lit(3))).alias("alt"))
    return parsed.where("pos is not null").dropDuplicates()


def snp_file(spark: SparkSession, path: str) -> DataFrame:
    return snps(spark.read.text(path))


def counts(spark: SparkSession, path: str) -> DataFrame:
    """A count table (barcode, gene_id or gene_name, unique_umi_count)."""
    rows = tsv(spark, path)
    return rows.withColumn("unique_umi_count", F.col("unique_umi_count").cast("long"))
