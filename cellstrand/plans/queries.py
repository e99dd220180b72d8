"""Queries of the driver contract: every operator over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstrand.functions import alignment as aln
from cellstrand.functions import sequence as seq
from cellstrand.operators import genomics, matrix, mismatches, multigene, nascent, reads, summary, trimming, umi, whitelist
from cellstrand.plans import fixtures as fx
from cellstrand.plans.commands import tagged
from cellstrand.session import shared_dir
from cellstrand.sinks import bam
from cellstrand.sources import alignments, fasta, fastq, tables
from cellstrand.sources.files import files_in

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle is not None:
            _ORACLES[f.__name__] = oracle
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def dictionaries(spark: SparkSession) -> dict[str, DataFrame]:
    return {k: whitelist.correction_dictionary(fx.codes(spark, p, n, size), "barcode") for k, p, n, size in (("ligation", "lig", 12, 10), ("rt", "rt", 24, 10), ("inner_i7", "i7-", 4, 10), ("guides", "sg", 20, 20))}


def guide_classes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return reads.classified_guides(fx.guide_triplets(spark, sf_dir), **dictionaries(spark), **options)


DICTIONARIES = ",\n".join([fx.sql_dictionary("lig_d", fx.sql_codes("lig", 12, 10)), fx.sql_dictionary("rt_d", fx.sql_codes("rt", 24, 10)), fx.sql_dictionary("i7_d", fx.sql_codes("i7-", 4, 10)), fx.sql_dictionary("sg_d", fx.sql_codes("sg", 20, 20))])
CONSTANTS = ",\n".join([fx.sql_dictionary("c1_d", f"SELECT '{seq.CONSTANT_1}' AS s"), fx.sql_dictionary("c2_d", f"SELECT '{seq.CONSTANT_2}' AS s")])
GUIDES = f"""WITH {DICTIONARIES},
{CONSTANTS},
{fx.GUIDE_READS},
found AS (SELECT idx, l.original AS lig, i.original AS i7, r.original AS rt, g.original AS guide, substr(r1, 1, 8) AS umi, substr(r2, 36, 20) AS raw, c1.original IS NOT NULL AND c2.original IS NOT NULL AS constant
  FROM reads LEFT JOIN lig_d l ON l.variant = substr(r3, 1, 10) LEFT JOIN i7_d i ON i.variant = substr(r2, 1, 10) LEFT JOIN rt_d r ON r.variant = substr(r1, 9, 10) LEFT JOIN sg_d g ON g.variant = substr(r2, 36, 20)
  LEFT JOIN c1_d c1 ON c1.variant = substr(r1, 19, 10) LEFT JOIN c2_d c2 ON c2.variant = substr(r2, 11, 10)),
classified AS (SELECT *, CASE WHEN NOT constant THEN 'filtered_constant_region' WHEN lig IS NULL THEN 'filtered_ligation_barcode' WHEN i7 IS NULL THEN 'filtered_inner_i7' WHEN rt IS NULL THEN 'filtered_RT_barcode' WHEN guide IS NULL THEN 'filtered_sgrna' ELSE 'passed' END AS read_class FROM found),
cells AS (SELECT i7 || '.' || lig || rt AS barcode, guide AS sgrna_name, umi FROM classified WHERE read_class = 'passed')"""


def sql_summary(classes: tuple[str, ...], of: str = "classified") -> str:
    values = ", ".join(f"('{c}')" for c in classes)
    return f"""s AS (SELECT c.read_class, count(x.read_class)::bigint AS "count" FROM (VALUES {values}) c(read_class) LEFT JOIN {of} x ON x.read_class = c.read_class GROUP BY 1),
a AS (SELECT * FROM s UNION ALL SELECT '{summary.TOTAL}', sum("count")::bigint FROM s)
SELECT read_class, "count", "count"::double / nullif((SELECT sum("count") FROM s)::double, 0) * 100.0::double AS percent FROM a"""


@query(f"""WITH {fx.sql_dictionary('d', f"SELECT '{seq.CONSTANT_1}' AS s")},
o AS (SELECT CASE WHEN l_quantity::int <= 3 THEN 'CAAGGGGATA' WHEN l_linenumber = 2 THEN 'CAAGTTGATN' ELSE 'CAAGTTGATA' END AS piece FROM lineitem)
SELECT variant, count(piece)::bigint AS reads FROM d LEFT JOIN o ON piece = variant GROUP BY 1""")
def variants_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guide reads by the variant of the constant region that they hold, variants without reads included."""
    known = whitelist.variants(spark.createDataFrame([(seq.CONSTANT_1,)], "s string"), "s").select("variant")
    pieces = fx.guide_triplets(spark, sf_dir).groupBy(seq.piece(F.col("r1"), *reads.GuideLayout().constant_1).alias("piece")).agg(F.count(F.lit(1)).alias("n"))
    return known.join(pieces, F.col("piece") == F.col("variant"), "left").select("variant", F.coalesce("n", F.lit(0)).alias("reads"))


def part_codes(spark: SparkSession, sf_dir: str, folds: int | None = None) -> DataFrame:
    number = F.col("p_partkey") if folds is None else F.col("p_partkey") % folds
    return fx.table(spark, sf_dir, "part").select(fx.code("bc", number, 10).alias("barcode"))


PART_CODES = fx.sql_dictionary("d", f"SELECT DISTINCT {fx.sql_code('bc', 'p_partkey', 10)} AS s FROM part")


@query(f"WITH {PART_CODES} SELECT variant AS barcode_1bp_substitution, original AS original_barcode FROM d")
def correction_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.correction_file(part_codes(spark, sf_dir), "barcode")


@query(f"WITH {fx.sql_dictionary('d', f'SELECT {fx.sql_code("bc", "p_partkey % 1500", 10)} AS s FROM part')} SELECT variant, original FROM d")
def dup_poisoned_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitelist.correction_dictionary(part_codes(spark, sf_dir, 1500), "barcode")


@query(f"WITH {PART_CODES}, o AS (SELECT CASE WHEN l_linenumber = 1 THEN 'N' || substr(s, 2) WHEN l_linenumber = 2 THEN substr(s, 1, 4) || 'NN' || substr(s, 7) ELSE s END AS observed FROM (SELECT l_linenumber, {fx.sql_code('bc', 'l_partkey', 10)} AS s FROM lineitem)) SELECT original, count(*)::bigint AS reads FROM o LEFT JOIN d ON d.variant = o.observed GROUP BY 1")
def correct_and_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fx.code("bc", F.col("l_partkey"), 10)
    observed = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("N"), F.substring(s, 2, 9))).when(F.col("l_linenumber") == 2, F.concat(F.substring(s, 1, 4), F.lit("NN"), F.substring(s, 7, 4))).otherwise(s)
    found = whitelist.looked_up(fx.table(spark, sf_dir, "lineitem"), observed, whitelist.correction_dictionary(part_codes(spark, sf_dir), "barcode", dedup=True), "original")
    return found.groupBy("original").agg(F.count(F.lit(1)).alias("reads"))


@query(f"{GUIDES},\n{sql_summary(reads.GUIDE_CLASSES)}")
def read_class_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.class_summary(guide_classes(spark, sf_dir), reads.GUIDE_CLASSES)


SGRNA_COUNTS = "counts AS (SELECT barcode, sgrna_name, count(DISTINCT umi)::bigint AS unique_umi_count FROM cells GROUP BY 1, 2)"


@query(f"{GUIDES}, {SGRNA_COUNTS} SELECT * FROM counts")
def sgrna_umi_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.umi_counts(reads.guide_cells(guide_classes(spark, sf_dir)), feature="sgrna_name")


@query(f"{GUIDES}, {SGRNA_COUNTS} SELECT * FROM counts QUALIFY sum(unique_umi_count) OVER (PARTITION BY barcode) >= 30")
def sgrna_umi_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.cells_with(umi.umi_counts(reads.guide_cells(guide_classes(spark, sf_dir)), feature="sgrna_name"), 30)


@query(f"{GUIDES}, names AS (SELECT {fx.sql_code('sg', 'n', 20)} AS s, 'guide' || (n % 5) AS name FROM range(10) r(n)) SELECT 'S1' || barcode AS barcode, coalesce(name, sgrna_name) AS sgrna_name, count(DISTINCT umi)::bigint AS unique_umi_count FROM cells LEFT JOIN names ON s = sgrna_name GROUP BY 1, 2")
def sgrna_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.range(10).select(fx.code("sg", F.col("id"), 20).alias("gRNA_seq"), F.concat(F.lit("guide"), (F.col("id") % 5).cast("string")).alias("names"))
    return umi.umi_counts(reads.guide_cells(guide_classes(spark, sf_dir), "S1", names), feature="sgrna_name")


DISCOVERED = "CASE WHEN NOT constant THEN 'filtered_constant_region' WHEN lig IS NULL THEN 'filtered_ligation_barcode' WHEN i7 IS NULL THEN 'filtered_inner_i7' WHEN rt IS NULL THEN 'filtered_RT_barcode' ELSE 'passed' END"


@query(f"{GUIDES}, c AS (SELECT raw AS sgrna_seq, count(*)::bigint AS read_count FROM found WHERE {DISCOVERED} = 'passed' GROUP BY 1) SELECT sgrna_seq, read_count, read_count::double / (SELECT sum(read_count) FROM c)::double * 100.0::double AS percent_of_passed_reads FROM c")
def seq_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = dictionaries(spark) | {"guides": None}
    return reads.discovered_guides(reads.classified_guides(fx.guide_triplets(spark, sf_dir), **own))


@query(f"{GUIDES}, x AS (SELECT {DISCOVERED} AS read_class FROM found),\n{sql_summary(reads.DISCOVERY_CLASSES, 'x')}")
def discovery_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = dictionaries(spark) | {"guides": None}
    return summary.class_summary(reads.classified_guides(fx.guide_triplets(spark, sf_dir), **own), reads.DISCOVERY_CLASSES)


@query(f"{GUIDES} SELECT idx, read_class, count(*)::bigint AS n FROM classified WHERE idx <= 500 GROUP BY 1, 2")
def first_n_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guide_classes(spark, sf_dir, n_reads=500).groupBy("idx", "read_class").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {fx.RNA_READS} SELECT name, substr(lig, 1, 10) AS ligation, substr(umi, 1, 8) AS umi, substr(umi, 9, 10) AS rt, substr(umi, 19) AS rest, substr(bio, 1, 3) AS head FROM reads")
def slice_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    umi_seq = F.col("umi.seq")
    return fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), seq.piece(F.col("lig.seq"), 0, 10).alias("ligation"), seq.piece(umi_seq, 0, 8).alias("umi"), seq.piece(umi_seq, 8, 18).alias("rt"), seq.rest(umi_seq, 18).alias("rest"), seq.piece(F.col("bio.seq"), 0, 3).alias("head"))


@query(f"WITH {fx.RNA_READS} SELECT name, length(regexp_extract(substr(umi, 19), '^T{{5,}}'))::int AS n, substr(substr(umi, 19), length(regexp_extract(substr(umi, 19), '^T{{5,}}')) + 1) AS trimmed FROM reads")
def polyt_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), seq.rest(F.col("umi.seq"), 18).alias("s")).withColumn("n", seq.poly_t_length(F.col("s")))
    return r.select("name", "n", seq.rest(F.col("s"), F.col("n")).alias("trimmed"))


@query(f"WITH {fx.RNA_READS} SELECT name, CASE WHEN instr(umi, '{seq.ADAPTER}') > 0 THEN substr(umi, 1, instr(umi, '{seq.ADAPTER}') - 1) ELSE umi END AS trimmed FROM reads")
def adapter_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("umi.seq")
    return fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), F.substr(s, F.lit(1), seq.before(s, F.lit(seq.ADAPTER))).alias("trimmed"))


@query(f"""WITH {fx.RNA_READS}, placed AS (SELECT name, umi, list_min([p FOR p IN range(0, length(umi) - 9) IF hamming(substr(umi, p + 1, 10), 'ACGTACGTAC') <= 4]) AS p FROM reads)
SELECT name, coalesce(p, length(umi))::int AS before, substr(umi, 1, coalesce(p, length(umi))) AS trimmed FROM placed""")
def adapter_trim_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads before the first place that differs at four of ten bases at most from a sequence."""
    s = F.col("umi.seq")
    rows = fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), s.alias("s"), seq.before_within(s, "ACGTACGTAC", 4).alias("before"))
    return rows.select("name", "before", F.substr("s", F.lit(1), "before").alias("trimmed"))


TRIMS = {"umi": trimming.Trim(seq.ADAPTER, clip=1), "bio": trimming.Trim("A" * 8)}
#: Qualities of the bases ACGTN, some below the threshold.
TRIM_QUALITIES = "I5+?#"


def sql_trim(mate: str, how: trimming.Trim) -> str:
    """CTEs that end in <mate>_n (rid, s, n): the bases of a mate that are left, from all stretches of the read."""
    m, e = len(how.adapter), int(how.error_rate * len(how.adapter))
    return f"""{mate}_q AS (SELECT rid, {mate} AS s, translate({mate}, 'ACGTN', '{TRIM_QUALITIES}') AS q FROM numbered),
{mate}_r AS (SELECT rid, b, sum({how.quality} + 33 - ascii(substr(q, length(q) - b + 1, 1))) OVER (PARTITION BY rid ORDER BY b) AS t FROM (SELECT rid, q, unnest(range(1, length(q) + 1)) AS b FROM {mate}_q)),
{mate}_x AS (SELECT rid, b FROM {mate}_r LEFT JOIN (SELECT rid, min(b) AS stop FROM {mate}_r WHERE t < 0 GROUP BY 1) USING (rid)
  WHERE t > 0 AND b < coalesce(stop, b + 1) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY t DESC, b) = 1),
{mate}_c AS (SELECT rid, substr(s, 1, length(s) - coalesce(b, 0)) AS s FROM {mate}_q LEFT JOIN {mate}_x USING (rid)),
{mate}_e AS (SELECT rid, s, {m} AS k, unnest(range(0, length(s) + 1)) AS e FROM {mate}_c UNION ALL SELECT rid, s, k, length(s) FROM {mate}_c, range({min(how.overlap, m)}, {m}) r(k)),
{mate}_p AS (SELECT rid, k, e, p, levenshtein(substr(s, p + 1, e - p), substr('{how.adapter}', 1, k)) AS d FROM (SELECT *, unnest(range(greatest(0, e - k - {e}), greatest(0, e - k + {e} + 1))) AS p FROM {mate}_e) WHERE p <= e),
{mate}_b AS (SELECT * FROM {mate}_p QUALIFY row_number() OVER (PARTITION BY rid, k, e ORDER BY d, p) = 1),
{mate}_n AS (SELECT c.rid, any_value(c.s) AS s, greatest(0, coalesce(min(b.p) FILTER (b.d <= floor({how.error_rate} * b.k + 1e-9)), any_value(length(c.s))) - {how.clip})::int AS n
  FROM {mate}_c c LEFT JOIN {mate}_b b ON b.rid = c.rid GROUP BY 1)"""


@query(f"""WITH {fx.RNA_READS}, numbered AS (SELECT row_number() OVER () AS rid, * FROM reads), {", ".join(sql_trim(m, how) for m, how in TRIMS.items())}
SELECT name, CASE WHEN u.n >= 20 AND b.n >= 20 THEN 'passed_trimming' ELSE 'filtered_too_short_after_trimming' END AS read_class, substr(u.s, 1, u.n) AS r1, substr(b.s, 1, b.n) AS r2
FROM numbered JOIN umi_n u USING (rid) JOIN bio_n b USING (rid)""")
def trimmed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of reads cut by quality, by an adapter with errors, and by poly-A."""

    def mate(name: str) -> Column:
        s = F.col(f"{name}.seq")
        return F.struct(s.alias("seq"), F.translate(s, "ACGTN", TRIM_QUALITIES).alias("qual"))

    pairs = fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), mate("umi").alias("r1"), mate("bio").alias("r2"))
    return trimming.trimmed(pairs, TRIMS["umi"], TRIMS["bio"]).select("name", "read_class", F.col("r1.seq").alias("r1"), F.col("r2.seq").alias("r2"))


@query(f"WITH {fx.RNA_READS}, r AS (SELECT name, bio, reverse(translate(substr(umi, 9, 10), 'ACGTN', 'TGCAN')) AS rc FROM reads) SELECT name, rc, CASE WHEN instr(bio, rc) > 0 THEN substr(bio, 1, instr(bio, rc) - 1) ELSE bio END AS trimmed FROM r")
def revcomp_readthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc, bio = seq.reverse_complement(seq.piece(F.col("umi.seq"), 8, 18)), F.col("bio.seq")
    return fx.rna_triplets(spark, sf_dir).select(F.col("umi.id").alias("name"), rc.alias("rc"), F.substr(bio, F.lit(1), seq.before(bio, rc)).alias("trimmed"))


def demultiplexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = dictionaries(spark)
    random_n = spark.range(12, 24).select(fx.code("rt", F.col("id"), 10).alias("sequence"))
    return reads.demultiplexed(fx.rna_triplets(spark, sf_dir), own["ligation"], own["rt"], random_n)


DEMUX = f"""WITH {fx.sql_dictionary("lig_d", fx.sql_codes("lig", 12, 10))},
{fx.sql_dictionary("rt_d", fx.sql_codes("rt", 24, 10))},
{fx.RNA_READS},
rn AS (SELECT {fx.sql_code("rt", "n", 10)} AS s FROM range(12, 24) r(n)),
f AS (SELECT reads.*, l.original AS ligation, r.original AS rt, substr(umi, 1, 8) AS u, substr(umi, 19) AS s0 FROM reads LEFT JOIN lig_d l ON l.variant = substr(lig, 1, 10) LEFT JOIN rt_d r ON r.variant = substr(umi, 9, 10)),
g AS (SELECT *, CASE WHEN rt IN (SELECT s FROM rn) THEN s0 ELSE substr(s0, length(regexp_extract(s0, '^T{{5,}}')) + 1) END AS s1, reverse(translate(rt, 'ACGTN', 'TGCAN')) AS rc FROM f),
h2 AS (SELECT *, CASE WHEN instr(s1, '{seq.ADAPTER}') > 0 THEN substr(s1, 1, instr(s1, '{seq.ADAPTER}') - 1) ELSE s1 END AS r1, CASE WHEN instr(bio, rc) > 0 THEN substr(bio, 1, instr(bio, rc) - 1) ELSE bio END AS r2 FROM g),
classified AS (SELECT *, CASE WHEN ligation IS NULL THEN 'filtered_no_ligation_barcode' WHEN rt IS NULL THEN 'filtered_no_RT_barcode' WHEN length(r1) > 20 AND length(r2) > 20 THEN 'passed_all_filters' ELSE 'filtered_too_short' END AS read_class FROM h2)"""


@query(f"{DEMUX} SELECT ligation || rt || ',' || u || ',' || name AS read_name, r1 AS r1_seq, translate(r1, 'ACGTN', 'IHGFE') AS r1_qual, r2 AS r2_seq, translate(r2, 'ACGTN', 'IHGFE') AS r2_qual FROM classified WHERE read_class = 'passed_all_filters'")
def demux_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = demultiplexed(spark, sf_dir).where(F.col("read_class") == reads.RNA_CLASSES[-1])
    return passed.select(F.col("r1.name").alias("read_name"), F.col("r1.seq").alias("r1_seq"), F.col("r1.qual").alias("r1_qual"), F.col("r2.seq").alias("r2_seq"), F.col("r2.qual").alias("r2_qual"))


@query(f"{DEMUX},\n{sql_summary(reads.RNA_CLASSES)}")
def demux_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.class_summary(demultiplexed(spark, sf_dir), reads.RNA_CLASSES)


@query(f"WITH {fx.PAIRS} SELECT qname, split_part(qname, ',', 1) AS cb, split_part(qname, ',', 2) AS ur, 'S1.' || split_part(qname, ',', 1) AS barcode, (2 * count(*))::bigint AS records FROM all_pairs GROUP BY 1")
def readname_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tagged(fx.alignments(spark, sf_dir).withColumn("tags", F.lit(None).cast("map<string,string>")))
    return rows.select("qname", F.col("tags")["CB"].alias("cb"), F.col("tags")["UR"].alias("ur")).groupBy("qname", "cb", "ur").agg(F.count(F.lit(1)).alias("records")).withColumn("barcode", F.concat(F.lit("S1."), "cb"))


@query("SELECT f AS flag, q AS mapq, count(*)::bigint AS n FROM (SELECT ((l_orderkey * 7 + l_partkey) % 4096)::int AS f, (l_suppkey % 61)::int AS q FROM lineitem) WHERE q >= 30 AND (f & 2) = 2 AND (f & 1804) = 0 GROUP BY 1, 2")
def flag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "lineitem").select(((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 4096).cast("int").alias("flag"), (F.col("l_suppkey") % 61).cast("int").alias("mapq"))
    return rows.where(aln.well_mapped(F.col("flag"), F.col("mapq"))).groupBy("flag", "mapq").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT l_suppkey % 12 AS cell, umi, chrom, pos, name FROM (SELECT l_suppkey, {fx.sql_code('umi', 'l_orderkey % 50', 8)} AS umi, 'chr' || (l_suppkey % 3 + 1) AS chrom, (l_partkey * 37) % 997 AS pos, {fx.KEY} AS name FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_suppkey % 12, umi, chrom, pos ORDER BY name) = 1")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem")
    rows = li.select((F.col("l_suppkey") % 12).alias("cell"), fx.code("umi", F.col("l_orderkey") % 50, 8).alias("umi"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("chrom"), ((F.col("l_partkey") * 37) % 997).alias("pos"), fx.key().alias("name"))
    return umi.exact_dedup(rows, ["cell", "umi", "chrom", "pos"], ["name"])


@query("SELECT l_orderkey::varchar AS qname, max(s) FILTER (f = 64) AS first_pos, max(s) FILTER (f = 128) AS second_pos FROM (SELECT l_orderkey, (l_partkey * 37 % 400000)::int AS s, CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END AS f FROM lineitem) GROUP BY 1 HAVING count(*) = 2 AND count(*) FILTER (f = 64) = 1")
def pair_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fx.table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").cast("string").alias("qname"), F.when(F.col("l_linenumber") % 2 == 1, 64).otherwise(128).alias("flag"), F.lit("chr1").alias("rname"), ((F.col("l_partkey") * 37) % 400000).cast("int").alias("pos"), F.lit("60M").alias("cigar"))
    return genomics.read_pairs(rows).select("qname", F.col("m1.pos").alias("first_pos"), F.col("m2.pos").alias("second_pos"))


@query(f"WITH {fx.PAIRS} SELECT qname, strand FROM pairs")
def fragment_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.read_pairs(fx.alignments(spark, sf_dir)).select("qname", aln.fragment_strand(F.col("m1.reverse"), F.col("m2.reverse")).alias("strand"))


@query(f"WITH {fx.GENES} SELECT gene_id, gene_id AS transcript_id, chrom, CASE WHEN strand = '+' THEN e ELSE g END::int AS tes, strand FROM genes")
def gtf_tes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.annotation(fx.gtf(spark, sf_dir))[1]


@query(f"WITH {fx.GENES} SELECT gene_id, gene_name FROM genes")
def gene_name_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.annotation(fx.gtf(spark, sf_dir))[2]


SHAPES = """WITH s AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS name, ((l_partkey * 37) % 400000)::int AS p, trunc(l_quantity)::int AS q, l_linenumber AS k FROM lineitem),
b AS (SELECT name, unnest(CASE k WHEN 1 THEN [[p, p + q]] WHEN 2 THEN [[p, p + q]] WHEN 3 THEN [[p, p + 20], [p + 20 + q, p + 60 + q]] WHEN 4 THEN [[p, p + 30], [p + 30, p + 30 + q]]
  WHEN 5 THEN [[p, p + 30], [p + 30 + q, p + 60 + q]] WHEN 6 THEN [[p + 25 + q, p + 55 + q]] ELSE [] END) AS b FROM s)
SELECT name, b[1]::int AS "start", b[2]::int AS "end", count(*)::bigint AS n FROM b GROUP BY ALL"""


@query(SHAPES)
def cigar_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned blocks of CIGARs with clips, gaps, insertions and deletions."""
    each = fx.shaped(spark, sf_dir).select("name", F.explode(aln.blocks(F.col("pos"), F.col("cigar"))).alias("b"))
    return each.groupBy("name", F.col("b.start").alias("start"), F.col("b.end").alias("end")).agg(F.count(F.lit(1)).alias("n"))


def stranded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = genomics.read_pairs(fx.alignments(spark, sf_dir))
    return pairs.select("qname", aln.fragment_strand(F.col("m1.reverse"), F.col("m2.reverse")).alias("strand"), "m1", "m2")


def exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.annotation(fx.gtf(spark, sf_dir))[0].where(F.col("feature_type") == "exon")


@query(f"WITH {fx.PAIRS}, {fx.GENES}, {fx.HITS} SELECT gene_id, mate::int AS mate, count(*)::bigint AS pairs FROM hits WHERE space = 'exon' GROUP BY 1, 2")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.pairs_by_gene(stranded_pairs(spark, sf_dir), exons(spark, sf_dir))


@query(f"WITH {fx.PAIRS}, {fx.GENES}, {fx.HITS} SELECT qname, {fx.CALL} AS gene_call, coalesce(b, 0)::int AS shared FROM sets WHERE space = 'exon'")
def gene_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = genomics.called(stranded_pairs(spark, sf_dir), exons(spark, sf_dir)).where("any_exon > 0")
    return found.select("qname", genomics.call_of("exon").alias("gene_call"), F.col("both_exon").alias("shared"))


SPACES = f"""WITH {fx.PAIRS}, {fx.GENES}, {fx.HITS}, {fx.NEAREST},
x AS (SELECT p.*, {fx.CALL} AS call, n.nearest FROM pairs p LEFT JOIN sets ON sets.qname = p.qname AND sets.space = 'exon' LEFT JOIN near n ON n.qname = p.qname AND n.space = 'exon'),
t AS (SELECT p.qname, {fx.CALL} AS call, n.nearest FROM pairs p LEFT JOIN sets ON sets.qname = p.qname AND sets.space = 'transcript' LEFT JOIN near n ON n.qname = p.qname AND n.space = 'transcript')"""
MAPPING = "x.qname || ' READ1 chr' || chrom || ':' || s1 || '-' || e1 || ' READ2 chr' || chrom || ':' || s2 || '-' || e2"


def assigned(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    features, tes, _ = genomics.annotation(fx.gtf(spark, sf_dir))
    return genomics.assigned(fx.alignments(spark, sf_dir), features, tes, **options)


@query(f"{SPACES}, y AS (SELECT qname, coalesce(call, '_multiple') AS g FROM x) SELECT y.qname, CASE WHEN g <> '_no_feature_overlap' THEN g ELSE coalesce(t.call, '_multiple') END AS gene_id, CASE WHEN g <> '_no_feature_overlap' THEN 'exon' WHEN coalesce(t.call, '_multiple') <> '_no_feature_overlap' THEN 'transcript' ELSE 'none' END AS mapped_feature FROM y JOIN t USING (qname)")
def exon_intron_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir, introns=True).drop("mapping")


@query(f"{SPACES} SELECT qname, coalesce(call, nearest, '_ambiguous') AS gene_id FROM x WHERE strand <> '.'")
def closest_tes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assigned(spark, sf_dir, policy="closest_TES").select("qname", "gene_id")
    return found.join(stranded_pairs(spark, sf_dir).where("strand <> '.'").select("qname"), "qname", "left_semi")


@query(f"{SPACES} SELECT coalesce(call, '_multiple') AS gene_id, count(*)::bigint AS pairs FROM x GROUP BY 1")
def multigene_discard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir).groupBy("gene_id").agg(F.count(F.lit(1)).alias("pairs"))


@query(f"WITH {fx.PAIRS}, {fx.GENES} SELECT x.qname, {MAPPING} AS mapping FROM pairs x")
def mapping_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genomics.read_pairs(fx.alignments(spark, sf_dir)).select("qname", genomics.mapping().alias("mapping"))


@query(f"""WITH {fx.PAIRS}, {fx.GENES}, {fx.HITS.replace("f.strand = p.strand AND ", "")} SELECT p.qname, coalesce({fx.CALL}, '_multiple') AS gene_id FROM pairs p LEFT JOIN sets ON sets.qname = p.qname AND sets.space = 'exon'""")
def unstranded_call(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir, library="none").select("qname", "gene_id")


CELL = "'S1.' || split_part(qname, ',', 1) AS barcode, split_part(qname, ',', 2) AS umi"


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir, introns=True).select(F.concat(F.lit("S1."), seq.cell_of_name(F.col("qname"))).alias("barcode"), seq.umi_of_name(F.col("qname")).alias("umi"), "gene_id")


ASSIGNED = f"{SPACES}, y AS (SELECT qname, coalesce(call, '_multiple') AS g FROM x), z AS (SELECT {CELL}, CASE WHEN g <> '_no_feature_overlap' THEN g ELSE coalesce(t.call, '_multiple') END AS gene_id FROM y JOIN t USING (qname))"


@query(f"{ASSIGNED} SELECT barcode, gene_id, count(DISTINCT umi)::bigint AS unique_umi_count FROM z GROUP BY 1, 2")
def gene_umi_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return umi.umi_counts(counted(spark, sf_dir))


@query(f"{ASSIGNED} SELECT barcode, gene_name, count(DISTINCT umi)::bigint AS unique_umi_count FROM z JOIN genes USING (gene_id) GROUP BY 1, 2")
def gene_name_umi_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = genomics.annotation(fx.gtf(spark, sf_dir))[2]
    return umi.umi_counts(counted(spark, sf_dir).join(names.hint("merge"), "gene_id"), feature="gene_name")


@query(f"WITH {fx.RNA_READS} SELECT name, umi AS seq, count(*)::bigint AS records FROM reads GROUP BY 1, 2")
def fastq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cell reads as FASTQ text, read back in ranges of bytes."""
    m = F.col("umi")
    record = F.concat_ws("\n", F.concat(F.lit("@"), m["id"]), m["seq"], F.lit("+"), m["qual"])
    folder = shared_dir(spark, "reads")
    fx.rna_triplets(spark, sf_dir).select(record.alias("value")).write.text(folder)
    found = fastq.fastq(spark, ",".join(files_in(folder, ".txt")), split=1 << 20)
    return found.groupBy(F.col("id").alias("name"), "seq").agg(F.count(F.lit(1)).alias("records"))


#: CIGARs of records for the reference below, by line number, and their SQL: the operations that consume the reference and the read's first base.
MD_CIGARS = ("32M", "10M5D22M", "5S10M100N17M", "8M2I22M", "32M", "3M1D4M2D20M")
CONTIG_LINES = 12_520


def sql_base(contig: str, place: str) -> str:
    return f"substr({fx.sql_dna(f"{contig} || '-' || (({place}) // 32)")}, (({place}) % 32 + 1)::int, 1)"


def reference(spark: SparkSession, sf_dir: str) -> str:
    """A FASTA file of three contigs whose bases follow from their places."""
    folder = shared_dir(spark, "reference")
    name = F.concat(F.lit("chr"), (F.col("id") + 1).cast("string"))
    lines = F.transform(F.sequence(F.lit(0), F.lit(CONTIG_LINES - 1)), lambda k: fx.dna(F.concat(name, F.lit("-"), k.cast("string"))))
    spark.range(3).select(F.concat(F.lit(">"), name, F.lit("\n"), F.array_join(lines, "\n")).alias("value")).write.text(folder)
    return ",".join(files_in(folder, ".txt"))


MD_OPS = "CASE k WHEN 2 THEN [[0, 10, 0], [10, 15, 1], [15, 37, 0]] WHEN 3 THEN [[0, 10, 0], [110, 127, 0]] WHEN 4 THEN [[0, 8, 0], [8, 30, 0]] WHEN 6 THEN [[0, 3, 0], [3, 4, 1], [4, 8, 0], [8, 10, 1], [10, 30, 0]] ELSE [[0, 32, 0]] END"


@query(f"""WITH r AS (SELECT row_number() OVER () AS rid, {fx.KEY} AS qname, 'chr' || (l_suppkey % 3 + 1) AS chrom, ((l_partkey * 37) % 400000)::bigint AS pos, l_linenumber AS k, (l_orderkey % 7)::int AS m FROM lineitem),
o AS (SELECT rid, chrom, pos, m, unnest({MD_OPS}) AS o FROM r),
c AS (SELECT rid, chrom, pos, m, o[3] AS gone, unnest(range(o[1], o[2])) AS x FROM o),
d AS (SELECT rid, x, gone, CASE WHEN gone = 0 AND (x + m) % 7 = 0 THEN 1 ELSE 0 END AS other, {sql_base("chrom", "pos + x")} AS b FROM c),
e AS (SELECT *, sum(CASE WHEN gone = 0 AND other = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY x) AS same,
  gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY x), 0) = 0 AS first FROM d),
f AS (SELECT rid, x, same, gone, b, first, same - coalesce(lag(same) OVER (PARTITION BY rid ORDER BY x), 0) AS n FROM e WHERE gone = 1 OR other = 1),
g AS (SELECT rid, string_agg(CASE WHEN first THEN n || '^' || b WHEN gone = 1 THEN b ELSE n || b END, '' ORDER BY x) AS md, max(same) AS last FROM f GROUP BY 1),
h AS (SELECT rid, max(same) AS same, sum(other) + sum(gone) AS nm FROM e GROUP BY 1)
SELECT qname, coalesce(md, '') || (same - coalesce(last, 0))::varchar AS md, (nm + CASE WHEN k = 4 THEN 2 ELSE 0 END)::int AS nm FROM r JOIN h USING (rid) LEFT JOIN g USING (rid)""")
def md_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MD and NM of a record for each line item, of which every seventh aligned base is N."""
    li = fx.table(spark, sf_dir, "lineitem")
    rows = li.select(
        F.monotonically_increasing_id().alias("idx"), fx.key().alias("qname"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("rname"),
        ((F.col("l_partkey") * 37) % 400000).cast("int").alias("pos"), F.coalesce(F.get(F.array(*map(F.lit, MD_CIGARS)), F.col("l_linenumber") - 1), F.lit("32M")).alias("cigar"), (F.col("l_orderkey") % 7).cast("int").alias("m"),
    )
    first = F.floor(F.col("pos") / 32)
    text = F.concat(*[fx.dna(F.concat("rname", F.lit("-"), (first + j).cast("string"))) for j in range(5)])
    records = rows.withColumn("seq", fx.reads_of(F.substr(text, (F.col("pos") % 32 + 1), F.lit(128)), F.col("cigar"), F.col("m"))).drop("m")
    return mismatches.with_md(records, fasta.windows(spark, reference(spark, sf_dir))).select("qname", F.col("tags")["MD"].alias("md"), F.col("tags")["NM"].cast("int").alias("nm"))


@query("SELECT l_orderkey::varchar AS qname, max(s) FILTER (f = 64) AS first_pos, max(s) FILTER (f = 128) AS second_pos FROM (SELECT l_orderkey, (l_partkey * 37 % 400000)::int AS s, CASE WHEN l_linenumber % 2 = 1 THEN 64 ELSE 128 END AS f FROM lineitem) GROUP BY 1 HAVING count(*) = 2 AND count(*) FILTER (f = 64) = 1")
def grouped_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a file that is grouped by name, put together while its ranges are read."""
    li = fx.table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_linenumber") % 2 == 1, 64).otherwise(128)
    rows = li.select(F.col("l_orderkey").alias("idx"), flag.alias("flag"), ((F.col("l_partkey") * 37) % 400000).cast("int").alias("pos")).orderBy("idx")
    more = {"qname": F.col("idx").cast("string"), "rname": F.lit("chr1"), "mapq": F.lit(60), "cigar": F.lit("60M"), "rnext": F.lit("*"), "pnext": F.lit(-1), "tlen": F.lit(0), "seq": F.lit("*"), "qual": F.lit("*"), "tags": F.create_map(F.lit("NM"), F.lit("0"))}
    path = f"{shared_dir(spark, 'bam')}/x.bam"
    bam.bam(rows.withColumns(more), "@HD\tVN:1.6\tGO:query\n@SQ\tSN:chr1\tLN:500000\n", [("chr1", 500_000)], path, ordered=True)
    return alignments.bam_pairs(spark, path, split=1 << 18).select("qname", F.col("m1.pos").alias("first_pos"), F.col("m2.pos").alias("second_pos"))


CHROMOSOMES = [("chr2", 600_000), ("chr3", 600_000), ("chr1", 600_000)]


def sorted_file(spark: SparkSession, sf_dir: str) -> str:
    """All alignments as a BAM file in order of coordinates, with its index, in a folder that all machines share."""
    folder = shared_dir(spark, "bam")
    more = {"idx": F.xxhash64("qname", "flag"), "mapq": F.lit(60), "rnext": F.lit("*"), "pnext": F.lit(-1), "tlen": F.lit(0), "seq": F.lit("*"), "qual": F.lit("*"), "tags": F.create_map(F.lit("NM"), F.lit("0"))}
    head = "".join(f"@SQ\tSN:{name}\tLN:{size}\n" for name, size in CHROMOSOMES)
    bam.sorted_bam(fx.alignments(spark, sf_dir).withColumns(more), head, CHROMOSOMES, f"{folder}/x.bam")
    return f"{folder}/x.bam"


MATES = f"WITH {fx.PAIRS}, mates AS (SELECT chrom, s1 AS pos FROM all_pairs UNION ALL SELECT chrom, s2 FROM all_pairs)"


@query(f"""{MATES} SELECT row_number() OVER (ORDER BY CASE chrom WHEN 'chr2' THEN 1 WHEN 'chr3' THEN 2 ELSE 3 END, pos)::bigint AS nth, chrom AS rname, pos FROM mates""")
def coordinate_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and positions of a sorted file's records, in its order."""
    # the file is read once; numbering goes over its rows several times
    folder = shared_dir(spark, "places")
    alignments.bam(spark, sorted_file(spark, sf_dir)).select("idx", "rname", "pos").write.parquet(folder)
    rows = spark.read.parquet(folder)
    return matrix.numbered(rows, [F.col("idx")], "nth").select("nth", "rname", "pos")


@query(f"""{MATES} SELECT pos, count(*)::bigint AS records FROM mates WHERE chrom = 'chr3' AND pos < 260000 AND pos + 60 > 150000 GROUP BY 1""")
def region_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one region, by the file's index."""
    return alignments.fetched(spark, sorted_file(spark, sf_dir), "chr3", 150_000, 260_000).groupBy("pos").agg(F.count(F.lit(1)).alias("records"))


#: Molecules (cell, UMI, gene list) and their classes, of pairs called by exons.
MOLECULES = f"""WITH {fx.PAIRS}, {fx.GENES}, {fx.HITS},
lists AS (SELECT qname, list_sort(list(gene_id)) AS genes FROM per_gene WHERE space = 'exon' AND mates = 2 GROUP BY 1),
called AS (SELECT p.qname, CASE WHEN {fx.CALL} IS NOT NULL THEN [{fx.CALL}] ELSE genes END AS genes
  FROM pairs p LEFT JOIN sets ON sets.qname = p.qname AND sets.space = 'exon' LEFT JOIN lists ON lists.qname = p.qname),
molecules AS (SELECT DISTINCT {CELL}, genes FROM called),
classes AS (SELECT barcode, genes, count(*)::bigint AS n FROM molecules GROUP BY 1, 2),
members AS (SELECT barcode, genes, n, len(genes) AS size, unnest(genes) AS gene_id FROM classes)"""


def placed_classes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Classes whose lists are told by digests, stored as several steps read them; and the exons."""
    features, folder = exons(spark, sf_dir), shared_dir(spark, "classes")
    found = genomics.called(stranded_pairs(spark, sf_dir), features, digests=True)
    multigene.placed(found, F.concat(F.lit("S1."), seq.cell_of_name(F.col("qname"))), seq.umi_of_name(F.col("qname"))).write.parquet(folder)
    return spark.read.parquet(folder), features


def gene_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes with their lists, which are shuffled once, to their cells; molecules are told by digests until then."""
    return multigene.with_lists(*placed_classes(spark, sf_dir))


def rounded(counts: DataFrame) -> DataFrame:
    return counts.withColumn(multigene.COUNT, F.round(multigene.COUNT, 6))


@query(f"""{MOLECULES} SELECT barcode, array_to_string(genes, ',') AS gene_id, n AS molecules FROM classes""")
def multigene_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells' molecules by their gene lists, joined to strings."""
    return multigene.placed_lists(*placed_classes(spark, sf_dir)).withColumnRenamed("n", "molecules")


@query(f"""{MOLECULES} SELECT barcode, gene_id, round(sum(n::double / size), 6) AS unique_umi_count FROM members GROUP BY 1, 2""")
def multigene_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(multigene.placed_uniform(*placed_classes(spark, sf_dir)))


@query(f"""{MOLECULES},
priors AS (SELECT m.*, coalesce(o.n, 0)::double AS prior FROM members m LEFT JOIN members o ON o.size = 1 AND o.barcode = m.barcode AND o.gene_id = m.gene_id),
shares AS (SELECT *, sum(prior) OVER (PARTITION BY barcode, genes) AS total FROM priors),
masses AS (SELECT barcode, gene_id, n * CASE WHEN size = 1 THEN 1 WHEN total > 0 THEN prior / total ELSE 1.0::double / size END AS mass FROM shares)
SELECT barcode, gene_id, round(sum(mass), 6) AS unique_umi_count FROM masses WHERE mass > 0 GROUP BY 1, 2""")
def multigene_prop_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(multigene.placed_prop_unique(*placed_classes(spark, sf_dir)))


@query()
def multigene_em(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by expectation-maximisation; as many steps as a cell needs, so there is no SQL: tests hold it against a plain loop."""
    return rounded(multigene.expectation_maximised(gene_classes(spark, sf_dir)))


SNP_LINE = "CASE n_nationkey % 5 WHEN 0 THEN '#c' || chr(9) || '1' || chr(9) || 'a' || chr(9) || 'g' WHEN 1 THEN 'chr1' || chr(9) || 'Position' || chr(9) || 'Ref' || chr(9) || 'Var' WHEN 2 THEN 'chr2' || chr(9) || '7' ELSE 'chr' || n_regionkey || chr(9) || (n_nationkey * 10) || chr(9) || 't' || chr(9) || 'c' || chr(9) || 'more' END"


@query(f"SELECT DISTINCT f[1] AS chrom, try_cast(f[2] AS int) AS pos, upper(f[3]) AS ref, upper(f[4]) AS alt FROM (SELECT string_split({SNP_LINE}, chr(9)) AS f, {SNP_LINE} AS l FROM nation) WHERE l NOT LIKE '#%' AND len(f) >= 4 AND try_cast(f[2] AS int) IS NOT NULL")
def snp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, tab = F.col("n_nationkey") % 5, F.lit("\t")
    line = F.when(k == 0, F.lit("#c\t1\ta\tg")).when(k == 1, F.lit("chr1\tPosition\tRef\tVar")).when(k == 2, F.lit("chr2\t7"))
    line = line.otherwise(F.concat(F.lit("chr"), F.col("n_regionkey").cast("string"), tab, (F.col("n_nationkey") * 10).cast("string"), tab, F.lit("t\tc\tmore")))
    return tables.snps(fx.table(spark, sf_dir, "nation").select(line.alias("value")))


def nascent_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, snps = fx.labelled_reads(spark, sf_dir)
    return nascent.classified(records, snps)


@query(f"WITH {fx.BASES} SELECT qname, t_count::int AS t_count, tc_count::bigint AS tc_count FROM classes")
def nascent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nascent_classes(spark, sf_dir).select("qname", "t_count", "tc_count")


@query(f"WITH {fx.BASES} SELECT qname, flag FROM li WHERE qname IN (SELECT qname FROM classes WHERE read_class = 'nascent_reads_classified')")
def nascent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nascent.nascent_records(fx.labelled_reads(spark, sf_dir)[0], nascent_classes(spark, sf_dir)).select("qname", "flag")


@query(f"WITH {fx.BASES},\n{sql_summary(nascent.CLASSES, 'classes')}")
def nascent_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.class_summary(nascent_classes(spark, sf_dir), nascent.CLASSES)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples' count tables put together."""
    counts = fx.counts(spark, sf_dir)
    return matrix.merged([counts.where("gene_id < 'm'"), counts.where("gene_id >= 'm'")])


@query(f"WITH {fx.COUNTS} SELECT * FROM counts")
def merge_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)


@query(f"WITH {fx.COUNTS} SELECT dense_rank() OVER (ORDER BY feature)::bigint AS row, dense_rank() OVER (ORDER BY barcode)::bigint AS col, n AS value FROM counts")
def mtx_triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.coordinates(merged(spark, sf_dir))


@query(f"WITH {fx.COUNTS} SELECT barcode, count(*) FILTER (n > 0)::bigint AS genes_detected, sum(n)::bigint AS total_counts FROM counts GROUP BY 1")
def cell_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.cell_annotation(merged(spark, sf_dir))


@query(f"WITH {fx.COUNTS} SELECT feature, count(*) FILTER (n > 0)::bigint AS cells_expressed FROM counts GROUP BY 1")
def gene_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.feature_annotation(merged(spark, sf_dir))


CELLS = f"WITH {fx.COUNTS}, cells AS (SELECT barcode, sum(n)::bigint AS total_counts FROM counts GROUP BY 1)"


@query(f"{CELLS} SELECT row_number() OVER (ORDER BY total_counts DESC, barcode)::bigint - 1 AS rank, barcode, total_counts, total_counts > 1000 AS highlight FROM cells")
def rank_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.rank_curve(matrix.cell_annotation(merged(spark, sf_dir)))


@query(f"{CELLS} SELECT t::bigint AS threshold, (SELECT count(*) FROM cells WHERE total_counts > t)::bigint AS cells FROM (VALUES (10000), (5000), (1000), (100), (10)) v(t)")
def threshold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.threshold_counts(matrix.cell_annotation(merged(spark, sf_dir)), (*matrix.THRESHOLDS, 10))


@query(f"WITH {fx.COUNTS} SELECT feature, coalesce(sum(n) FILTER (barcode = 'u1'), 0)::bigint AS u1, coalesce(sum(n) FILTER (barcode = 'u2'), 0)::bigint AS u2, coalesce(sum(n) FILTER (barcode = 'u7'), 0)::bigint AS u7 FROM counts GROUP BY 1")
def pivot_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.pivoted(merged(spark, sf_dir), ["u1", "u2", "u7"])


#: A UMI's head is the first, by reads and then by name, of all UMIs from which a path of edges leads to it.
@query(f"""WITH RECURSIVE c AS (SELECT l_suppkey % 12 AS cell, l_partkey % 97 AS pos, substr({fx.sql_dna('l_orderkey % 500')}, 1, 4) AS umi, count(*)::bigint AS n FROM lineitem GROUP BY 1, 2, 3),
e AS (SELECT a.cell, a.pos, a.umi AS above, b.umi AS below FROM c a JOIN c b ON a.cell = b.cell AND a.pos = b.pos AND a.n >= 2 * b.n - 1 AND hamming(a.umi, b.umi) = 1),
r AS (SELECT cell, pos, umi, umi AS head FROM c UNION SELECT r.cell, r.pos, r.umi, e.above FROM r JOIN e ON e.cell = r.cell AND e.pos = r.pos AND e.below = r.head)
SELECT cell, pos, umi, c.n, r.head AS umi_group FROM c JOIN r USING (cell, pos, umi) JOIN c h ON h.cell = r.cell AND h.pos = r.pos AND h.umi = r.head
QUALIFY row_number() OVER (PARTITION BY cell, pos, umi ORDER BY h.n DESC, r.head) = 1""")
def umi_directional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heads of the UMIs' directional clusters."""
    li = fx.table(spark, sf_dir, "lineitem")
    rows = li.select((F.col("l_suppkey") % 12).alias("cell"), (F.col("l_partkey") % 97).alias("pos"), F.substring(fx.dna(F.col("l_orderkey") % 500), 1, 4).alias("umi"))
    return umi.directional_clusters(rows, ["cell", "pos"])


@query(f"WITH {fx.BASES} SELECT qname, (o - 1)::int AS query_pos, (bases.pos + o - 1)::int AS ref_pos, ref AS ref_base FROM bases JOIN li USING (qname) WHERE li.l_partkey % 17 <> 0")
def aligned_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of records of every flag that have MD."""
    rows = fx.labelled_reads(spark, sf_dir)[0]
    columns = nascent.aligned_pairs(F.col("pos"), F.col("cigar"), F.col("tags")["MD"], F.col("seq"))
    return rows.select("qname", F.explode(columns).alias("c")).select("qname", "c.*")
