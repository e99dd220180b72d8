"""Annotation tables, read pairs, interval overlap and gene calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.functions import alignment as aln
from cellstrand.operators import places
from cellstrand.operators.whitelist import BROADCAST_BYTES

#: Widths of the bins that turn an overlap into an equi-join; a feature lies in at most two bins of the first that is not narrower than it.
BINS = (1 << 14, 1 << 18, 1 << 22, 1 << 30)
#: Bytes of a feature in a broadcast table.
FEATURE_BYTES = 256
#: A transcript end counts if the fragment reaches at most this far beyond it.
END_CUTOFF = -50
NO_OVERLAP, AMBIGUOUS, MULTIPLE = "_no_feature_overlap", "_ambiguous", "_multiple"
POLICIES = ("discard", "closest_TES", "uniform", "prop_unique", "EM")
#: Policies that keep the list of genes, to be resolved when the cell's counts are known.
LISTED = POLICIES[2:]


def annotation(gtf: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """features, tes and gene_names from GTF rows (feature, chrom, start, end, strand, gene_id, transcript_id, gene_name, line); starts from 0."""
    stranded = gtf.where(F.col("strand").isin("+", "-") & F.col("gene_id").isNotNull())
    features = stranded.where(F.col("feature").isin("exon", "transcript")).select(F.col("feature").alias("feature_type"), "chrom", "start", "end", "strand", "gene_id")
    tes = stranded.where(F.col("feature") == "transcript").select("gene_id", "transcript_id", "chrom", aln.end_site(F.col("strand"), F.col("start"), F.col("end")).alias("tes"), "strand")
    names = gtf.where((F.col("feature") == "gene") & F.col("gene_id").isNotNull())
    name = F.coalesce(F.nullif(F.col("gene_name"), F.lit("")), F.col("gene_id"))
    names = names.groupBy("gene_id").agg(F.max_by(name, "line").alias("gene_name"))
    return features, tes, names


def read_pairs(alignments: DataFrame) -> DataFrame:
    """One row for each name that has exactly one first and one second mate; one shuffle, no self-join."""
    first, second = aln.has_bits(F.col("flag"), aln.FIRST), aln.has_bits(F.col("flag"), aln.SECOND)
    pos, cigar = F.col("pos"), F.col("cigar")
    # blocks are shuffled only where they do not follow from start and end
    several = F.when(aln.one_block(cigar).isNull(), aln.blocks(pos, cigar))
    mate = F.struct("rname", "pos", aln.reference_end(pos, cigar).alias("aend"), aln.has_bits(F.col("flag"), aln.REVERSE).alias("reverse"), several.alias("several"))
    sided = alignments.select("qname", first.alias("f"), second.alias("s"), mate.alias("mate"))
    pairs = sided.groupBy("qname").agg(
        F.count_if("f").alias("nf"), F.count_if("s").alias("ns"), F.count(F.lit(1)).alias("n"), F.any_value(F.when(F.col("f"), F.col("mate")), ignoreNulls=True).alias("m1"), F.any_value(F.when(F.col("s"), F.col("mate")), ignoreNulls=True).alias("m2")
    )

    def placed(m: str) -> Column:
        single = F.array(F.struct(F.col(f"{m}.pos").cast("int").alias("start"), F.col(f"{m}.aend").alias("end")))
        return F.struct(f"{m}.rname", f"{m}.pos", f"{m}.aend", f"{m}.reverse", F.coalesce(f"{m}.several", single).alias("blocks")).alias(m)

    return pairs.where("nf = 1 and ns = 1 and n = 2").select("qname", placed("m1"), placed("m2"))


def bins(start: Column, end: Column, width: Column | int) -> Column:
    return F.sequence(F.floor(start / width), F.floor((end - 1) / width))


def level_of(start: Column, end: Column, widths: tuple[int, ...]) -> Column:
    """The first of the widths, as a number, that is not narrower than [start, end)."""
    level = F.lit(len(widths) - 1)
    for k in reversed(range(len(widths) - 1)):
        level = F.when(end - start <= widths[k], k).otherwise(level)
    return level


def overlaps(blocks: DataFrame, features: DataFrame, stranded: bool = True, widths: tuple[int, ...] = BINS, broadcast: bool | None = None) -> DataFrame:
    """blocks with the feature_type and gene_id of every feature that they overlap by a base; a pair of both may come more than once.

    blocks and features: chrom, start, end, strand; features also feature_type. The join is an equi-join on
    chromosome, strand, level and bin with the overlap as residual. A feature has the level of its length
    and so two rows at most, however long it is; a block is laid on the bins of every level that some feature
    has. Features are counted, as the optimizer takes those of a well compressed file for few: they are
    broadcast within BROADCAST_BYTES, otherwise both sides are dealt by the keys.
    """
    known = features.where("end > start").select(F.col("chrom").alias("f_chrom"), F.col("strand").alias("f_strand"), F.col("start").alias("f_start"), F.col("end").alias("f_end"), "feature_type", "gene_id")
    known = known.withColumn("f_level", level_of(F.col("f_start"), F.col("f_end"), widths))
    # as many rows as there are levels, at most
    counts = known.groupBy("f_level").count().collect()
    levels = sorted(r.f_level for r in counts)
    if broadcast is None:
        broadcast = sum(r["count"] for r in counts) * FEATURE_BYTES <= BROADCAST_BYTES
    width = F.element_at(F.array(*map(F.lit, widths)), F.col("f_level") + 1)
    known = known.withColumn("f_bin", F.explode(bins(F.col("f_start"), F.col("f_end"), width)))

    def laid_on(k: int) -> Column:
        return F.transform(bins(F.col("start"), F.col("end"), widths[k]), lambda b: F.struct(F.lit(k).alias("level"), b.alias("bin")))

    laid = [laid_on(k) for k in levels]
    on = blocks.where("end > start").withColumn("at", F.explode(F.concat(*laid) if laid else F.array().cast("array<struct<level:int,bin:bigint>>")))
    on = on.withColumns({"level": F.col("at.level"), "bin": F.col("at.bin")}).drop("at")
    meets = (F.col("chrom") == F.col("f_chrom")) & (F.col("level") == F.col("f_level")) & (F.col("bin") == F.col("f_bin")) & (F.col("start") < F.col("f_end")) & (F.col("f_start") < F.col("end"))
    if stranded:
        meets = meets & (F.col("strand") == F.col("f_strand"))
    return on.join(known.hint("broadcast" if broadcast else "merge"), meets).drop("level", "bin", "f_chrom", "f_strand", "f_start", "f_end", "f_level", "f_bin")


def genes_of_mates(pairs: DataFrame, features: DataFrame, stranded: bool = True, spaces: tuple[str, ...] = ("exon",)) -> DataFrame:
    """qname and, for each search space, genes1_<space> and genes2_<space>, of the pairs (qname, strand, m1, m2) with any overlap.

    All spaces are searched in one join and gathered in one aggregation.
    """
    sides = F.explode(F.array(*[F.struct(F.lit(k).alias("mate"), F.col(f"m{k}.rname").alias("chrom"), F.col(f"m{k}.blocks").alias("blocks")) for k in (1, 2)]))
    mates = pairs.select("qname", "strand", sides.alias("side")).select("qname", "strand", "side.mate", "side.chrom", F.explode("side.blocks").alias("block"))
    hits = overlaps(mates.select("qname", "strand", "mate", "chrom", "block.start", "block.end"), features.where(F.col("feature_type").isin(*spaces)), stranded)
    gathered = [F.array_sort(F.collect_set(F.when((F.col("mate") == k) & (F.col("feature_type") == s), F.col("gene_id")))).alias(f"genes{k}_{s}") for s in spaces for k in (1, 2)]
    return hits.groupBy("qname").agg(*gathered)


def gene_call(genes1: Column, genes2: Column) -> tuple[Column, Column]:
    """The call of a pair's two gene sets (sorted), null where several genes are left; and those genes."""
    union, both = F.array_union(genes1, genes2), F.array_intersect(genes1, genes2)
    call = F.when(F.size(union) == 0, NO_OVERLAP).when(F.size(union) == 1, F.get(union, F.lit(0))).when(F.size(both) == 1, F.get(both, F.lit(0))).when(F.size(both) == 0, AMBIGUOUS)
    return call, both


def _both_local(pairs: DataFrame) -> tuple[DataFrame, Column]:
    """pairs with the columns of their shape, and whether the shape is local: mates of one chromosome that lie near each other."""
    shaped = pairs.withColumns({
        "chrom": F.col("m1.rname"), "low": F.least("m1.pos", "m2.pos").cast("int"), "high": F.greatest("m1.aend", "m2.aend").cast("int"),
        "blocks1": F.col("m1.blocks").cast(places.BLOCKS), "blocks2": F.col("m2.blocks").cast(places.BLOCKS),
    })
    near = F.coalesce(F.col("m1.rname") == F.col("m2.rname"), F.lit(False)) & F.col("m1.blocks").isNotNull() & F.col("m2.blocks").isNotNull()
    return shaped, near & places.is_local(F.col("low"), F.col("high"))


def called(pairs: DataFrame, features: DataFrame, stranded: bool = True, spaces: tuple[str, ...] = ("exon",), tes: DataFrame | None = None, lists: bool = False, digests: bool = False) -> DataFrame:
    """pairs (qname, strand, m1, m2) with, for each space, any_, both_, one_ and, if asked for, nearest_, genes_ and digest1_, digest2_, as places.outcomes has them.

    With `digests` there are also columns `shape`, null where mates lie far apart, and genes_ of those alone.
    Local pairs get what their shape has; pairs whose mates lie far apart are joined with their features.
    """
    shaped, near = _both_local(pairs if stranded else pairs.withColumn("strand", F.lit(".")))
    sites = None
    if tes is not None:
        sites = tes.where(F.col("tes").isNotNull() & F.col("strand").isin("+", "-")).groupBy("gene_id").agg(F.collect_set(F.struct(F.col("tes").cast("int").alias("tes"), "strand")).alias("sites"))
    local = shaped.where(near)
    of = local.where(F.col("strand").isin("+", "-")) if stranded else local
    found = places.outcomes(of.select(places.SHAPE), features, spaces, stranded, sites, END_CUTOFF, lists, digests)
    # a number first, by which rows are sorted faster; all columns decide
    keyed, own = (x.withColumn("h", F.xxhash64(*places.SHAPE)) for x in (local, found))
    local = keyed.join(own, ["h", *places.SHAPE], "left")
    more = [f"{name}_{s}" for s in spaces for name in ("any", "both", "one", *["nearest"] * (tes is not None), *["genes"] * (lists or digests), *["digest1", "digest2"] * digests)]
    if digests:
        more.append("shape")
        local = local.withColumn("shape", F.struct(*places.SHAPE))
        if not lists:
            local = local.withColumns({f"genes_{s}": F.lit(None).cast("array<string>") for s in spaces})
    local = local.select("qname", "strand", "m1", "m2", *more)

    far = shaped.where(~near).select("qname", "strand", "m1", "m2")
    genes = genes_of_mates(far, features, stranded, spaces)
    none = F.array().cast("array<string>")
    far = far.join(genes, "qname", "left")
    for s in spaces:
        one, two = (F.coalesce(f"genes{k}_{s}", none) for k in (1, 2))
        some, both = F.array_union(one, two), F.array_intersect(one, two)
        single = F.when(F.size(some) == 1, F.get(some, F.lit(0))).when(F.size(both) == 1, F.get(both, F.lit(0)))
        far = far.withColumns({f"any_{s}": F.size(some), f"both_{s}": F.size(both), f"one_{s}": single, f"genes_{s}": F.when(F.size(both) > 1, F.array_sort(both))})
        if tes is not None:
            ends = nearest_ends(far.where(F.col(f"both_{s}") > 1).select("qname", "m1", "m2", F.col(f"genes_{s}").alias("genes")), tes)
            far = far.join(ends.withColumnRenamed("nearest", f"nearest_{s}"), "qname", "left")
        if digests:
            far = far.withColumns({f"digest{k}_{s}": x for k, x in enumerate(places.digest(F.col(f"genes_{s}")), 1)})
    if digests:
        far = far.withColumn("shape", F.lit(None).cast(local.schema["shape"].dataType))
    return local.unionByName(far.select("qname", "strand", "m1", "m2", *more))


def call_of(space: str) -> Column:
    """A pair's call from `called`, null where several genes are left."""
    some = F.coalesce(f"any_{space}", F.lit(0))
    return F.when(some == 0, NO_OVERLAP).when(F.col(f"one_{space}").isNotNull(), F.col(f"one_{space}")).when(F.col(f"both_{space}") == 0, AMBIGUOUS)


def pairs_by_gene(pairs: DataFrame, features: DataFrame, stranded: bool = True) -> DataFrame:
    """(gene_id, mate, pairs): how many pairs (qname, strand, m1, m2) have the mate on the gene; mates that lie alike are counted before."""
    sides = F.explode(F.array(*[F.struct(F.lit(k).alias("mate"), F.col(f"m{k}.rname").alias("chrom"), F.col(f"m{k}.pos").cast("int").alias("low"), F.col(f"m{k}.aend").cast("int").alias("high"), F.col(f"m{k}.blocks").cast(places.BLOCKS).alias("blocks")) for k in (1, 2)]))
    strand = F.col("strand") if stranded else F.lit(".")
    mates = pairs.select(strand.alias("strand"), sides.alias("s")).select("strand", "s.*").where("chrom is not null and blocks is not null")
    mates = mates.groupBy("mate", "chrom", "strand", "low", "high", "blocks").agg(F.count(F.lit(1)).alias("n"))
    near = places.is_local(F.col("low"), F.col("high"))
    far = mates.where(~near).withColumn("block", F.explode("blocks")).select("mate", "chrom", "strand", "low", "high", "blocks", "n", "block.start", "block.end")
    met = overlaps(far, features, stranded).select("mate", "chrom", "strand", "low", "high", "blocks", "n", "gene_id").distinct()
    found = places.reads_by_gene(mates.where(near), features, stranded).unionByName(met.select("gene_id", "mate", "n"))
    return found.groupBy("gene_id", "mate").agg(F.sum("n").alias("pairs"))


def nearest_ends(candidates: DataFrame, tes: DataFrame, cutoff: int = END_CUTOFF) -> DataFrame:
    """(qname, gene_id) of the candidate gene whose transcript end has the least signed distance above the cutoff.

    candidates: qname, m1, m2, genes. Ties go to the lesser gene_id; pairs without any such end are missing.
    """
    each = candidates.select("qname", F.col("m1.pos").alias("s1"), F.col("m1.aend").alias("e1"), F.col("m2.pos").alias("s2"), F.col("m2.aend").alias("e2"), F.explode("genes").alias("gene_id"))
    at = each.join(tes.select("gene_id", "tes", "strand").hint("merge"), "gene_id")
    far = aln.end_distance(F.col("strand"), F.col("tes"), F.col("s1"), F.col("e1"), F.col("s2"), F.col("e2"))
    return at.withColumn("d", far).where(F.col("d") > cutoff).groupBy("qname").agg(F.min(F.struct("d", "gene_id"))["gene_id"].alias("nearest"))


def check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"unknown multi-gene policy {policy!r}; use one of {POLICIES}")


def mapping() -> Column:
    """Where the mates of a pair (qname, m1, m2) lie; no gene is needed for it."""
    return aln.mapping_text(F.col("qname"), F.col("m1.rname"), F.col("m1.pos"), F.col("m1.aend"), F.col("m2.rname"), F.col("m2.pos"), F.col("m2.aend"))


def assigned(alignments: DataFrame, features: DataFrame, tes: DataFrame, library: str = "reverse", policy: str = "discard", introns: bool = False, paired: bool = False) -> DataFrame:
    """qname, gene_id, mapped_feature and mapping of every complete pair of alignments, which are pairs (qname, m1, m2) already if `paired`.

    Exons come first; with `introns`, pairs without any exon are called by whole transcripts. Under a policy of LISTED, gene_id
    has the genes that are left in order, joined by commas, and a column `genes` has them as an array.
    """
    check_policy(policy)
    pairs = alignments if paired else read_pairs(alignments)
    pairs = pairs.select("qname", aln.fragment_strand(F.col("m1.reverse"), F.col("m2.reverse"), library).alias("strand"), "m1", "m2")
    spaces = ("exon", "transcript") if introns else ("exon",)
    found = called(pairs, features, library != "none", spaces, tes if policy == "closest_TES" else None, policy in LISTED)
    last = (call_of("exon") == NO_OVERLAP) if introns else F.lit(False)

    def chosen(of: Callable[[str], Column]) -> Column:
        return F.when(last, of(spaces[-1])).otherwise(of("exon")) if introns else of("exon")

    out = found.withColumns({"mapped_feature": F.when(last, "transcript").otherwise("exon"), "call": chosen(call_of)})
    if policy == "closest_TES":
        out = out.withColumn("gene_id", F.coalesce("call", chosen(lambda s: F.col(f"nearest_{s}")), F.lit(AMBIGUOUS)))
    elif policy in LISTED:
        listed = F.when(F.col("call").isNotNull(), F.array("call")).otherwise(chosen(lambda s: F.col(f"genes_{s}")))
        out = out.withColumn("genes", listed).withColumn("gene_id", F.array_join("genes", ","))
    else:
        out = out.withColumn("gene_id", F.coalesce("call", F.lit(MULTIPLE)))
    feature = F.when(F.col("gene_id") == NO_OVERLAP, "none").otherwise(F.col("mapped_feature"))
    return out.select("qname", "gene_id", feature.alias("mapped_feature"), mapping().alias("mapping"), *["genes"] * (policy in LISTED))
