"""Gene calls by shapes and windows against all pairs of reads and features."""

import random

from cellstrand.operators import genomics, places

MATE = "struct<rname:string,pos:int,aend:int,reverse:boolean,blocks:array<struct<start:int,end:int>>>"


def made(rng):
    """Genes of several exons, some stacked and some long, and pairs: spliced, near borders of windows, far apart, on two chromosomes."""
    w = places.WINDOW
    genes = [(f"G{k}", rng.choice("ab"), rng.choice("+-"), rng.choice([rng.randrange(3 * w), w - 300, 2 * w - 50, 100])) for k in range(120)]
    features, tes = [], []
    for g, c, strand, at in genes:
        size = rng.choice([400, 900, 40_000])
        features += [("transcript", c, at, at + size, strand, g), ("exon", c, at, at + 150, strand, g), ("exon", c, at + size - 200, at + size, strand, g), ("exon", c, at + 5, at + 5, strand, g)]
        tes += [(g, g + "t", c, t, strand) for t in {at + size, at + size - rng.choice([0, 30])} | ({at} if strand == "-" else set())]
    pairs = []
    for k in range(400):
        mates = []
        c, at = rng.choice("ab"), rng.choice([rng.randrange(3 * w), w - 40, 2 * w - 100, 120, rng.choice(genes)[3]])
        for _ in range(2):
            start = at + rng.choice([0, 30, 250, 700, *[3 * w] * (k % 9 == 0)])
            cut = rng.choice([0, 0, 50, 400])
            blocks = [(start, start + 30), (start + 30 + cut, start + 60 + cut)] if cut else [(start, start + 60)] * (k % 31 != 0)
            mates.append((c if k % 13 else rng.choice("ab"), start, start + 60 + cut, False, blocks))
        pairs.append((f"q{k}", rng.choice("+-."), *mates))
    return features, tes, pairs * 1 + [(f"copy{x[0]}", *x[1:]) for x in pairs[:50]]


def met(pair, features, space, stranded):
    out = []
    for m in pair[2:4]:
        out.append({g for f, c, s, e, strand, g in features if f == space and c == m[0] and s < e and (not stranded or strand == pair[1]) and any(a < e and s < b for a, b in m[4])})
    return out


def test_calls_counts_lists_and_ends_against_all_pairs(spark):
    features, tes, pairs = made(random.Random(5))
    f = spark.createDataFrame(features, "feature_type string, chrom string, start int, end int, strand string, gene_id string")
    t = spark.createDataFrame(tes, "gene_id string, transcript_id string, chrom string, tes int, strand string")
    p = spark.createDataFrame(pairs, f"qname string, strand string, m1 {MATE}, m2 {MATE}")
    several = 0
    for stranded in (True, False):
        got = {r.qname: r for r in genomics.called(p, f, stranded, ("exon", "transcript"), t, True).collect()}
        assert len(got) == len(pairs)
        for pair in pairs:
            r = got[pair[0]]
            for space in ("exon", "transcript"):
                one, two = met(pair, features, space, stranded)
                some, both = one | two, one & two
                assert ((r[f"any_{space}"] or 0), (r[f"both_{space}"] or 0)) == (len(some), len(both))
                single = some if len(some) == 1 else both
                assert r[f"one_{space}"] == (min(single) if len(single) == 1 else None)
                if len(some) > 1 and len(both) > 1:
                    several += 1
                    assert list(r[f"genes_{space}"]) == sorted(both)
                    low, high = min(m[1] for m in pair[2:4]), max(m[2] for m in pair[2:4])
                    far = [(x - high if strand == "+" else low - x, g) for g, _, _, x, strand in tes if g in both]
                    assert r[f"nearest_{space}"] == min((x for x in far if x[0] > genomics.END_CUTOFF), default=(0, None))[1]
    assert several > 50
    wanted = {}
    for pair in pairs:
        for k, genes in enumerate(met(pair, features, "exon", True), 1):
            for g in genes:
                wanted[g, k] = wanted.get((g, k), 0) + 1
    counts = genomics.pairs_by_gene(p, f.where("feature_type = 'exon'")).collect()
    assert {(r.gene_id, r.mate): r.pairs for r in counts} == wanted


def test_alike_pairs_on_stacked_genes_make_no_row_for_each_pair_and_gene(spark):
    mate = "named_struct('rname', 'a', 'pos', 100, 'aend', 160, 'reverse', false, 'blocks', array(named_struct('start', 100, 'end', 160)))"
    p = spark.range(40_000).selectExpr("cast(id as string) AS qname", "'+' AS strand", f"{mate} AS m1", f"{mate} AS m2")
    f = spark.range(20_000).selectExpr("'exon' AS feature_type", "'a' AS chrom", "50 AS start", "150 AS end", "'+' AS strand", "concat('G', id) AS gene_id")
    # 1.6 thousand million rows if each mate met each gene
    assert genomics.called(p, f).where("both_exon = 20000 and one_exon is null").count() == 40_000
    assert genomics.pairs_by_gene(p, f).where("pairs = 40000").count() == 40_000
