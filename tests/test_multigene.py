"""Policies for reads of several genes, against plain loops and values worked out by hand."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellstrand.operators import genomics, multigene
from cellstrand.plans import commands, queries
from tests.test_commands import CELL, HEAD, annotated, counted, sam_line  # noqa: F401


def plain_em(classes, steps=20_000):
    """{gene: count} of one cell's [(genes, n)], without arrays."""
    theta = defaultdict(float)
    for genes, n in classes:
        for g in genes:
            theta[g] += n / len(genes)
    for _ in range(steps):
        new = defaultdict(float)
        for genes, n in classes:
            total = sum(theta[g] for g in genes)
            for g in genes:
                new[g] += n * theta[g] / total
        done = max(abs(new[g] - theta[g]) for g in new) < 1e-13
        theta = new
        if done:
            break
    return theta


def molecules(seed, cells=6, genes=7, rows=300):
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        size = rng.choice([1, 1, 2, 2, 3])
        out.append((f"c{rng.randrange(cells)}", f"u{rng.randrange(25)}", rng.sample([f"g{k}" for k in range(genes)], size)))
    return out


def classes_of(rows):
    distinct = {(c, u, tuple(sorted(set(g)))) for c, u, g in rows if c and u and g}
    out = defaultdict(lambda: defaultdict(int))
    for c, _, g in distinct:
        out[c][g] += 1
    return {c: sorted(x.items()) for c, x in out.items()}


@pytest.fixture(scope="module")
def reads(spark):
    rows = molecules(1) + molecules(1)[:100] + [(None, "u", ["g1"]), ("c1", None, ["g1"]), ("c1", "u", []), ("c9", "u", ["_ambiguous"]), ("c9", "u", ["g1", "g0"]), ("c9", "v", ["g1", "g0"])]
    return rows, spark.createDataFrame([(c, u, g, 1) for c, u, g in rows], "barcode string, umi string, genes array<string>, n int").repartition(3)


def test_classes(reads):
    got = defaultdict(list)
    for r in multigene.classes(reads[1]).collect():
        got[r.barcode].append((tuple(r.genes), r.n))
    assert {c: sorted(x) for c, x in got.items()} == classes_of(reads[0])


def test_em_against_a_plain_loop(reads):
    got = {(r.barcode, r.gene_id): r.unique_umi_count for r in multigene.expectation_maximised(multigene.classes(reads[1])).collect()}
    wanted = {(c, g): n for c, own in classes_of(reads[0]).items() for g, n in plain_em(own).items() if n >= 1e-9}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)
    assert got["c9", "g0"] == got["c9", "g1"] == 1.0 and got["c9", "_ambiguous"] == 1.0


@pytest.mark.parametrize("policy", sorted(multigene.RESOLVED))
def test_masses_add_up_to_the_molecules(reads, policy):
    got = defaultdict(float)
    for r in multigene.RESOLVED[policy](multigene.classes(reads[1])).collect():
        got[r.barcode] += r.unique_umi_count
    assert {c: round(x, 9) for c, x in got.items()} == {c: sum(n for _, n in own) for c, own in classes_of(reads[0]).items()}


def test_uniform_and_prop_unique_against_plain_loops(reads):
    for policy in ("uniform", "prop_unique"):
        wanted = defaultdict(float)
        for c, own in classes_of(reads[0]).items():
            alone = {g[0]: n for g, n in own if len(g) == 1}
            for genes, n in own:
                total = sum(alone.get(g, 0) for g in genes)
                for g in genes:
                    wanted[c, g] += n * (alone.get(g, 0) / total if policy == "prop_unique" and total and len(genes) > 1 else 1 / len(genes))
        got = {(r.barcode, r.gene_id): r.unique_umi_count for r in multigene.RESOLVED[policy](multigene.classes(reads[1])).collect()}
        assert got == pytest.approx({k: n for k, n in wanted.items() if n > 0})


def test_placed_classes_are_the_classes_of_lists(spark):
    """Pairs near each other, of two windows and far apart; lists do not leave their windows, and give what arrays give."""
    genes = [(f"G{k}", 16_300 + 20 * k) for k in range(12)] + [("G90", 90_000), ("G91", 90_010)]
    features = spark.createDataFrame([("exon", "c", s, s + 150, "+", g) for g, s in genes], "feature_type string, chrom string, start int, end int, strand string, gene_id string")
    block, rng, rows = "struct<rname:string,pos:int,aend:int,reverse:boolean,blocks:array<struct<start:int,end:int>>>", random.Random(3), []
    for k in range(400):
        low = rng.randrange(16_200, 16_800)
        low, high = (low, low + rng.randrange(0, 60)) if k % 8 else (16_320, 90_020 if k % 16 else 16_320)
        first, second = (("c", x, x + 40, False, [(x, x + 40)]) for x in (low, high))
        rows.append((f"c{k % 5},u{k % 9},{k}", "+", first, second))
    # both mates of a read over a gap of 60,000 meet two genes
    gap = ("c", 16_320, 90_060, False, [(16_320, 16_330), (90_020, 90_060)])
    rows += [("c1,u1,far", "+", gap, gap), ("c2,u3,near", "+", *[("c", 90_020, 90_060, False, [(90_020, 90_060)])] * 2)]
    pairs = spark.createDataFrame(rows, f"qname string, strand string, m1 {block}, m2 {block}")
    names = F.split("qname", ",")
    placed = multigene.placed(genomics.called(pairs, features, digests=True), names[0], names[1]).localCheckpoint()
    assert placed.where("shape is not null").count() and placed.where("genes is not null and shape is null").count()
    found = genomics.called(pairs, features, lists=True)
    lists = F.when(genomics.call_of("exon").isNotNull(), F.array(genomics.call_of("exon"))).otherwise(F.col("genes_exon"))
    classes = multigene.classes(found.select(names[0].alias("barcode"), names[1].alias("umi"), lists.alias("genes"))).localCheckpoint()
    assert classes.where("size(genes) > 3").count()
    own = sorted(map(tuple, multigene.placed_lists(placed, features).collect()))
    assert own == sorted((r.barcode, ",".join(r.genes), r.n) for r in classes.collect())
    for whole, of in ((multigene.placed_uniform, multigene.uniform), (multigene.placed_prop_unique, multigene.prop_unique)):
        got, wanted = ({(r.barcode, r.gene_id): r.unique_umi_count for r in x.collect()} for x in (whole(placed, features), of(classes)))
        assert got == pytest.approx(wanted)


def test_unique_evidence_draws_shared_molecules():
    genes, mass = multigene.maximised([["a", "b"], ["a"]], [10, 1])
    assert genes == ["a", "b"] and mass[0] == pytest.approx(11) and mass[1] < 1e-9
    genes, mass = multigene.maximised([["a", "b"], ["a"], ["b"]], [12, 3, 1])
    assert mass.tolist() == pytest.approx([12, 4])


def test_an_unsettled_cell_is_an_error():
    with pytest.raises(RuntimeError, match="not settled after 3 steps"):
        multigene.maximised([["a", "b"], ["a"]], [10, 1], most_steps=3)


def test_policies_of_nothing(spark):
    none = multigene.classes(spark.createDataFrame([], "barcode string, umi string, genes array<string>"))
    assert all(f(none).count() == 0 for f in multigene.RESOLVED.values())


def test_count_command(spark, tmp_path, annotated):  # noqa: F811
    """Pairs 1 and 5 fit G1 and G2; UMI1 of the cell has one molecule of the list and one of G1 alone, UMI0 one of each name."""
    pairs = [(1010, 1040, True), (1110, 1150, True), (6000, 6100, True), (1850, 1850, True), (1010, 40, False), (1110, 1150, True)]
    calls, counts = counted(spark, tmp_path, annotated, pairs, multigene_reads="uniform")
    assert calls[1] == calls[5] == ("G1,G2", "exon") and calls[2] == ("_no_feature_overlap", "none")
    assert counts == {("G1", 2.5), ("G2", 0.5), ("G3", 1.0), ("_no_feature_overlap", 1.0)}
    _, counts = counted(spark, tmp_path, annotated, pairs, multigene_reads="prop_unique")
    assert counts == {("G1", 3.0), ("G3", 1.0), ("_no_feature_overlap", 1.0)}
    _, counts = counted(spark, tmp_path, annotated, pairs, multigene_reads="EM", drop_unassigned=True)
    assert {(g, round(n, 6)) for g, n in counts} == {("G1", 3.0), ("G3", 1.0)}
    # the names of G1 and G3 are one
    _, counts = counted(spark, tmp_path, annotated, pairs, multigene_reads="uniform", collapse_by_gene_name=True)
    assert counts == {("A", 2.5), ("G2", 0.5)}


def test_em_query_against_a_plain_loop(spark, sf_dir):
    own = defaultdict(list)
    for r in queries.gene_classes(spark, sf_dir).collect():
        own[r.barcode].append((tuple(r.genes), r.n))
    assert any(len(g) > 1 for x in own.values() for g, _ in x)
    wanted = {(c, g): n for c, x in own.items() for g, n in plain_em(sorted(x)).items() if n >= 1e-9}
    got = {(r.barcode, r.gene_id): r.unique_umi_count for r in queries.queries()["multigene_em"](spark, sf_dir).collect()}
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-6 for k in got)


def laid_out(monkeypatch):
    """Numbers of genes in lists of several, of each layout that steps are taken on."""
    sizes, init = [], multigene._Lists.__init__

    def counted_init(self, *given):
        init(self, *given)
        sizes.append(len(self.owner))

    monkeypatch.setattr(multigene._Lists, "__init__", counted_init)
    return sizes


def test_genes_without_a_visible_count_leave_the_steps(monkeypatch):
    """Half of the genes die, and lists that differed in them alone are one."""
    sizes = laid_out(monkeypatch)
    own = [(["a", "b"], 5), (["a"], 3), (["b"], 1)] + [(["a", "b", f"d{k}"], 1) for k in range(20)]
    genes, mass = multigene.maximised(*zip(*own, strict=True))
    wanted = plain_em(own)
    assert sizes[0] == 62 and sizes[-1] == 2
    assert all(abs(m - wanted[g]) < 1e-9 for g, m in zip(genes, mass, strict=True))


def test_a_gene_left_out_that_would_grow_stays_in(monkeypatch):
    own = [(["b", "c"], 1), (["a", "b"], 2), (["d"], 1), (["a", "c", "d"], 1), (["a", "c"], 2)]
    monkeypatch.setattr(multigene, "LOST", 0.25)
    monkeypatch.setattr(multigene, "CUT_AFTER", 2)
    sizes = laid_out(monkeypatch)
    genes, mass = multigene.maximised(*zip(*own, strict=True))
    wanted = plain_em(own)
    # b was left out once
    assert len(sizes) > 1 and 0 < wanted["b"] < 0.25
    assert all(abs(m - wanted[g]) < 1e-8 for g, m in zip(genes, mass, strict=True))


def test_em_makes_lists_of_classes_and_not_of_pairs(spark, sf_dir, monkeypatch):
    asked, real = [], genomics.called

    def called(*given, **options):
        asked.append(options.get("lists", len(given) > 5 and given[5]))
        return real(*given, **options)

    monkeypatch.setattr(genomics, "called", called)
    own = queries.gene_classes(spark, sf_dir)
    assert asked == [False]
    assert own.groupBy("barcode", "genes").count().where("count > 1").isEmpty()
