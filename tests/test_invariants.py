"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellstrand.operators import genomics, matrix, nascent, reads, summary, umi, whitelist

quiet = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LIG, RT, RANDOM = "AACCGGTTAA", "CATGCATGCA", "GGATCCGGAT"
bases = st.text("ACGTN", min_size=0, max_size=40)


def codes(spark, *of):
    return whitelist.correction_dictionary(spark.createDataFrame([(c,) for c in of], "s string"), "s")


@quiet
@given(st.lists(st.tuples(st.sampled_from([LIG, "N" + LIG[1:], "A" * 10, ""]), st.sampled_from([RT, RANDOM, "T" * 10]), st.sampled_from(["", "TTTTTTT"]), bases, bases), min_size=1, max_size=25))
def test_demultiplexing(spark, rows):
    def read(s):
        return ("r", "r", s, "".join(chr(40 + k % 40) for k in range(len(s))))

    kind = "struct<id:string,desc:string,seq:string,qual:string>"
    triplets = spark.createDataFrame([(k, read(lig), read("ACGTACGT" + rt + t + a), read(b)) for k, (lig, rt, t, a, b) in enumerate(rows)], f"idx long, lig {kind}, umi {kind}, bio {kind}")
    out = reads.demultiplexed(triplets, codes(spark, LIG), codes(spark, RT, RANDOM), spark.createDataFrame([(RANDOM,)], "sequence string"))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.read_class == "passed_all_filters":
            assert len(r.r1.seq) == len(r.r1.qual) > 20 and len(r.r2.seq) == len(r.r2.qual) > 20
            assert r.r1.name.startswith(LIG + r.rt + ",ACGTACGT,")
    told = {r.read_class: r["count"] for r in summary.class_summary(out, reads.RNA_CLASSES).collect()}
    assert sum(told[c] for c in reads.RNA_CLASSES) == told[summary.TOTAL] == len(rows)


@quiet
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.sampled_from(["AA", "AC", "CC"])), min_size=1, max_size=40), st.integers(1, 5))
def test_counts(spark, rows, parts):
    table = spark.createDataFrame(rows, "barcode string, gene_id string, umi string")
    counts = umi.umi_counts(table)
    got = {(r.barcode, r.gene_id): r.unique_umi_count for r in counts.collect()}
    assert got == {(b, g): len({u for x, y, u in rows if (x, y) == (b, g)}) for b, g, _ in rows}
    assert got == {(r.barcode, r.gene_id): r.unique_umi_count for r in umi.umi_counts(table.repartition(parts)).collect()}
    merged = matrix.merged([counts])
    cells, features, triplets = matrix.cell_annotation(merged), matrix.feature_annotation(merged), matrix.coordinates(merged)
    assert cells.agg(F.sum("total_counts")).first()[0] == sum(got.values())
    assert cells.agg(F.sum("genes_detected")).first()[0] == features.agg(F.sum("cells_expressed")).first()[0] == triplets.count() == len(got)


@quiet
@given(st.lists(st.sampled_from("ABCD"), max_size=3, unique=True), st.lists(st.sampled_from("ABCD"), max_size=3, unique=True))
def test_gene_calls_do_not_depend_on_the_mates_order(spark, one, two):
    table = spark.createDataFrame([(sorted(one), sorted(two))], "a array<string>, b array<string>")
    first, second = (genomics.gene_call(F.col(x), F.col(y))[0] for x, y in (("a", "b"), ("b", "a")))
    r = table.select(first.alias("x"), second.alias("y")).first()
    assert r.x == r.y


def test_nascent_shrinks_with_thresholds(spark):
    table = spark.createDataFrame([(t, c) for t in range(8) for c in range(t + 1)], "t int, c int")

    def kept(ratio, count):
        return table.where(nascent.verdict(F.col("t"), F.col("c"), ratio, count) == nascent.CLASSES[5]).count()

    assert kept(0.3, 1) >= kept(0.5, 1) >= kept(0.9, 1) and kept(0.3, 1) >= kept(0.3, 2) >= kept(0.3, 5)


def test_summary_of_nothing(spark):
    rows = summary.class_summary(spark.createDataFrame([], "read_class string"), reads.RNA_CLASSES).collect()
    assert [r["count"] for r in rows] == [0] * 5 and all(r.percent is None for r in rows)


def test_numbers_are_found_by_halves(spark):
    rows = spark.range(3000).selectExpr("cast(nullif(id * 7919 % 3001, 17) AS int) AS a", "concat('k', id % 7) AS b", "id")
    for keys in (["a"], ["b", "id"]):
        out = matrix.numbered(rows, [F.col(k) for k in keys], "n")
        assert "filter(" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = sorted(out.collect(), key=lambda r: r.n)
        assert [r.n for r in got] == list(range(1, 3001))
        order = [tuple((r[k] is not None, r[k] or 0) if k != "b" else r[k] for k in keys) for r in got]
        assert order == sorted(order)
