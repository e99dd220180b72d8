"""The interval join against all pairs, with features of all lengths."""

import random

import pytest
from pyspark.sql import functions as F

from cellstrand.operators import genomics


@pytest.mark.parametrize("broadcast", [True, False])
def test_features_of_every_length(spark, broadcast):
    rng = random.Random(3)
    sizes = [1, 60, 16_384, 16_385, 100_000, 262_145, 2_000_000, 5_000_000, 100_000_000, 0]
    features, blocks = [], []
    for k in range(150):
        start = rng.choice([rng.randrange(9_000_000), 16_384 * rng.randrange(400)])
        features.append((rng.choice(["a", "b"]), start, start + rng.choice(sizes), rng.choice("+-"), "exon", f"G{k}"))
    for k in range(200):
        start = rng.choice([rng.randrange(9_000_000), 16_384 * rng.randrange(400) - 30, rng.choice(features)[1]])
        blocks.append((k, rng.choice(["a", "b", None]), max(0, start), max(0, start) + rng.choice([1, 60, 0, 40_000]), rng.choice("+-.")))
    known = spark.createDataFrame(features, "chrom string, start int, end int, strand string, feature_type string, gene_id string")
    on = spark.createDataFrame(blocks, "k int, chrom string, start int, end int, strand string")
    for stranded in (True, False):
        wanted = {(k, g) for k, c, s, e, strand in blocks for fc, fs, fe, fstrand, _, g in features if c == fc and s < fe and fs < e and fs < fe and s < e and (not stranded or strand == fstrand)}
        got = genomics.overlaps(on, known, stranded, broadcast=broadcast).select("k", "gene_id").distinct().collect()
        assert {(r.k, r.gene_id) for r in got} == wanted and len(wanted) > 100
    assert genomics.overlaps(on, known.limit(0)).count() == 0


def test_a_long_feature_has_two_rows_at_most(spark):
    plan = spark.createDataFrame([("a", 1_000_000, 3_000_000, "+", "transcript", "G")], "chrom string, start int, end int, strand string, feature_type string, gene_id string")
    level = genomics.level_of(plan["start"], plan["end"], genomics.BINS)
    assert plan.select(level.alias("k")).first().k == 2
    assert plan.selectExpr(f"sequence(floor(start / {1 << 22}), floor((end - 1) / {1 << 22})) AS b").first().b in ([0], [0, 1])


def test_many_features_that_the_optimizer_takes_for_few_are_not_broadcast(spark):
    gene = F.concat(F.lit("G"), F.col("k").cast("string"))
    known = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(299_999))).alias("k")).select(F.lit("a").alias("chrom"), (F.col("k") * 10).alias("start"), (F.col("k") * 10 + 5).alias("end"), F.lit("+").alias("strand"), F.lit("exon").alias("feature_type"), gene.alias("gene_id"))
    on = spark.createDataFrame([("a", 2_000_012, 2_000_025, "+")], "chrom string, start int, end int, strand string")
    got = genomics.overlaps(on, known)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.gene_id for r in got.collect()) == ["G200001", "G200002"]
    few = genomics.overlaps(on, known.where("k < 100"))
    assert "Broadcast" in few._jdf.queryExecution().executedPlan().toString()
