import pytest
from pyspark.sql import functions as F

from cellstrand.plans import fixtures as fx
from cellstrand.plans.queries import oracle_sql, queries
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_against_sql(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    if name in oracle_sql():
        assert_same(df, oracle_sql()[name], sf_dir)
    else:
        assert df.count() > 0


def test_every_query_but_the_one_that_iterates_on_numbers_has_sql():
    assert set(queries()) - set(oracle_sql()) == {"multigene_em"}


def test_reads_are_classified_once_for_counts_and_their_total(spark, sf_dir):
    df = queries()["seq_discovery"](spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_codes_from_an_array_are_the_codes_of_each_row(spark):
    rows = spark.range(100).select(fx.one_of("lig", F.col("id"), 12, 10).alias("a"), fx.code("lig", F.col("id") % 12, 10).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_entry(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["barcode", "sgrna_name", "unique_umi_count"]
