import os

import pytest

from cellstrand.plans.queries import oracle_sql, queries
from cellstrand.session import PUSHDOWN, shared_dir, sweep
from tests.oracle import assert_same


def test_shared_folders_have_a_scheme_and_are_swept(spark):
    one, other = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert one != other and one.startswith("file:") and spark.sparkContext.applicationId in one
    spark.range(3).write.parquet(one)
    folder = os.path.dirname(one.removeprefix("file:"))
    assert os.path.isdir(folder)
    sweep(spark)
    assert not os.path.isdir(folder)
    sweep(spark)


def test_shared_folders_stand_below_the_checkpoint_folder(spark, tmp_path, monkeypatch):
    conf = type(spark.conf)
    given = conf.get
    monkeypatch.setattr(conf, "get", lambda self, key, *rest: str(tmp_path) if key == "spark.checkpoint.dir" else given(self, key, *rest))
    assert shared_dir(spark, "x").startswith(f"file:{tmp_path}/")


@pytest.mark.parametrize("name", ["region_fetch", "coordinate_sort", "fastq_ranges", "grouped_pairs"])
def test_sources_in_a_session_that_pushes_no_filters(spark, sf_dir, name):
    spark.conf.set(PUSHDOWN, "false")
    try:
        assert_same(queries()[name](spark, sf_dir), oracle_sql()[name], sf_dir)
    finally:
        spark.conf.set(PUSHDOWN, "true")
