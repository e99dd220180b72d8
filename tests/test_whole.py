"""Every line item and every event reaches the queries, on small tables."""

from collections import Counter

import pandas as pd
import pytest

from cellstrand.plans.queries import oracle_sql, queries
from tests.oracle import assert_same


@pytest.fixture(scope="module")
def line_items(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("whole"))
    rows = [(order, order * 7 % 211, order * 3 % 11, line) for order in (1, 2999, 3000, 3001, 70_000, 599_999) for line in range(1, 8)]
    pd.DataFrame(rows, columns=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).to_parquet(f"{folder}/lineitem.parquet")
    return folder, rows


@pytest.mark.parametrize(("name", "each"), [("nascent_scores", 1), ("aligned_pairs", 32)])
def test_every_line_item_is_read(spark, line_items, name, each):
    folder, rows = line_items
    got = [r.qname for r in queries()[name](spark, folder).select("qname").collect()]
    assert sorted(got) == sorted("-".join(map(str, r)) for r in rows if each == 1 or r[1] % 17 for _ in range(each))


@pytest.mark.parametrize("name", ["nascent_scores", "nascent_pairs", "nascent_summary", "aligned_pairs"])
def test_nascent_queries_against_sql(spark, line_items, name):
    assert_same(queries()[name](spark, line_items[0]), oracle_sql()[name], line_items[0])


def test_every_event_is_counted(spark, tmp_path):
    kinds = ("click", "view", "buy")
    rows = [(k, k % 8, kinds[k % 3]) for k in range(1, 200)]
    pd.DataFrame(rows, columns=["event_id", "user_id", "event_type"]).to_parquet(f"{tmp_path}/events.parquet")
    got = {r.barcode: r.total_counts for r in queries()["cell_annotation"](spark, str(tmp_path)).collect()}
    assert got == Counter(f"u{u}" for _, u, _ in rows)
    triplets = queries()["mtx_triplets"](spark, str(tmp_path)).collect()
    assert len(triplets) == len({r[1:] for r in rows}) and sum(r.value for r in triplets) == len(rows)
    for name in ("merge_union", "gene_annotation", "rank_curve", "threshold_counts", "pivot_small"):
        assert_same(queries()[name](spark, str(tmp_path)), oracle_sql()[name], str(tmp_path))
