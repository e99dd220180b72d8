"""Kernels over batches against the plain functions that tell the same record by record."""

import random

import pyarrow as pa
import pytest

from cellstrand.functions import batches
from cellstrand.operators import mismatches, nascent
from cellstrand.sources import fasta


def records(n, letters="ACGTNacgt="):
    """(cigar, read, reference) of all operations, some too short, some null."""
    rng = random.Random(3)
    rows = []
    for _ in range(n):
        cigar = "".join(f"{rng.choice([1, 2, 3, 12, 120])}{rng.choice('MMMMIDNSHP=X')}" for _ in range(rng.randrange(6)))
        own = "".join(rng.choice(letters) for _ in range(rng.randrange(400)))
        ref = own.replace("=", "A") if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randrange(500)))
        rows.append(tuple(None if rng.random() < 0.03 else x for x in (cigar, own, ref)))
    return rows


@pytest.mark.parametrize("rows", [records(1500), records(300, "ACGTé"), [("0D3M", "ACG", "ACG"), ("3M", "ACG", "ATG")], [(None, None, None)], []])
@pytest.mark.parametrize("at_once", [1 << 22, 50])
def test_md(monkeypatch, rows, at_once):
    monkeypatch.setattr(batches, "AT_ONCE", at_once)
    found = mismatches.made_of(*[pa.array([r[k] for r in rows], pa.string()) for k in range(3)])
    wanted = [(None, None) if None in r else mismatches.md_of(*r) or (None, None) for r in rows]
    assert list(zip(*[f.to_pylist() for f in found], strict=True)) == wanted


def test_records_meet_their_reference_in_one_join_and_a_large_one_is_not_broadcast(spark, tmp_path, monkeypatch):
    (tmp_path / "g.fa").write_text(">chr1\n" + "ACGTTGCA\n" * 20)
    rows = [(k, "chr1", 3 * k, "8M", ("ACGTTGCA" * 20)[3 * k : 3 * k + 8]) for k in range(50)] + [(50, "chr1", 0, "2M100N2M", "ACCA"), (51, "chr1", 100, "90M", "A" * 90)]
    made = spark.createDataFrame(rows, "idx long, rname string, pos int, cigar string, seq string")
    for limit, join in ((1 << 20, "BroadcastHashJoin"), (1, "SortMergeJoin")):
        monkeypatch.setattr(fasta, "BROADCAST_BYTES", limit)
        got = mismatches.with_md(made, fasta.windows(spark, str(tmp_path / "g.fa"), 10), 10)
        assert {r.idx: r.tags.get("MD") for r in got.collect()} == {k: "8" for k in range(50)} | {50: "4", 51: None}
        plan = got._jdf.queryExecution().sparkPlan().toString().split("\n:- ")[1]
        joins = [x for x in ("BroadcastHashJoin", "SortMergeJoin") if x in plan.split("\n+- ")[0]]
        assert joins == [join]


def marked(n, letters="ACGTacgtN"):
    """(flag, pos, cigar, MD, read, qualities), MD of any form."""
    rng = random.Random(4)
    rows = []
    for _ in range(n):
        cigar = "".join(f"{rng.choice([1, 2, 3, 12])}{rng.choice('MMMMIDNSHP=X')}" for _ in range(rng.randrange(6)))
        md = "".join(rng.choice(["0", "1", "7", "12", "A", "c", "T", "^AC", "^", "-", "10G"]) for _ in range(rng.randrange(9)))
        rows.append((rng.choice([83, 99, 147, 163, None]), rng.randrange(10**6), cigar, md, "".join(rng.choice(letters) for _ in range(70)), "".join(chr(rng.randrange(60, 90)) for _ in range(70))))
    return rows


KINDS = [pa.int32(), pa.int32(), *[pa.string()] * 4]


@pytest.mark.parametrize("rows", [marked(1500), marked(200, "ACGTé"), [(99, 5, "3M", "99999999999999999999T", "ACT", "~~~")], [(99, 5, "3M", "T99999999999T", "ACT", "~~~")], []])
@pytest.mark.parametrize("at_once", [1 << 22, 50])
def test_aligned_columns_and_conversions(monkeypatch, rows, at_once):
    monkeypatch.setattr(batches, "AT_ONCE", at_once)
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(KINDS)]
    found = nascent.conversions_of(*columns, 40)
    assert list(zip(*[f.to_pylist() for f in found], strict=True)) == [(0, []) if r[0] is None else nascent.conversions(*r, 40) for r in rows]
    short = [(r[1] if k % 9 else None, r[2], r[3] if k % 7 else None, r[4][: 70 - k % 50]) for k, r in enumerate(rows)]
    got = nascent.pairs_of(*[pa.array([r[k] for r in short], kind) for k, kind in enumerate(KINDS[1:5])]).to_pylist()
    assert [x and [tuple(c.values()) for c in x] for x in got] == [None if None in r else nascent.aligned(*r) for r in short]


def test_a_read_without_a_targets_quality_is_an_error():
    columns = [pa.array([x], kind) for x, kind in zip((99, 0, "3M", "3", "ACT", "~~"), KINDS, strict=True)]
    with pytest.raises(IndexError):
        nascent.conversions_of(*columns, 40)
