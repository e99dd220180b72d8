"""Mates of files grouped by name, put together range by range, against the pairing by a shuffle."""

import random

import pytest

from cellstrand.operators import genomics
from cellstrand.plans import commands
from cellstrand.sinks import bam as sink
from cellstrand.sources import alignments
from tests.test_commands import CELL, HEAD, annotated, sam_line  # noqa: F401

GROUPED = "@HD\tVN:1.6\tSO:queryname\n@SQ\tSN:chr1\tLN:100000\n"


@pytest.fixture(scope="module")
def grouped(spark, tmp_path_factory):
    """Names of one to seventy records, with the mates that make a pair or not; blocks are small."""
    rng = random.Random(7)
    rows, idx = [], 0
    for k in range(500):
        flags = rng.choice([[83, 163]] * 6 + [[99, 147], [163, 83], [83], [83, 83], [83, 163, 339], [83, 163, 83, 163], [4, 4], [65] * 70])
        for flag in flags:
            cigar = rng.choice(["20M", "5S10M100N5M", "8M2D3I9M", "*"])
            rows.append((idx, f"n{k:04d}" + "x" * rng.randrange(60), flag, "chr1", rng.randrange(90_000), 60, cigar, "*", -1, 0, "*", "*", None, None))
            idx += 1
        size = len(flags)
        name = rows[-size][1]
        rows[-size:] = [(r[0], name, *r[2:]) for r in rows[-size:]]
    path = str(tmp_path_factory.mktemp("grouped") / "x.bam")
    data = [sink.header_blocks(GROUPED, [("chr1", 100_000)])]
    body = b"".join(sink.bam_record({"chr1": 0}, *r[1:12], {}) for r in rows)
    data += [sink.packed_block(body[k : k + 900]) for k in range(0, len(body), 900)]
    with open(path, "wb") as out:
        out.write(b"".join(data) + sink.END_BLOCK)
    return path, spark.createDataFrame(rows, alignments.SCHEMA)


@pytest.mark.parametrize("split", [60, 300, 1000, 4000, 1 << 25])
def test_every_cut_gives_the_pairs_of_a_shuffle(spark, grouped, split):
    path, rows = grouped
    wanted = sorted(map(str, genomics.read_pairs(rows).collect()))
    reader = alignments.PairReader([path], split)
    pairs = [row for p in reader.partitions() for row in reader.read(p)]
    assert sorted(p[0] for p in pairs) == sorted(r.qname for r in genomics.read_pairs(rows).collect()) and len(pairs) > 200
    if split >= 1000:
        found = alignments.bam_pairs(spark, path, split)
        assert sorted(map(str, found.collect())) == wanted
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_file_that_is_not_grouped_is_an_error(spark, grouped, tmp_path):
    path = str(tmp_path / "x.bam")
    sink.bam(grouped[1], "@HD\tVN:1.6\tSO:coordinate\n@SQ\tSN:chr1\tLN:100000\n", [("chr1", 100_000)], path)
    with pytest.raises(ValueError, match="grouped by name"):
        alignments.bam_pairs(spark, path)


def test_count_of_a_grouped_file(spark, tmp_path, annotated):  # noqa: F811
    """The same assignments and counts as from records in any order."""
    rows = []
    for k, (s1, s2, plus) in enumerate([(1010, 1040, True), (1110, 1150, True), (6000, 6100, True), (1010, 40, False)]):
        rows += [sam_line(f"{CELL},U{k % 2},{k}", 83 if plus else 99, s1), sam_line(f"{CELL},U{k % 2},{k}", 163 if plus else 147, s2)]
    told = []
    for head in ("@HD\tVN:1.6\tSO:queryname", "@HD\tVN:1.6"):
        (tmp_path / "x.sam").write_text("\n".join([head, *HEAD[1:], *rows]) + "\n")
        commands.save_alignments(spark, alignments.sam(spark, str(tmp_path / "x.sam")), str(tmp_path / "x.sam"), str(tmp_path / "x.bam"))
        assert alignments.grouped_by_name(str(tmp_path / "x.bam")) == ("queryname" in head)
        found, counts = commands.count(spark, str(tmp_path / "x.bam"), annotated, str(tmp_path / "c"), "S")
        told.append((sorted(map(str, found.collect())), sorted(map(str, counts.collect()))))
    assert told[0] == told[1] and len(told[0][0]) == 4


def test_mappings_are_made_without_genes(spark, sf_dir):
    from cellstrand.plans.queries import queries

    assert "part.parquet" not in queries()["mapping_string"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("split", [60, 300, 1000, 4000, 1 << 25])
@pytest.mark.parametrize("at_once", [40, 5000, 1 << 22])
def test_pairs_of_batches_are_those_of_records(grouped, split, at_once):
    path, _ = grouped
    reader = alignments.PairReader([path], split)
    for p in reader.partitions():
        own = [{"qname": q, **{m: dict(zip(("rname", "pos", "aend", "reverse", "blocks"), x, strict=True)) for m, x in (("m1", a), ("m2", b))}} for q, a, b in reader.read(p)]
        for row in own:
            for m in ("m1", "m2"):
                row[m]["blocks"] = [{"start": a, "end": b} for a, b in row[m]["blocks"]]
        assert [row for batch in alignments.paired(*p.value, at_once) for row in batch.to_pylist()] == own
