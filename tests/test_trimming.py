"""Trimming against plain loops: all stretches of a read, all places of a pattern."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from cellstrand.functions import sequence as seq
from cellstrand.operators import trimming
from cellstrand.plans import commands


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
    return row[-1]


def plain_end(read, adapter, overlap, rate):
    cuts = [len(read)]
    for end in range(len(read) + 1):
        for k in ([*range(min(overlap, len(adapter)), len(adapter))] if end == len(read) else []) + [len(adapter)]:
            best = min((edit_distance(read[p:end], adapter[:k]), p) for p in range(end + 1))
            if best[0] <= int(rate * k):
                cuts.append(best[1])
    return min(cuts)


@pytest.mark.parametrize(("adapter", "rate"), [("AAAAAAAA", 0.1), ("AGATCGGAAGAGC", 0.1), ("ACGTAC", 0.34), ("AC", 0.5)])
def test_adapters_against_all_stretches(adapter, rate):
    rng = random.Random(len(adapter))
    reads = ["", adapter, adapter[:3], adapter[:2], adapter * 2, "N" * 9]
    for _ in range(60):
        own = list(adapter)
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(own))
            own[k : k + 1] = rng.choice(["", rng.choice("ACGT"), own[k] + rng.choice("ACGT")])
        reads.append("".join(rng.choice("ACGTN") for _ in range(rng.randrange(12))) + "".join(own)[: rng.randrange(1, 20)] + "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 5]))))
    assert trimming.adapter_ends(reads, adapter, 3, rate).tolist() == [plain_end(r, adapter, 3, rate) for r in reads]


def test_qualities_against_a_plain_loop():
    rng = random.Random(2)
    marks = ["", "#", "I", "#I#", "II##I##"] + ["".join(chr(33 + rng.choice([2, 15, 20, 25, 40])) for _ in range(rng.randrange(40))) for _ in range(200)]

    def plain(q):
        total, most, end = 0, 0, len(q)
        for k in reversed(range(len(q))):
            total += 20 - (ord(q[k]) - 33)
            if total < 0:
                break
            if total > most:
                most, end = total, k
        return end

    assert trimming.quality_ends(marks, 20).tolist() == [plain(q) for q in marks]


def test_mates_stay_in_step(spark):
    read = "struct<id:string,seq:string,qual:string>"
    rows = [(1, ("a", "ACGT" * 8, "I" * 32), ("a", "CCGT" * 6 + "A" * 8 + "GG", "I" * 34)), (2, ("b", "ACGT" * 8, "I" * 10 + "#" * 22), ("b", "CCGT" * 6, "I" * 24)), (3, ("c", None, None), ("c", "", "")), (4, ("d", "C" * 30, "I"), ("d", "G" * 30, None))]
    pairs = spark.createDataFrame(rows, f"idx long, r1 {read}, r2 {read}")
    got = {r.idx: r for r in trimming.trimmed(pairs, trimming.Trim("AGATCGGAAGAGC", clip=1), trimming.Trim("AAAAAAAA")).collect()}
    assert (got[1].r1.seq, got[1].r1.qual) == ("ACGT" * 7 + "ACG", "I" * 31) and got[1].r2.seq == "CCGT" * 6 and got[1].read_class == trimming.CLASSES[1]
    assert got[2].r1.seq == "ACGT" * 2 + "A" and got[2].read_class == got[3].read_class == trimming.CLASSES[0]
    assert got[4].r1.seq == "C" * 29 and got[4].r2.seq == "G" * 30


def test_trim_command(spark, tmp_path):
    r1 = [("x1 1", "ACGTTGCA" * 4, "I" * 32), ("x2 1", "ACGT", "IIII"), ("x3 1", "CCGGTTAA" * 3 + "AGATCGGAACAGC" + "TT", "I" * 39)]
    r2 = [("x1 2", "GGCCTTAG" * 3 + "AAAA", "I" * 28), ("x2 2", "G" * 30, "I" * 30), ("x3 2", "G" * 25, "I" * 25)]
    for name, rows in (("1", r1), ("2", r2)):
        with gzip.open(tmp_path / f"{name}.fastq.gz", "wt") as out:
            out.write("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in rows))
    told = commands.trim(spark, str(tmp_path / "1.fastq.gz"), str(tmp_path / "2.fastq.gz"), str(tmp_path / "o" / "s"))
    assert [r["count"] for r in told.collect()] == [1, 2, 3]
    with gzip.open(tmp_path / "o" / "s.R1_val_1.fq.gz", "rt") as text:
        assert text.read().splitlines()[:2] == ["@x1 1", ("ACGTTGCA" * 4)[:-1]]
    with gzip.open(tmp_path / "o" / "s.R2_val_2.fq.gz", "rt") as text:
        assert text.read().splitlines()[1::4] == ["GGCCTTAG" * 3, "G" * 25]


@pytest.mark.parametrize(("pattern", "mismatches"), [("CTGTCTCTTATACACAT", 1), ("CTGTCTCTTATACACAT", 2), ("ACG", 1), ("A", 1), ("ACGTACGTAC", 4), ("G" * 60, 3), ("ACGT", 0)])
def test_first_place_with_mismatches(spark, pattern, mismatches):
    rng = random.Random(len(pattern))
    reads = ["", None, pattern, pattern[:-1], "N" * 200, "acgt" * 30]
    for _ in range(150):
        own = list(pattern)
        for _ in range(rng.randrange(mismatches + 2)):
            own[rng.randrange(len(own))] = rng.choice("ACGTN")
        reads.append("".join(rng.choice("ACGTN") for _ in range(rng.randrange(130))) + "".join(own) + "".join(rng.choice("ACGT") for _ in range(rng.randrange(30))))

    def plain(read):
        m = len(pattern)
        return next((p for p in range(len(read) - m + 1) if sum(a != b for a, b in zip(read[p : p + m], pattern, strict=True)) <= mismatches), len(read))

    rows = spark.createDataFrame(list(enumerate(reads)), "k int, s string")
    got = {r.k: r.n for r in rows.select("k", seq.before_within(F.col("s"), pattern, mismatches).alias("n")).collect()}
    assert got == {k: None if r is None else plain(r) for k, r in enumerate(reads)}


def test_patterns_that_have_no_mask():
    with pytest.raises(ValueError):
        seq.before_within(None, "XYZ", 1)


def test_a_pattern_longer_than_a_word_of_bits_and_rows_of_all_kinds(spark):
    pattern = "ACGT" * 20
    near = "N" + pattern[1:40] + "N" + pattern[41:]
    reads = [None, "", "A", pattern, "GG" + near + "T", "GG" + near[:-1], "é" + near, near.lower(), pattern[:-1], None]
    rows = spark.createDataFrame(list(enumerate(reads)), "k int, s string").coalesce(1)
    got = {r.k: r.n for r in rows.select("k", seq.before_within(F.col("s"), pattern, 2).alias("n")).collect()}
    assert [got[k] for k in range(len(reads))] == [None, 0, 1, 0, 2, 81, 1, 80, 79, None]


def test_reads_that_hold_no_part_of_the_adapter_are_not_searched():
    rng = random.Random(8)
    for adapter, overlap, rate in (("CTGTCTCTTATACACAT", 3, 0.1), ("AAAAAAAA", 3, 0.1), ("ACGTACGTAC", 1, 0.3), ("ACG", 0, 0.5), ("ACGT", 5, 0.0), ("AC", 1, 1.0)):
        reads = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(60))) for _ in range(400)]
        reads += [r[:20] + "".join(c for c in adapter if rng.random() > 0.08)[: rng.randrange(1, 18)] + r[20:] * (k % 2) for k, r in enumerate(reads)]
        assert trimming.adapter_ends(reads, adapter, overlap, rate).tolist() == trimming._searched(reads, adapter, overlap, rate).tolist()
    assert trimming.possible([b"G" * 90, b"GGGCTGTCTCTGGG", b"GGGCTG", b""], b"CTGTCTCTTATACACAT", 3, 0.1) == [1, 2]
