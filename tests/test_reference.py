"""FASTA windows and MD tags against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from cellstrand.operators import mismatches, nascent
from cellstrand.plans import commands
from cellstrand.sources import alignments, fasta

GENOME_SEED = 5


def genome():
    rng = random.Random(GENOME_SEED)
    return {name: "".join(rng.choice("ACGT") for _ in range(size)) for name, size in (("chr1", 5000), ("chr2", 1), ("chrL", 40_000), ("chr3", 77))}


def fasta_text(bases, width, end="\n", last=True):
    text = ""
    for name, s in bases.items():
        text += f">{name} of a test{end}" + "".join(s[k : k + width] + end for k in range(0, len(s), width))
    return text if last else text.removesuffix(end)


@pytest.mark.parametrize(("width", "end", "last"), [(60, "\n", True), (60, "\r\n", True), (77, "\n", False), (50_000, "\n", True), (1, "\n", True)])
def test_windows(spark, tmp_path, width, end, last):
    own = genome()
    (tmp_path / "g.fa").write_bytes(fasta_text(own, width, end, last).encode())
    for split in (500, 1 << 20):
        known = fasta.contigs(spark, str(tmp_path / "g.fa"), split)
        assert [(c.name, c.size) for c in known] == [(n, len(s)) for n, s in own.items()]
    got = fasta.windows(spark, str(tmp_path / "g.fa"), 1000, 700).collect()
    for name, s in own.items():
        assert "".join(r.bases for r in sorted((r for r in got if r.rname == name), key=lambda r: r.window)) == s
        assert all(len(r.bases) == 1000 for r in got if r.rname == name and (r.window + 1) * 1000 <= len(s))


def test_unequal_lines_and_packed_files_are_errors(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">a\nACGT\nACG\nACGT\nACGT\nA\n")
    with pytest.raises(Exception, match="not equally long"):
        fasta.windows(spark, str(tmp_path / "g.fa")).collect()
    (tmp_path / "g.fa.gz").write_bytes(b"\x1f\x8b\x08")
    with pytest.raises(ValueError, match="packed"):
        fasta.windows(spark, str(tmp_path / "g.fa.gz"))
    (tmp_path / "none.fa").write_text("")
    assert fasta.windows(spark, str(tmp_path / "none.fa")).count() == 0


def test_md_of_every_operation():
    ref = "ACGTACGTAC"
    assert mismatches.md_of("10M", "ACGTACGTAC", ref) == ("10", 0)
    assert mismatches.md_of("10M", "CCGTACGTAA", ref) == ("0A8C0", 2)
    assert mismatches.md_of("3S4M1I2M2D2M5H", "NNN" + "AGGT" + "T" + "AC" + "AG", ref) == ("1C4^GT1C0", 5)
    assert mismatches.md_of("4M2D2M", "ACGTGT", "ACGTACGT") == ("4^AC2", 2)
    assert mismatches.md_of("4M2D2M", "ACGTCT", "ACGTACGT") == ("4^AC0G1", 3)
    assert mismatches.md_of("4M100N4=", "AC=NACGT", "ACGTacgt") == ("3T4", 1)
    assert mismatches.md_of("5M", "ACGTA", "ACG") is None and mismatches.md_of("3M", "AC", "ACG") is None


def reads(own, n=300):
    """Records of all operations, with the MD that follows from how they were made."""
    rng = random.Random(9)
    rows = []
    for k in range(n):
        name = rng.choice(["chr1", "chrL", "chrL"])
        pos = rng.randrange(len(own[name]) - 700) if k % 7 else rng.choice([16_384 * j - rng.randrange(30) for j in (1, 2)]) * (name == "chrL")
        at, cigar, seq, md, same = pos, [], "", "", 0
        for op in rng.choice(["M", "SMIMDMS", "MNM", "MDDM", "IMXM", "M=M", "HSMDMNMIM"]):
            size = rng.randrange(1, 25) if op != "N" else rng.choice([5, 400])
            cigar.append(f"{size}{op}")
            if op in "M=X":
                for b in own[name][at : at + size]:
                    c = rng.choice("ACGTN") if op != "=" and rng.random() < 0.15 else b
                    seq += c
                    if c == b:
                        same += 1
                    else:
                        md, same = f"{md}{same}{b}", 0
                at += size
            elif op == "D":
                md, same, at = f"{md}{same}^{own[name][at : at + size]}", 0, at + size
            elif op == "N":
                at += size
            elif op in "IS":
                seq += "".join(rng.choice("ACGT") for _ in range(size))
        rows.append((k, name, pos, "".join(cigar), seq, f"{md}{same}"))
    return rows


def test_md_against_how_the_records_were_made(spark, tmp_path):
    own = genome()
    (tmp_path / "g.fa").write_text(fasta_text(own, 61))
    rows = reads(own)
    made = spark.createDataFrame(rows, "idx long, rname string, pos int, cigar string, seq string, wanted string").repartition(4)
    for window in (fasta.WINDOW, 37):
        got = mismatches.with_md(made, fasta.windows(spark, str(tmp_path / "g.fa"), window), window).collect()
        assert len(got) == len(rows) and all(r.tags["MD"] == r.wanted and r.tag_types["MD"] == "Z" for r in got)
    # what MD says is what the reference is
    for r in got[:50]:
        for query, ref, base in nascent.aligned(r.pos, r.cigar, r.tags["MD"], r.seq):
            assert own[r.rname][ref] == base or r.seq[query] == "N" == base


def test_calmd_command(spark, tmp_path):
    own = genome()
    (tmp_path / "g.fa").write_text(fasta_text(own, 60))
    s = own["chr1"][10:20]
    changed = "T" if s[3] != "T" else "G"
    head = "@SQ\tSN:chr1\tLN:5000\n@SQ\tSN:other\tLN:50\n"
    lines = [("a", "0", "chr1", "11", "10M", s[:3] + changed + s[4:], "MD:Z:10\tXS:A:+\tNM:i:0"), ("b", "0", "other", "1", "4M", "ACGT", "MD:Z:4"), ("c", "4", "*", "0", "*", "ACGT", ""), ("d", "0", "chr1", "4995", "10M", "A" * 10, "")]
    (tmp_path / "in.sam").write_text(head + "".join("\t".join([n, f, c, p, "60", g, "*", "0", "0", q, "I" * len(q), *([t] if t else [])]) + "\n" for n, f, c, p, g, q, t in lines))
    commands.calmd(spark, str(tmp_path / "in.sam"), str(tmp_path / "g.fa"), str(tmp_path / "out.bam"))
    got = {r.qname: r for r in alignments.bam(spark, str(tmp_path / "out.bam")).collect()}
    assert got["a"].tags == {"XS": "+", "NM": "1", "MD": f"3{s[3]}6"} and got["a"].tag_types == {"XS": "A", "NM": "i", "MD": "Z"}
    assert got["b"].tags == {"MD": "4"} and got["c"].tags == {} and got["d"].tags == {}


def test_md_of_nothing(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1\nACGT\n")
    none = spark.createDataFrame([], "idx long, rname string, pos int, cigar string, seq string, tags map<string,string>")
    got = mismatches.with_md(none, fasta.windows(spark, str(tmp_path / "g.fa")))
    assert got.count() == 0 and "tag_types" in got.columns
    nulls = spark.createDataFrame([(1, None, 0, "4M", "ACGT", None), (2, "chr1", 0, None, "ACGT", None), (3, "chr1", 0, "4M", None, None)], none.schema)
    got = mismatches.with_md(nulls, fasta.windows(spark, str(tmp_path / "g.fa"))).select(F.map_keys("tags").alias("k")).collect()
    assert [r.k for r in got] == [[], [], []]


