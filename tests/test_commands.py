"""Commands on small files, held against values worked out by hand."""

import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from cellstrand import cli
from cellstrand.functions import sequence as seq
from cellstrand.operators import matrix, nascent, umi, whitelist
from cellstrand.plans import commands
from cellstrand.sinks import files as sinks
from cellstrand.sources import alignments, fastq, tables

LIG, RT_T, RT_N, I7, SG = "AACCGGTTAA", "CATGCATGCA", "GGATCCGGAT", "TTGGCCAATT", "ACGTACGTACGTACGTACGA"


def write_fastq(path, reads, packed=True):
    text = "".join(f"@{name}\n{s}\n+\n{q or 'I' * len(s)}\n" for name, s, q in reads)
    with (gzip.open if packed else open)(path, "wt") as out:
        out.write(text)
    return str(path)


def dictionary(spark, path, *codes):
    rows = spark.createDataFrame([(c,) for c in codes], "s string")
    sinks.tsv(whitelist.correction_file(rows, "s"), str(path))
    return str(path)


def lines(path, packed=False):
    with (gzip.open if packed else open)(path, "rt") as text:
        return text.read().splitlines()


@pytest.fixture
def codes(spark, tmp_path):
    random_n = tmp_path / "random_n.txt"
    random_n.write_text(RT_N + "\n")
    return dictionary(spark, tmp_path / "lig.tsv", LIG), dictionary(spark, tmp_path / "rt.tsv", RT_T, RT_N), str(random_n)


def test_barcode(spark, tmp_path, codes):
    insert, bio = "ACGGACTTACGGATCAGGACTTAGC", "GGATTACAGGATTACAGGATTACAT"
    lig, cell, own = [], [], []

    def add(name, l, rt, tail, b):
        lig.append((f"{name} 1", l + "GG", None))
        cell.append((f"{name} 2", "ACGTACGT" + rt + tail, None))
        own.append((f"{name} 3", b, None))

    add("plain", LIG, RT_T, "TTTTTTTTT" + insert, bio)
    add("four_t", "N" + LIG[1:], RT_T[:-1] + "N", "TTTT" + insert, bio)
    add("random", LIG, RT_N, "TTTTTTTTT" + insert, bio)
    add("no_lig", "CCCCCCCCCC", RT_T, insert, bio)
    add("no_rt", LIG, "NN" + RT_T[2:], insert, bio)
    add("adapter", LIG, RT_T, "TTTTT" + insert + seq.ADAPTER + "AAAA", bio)
    add("adapter_1", LIG, RT_T, insert + seq.ADAPTER[:-1] + "A", bio)
    add("short20", LIG, RT_T, insert[:20], bio)
    add("long21", LIG, RT_T, insert[:21], bio)
    add("through", LIG, RT_T, insert, "TGCATGCATG" + bio)
    add("through22", LIG, RT_T, insert, bio[:22] + "TGCATGCATG" + bio)
    files = [write_fastq(tmp_path / f"{n}.fastq.gz", r) for n, r in (("l", lig), ("c", cell + [("extra", "A" * 40, None)]), ("b", own))]
    out = str(tmp_path / "out" / "s1")
    told = commands.barcode(spark, *files, out, *codes)
    assert [(r.read_class, r["count"]) for r in told.collect()] == [("filtered_no_ligation_barcode", 1), ("filtered_no_RT_barcode", 1), ("filtered_too_short", 2), ("passed_all_filters", 7), ("total_reads_processed", 11)]
    r1, r2 = lines(f"{out}.R1.fastq.gz", True), lines(f"{out}.R2.fastq.gz", True)
    assert len(r1) == len(r2) == 28
    by = {r1[k].split(",")[2].split()[0]: (r1[k : k + 4], r2[k : k + 4]) for k in range(0, 28, 4)}
    assert list(by) == ["plain", "four_t", "random", "adapter", "adapter_1", "long21", "through22"]
    assert by["plain"][0][0] == f"@{LIG}{RT_T},ACGTACGT,plain plain 2" and by["plain"][0][1] == insert
    assert by["four_t"][0][1] == "TTTT" + insert and by["random"][0][1] == "TTTTTTTTT" + insert
    assert by["adapter"][0][1] == insert and by["adapter_1"][0][1].endswith("A") and len(by["adapter_1"][0][1]) == 25 + 17
    assert by["through22"][1][1] == bio[:22] and all(len(x[1]) == len(x[3]) for pair in by.values() for x in pair)
    assert lines(f"{out}-summary.tsv")[0] == "read_class\tcount\tpercent"


def test_guides_and_discovery(spark, tmp_path, codes):
    i7 = tmp_path / "i7.tsv"
    i7.write_text(f"sample_id\tbarcode\ns\t{I7}\n")
    other = "CCGTTCGTACGTACGTACGT"
    sg = dictionary(spark, tmp_path / "sg.tsv", SG, other)
    names = tmp_path / "names.tsv"
    names.write_text(f"gRNA_seq\tnames\n{SG}\tg1\n{other}\tg1\n")
    r1, r2, r3 = [], [], []

    def add(umi8, rt=RT_T, c1=seq.CONSTANT_1, i=I7, c2=seq.CONSTANT_2, guide=SG, lig=LIG):
        r1.append(("r", umi8 + rt + c1 + "AAAA", None))
        r2.append(("r", i + c2 + "C" * 15 + guide + "GG", None))
        r3.append(("r", lig + "A", None))

    add("AAAAAAAA")
    add("AAAAAAAA")
    add("AAAAAAAA", guide=other)
    add("CCCCCCCC", c1="N" + seq.CONSTANT_1[1:])
    add("GGGGGGGG", rt=RT_N)
    add("AAAAAAAA", c1="NN" + seq.CONSTANT_1[2:], lig="CCCCCCCCCC")
    add("AAAAAAAA", lig="CCCCCCCCCC", i="CCCCCCCCCC")
    add("AAAAAAAA", i="CCCCCCCCCC")
    add("AAAAAAAA", rt="CCCCCCCCCC")
    add("AAAAAAAA", guide="G" * 20)
    files = [write_fastq(tmp_path / f"{n}.fastq.gz", r) for n, r in (("1", r1), ("2", r2), ("3", r3))]
    counts, classes = commands.guides(spark, *files, codes[0], codes[1], str(i7), sg, str(tmp_path), "S", annotation_file=str(names))
    assert {(r.barcode, r.sgrna_name, r.unique_umi_count) for r in counts.collect()} == {(f"S{I7}.{LIG}{RT_T}", "g1", 2), (f"S{I7}.{LIG}{RT_N}", "g1", 1)}
    assert [r["count"] for r in classes.collect()] == [1, 1, 1, 1, 1, 5, 10]
    counts, _ = commands.guides(spark, *files, codes[0], codes[1], str(i7), sg, str(tmp_path), "S", min_umi_threshold=3)
    assert {(r.sgrna_name, r.unique_umi_count) for r in counts.collect()} == {(SG, 2), (other, 1)}
    _, classes = commands.guides(spark, *files, codes[0], codes[1], str(i7), sg, str(tmp_path), "S", n_reads=2)
    assert [r["count"] for r in classes.collect()][-2:] == [2, 2]
    discovery, classes = commands.discover(spark, *files, codes[0], codes[1], str(i7), str(tmp_path), "S")
    assert [(r.sgrna_seq, r.read_count) for r in discovery.collect()] == [(SG, 4), (other, 1), ("G" * 20, 1)]
    assert [r["count"] for r in classes.collect()] == [1, 1, 1, 1, 6, 10]
    i7.write_text(f"sample_id\tbarcode\ns\t{I7}\nt\t{I7}\n")
    _, classes = commands.guides(spark, *files, codes[0], codes[1], str(i7), sg, str(tmp_path), "S")
    assert {r.read_class: r["count"] for r in classes.collect()}["passed"] == 0


def test_dictionary_command(spark, tmp_path):
    (tmp_path / "w.tsv").write_text("name\tbc\na\tACGT\nb\tACGT\nc\tTTTT\n")
    cli_args = cli.parser().parse_args(["build-correction-dict", "--input_file", str(tmp_path / "w.tsv"), "--sequence_column", "bc", "--output_file", str(tmp_path / "d.tsv")])
    cli_args.call(spark, **{of: getattr(cli_args, of) for of in cli_args.wants})
    rows = lines(tmp_path / "d.tsv")
    assert rows[0] == "barcode_1bp_substitution\toriginal_barcode" and rows[1:] == sorted(rows[1:]) and len(rows) == 1 + 2 * 17


HEAD = ["@HD\tVN:1.6", "@SQ\tSN:chr1\tLN:100000", "@SQ\tSN:chr2\tLN:100000"]
CELL = "A" * 20


def sam_line(name, flag, pos, cigar="20M", chrom="chr1", seq_="A" * 20, qual="I" * 20, tags="MD:Z:20", mate="="):
    return "\t".join([name, str(flag), chrom, str(pos + 1), "60", cigar, mate, str(pos + 1), "0", seq_, qual, *([tags] if tags else [])])


GTF = """#c
chr1\ts\tgene\t1001\t2000\t.\t+\t.\tgene_id "G1"; gene_name "A";
chr1\ts\ttranscript\t1001\t2000\t.\t+\t.\tgene_id "G1"; transcript_id "T1";
chr1\ts\texon\t1001\t1200\t.\t+\t.\tgene_id "G1"; transcript_id "T1";
chr1\ts\texon\t1801\t2000\t.\t+\t.\tgene_id "G1"; transcript_id "T1";
chr1\ts\tgene\t1101\t1900\t.\t+\t.\tgene_id "G2"; gene_name "";
chr1\ts\ttranscript\t1101\t1900\t.\t+\t.\tgene_id "G2"; transcript_id "T2";
chr1\ts\texon\t1101\t1200\t.\t+\t.\tgene_id "G2"; transcript_id "T2";
chr1\ts\tgene\t1\t5000\t.\t-\t.\tgene_id "G3"; gene_name "A";
chr1\ts\ttranscript\t1\t5000\t.\t-\t.\tgene_id "G3"; transcript_id "T3";
chr1\ts\texon\t1\t100\t.\t-\t.\tgene_id "G3"; transcript_id "T3";
chr1\ts\texon\t7001\t7100\t.\t.\t.\tgene_id "G4"; transcript_id "T4";
"""


@pytest.fixture
def annotated(spark, tmp_path):
    (tmp_path / "a.gtf").write_text(GTF)
    commands.index(spark, str(tmp_path / "a.gtf"), str(tmp_path / "index"))
    return str(tmp_path / "index")


def counted(spark, tmp_path, annotated, pairs, **options):
    rows = [*HEAD]
    for k, (s1, s2, plus) in enumerate(pairs):
        name = f"{CELL},UMI{k % 2},{k}"
        rows += [sam_line(name, 83 if plus else 99, s1), sam_line(name, 163 if plus else 147, s2)]
    rows.append(sam_line(f"{CELL},U,lonely", 83, 1010))
    (tmp_path / "x.sam").write_text("\n".join(rows) + "\n")
    found, counts = commands.count(spark, str(tmp_path / "x.sam"), annotated, str(tmp_path / "counts"), "S", **options)
    genes = {r.mapping.split(",")[2].split()[0]: (r.gene_id, r.mapped_feature) for r in found.collect()}
    return [genes[str(k)] for k in range(len(pairs))], {(r[1], r[2]) for r in counts.collect()}


def test_count(spark, tmp_path, annotated):
    pairs = [(1010, 1040, True), (1110, 1150, True), (1010, 1150, True), (1300, 1350, True), (1010, 40, False), (6000, 6100, True), (1010, 1190, True), (1850, 1180, True)]
    calls, counts = counted(spark, tmp_path, annotated, pairs)
    assert calls == [("G1", "exon"), ("_multiple", "exon"), ("G1", "exon"), ("_no_feature_overlap", "none"), ("G3", "exon"), ("_no_feature_overlap", "none"), ("G1", "exon"), ("G1", "exon")]
    assert ("G1", 2) in counts and ("_multiple", 1) in counts
    calls, counts = counted(spark, tmp_path, annotated, pairs, count_introns=True, collapse_by_gene_name=True)
    assert calls[3] == ("_multiple", "transcript") and calls[5] == ("_no_feature_overlap", "none")
    assert counts == {("A", 2)}
    calls, _ = counted(spark, tmp_path, annotated, pairs, multigene_reads="closest_TES")
    assert calls[1] == ("G2", "exon")
    calls, _ = counted(spark, tmp_path, annotated, pairs, library_strandedness="none")
    assert calls[4] == ("_ambiguous", "exon")
    with pytest.raises(ValueError, match="unknown multi-gene policy"):
        commands.count(spark, "missing.sam", "missing", str(tmp_path), "S", multigene_reads="em")


def test_annotation_names(spark, annotated):
    names = {r.gene_id: r.gene_name for r in spark.read.parquet(f"{annotated}/gene_names").collect()}
    assert names == {"G1": "A", "G2": "G2", "G3": "A"}
    tes = {r.gene_id: r.tes for r in spark.read.parquet(f"{annotated}/tes").collect()}
    assert tes == {"G1": 2000, "G2": 1900, "G3": 0}


def test_nearest_end_prefers_the_least_signed_distance(spark):
    from cellstrand.operators import genomics

    mate = "struct<pos:int,aend:int>"
    pairs = spark.createDataFrame([("q", (900, 960), (940, 1000), ["A", "B", "C"]), ("r", (900, 960), (940, 1000), ["C"])], f"qname string, m1 {mate}, m2 {mate}, genes array<string>")
    tes = spark.createDataFrame([("A", 960, "+"), ("B", 1000, "+"), ("C", 950, "+")], "gene_id string, tes int, strand string")
    assert {r.qname: r.nearest for r in genomics.nearest_ends(pairs, tes).collect()} == {"q": "A"}


def test_tag_round_trip_through_bam(spark, tmp_path):
    rows = [*HEAD, sam_line(f"{CELL},ACGT,r1", 83, 5, tags="MD:Z:20\tNM:i:3"), sam_line(f"{CELL},ACGT,r2", 99, 7, cigar="5S10M5I", seq_="ACGTN" * 4, chrom="chr2"), sam_line(f"{CELL},TTTT,r3", 4, -1, cigar="*", chrom="*", qual="*", tags="", mate="*")]
    (tmp_path / "in.sam").write_text("\n".join(rows) + "\n")
    commands.tag(spark, str(tmp_path / "in.sam"), str(tmp_path / "out.bam"))
    assert alignments.bam_header(str(tmp_path / "out.bam"))[1] == [("chr1", 100000), ("chr2", 100000)]
    got = alignments.bam(spark, str(tmp_path / "out.bam")).orderBy("idx").collect()
    assert [r.qname.split(",")[2] for r in got] == ["r1", "r2", "r3"]
    assert got[0].tags == {"MD": "20", "NM": "3", "CB": CELL, "UR": "ACGT"} and got[0].pos == 5 and got[0].rname == "chr1"
    assert (got[1].seq, got[1].cigar, got[1].qual) == ("ACGTN" * 4, "5S10M5I", "I" * 20) and got[2].rname is None and got[2].qual == "*"
    only = alignments.bam(spark, str(tmp_path / "out.bam")).where("rname = 'chr2'").collect()
    assert [r.pos for r in only] == [7]
    commands.tag(spark, str(tmp_path / "out.bam"), str(tmp_path / "again.sam"))
    text = lines(tmp_path / "again.sam")
    assert text[:3] == HEAD and text[3].split("\t")[:6] == rows[3].split("\t")[:6] and "UR:Z:ACGT" in text[3]
    (tmp_path / "bad.sam").write_text("\n".join([*HEAD, sam_line("no_parts", 83, 5)]) + "\n")
    with pytest.raises(Exception, match="read name without"):
        commands.tag(spark, str(tmp_path / "bad.sam"), str(tmp_path / "bad.bam"))
    assert commands.tagged(alignments.sam(spark, str(tmp_path / "bad.sam")), "skip").count() == 0


def test_slam(spark, tmp_path):
    def read(name, flag, bases, md, qual="P" * 10, start=100):
        return "\t".join([name, str(flag), "chr1", str(start + 1), "60", "10M", "=", str(start + 1), "0", bases, qual, *([f"MD:Z:{md}"] if md else [])])

    rows = [
        *HEAD,
        read("n1", 99, "ACCAAAAAAA", "2T7"), read("n1", 147, "CCCCCCCCCC", "10"),
        read("low", 99, "TTTTCTTTTT", "4T5"),
        read("snp", 163, "AAACAAAAAA", "3T6", start=200),
        read("minus", 83, "GAAACCCCCC", "0A9"),
        read("bad_quality", 99, "AACAAAAAAA", "2T7", qual="N" * 10),
        read("no_md", 99, "AAAAAAAAAA", ""), read("no_qual", 99, "AAAAAAAAAA", "10", qual="*"), read("flag", 65, "AACAAAAAAA", "2T7"),
    ]
    (tmp_path / "in.sam").write_text("\n".join(rows) + "\n")
    (tmp_path / "snps.txt").write_text("#x\nChrom\tPosition\tRef\tVar\nchr1\t204\tt\tc\nchr1\t5\n")
    told = commands.slam(spark, str(tmp_path / "in.sam"), str(tmp_path / "a.bam.dir.sam"), str(tmp_path / "snps.txt"))
    counters = {r.read_class: r["count"] for r in told.collect()}
    assert counters == {"total_reads_processed": 9, "skipped_wrong_flag": 1, "skipped_no_md_tag": 1, "skipped_no_qualities": 1, "no_mismatches": 2, "tc_ratio_below_threshold": 3, "nascent_reads_classified": 1, "total_reads_written": 2}
    assert sum(counters[c] for c in nascent.CLASSES) == 9
    kept = [x.split("\t")[0] for x in lines(tmp_path / "a.bam.dir.sam") if not x.startswith("@")]
    assert kept.count("n1") == 2 and "low" not in kept and "snp" not in kept and "bad_quality" not in kept
    assert lines(tmp_path / "a.bam.dir-slam-summary.tsv")[0] == "read_class\tcount"


def test_slam_without_a_snp_list(spark, tmp_path):
    row = "\t".join(["snp", "163", "chr1", "201", "60", "10M", "=", "201", "0", "AAACAAAAAA", "P" * 10, "MD:Z:3T6"])
    (tmp_path / "in.sam").write_text("\n".join([*HEAD, row]) + "\n")
    given = cli.parser().parse_args(["slam", "--input_bam", str(tmp_path / "in.sam"), "--output_bam", str(tmp_path / "out.sam")])
    given.call(spark, **{of: getattr(given, of) for of in given.wants})
    assert "nascent_reads_classified\t1" in lines(tmp_path / "out-slam-summary.tsv") and len([x for x in lines(tmp_path / "out.sam") if x.startswith("snp")]) == 1


def bam_of(spark, tmp_path, name, rows):
    (tmp_path / f"{name}.sam").write_text("\n".join([*HEAD, *rows]) + "\n")
    commands.save_alignments(spark, alignments.sam(spark, str(tmp_path / f"{name}.sam")), str(tmp_path / f"{name}.sam"), str(tmp_path / f"{name}.bam"))
    return str(tmp_path / f"{name}.bam")


def test_records_of_several_bam_files_are_told_apart(spark, tmp_path):
    def read(name, bases, md):
        return "\t".join([name, "99", "chr1", "101", "60", "10M", "=", "101", "0", bases, "P" * 10, f"MD:Z:{md}"])

    one, other = bam_of(spark, tmp_path, "one", [read("converted", "ACCAAAAAAA", "2T7")]), bam_of(spark, tmp_path, "other", [read("not", "TTTTTTTTTT", "10"), read("more", "TTTTTTTTTT", "10")])
    none = spark.createDataFrame([], "chrom string, pos int, ref string, alt string")
    rows = {r.qname: (r.read_class, r.tc_count) for r in nascent.classified(alignments.bam(spark, f"{one},{other}"), none).collect()}
    assert rows == {"converted": ("nascent_reads_classified", 1), "not": ("tc_ratio_below_threshold", 0), "more": ("tc_ratio_below_threshold", 0)}
    assert [r.qname for r in alignments.bam(spark, f"{one},{other}").orderBy("idx").collect()] == ["converted", "not", "more"]


@pytest.mark.parametrize("split", [700, 5_000, 70_000])
def test_ranges_of_a_bam_file_are_read_by_several_tasks(spark, tmp_path, split, monkeypatch):
    from cellstrand.sinks import bam as files

    monkeypatch.setattr(files, "BLOCK", 1500)
    rng = random.Random(split)
    rows = [sam_line(f"read{k}," + "x" * rng.randint(0, 60), 83, rng.randint(0, 900), seq_="".join(rng.choice("ACGT") for _ in range(20))) for k in range(900)]
    number = {"chr1": 0, "chr2": 1}
    data = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 2)
    for name in number:
        data += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", 100_000)
    for row in rows:
        f = row.split("\t")
        data += files.bam_record(number, f[0], int(f[1]), f[2], int(f[3]) - 1, int(f[4]), f[5], f[6], int(f[7]) - 1, 0, f[9], f[10], {"MD": "20"})
    # records cross blocks, of which one is empty
    blocks = [files.packed_block(data[k : k + 1500]) for k in range(0, len(data), 1500)]
    blocks.insert(7, files.packed_block(b""))
    (tmp_path / "in.bam").write_bytes(b"".join(blocks) + files.END_BLOCK)
    whole = list(alignments.bam_records(str(tmp_path / "in.bam")))
    assert [r[1] for r in whole] == [r.split("\t")[0] for r in rows]
    read = alignments.bam(spark, str(tmp_path / "in.bam"), split)
    assert split > 5_000 or read.rdd.getNumPartitions() > 3
    got = sorted(tuple(r)[:-2] for r in read.collect())
    assert got == [r[:-2] for r in whole] and len({r[0] for r in whole}) == 900


def test_guides_are_written_as_first_seen(spark, tmp_path, codes):
    i7 = tmp_path / "i7.tsv"
    i7.write_text(f"sample_id\tbarcode\ns\t{I7}\n")
    other = "AAGTTCGTACGTACGTACGT"
    sg = dictionary(spark, tmp_path / "sg.tsv", SG, other)
    reads = [(RT_T, SG), (RT_N, other), (RT_T, other), (RT_N, SG)]
    reads = reads if RT_T > RT_N else [(RT_N if rt == RT_T else RT_T, g) for rt, g in reads]
    files = [write_fastq(tmp_path / f"{n}.fastq.gz", rows) for n, rows in (("1", [("r", "A" * 8 + rt + seq.CONSTANT_1, None) for rt, _ in reads]), ("2", [("r", I7 + seq.CONSTANT_2 + "C" * 15 + g, None) for _, g in reads]), ("3", [("r", LIG, None)] * 4))]
    commands.guides(spark, *files, codes[0], codes[1], str(i7), sg, str(tmp_path), "S")
    wanted = [(rt, g) for rt in (reads[0][0], reads[1][0]) for r, g in reads if r == rt]
    assert [tuple(x.split("\t")[:2]) for x in lines(tmp_path / "S-sgrna_count.tsv")[1:]] == [(f"S{I7}.{LIG}{rt}", g) for rt, g in wanted]


def test_triplets_of_several_files_and_of_other_ids(spark, tmp_path):
    sets = [[write_fastq(tmp_path / f"{n}{k}.fastq.gz", [(f"id{k}", "ACGT", None)]) for n in "abc"] for k in range(2)]
    paths = [",".join(s[j] for s in sets) for j in range(3)]
    rows = fastq.triplets(spark, *paths, check_ids=True).orderBy("idx").collect()
    assert [r.lig.id for r in rows] == ["id0", "id1"] and rows[0].idx == 1
    with pytest.raises(Exception, match="other ids"):
        fastq.triplets(spark, sets[0][0], sets[1][1], sets[0][2], check_ids=True).collect()
    assert fastq.triplets(spark, sets[0][0], sets[1][1], sets[0][2]).count() == 1


def test_aligned_columns():
    assert nascent.aligned(10, "3S4M1I2M2D3M5N1M", "2A3^GT1C2", "NNNACGTGTTACGA") == [(3, 10, "A"), (4, 11, "C"), (5, 12, "A"), (6, 13, "T"), (8, 14, "T"), (9, 15, "T"), (10, 18, "A"), (11, 19, "C"), (12, 20, "G"), (13, 26, "A")]


def test_merge(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("barcode\tgene_id\tunique_umi_count\nb2\tg1\t3\nb1\tg2\t1200\n")
    (tmp_path / "b.tsv").write_text("barcode\tgene_id\tunique_umi_count\nb3\tg1\t1\n")
    base = str(tmp_path / "m" / "s_")
    commands.merge(spark, f"{tmp_path}/a.tsv,{tmp_path}/b.tsv", base)
    assert lines(base + "gene_counts.mtx") == ["%%MatrixMarket matrix coordinate integer general", "%", "2 3 3", "2 1 1200", "1 2 3", "1 3 1"]
    assert lines(base + "cell_annotation.tsv") == ["barcode\tgenes_detected\ttotal_counts", "b1\t1\t1200", "b2\t1\t3", "b3\t1\t1"]
    assert lines(base + "gene_annotation.tsv") == ["gene_id\tcells_expressed", "g1\t2", "g2\t1"]
    assert lines(base + "barcode_rank.tsv")[1] == "0\tb1\t1200\ttrue"
    with pytest.raises(ValueError):
        matrix.merged([spark.createDataFrame([("b", "g", 1)], "barcode string, gene_id string, unique_umi_count long"), spark.createDataFrame([("b", "g", 1)], "barcode string, gene_name string, unique_umi_count long")])
    twice = tables.counts(spark, str(tmp_path / "b.tsv"))
    with pytest.raises(Exception, match="counted twice"):
        matrix.merged([twice, twice]).collect()


def test_numbers_follow_the_order_over_many_ranges(spark):
    rows = spark.range(1000).select(F.format_string("k%05d", (F.col("id") * 7919) % 1000).alias("k"))
    got = matrix.numbered(rows, [F.col("k")], "n", splits=7).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001)) and [r.k for r in got] == sorted(r.k for r in got)


def test_directional_clusters():
    assert umi.clusters_of(["AAAA", "AAAT", "AATT", "CCCC"], [10, 5, 3, 1]) == ["AAAA", "AAAA", "AAAA", "CCCC"]
    assert umi.clusters_of(["AAAA", "AAAT"], [10, 6]) == ["AAAA", "AAAT"]


def test_fastq_source(spark, tmp_path):
    path = write_fastq(tmp_path / "x.fastq", [("a one", "ACG", "III"), ("b", "", "")], packed=False)
    assert [tuple(r)[1:] for r in fastq.fastq(spark, path).collect()] == [(1, "a", "a one", "ACG", "III"), (2, "b", "b", "", "")]
    assert fastq.fastq(spark, path).where("idx <= 1").count() == 1
    (tmp_path / "bad.fastq").write_text("@a\nAC\n+\nI\n")
    with pytest.raises(Exception, match="not a FASTQ record"):
        fastq.fastq(spark, str(tmp_path / "bad.fastq")).collect()


def test_streaming_counts(spark, tmp_path):
    from cellstrand.operators.whitelist import correction_dictionary
    from cellstrand.streaming.guides import streaming_counts

    def codes(*of):
        return correction_dictionary(spark.createDataFrame([(c,) for c in of], "s string"), "s")

    r2, r3 = I7 + seq.CONSTANT_2 + "C" * 15 + SG, LIG
    rows = [(k, f"2024-01-01 00:{minute:02d}:00", u + RT_T + seq.CONSTANT_1, r2, r3) for k, (u, minute) in enumerate((("A" * 8, 0), ("A" * 8, 1), ("C" * 8, 2), ("A" * 8, 59)))] + [(9, "2024-01-02 00:00:00", "G" * 8 + RT_T + seq.CONSTANT_1, r2, r3)]
    schema = "idx long, ts string, r1 string, r2 string, r3 string"
    for k in range(0, len(rows), 2):
        spark.createDataFrame(rows[k : k + 2], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).withColumn("ts", F.to_timestamp("ts"))
    out = streaming_counts(stream, codes(LIG), codes(RT_T), codes(I7), codes(SG))
    run = out.writeStream.format("memory").queryName("guide_counts").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    run.processAllAvailable()
    run.stop()
    got = spark.table("guide_counts").collect()
    assert [(r.barcode, r.sgrna_name) for r in got] == [(f"{I7}.{LIG}{RT_T}", SG)] and got[0].unique_umi_count == 2


def test_json_summary(spark, tmp_path):
    sinks.json_summary(spark.createDataFrame([("a", 1)], "read_class string, count long"), str(tmp_path / "s.json"))
    assert (tmp_path / "s.json").read_text() == '{\n  "a": 1\n}'


def test_command_line_names():
    kinds = cli.parser()._subparsers._group_actions[0].choices
    assert list(kinds) == ["barcode", "trim", "tag", "sort", "calmd", "index", "count", "merge", "slam", "gRNA", "gRNA-discover", "build-correction-dict"]
