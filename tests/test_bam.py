"""BAM files: types of tags, coordinate order, the index and reading by it."""

import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellstrand.plans import commands
from cellstrand.sinks import bam as sink
from cellstrand.sinks import files
from cellstrand.sources import alignments, bam_index
from cellstrand.sources.files import open_at

REFERENCES = [("chr2", 3_000_000), ("chr1", 600_000), ("chrEmpty", 1000), ("chrM", 20_000)]
HEAD = "@HD\tVN:1.6\tSO:unsorted\n" + "".join(f"@SQ\tSN:{n}\tLN:{s}\n" for n, s in REFERENCES)


def raw_tags():
    """A tag of every type, as bytes of the format."""
    out = b"XSA+" + b"NHC\x07" + b"hicd"[:2] + b"c" + struct.pack("<b", -3) + b"mss" + struct.pack("<h", -300) + b"mSS" + struct.pack("<H", 60_000)
    out += b"NMi" + struct.pack("<i", -70_000) + b"bII" + struct.pack("<I", 4_000_000_000) + b"ASf" + struct.pack("<f", 1.1) + b"AXf" + struct.pack("<f", 1e-12) + b"BCZ0012\0" + b"MDZ20\0" + b"XZZ\0" + b"XHH1AE3\0"
    out += b"jMBc" + struct.pack("<i2b", 2, -1, 3) + b"jSBS" + struct.pack("<i2H", 2, 1, 65_535) + b"jIBi" + struct.pack("<i3i", 3, 1, -2, 2**31 - 1) + b"jFBf" + struct.pack("<i3f", 3, 0.1, -2.5, 3e30) + b"jEBC" + struct.pack("<i", 0)
    return out


def raw_record(name, tags, ref=0, pos=5):
    name = name.encode() + b"\0"
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name), 60, sink.index_bin(pos, pos + 4), 1, 99, 4, -1, -1, 0) + name + struct.pack("<I", 4 << 4) + b"\x12\x48" + b"\x28" * 4 + tags
    return struct.pack("<i", len(body)) + body


def bodies(path):
    """A BAM file's records as they are stored."""
    references = alignments.bam_header(path)[1]
    return [b for _, b in alignments._bodies(path, len(references), skipped=alignments._skipped(references)) if b]


def test_tags_of_every_type_come_back_byte_for_byte(spark, tmp_path):
    records = [raw_record(f"{'A' * 20},ACGT,r{k}", raw_tags() if k % 2 else b"") for k in range(6)]
    path, again, tagged = (str(tmp_path / f"{n}.bam") for n in ("in", "again", "tagged"))
    data = sink.header_blocks(HEAD, REFERENCES) + sink.packed_block(b"".join(records)) + sink.END_BLOCK
    (tmp_path / "in.bam").write_bytes(data)
    commands.save_alignments(spark, commands.load_alignments(spark, path), path, again)
    assert bodies(again) == bodies(path) == [r[4:] for r in records]
    commands.tag(spark, path, tagged)
    own = b"CBZ" + b"A" * 20 + b"\0URZACGT\0"
    assert [b for b in bodies(tagged)] == [r[4:] + own for r in records]
    one = next(r for r in alignments.bam(spark, path).collect() if r.tags)
    assert one.tags["BC"] == "0012" and one.tag_types["BC"] == "Z" and one.tags["jM"] == "c,-1,3" and one.tag_types["AS"] == "f" and one.tags["AS"] == "1.1"


def test_tag_types_in_text(spark, tmp_path):
    tags = ["XS:A:+", "NM:i:-3", "BC:Z:0012", "AS:f:1.5", "XH:H:1AE3", "jM:B:c,-1,3", "XZ:Z:", "big:i:4000000000"[1:]]
    line = "\t".join(["r", "99", "chr1", "6", "60", "4M", "*", "0", "0", "ACGT", "IIII", *tags])
    (tmp_path / "in.sam").write_text(HEAD + line + "\n")
    path = str(tmp_path / "in.sam")
    commands.save_alignments(spark, commands.load_alignments(spark, path), path, str(tmp_path / "out.sam"))
    commands.save_alignments(spark, commands.load_alignments(spark, path), path, str(tmp_path / "out.bam"))
    commands.save_alignments(spark, alignments.bam(spark, str(tmp_path / "out.bam")), path, str(tmp_path / "back.sam"))
    for name in ("out.sam", "back.sam"):
        assert (tmp_path / name).read_text().splitlines()[-1] == line
    # what nobody gave a type is a number or text by its looks
    rows = alignments.sam(spark, path).withColumn("tags", F.create_map(F.lit("NM"), F.lit("12"), F.lit("BC"), F.lit("0012"), F.lit("MD"), F.lit("4"))).drop("tag_types")
    assert files.sam_lines(rows).first().value.split("\t")[11:] == ["NM:i:12", "BC:Z:0012", "MD:Z:4"]


@pytest.fixture(scope="module")
def reads(spark):
    rng = random.Random(6)
    rows = []
    for k in range(4000):
        ref = rng.choice(["chr2"] * 6 + ["chr1"] * 3 + ["chrM", None])
        pos = -1 if ref is None else rng.choice([rng.randrange(18_000), rng.randrange(dict(REFERENCES)[ref] - 200), 777])
        cigar = "*" if ref is None else rng.choice(["20M", "8M100N12M", "5S15M", "10M40000N10M" if ref != "chrM" else "20M"])
        rows.append((k, f"read{k}", 4 if ref is None else 99, ref, pos, 60, cigar, "*", -1, 0, "".join(rng.choice("ACGT") for _ in range(20)), "I" * 20, {"MD": "20"}, {"MD": "Z"}))
    return rows, spark.createDataFrame(rows, alignments.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def sorted_file(spark, reads, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sorted") / "x.bam")
    sink.sorted_bam(reads[1], HEAD, REFERENCES, path)
    return path


def in_order(rows):
    number = {name: k for k, (name, _) in enumerate(REFERENCES)}
    return sorted(rows, key=lambda r: (number.get(r[3], 99), r[4], r[0]))


def test_coordinate_order(spark, reads, sorted_file):
    got = alignments.bam(spark, sorted_file, split=40_000).orderBy("idx").collect()
    assert [tuple(r)[1:] for r in got] == [r[1:] for r in in_order(reads[0])] and len({r.idx for r in got}) == len(got)
    assert alignments.bam_header(sorted_file)[0].startswith("@HD\tVN:1.6\tSO:coordinate\n@SQ")


def test_index_comes_back_and_is_the_one_made_from_the_file(spark, reads, sorted_file):
    written = bam_index.load(sorted_file)
    data = (open(f"{sorted_file}.bai", "rb")).read()
    assert data[:4] == b"BAI\x01" and written.unplaced == sum(r[3] is None for r in reads[0])
    assert bam_index.Index.from_bytes(data).to_bytes() == data
    built = bam_index.build(spark, sorted_file, 50_000)
    assert built.unplaced == written.unplaced
    for ref in range(len(REFERENCES)):
        assert built.bins[ref].keys() == written.bins[ref].keys()
        assert {w: o for w, o in bam_index.load(sorted_file).windows[ref].items()} == {w: o for w, o in written.windows[ref].items()}


def overlapping(rows, rname, start, end):
    def last(r):
        sizes = {"20M": 20, "8M100N12M": 120, "5S15M": 15, "10M40000N10M": 40_020}
        return r[4] + sizes[r[6]]

    return sorted(r[1] for r in rows if r[3] == rname and r[4] < end and last(r) > start)


@pytest.mark.parametrize("split", [20_000, 1 << 25])
def test_records_of_a_region(spark, reads, sorted_file, split):
    for rname, start, end in [("chr1", 0, 1 << 29), ("chr2", 16_384, 16_385), ("chr2", 500_000, 700_000), ("chrM", 700, 800), ("chr2", 2_999_990, 3_000_000), ("chrEmpty", 0, 1000), ("chr1", 777, 778)]:
        got = sorted(r.qname for r in alignments.fetched(spark, sorted_file, rname, start, end, split).collect())
        assert got == overlapping(reads[0], rname, start, end), (rname, start, end)
    assert alignments.fetched(spark, sorted_file, "unknown").count() == 0
    begun = alignments.bam(spark, sorted_file, split).where("rname = 'chr2' and pos >= 1000 and pos <= 30000")
    assert sorted(r.qname for r in begun.collect()) == sorted(r[1] for r in reads[0] if r[3] == "chr2" and 1000 <= r[4] <= 30_000)


def test_only_blocks_of_the_reference_are_read(reads, sorted_file, monkeypatch):
    """Bytes that tasks ask for are near the share of one reference, and far below the file."""
    size = open_at(sorted_file)[1]
    asked = []
    given = alignments.Blocks.fill

    def counting(self, wanted):
        before = self.at
        out = given(self, wanted)
        asked.append(self.at - before)
        return out

    monkeypatch.setattr(alignments.Blocks, "fill", counting)
    reader = alignments.BamReader([sorted_file], 30_000)
    reader.only = "chr1"
    rows = [row for p in reader.partitions() for row in reader.read(p)]
    share = sum(r[3] == "chr1" for r in reads[0]) / len(reads[0])
    assert len(rows) == sum(r[3] == "chr1" for r in reads[0])
    # a task needs the block that its last record ends in, and a first one to begin in
    tasks = len(reader.partitions())
    assert sum(asked) < share * size + (2 * tasks + 2) * 25_000
    asked.clear()
    reader = alignments.BamReader([sorted_file], 1 << 25)
    reader.only = "chrM"
    assert len([row for p in reader.partitions() for row in reader.read(p)]) == sum(r[3] == "chrM" for r in reads[0])
    assert sum(asked) < 0.5 * size


def test_a_file_without_an_index_and_one_that_is_not_sorted(spark, reads, tmp_path):
    path = str(tmp_path / "plain.bam")
    sink.bam(reads[1], HEAD, REFERENCES, path)
    assert bam_index.load(path) is None
    assert sorted(r.qname for r in alignments.fetched(spark, path, "chr1", 777, 778).collect()) == overlapping(reads[0], "chr1", 777, 778)
    with pytest.raises(Exception, match="not sorted"):
        bam_index.build(spark, path, 60_000)


def test_a_folder_of_sorted_files(spark, reads, tmp_path):
    folder = str(tmp_path / "many")
    sink.sorted_bam(reads[1], HEAD, REFERENCES, folder, single=False)
    paths = f"{folder}/part-*.bam"
    got = alignments.bam(spark, paths).orderBy("idx").collect()
    assert [r.qname for r in got] == [r[1] for r in in_order(reads[0])]
    assert sorted(r.qname for r in alignments.fetched(spark, paths, "chr2", 0, 50_000).collect()) == overlapping(reads[0], "chr2", 0, 50_000)


def test_parts_that_another_machine_keeps_are_an_error(reads, tmp_path, monkeypatch):
    given = sink.pafs.FileSelector
    monkeypatch.setattr(sink.pafs, "FileSelector", lambda path: given(str(tmp_path)))
    with pytest.raises(OSError, match="no folder that all machines share"):
        sink.bam(reads[1].limit(5), HEAD, REFERENCES, str(tmp_path / "x" / "y.bam"))


def test_sorting_of_nothing(spark, reads, tmp_path):
    path = str(tmp_path / "none.bam")
    sink.sorted_bam(reads[1].limit(0), HEAD, REFERENCES, path)
    assert alignments.bam(spark, path).count() == 0 and alignments.fetched(spark, path, "chr1").count() == 0
    with pytest.raises(ValueError, match="only BAM files"):
        commands.sort(spark, path, str(tmp_path / "x.sam"))
    commands.sort(spark, path, str(tmp_path / "again.bam"))
    assert bam_index.load(str(tmp_path / "again.bam")).unplaced == 0


def test_bins():
    import numpy as np

    starts = np.array([0, 16_383, 16_384, 0, 1 << 17, (1 << 26) - 1])
    ends = np.array([1, 16_385, 16_385, 1 << 29, (1 << 17) + 20_000, (1 << 26) + 1])
    assert bam_index.bins_of_records(starts, ends).tolist() == [4681, 585, 4682, 0, 586, 0]
    assert 4681 in set(bam_index.bins_over(0, 1)) and len(set(bam_index.bins_over(0, 1))) == 6


def test_a_record_is_made_without_an_array_of_its_own(monkeypatch):
    starts = [-1, 0, 5, 16_383, 16_384, (1 << 26) - 1, (1 << 29) - 2]
    wanted = [[int(bam_index.bins_of_records(np.array([s]), np.array([s + n]))[0]) & 0xFFFF for n in (1, 60, 1 << 15, 1 << 24)] for s in starts]

    def refused(*_):
        raise AssertionError("arrays for a single record")

    monkeypatch.setattr(bam_index, "bins_of_records", refused)
    assert [[sink.index_bin(s, s + n) for n in (1, 60, 1 << 15, 1 << 24)] for s in starts] == wanted
    assert sink.bam_record({"a": 0}, "q", 99, "a", 5, 60, "4M", "=", 9, 4, "ACGT", "IIII", {"NM": "0"})


def test_records_leave_a_reader_in_batches(spark, tmp_path):
    rows = spark.range(9_000).selectExpr("id AS idx", "concat('q', id) AS qname", "99 AS flag", "'a' AS rname", "cast(id AS int) AS pos", "60 AS mapq", "if(id % 2 = 0, '4M', '*') AS cigar", "'*' AS rnext", "-1 AS pnext", "0 AS tlen", "'ACGT' AS seq", "'IIII' AS qual", "if(id % 3 = 0, map('NM', '7'), map()) AS tags")
    path = str(tmp_path / "x.bam")
    sink.bam(rows.coalesce(1), "@HD\tVN:1.6\n", [("a", 100_000)], path)
    reader = alignments.BatchReader([path])
    parts = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in parts) == 9_000 and len(parts) < 9
    found = alignments.bam(spark, path)
    assert found.count() == 9_000
    assert found.where("cigar = '4M' and tags['NM'] = '7' and pos % 6 = 0 and qname = concat('q', pos)").count() == 1_500


def test_records_of_a_batch_are_those_made_one_by_one():
    rng = random.Random(5)
    rows = []
    for k in range(300):
        size = rng.choice([0, 1, 7, 20, 33])
        seq = "".join(rng.choice("ACGTNacgtRx=") for _ in range(size)) or rng.choice(["*", ""])
        qual = rng.choice(["*", "".join(chr(33 + rng.randrange(60)) for _ in range(size))])
        tags = {t: v for t, v in (("NM", str(rng.randrange(-3, 70_000))), ("MD", "3A" + str(k)), ("XX", "a b"), ("CB", "1")) if rng.random() < 0.6}
        cigar = rng.choice(["*", "20M", "5S10M100000N5M", "1M", "3I"])
        rows.append([f"q{k}" + "x" * rng.randrange(40), rng.randrange(1 << 12), rng.choice([None, "", "c1", "c2", "zz"]), rng.randrange(-1, 1 << 28), rng.randrange(256), cigar, rng.choice(["*", "=", "c1"]), rng.randrange(-1, 99), rng.randrange(-500, 500), seq, qual, rng.choice([None, tags]), None])
    kinds = [dict(zip(alignments.ARROW.names, alignments.ARROW.types, strict=True))[c] for c in sink.COLUMNS]
    # a part of a batch, so that arrays begin in the middle
    batch = pa.record_batch([pa.array([None if v is None else list(v.items()) if isinstance(v, dict) else v for v in c], t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=sink.COLUMNS).slice(17, 200)
    got = sink.bam_records({"c1": 0, "c2": 1}, batch)
    wanted = [sink.bam_record({"c1": 0, "c2": 1}, *r[:11], r[11] or {}) for r in rows[17:217]]
    assert got.sizes.tolist() == [len(x) for x in wanted] and got.data.tobytes() == b"".join(wanted)
    assert got.ref.tolist() == [{"c1": 0, "c2": 1}.get(r[2], -1) for r in rows[17:217]]
    # what only the other way tells
    odd = batch.set_column(12, "tag_types", pa.array([[("NM", "c")]] * 200, kinds[12]))
    assert sink.bam_records({"c1": 0}, odd) is None and sink.bam_records({"c1": 0}, batch.set_column(0, "qname", pa.array(["\u00e9"] * 200))) is None


def as_rows(batches):
    return [tuple(dict(v) if k > 11 else v for k, v in enumerate(r.values())) for b in batches for r in b.to_pylist()]


@pytest.mark.parametrize("at_once", [1 << 20, 3000, 50])
def test_batches_are_the_records_of_a_range(sorted_file, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(alignments, "READ_BYTES", at_once)
    rng, records = random.Random(4), []
    for k in range(3000):
        size, ops = rng.choice([0, 1, 4, 7, 30]), rng.choice([[], [4 << 4], [3 << 4, 20 << 4 | 3, 9 << 4]])
        seq, qual = bytes(rng.randrange(256) for _ in range((size + 1) // 2)), rng.choice([b"\xff" * size, bytes(rng.randrange(90) for _ in range(size))])
        ref = rng.choice([-1, 0, 1, 3])
        name = (b"\xc3\xa9" if k == 1500 else b"") + b"r%d" % k + b"x" * rng.randrange(5) + b"\0"
        body = struct.pack("<iiBBHHHiiii", ref, rng.randrange(-1, 900), len(name), rng.randrange(256), 0, len(ops), rng.randrange(1 << 16), size, rng.choice([-1, ref, 1]), rng.randrange(-1, 900), rng.randrange(-500, 500))
        body += name + struct.pack(f"<{len(ops)}I", *ops) + seq + qual + rng.choice([b"", raw_tags(), b"NMC\x07"])
        records.append(struct.pack("<i", len(body)) + body)
    odd, data = tmp_path / "odd.bam", b"".join(records)
    blocks = [data[k : k + 9000] for k in range(0, len(data), 9000)]
    odd.write_bytes(sink.header_blocks(HEAD, REFERENCES) + b"".join(map(sink.packed_block, [*blocks[:3], b"", *blocks[3:]])) + sink.END_BLOCK)
    for path in (sorted_file, str(odd)):
        size = open_at(path)[1]
        for split in (size, size // 3 + 1, 20_000):
            for start in range(0, size, split):
                wanted = list(alignments.bam_records(path, None, 2, start, start + split))
                assert as_rows(alignments.bam_batches(path, None, 2, start, start + split)) == wanted
        assert as_rows(alignments.bam_batches(path, "chr1")) == list(alignments.bam_records(path, "chr1"))
        offsets = [o for o, _ in alignments._bodies(path, 4, skipped=alignments._skipped(REFERENCES))]
        first, stop = offsets[300], offsets[900]
        assert as_rows(alignments.bam_batches(path, None, 0, first >> 16, None, first, stop)) == list(alignments.bam_records(path, None, 0, first >> 16, None, first, stop))
    cut = tmp_path / "cut.bam"
    cut.write_bytes(sink.header_blocks(HEAD, REFERENCES) + sink.packed_block(data[:-3]) if len(data) < 60_000 else sink.header_blocks(HEAD, REFERENCES) + sink.packed_block(data[:50_000]))
    with pytest.raises(ValueError, match="cut off"):
        list(alignments.bam_batches(str(cut)))
