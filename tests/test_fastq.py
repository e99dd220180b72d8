"""FASTQ files in ranges of bytes against the same files read from their beginning."""

import gzip
import random

import pytest

from cellstrand.sinks import bam
from cellstrand.sources import fastq


def reads(seed, n, most=80):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.choice([0, 1, rng.randrange(most)])
        sequence = "".join(rng.choice("ACGTN") for _ in range(size))
        # qualities that look like titles and plus lines
        quality = "".join(rng.choice("@+I#") for _ in range(size))
        out.append((f"{rng.choice('@+r')}{k}", f" {'x' * rng.randrange(12)}" * rng.randrange(2), sequence, quality))
    return out


def text_of(rows, end="\n", last=True):
    text = "".join(f"@{name}{more}{end}{s}{end}+{end}{q}{end}" for name, more, s, q in rows)
    return (text if last else text.removesuffix(end)).encode()


def write(path, kind, data, block=700):
    if kind == "gzip":
        data = gzip.compress(data)
    elif kind == "blocked":
        blocks = [bam.packed_block(data[k : k + block]) for k in range(0, len(data), block)]
        blocks.insert(3, bam.packed_block(b""))
        data = b"".join(blocks) + bam.END_BLOCK
    path.write_bytes(data)
    return str(path)


@pytest.mark.parametrize("kind", ["plain", "blocked"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_cut_gives_the_same_records(tmp_path, kind, end):
    """Ranges of every size, also of less than a record or a block, put together."""
    path = write(tmp_path / "x", kind, text_of(reads(1, 60), end, last=end == "\r\n"), block=97)
    assert fastq.kind_of(path) == kind
    whole = list(fastq.records(path))
    assert len(whole) == 60
    for split in [1, 7, 50, 64, 97, 333, 1000, 1 << 20]:
        assert [r for start, stop in fastq.file_ranges(path, split) for r in fastq.ranged_records(path, start, stop)] == whole, split


@pytest.mark.parametrize("kind", ["plain", "blocked", "gzip"])
def test_numbers_are_those_of_the_serial_reader(spark, tmp_path, kind):
    paths = [write(tmp_path / f"{k}.fastq", kind, text_of(reads(k, 500))) for k in range(2)]
    found = fastq.fastq(spark, ",".join(paths), split=3000)
    wanted = [(p, idx, *r) for p in paths for idx, r in enumerate(fastq.records(p), 1)]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert found.rdd.getNumPartitions() == 2 if kind == "gzip" else found.rdd.getNumPartitions() > 4
    assert sorted(r.idx for r in found.where("idx <= 3").collect()) == [1, 1, 2, 2, 3, 3]


@pytest.mark.parametrize("kinds", [("plain", "plain", "plain"), ("blocked", "plain", "blocked"), ("plain", "gzip", "plain")])
def test_triplets_in_step(spark, tmp_path, kinds):
    """Files of unequal record sizes and lengths: record n of each, to the end of the shortest."""
    paths = [write(tmp_path / f"{k}.fastq", kind, text_of(reads(k, n, most))) for k, (kind, n, most) in enumerate(zip(kinds, (900, 950, 870), (20, 200, 60), strict=True))]
    wanted = [(idx, *three) for idx, three in enumerate(zip(*map(fastq.records, paths), strict=False), 1)]
    assert len(wanted) == 870
    found = fastq.triplets(spark, *paths, split=5000)
    assert sorted((r.idx, tuple(r.lig), tuple(r.umi), tuple(r.bio)) for r in found.collect()) == wanted
    assert (found.rdd.getNumPartitions() == 1) == ("gzip" in kinds)
    assert sorted(r.idx for r in found.where("idx <= 600").collect()) == list(range(1, 601))
    assert sorted(r.idx for r in found.where("idx < 3").collect()) == [1, 2]


def test_a_limit_leaves_tasks_out(spark, tmp_path):
    path = write(tmp_path / "x", "plain", text_of(reads(3, 900)))
    reader = fastq.FastqReader(fastq._plan(spark, fastq.planned(spark, [(path,)], 2000)))
    every = len(reader.partitions())
    reader.most = 5
    assert every > 10 and len(reader.partitions()) == 1
    assert [row[1] for p in reader.partitions() for row in reader.read(p)] == [1, 2, 3, 4, 5]


def test_what_is_no_record_is_an_error_in_any_range(spark, tmp_path):
    data = text_of(reads(5, 300)) + b"@cut\nACGT\n+\nII\n" + text_of(reads(6, 300))
    path = write(tmp_path / "x", "plain", data)
    with pytest.raises(Exception, match="not a FASTQ record"):
        fastq.fastq(spark, path, split=2000).collect()


def test_empty_files(spark, tmp_path):
    paths = [write(tmp_path / f"{k}", kind, b"") for k, kind in enumerate(("plain", "gzip"))]
    assert fastq.fastq(spark, ",".join(paths)).count() == 0
    assert fastq.triplets(spark, paths[0], paths[1], paths[0]).count() == 0


def test_batches_have_the_records_and_tasks_are_bounded(spark, tmp_path, monkeypatch):
    path = write(tmp_path / "x.fastq", "plain", text_of(reads(3, 700)))
    monkeypatch.setattr(fastq, "MOST_TASKS", 4)
    monkeypatch.setattr(fastq, "BATCH", 50)
    plan = fastq._plan(spark, fastq.planned(spark, [(path,)], 1000))
    plain, batched = fastq.FastqReader(plan), fastq.BatchReader(plan)
    assert len(plain.partitions()) > 20 and len(batched.partitions()) <= 4
    wanted = [row for p in plain.partitions() for row in plain.read(p)]
    found = [b for p in batched.partitions() for b in batched.read(p)]
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == wanted and max(map(len, found)) <= 50
