"""Byte-level BPE and token files against the libraries, neighbours against all pairs, and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellstrand.llm import ann, byte_bpe, chunks, queries, token_files
from cellstrand.llm.common import spread

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EDGES = ["", " ", "  a", "a  b", "a \n b", "don't we'll I'M", "tab\tx", " x y", "x  y", "a" * 3000, "漢字 かな", "<|endoftext|> z", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>y. <|endoftext", "Слово слово, ελληνικά 𐓏𐓘 ", "\x00\x01", "é" * 200, " lead", "trail "]


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sample_texts(spark, sf_dir):
    return [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def test_bpe_against_the_library(reference):
    rng = random.Random(1)
    own = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    texts = EDGES + ["".join(rng.choice("ab th e\n \t'sé1 2!? 　 漢") for _ in range(rng.randint(0, 90))) for _ in range(800)]
    counts, encoded, decoded = own.digests(texts)
    for text, n, e, d in zip(texts, counts, encoded, decoded, strict=True):
        ids = reference.encode_ordinary(text)
        assert (n, e, d) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    for piece in (b"x" * 5000, bytes(rng.choice(b"abcde") for _ in range(3000))):
        assert own.bpe.encode_piece(piece) == own.bpe._encode_rows([piece], 8192)[0] == reference.encode_ordinary(piece.decode())


def test_bpe_query_and_columns(spark, sf_dir, reference):
    got = {r.doc_id: r for r in queries.op8_byte_bpe(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert got[r.doc_id].n_tokens == len(reference.encode_ordinary(r.text or "")) and got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    docs = spark.createDataFrame([(1, "some text"), (1, None)], "doc_id long, text string")
    both = docs.select(byte_bpe.encode(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("ids")).select("ids", byte_bpe.decode(F.col("ids"), RANKS, public_tokenizers.PATTERN).alias("back")).collect()
    assert [bytes(r.back) for r in both] == [b"some text", b""]
    assert byte_bpe.encoding_digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_chunks_put_together_are_the_text():
    memory = chunks.ChunkMemory(lambda many: [(c,) for c in many], limit=3)
    for text in [*EDGES, *EDGES]:
        assert "".join(c for (c,) in memory.values([text])[0]) == text


def hashes(spark, texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", F.xxhash64("t").alias("h")).collect()
    return {r.k: r.h for r in rows}


def test_token_files_against_the_library(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(k * 3 % 17, t) for k, t in enumerate(EDGES)] + [(None, "null id"), (50, None), (50, None)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").repartition(5)
    url = f"file://{tmp_path}/tokens"
    shards = token_files.write(docs, url, path, 2)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read(shards, url).collect()))
    start, wanted, hashed = 0, [], hashes(spark, [t for _, t in rows])
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, hashed[k])):
        d, t = rows[k]
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        wanted.append((start, d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == wanted
    first = shards.orderBy("shard").first()
    assert token_files.document(url, first.shard, 0).tolist() == [*library.encode("null id", add_special_tokens=False).ids, 2]
    assert token_files.round_trip(docs.limit(0), path, 2).count() == 0
    assert token_files.width(70_000, 2) == "<u4"


def test_special_strings_become_their_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    special = Tokenizer.from_file(path).token_to_id("<|endoftext|>")
    row = np.frombuffer(token_files.Encoder(path, "<u2").rows(["plain", "a <|endoftext|> b"])[1], dtype="<u2")
    assert len(row) == 4 and special in row


def test_rows_of_one_id_are_spread_over_shards(spark, tmp_path):
    docs = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    shards = token_files.write(docs, str(tmp_path / "hot"), public_tokenizers.path("byte_bpe_50k.json"), 2, shard_bytes=1000).collect()
    assert len(shards) > 8 and max(r.n_docs for r in shards) < 200 and sum(r.n_docs for r in shards) == 600
    assert [r.base for r in shards] == np.r_[0, np.cumsum([r.n_tokens for r in shards])][:-1].tolist()


def test_bases_are_sums_over_runs_and_within_them(spark):
    told = spark.createDataFrame([(shard, 1, shard * shard) for shard in range(0, 50, 3)], "shard int, n_docs long, n_tokens long")
    wanted, base = [], 0
    for shard in range(0, 50, 3):
        wanted.append((shard, base, 1, shard * shard))
        base += shard * shard
    for size in (1, 4, 7, 1000):
        assert sorted(tuple(r) for r in token_files.based(told, size).collect()) == wanted
    assert token_files.based(told.limit(0)).count() == 0


def test_pieces_of_work_are_dealt_to_a_bounded_number_of_tasks(spark):
    for count, most in ((3, 4), (30, 30), (900, 64)):
        dealt = spread(spark.range(count).withColumnRenamed("id", "chunk"), "chunk")
        assert dealt.rdd.getNumPartitions() == most
        assert sorted(r.chunk for r in dealt.collect()) == list(range(count))


def test_token_files_query_against_the_library(spark, sf_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op9_token_files(spark, sf_dir).orderBy("start").collect()]
    start, wanted = 0, []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        wanted.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert got == wanted


def test_neighbours_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])
    found = {}
    for r in queries.op7_ann(spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    recall = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[q]).sum(1)
        score[q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        own = found[int(ids[q])]
        recall.append(len(set(best.tolist()) & {v for v, _ in own}) / 20)
        assert len(own) == 20 and all(abs(s - score[ids == v][0]) < 1e-12 for v, s in own)
    assert np.mean(recall) >= 0.9


def test_neighbours_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [3.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (40, [0.0, 0.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(vectors, F.col("vec_id") % 20 == 0, k=3, share=1.0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3, 3.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (20, 1, 3, 1.5), (20, 2, 0, 0.5), (20, 3, 1, 0.5)]
    assert ann.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(vectors.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
    blocks = ann.search(vectors, F.col("vec_id") % 20 == 0, k=3, share=1.0, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in blocks] == got


def test_a_truncated_vector_does_not_set_the_dimension(spark):
    rng = np.random.default_rng(1)
    ids = spark.range(200).select(F.col("id").alias("vec_id"))
    first = ids.orderBy(F.xxhash64("vec_id"), "vec_id").first().vec_id
    vectors = {k: rng.normal(size=4).tolist() for k in range(200)} | {first: [1.0, 2.0]}
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=3, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    whole = [k for k in vectors if k != first]
    assert got == {q: sorted((k for k in whole if k != q), key=lambda k: -np.dot(vectors[q], vectors[k]))[:3] for q in whole if q % 20 == 0}


def test_many_equal_vectors(spark):
    rng = np.random.default_rng(0)
    vectors = [[1.0, 2.0, 3.0]] * 300 + rng.normal(size=(300, 3)).tolist()
    table = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in ann.search(table, F.col("vec_id") == 100, k=5, share=0.9).orderBy("rank").collect()]
    assert len(got) == 5 and all(v < 300 for v in got)


def test_rows_that_share_an_id_have_lists_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 3.0]), (1, [2.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(table, F.col("vec_id") % 20 == 0, k=3, share=1.0).collect())
    assert got == sorted([(20, 1, 1, 2.0), (20, 2, 1, 2.0), (20, 3, 2, 0.0), (20, 1, 2, 3.0), (20, 2, 1, 0.0), (20, 3, 1, 0.0)])


def test_only_leaves_that_a_query_takes_are_multiplied():
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(60, 24))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    points = np.repeat(middle, 100, axis=0) + rng.normal(size=(6000, 24)) * 0.01
    sample = points[rng.choice(6000, 2000, replace=False)]
    forest = ann.Forest(sample, float(np.linalg.norm(points, axis=1).max()))
    forest.fit_share(sample, 7)
    place = forest.leaves(points)
    parts = ann.Parts(np.stack([np.bincount(p, minlength=1 << forest.depth) for p in place]), 500)
    batch = pa.record_batch([pa.array(np.arange(6000)), pa.array(np.arange(6000)), pa.array([p.tobytes() for p in points])], names=["row", "vec_id", "vector"])
    queries = pa.Table.from_batches([ann.dealt_queries(forest, parts, batch.take(pa.array(np.arange(0, 6000, 20))))])
    rows = pa.Table.from_batches([ann.dealt_rows(forest, parts, batch)])
    products, found = 0, {}
    for part in range(parts.count):
        near, more = ann.nearest_in_part(rows.filter(pc.equal(rows["part"], part)), queries.filter(pc.equal(queries["part"], part)), 24, 10)
        products += more
        for q, v in zip(near["query_id"].to_pylist(), near["vec_id"].to_pylist(), strict=True):
            found.setdefault(q, set()).add(v)
    assert products < 0.2 * 300 * 6000
    recall = []
    for q in range(0, 6000, 20):
        score = points @ points[q]
        score[q] = -np.inf
        recall.append(len(set(np.argsort(-score)[:10].tolist()) & found[q]) / 10)
    assert np.mean(recall) >= 0.9


def test_recall_on_rows_that_the_forest_was_not_fitted_on(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(4000, 16))
    table = spark.createDataFrame([(k, v) for k, v in enumerate(points.tolist())], "vec_id long, embedding array<double>")
    own = table.withColumn("h", F.xxhash64("vec_id"))
    fitted = {r.vec_id for r in own.orderBy("h", "vec_id").limit(800).collect()}
    found = {}
    for r in ann.search(table, F.col("vec_id") % 20 == 0, k=20, sample=800, part_rows=150, block=50).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    outside = [q for q in range(0, 4000, 20) if q not in fitted]
    recall = []
    for q in outside:
        score = points @ points[q]
        score[q] = -np.inf
        assert [n for n, _ in sorted(found[q])] == list(range(1, 21))
        recall.append(len(set(np.argsort(-score)[:20].tolist()) & {v for _, v in found[q]}) / 20)
    assert len(outside) > 100 and np.mean(recall) >= 0.9


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns and after.schema == docs.schema, name
        count = after.count()
        assert 0 < count <= before
        docs, before = after, count
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert tokens.count() == before
    assert corpus_pipeline.run(spark, sf_dir).count() == before


def test_pipeline_of_nothing(spark, sf_dir):
    import corpus_pipeline

    none = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
