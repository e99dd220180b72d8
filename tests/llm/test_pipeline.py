"""The trained queries and the pipeline over tables with every odd kind of row, against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from cellstrand.llm import byte_bpe, quality, queries, toxicity
from tests.llm.test_dedup import brute_hits, brute_join, brute_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "score", "predicted", "component_id", "chunk", "k", "n_hit", "row"]


@pytest.fixture(scope="module")
def odd(sf_dir, tmp_path_factory):
    """A folder of tables with null ids and texts, repeated rows, a very long text and columns of clashing names; and the rows."""
    folder = tmp_path_factory.mktemp("odd")
    docs, labels, benchmark = (pd.read_parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rng = random.Random(1)
    words = [w for t in docs.text.dropna().head(40) for w in t.split()]
    passage, item = " ".join(rng.choices(words, k=60)), benchmark.text.iloc[0]
    more = [(None, None), (None, "no id but words of its own here"), (900_001, None), (900_002, ""), (900_003, " \t\n"), (900_004, " ".join(rng.choices(words, k=120_000)))]
    more += [(900_010, f"{passage} first tail"), (900_010, f"{passage} first tail"), (None, f"{passage} first tail"), (900_011, "other head and words " * 3 + passage), (900_012, f"a b c {item} d e f"), (900_013, "tiny")]
    rows = [(None if pd.isna(d) else int(d), t) for d, t in zip(docs.doc_id, docs.text, strict=True)] + more
    table = pd.DataFrame({"doc_id": pd.array([d for d, _ in rows], dtype="Int64"), "text": [t for _, t in rows], "lang": "xx", "source": "s", "n_chars": pd.array([len(t or "") for _, t in rows], dtype="Int64")})
    for k, name in enumerate(COLUMNS[5:]):
        table[name] = k
    table.to_parquet(f"{folder}/documents.parquet")
    labels.to_parquet(f"{folder}/labels.parquet")
    benchmark.to_parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, labels, [(int(i), t.encode()) for i, t in zip(benchmark.item_id, benchmark.text, strict=True)]


def sample_of(spark, rows, labels, label, folds, fold):
    """What the model may learn from: every labelled row of the other folds, as there are few."""
    text = {}
    for d, t in rows:
        if d is not None:
            text[d] = min(text.get(d, t or ""), t or "")
    known = {int(d): int(y) for d, y in zip(labels.doc_id, labels[label], strict=True)}
    own = sorted(d for d in known if d in text and zlib.crc32(str(d).encode()) % folds != fold)
    return [text[d] for d in own], [known[d] for d in own]


@pytest.mark.parametrize(("name", "module", "label", "folds", "fold", "least"), [("op1_toxicity", toxicity, "toxic", 3, 1, queries.TOXIC_FROM), ("op10_quality", quality, "quality", 5, 0, queries.GOOD_FROM)])
def test_scores_of_whole_tables(spark, odd, name, module, label, folds, fold, least):
    folder, rows, labels, _ = odd
    model = module.train(*sample_of(spark, rows, labels, label, folds, fold))
    scores = model.scores([t or "" for _, t in rows])
    held = [d is not None and zlib.crc32(str(d).encode()) % folds == fold for d, _ in rows]
    wanted = sorted((str(d), h, round(float(s), 4), int(s >= least)) for (d, _), h, s in zip(rows, held, scores, strict=True))
    got = sorted((str(r.doc_id), r.held_out, round(r.score, 4), r.predicted) for r in getattr(queries, name)(spark, folder).collect())
    assert got == wanted


@pytest.mark.parametrize(("name", "label", "right"), [("op1_toxicity", "toxic", 0.95), ("op10_quality", "quality", 0.97)])
def test_held_out_accuracy_of_the_query(spark, name, label, right):
    folder = "/root/testdata/sf0.1"
    labels = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id")[label].to_dict()
    told = [(labels[r.doc_id], r.predicted) for r in getattr(queries, name)(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert len(told) > 300 and np.mean([a == b for a, b in told]) > right


def test_pipeline_against_plain_python(spark, odd):
    import corpus_pipeline

    folder, rows, labels, items = odd
    model = toxicity.train(*sample_of(spark, rows, labels, "toxic", 3, 1))
    rows = [r for r, s in zip(rows, model.scores([t or "" for _, t in rows]), strict=True) if s < corpus_pipeline.TOXIC_FROM]
    # the join's brute force names a component by its least key; keys order rows with ids before those without
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    joined = brute_join([(n, rows[k][1]) for n, k in enumerate(order)])
    rows = [rows[k] for n, k in enumerate(order) if joined[n][1] == n or joined[n][0] == 0]
    raw = [(t or "").encode() for _, t in rows]
    cut = [np.frombuffer(t, dtype=np.uint8)[~g].tobytes().decode("utf-8", "ignore") for t, g in zip(raw, brute_repeats(raw, 200), strict=True)]
    hits = brute_hits_fast([t.encode() for t in cut], items)
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    wanted = []
    for (d, _), t, hit in zip(rows, cut, hits, strict=True):
        if not hit:
            ids = encoder.encode_ordinary(t)
            wanted.append((str(d), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got) == sorted(wanted)


def brute_hits_fast(texts, items):
    """Whether each text holds a window: as brute_hits, which it is held against on a few, by a set of windows."""
    from cellstrand.llm.decontaminate import words_of

    windows = set()
    for _, t in items:
        b = words_of(t)
        windows |= {tuple(b[a : a + 10]) for a in range(max(1, len(b) - 9))} - {()}
    sizes = {len(w) for w in windows}
    out = []
    for t in texts:
        words = words_of(t)
        out.append(any(tuple(words[s : s + n]) in windows for n in sizes for s in range(len(words) - n + 1)))
    few = [k for k in range(len(texts)) if len(texts[k]) < 300][:8]
    assert few and [out[k] for k in few] == [h[4] for h in brute_hits([texts[k] for k in few], items)]
    return out


def test_every_stage_keeps_the_columns(spark, odd):
    import corpus_pipeline

    docs = spark.read.parquet(f"{odd[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, odd[0])
        assert after.schema == docs.schema, name
        assert after.count() > 0
