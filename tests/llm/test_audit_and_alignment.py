"""Cross-tokenizer alignment and the filter audit against plain Python, exact top-k against all products."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellstrand.llm import filter_audit, pivot_topk, queries, token_alignment
from tests.oracle import assert_same

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = [None, "", " ", "  a", "a  b", "a \n b", "don't we'll I'M", "tab\tx", " x y", "x  y", "x \x1c y", "a" * 3000, "漢字 かな", "<|endoftext|> z", "<s> </s><unk> <0x41>", "a▁b c", "Слово слово, ελληνικά 𐓏𐓘 ", "\x00\x01", "é" * 200, "lead ", "　wide　 x", "\xa0 n", "é ﬁ"]


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    table.update({chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in plain)})
    return table


@pytest.fixture(scope="module")
def whole_texts():
    """(groups, links) of a whole text, from the libraries alone."""
    a, b, byte = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), letters()
    a.encode_special_tokens = True
    piece_bytes = []
    for k in range(b.get_piece_size()):
        p = b.id_to_piece(k)
        m = re.fullmatch("<0x(..)>", p)
        piece_bytes.append(bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode())

    def ends(pieces):
        return np.cumsum([len(p) for p in pieces]).tolist()

    def one(text):
        if not text:
            return None
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs, ys = [bytes(byte[c] for c in a.id_to_token(k)) for k in x], [piece_bytes[k] for k in y]
        if b"".join(xs) != (" " + text).encode() or b"".join(ys) != (" " + text).encode():
            return None
        by_end = dict(zip(ends(ys), y, strict=True))
        groups, links, own_a, own_b, j = [], [], [], [], 0
        y_ends = ends(ys)
        for end, k in zip(ends(xs), x, strict=True):
            own_a.append(k)
            if end in by_end:
                while j < len(y) and y_ends[j] <= end:
                    own_b.append(y[j])
                    j += 1
                groups.append((own_a, own_b))
                links.append((k, by_end[end]))
                own_a, own_b = [], []
        return x, y, groups, links

    return one


def expected(rows, whole_texts):
    found = [(d, whole_texts(t)) for d, t in rows]
    count = Counter(p for _, f in found if f for p in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for d, f in found:
        if f is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_alignment_of_odd_texts(spark, whole_texts):
    rng = random.Random(4)
    texts = EDGES + ["".join(rng.choice("ab th e\n \t'sé1 2!? 　漢▁\x1c\xa0") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    rows = [(k % 300, t) for k, t in enumerate(texts)] + [(None, "null id")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, pair string, n int").repartition(5)
    for chunk_bytes in (300, 1 << 20):
        got = token_alignment.alignment(docs, A, B, chunk_bytes)
        assert got.columns == token_alignment.COLUMNS
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows, whole_texts)
    assert token_alignment.alignment(docs.limit(0), A, B).count() == 0
    own = token_alignment.aligned(docs.where("doc_id = 6"), A, B).collect()
    assert [[(list(g.a), list(g.b)) for g in r.groups] for r in own if r.groups][0] == whole_texts(EDGES[6])[2]


def test_alignment_of_the_whole_table(spark, sf_dir, whole_texts):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.op11_token_alignment(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows, whole_texts)


def test_a_worker_that_forgets_gives_the_same():
    aligner = token_alignment.Aligner(A, B)
    small, large = token_alignment.Memory(aligner, 3), token_alignment.Memory(aligner)
    texts = ["one two three four five", "six seven", "one two", ""]
    for _ in range(2):
        assert list(token_alignment.measured(small, texts)) == list(token_alignment.measured(large, texts))


def test_long_cuts_are_not_kept():
    own = token_alignment.Memory(token_alignment.Aligner(A, B))
    texts = ["漢字" * 100 + " short", "short " + "漢字" * 100]
    first = list(token_alignment.measured(own, texts))
    assert any(len(c) > token_alignment.LONGEST for c in own.known)
    assert list(token_alignment.measured(own, texts)) == first
    own.rows(["other"])
    assert "short" in own.known and all(len(c) <= token_alignment.LONGEST for c in own.known)


def judged(rows, labels):
    """The audit by going through every order for every document."""
    good, toxic = ({r[0] for r in labels if r[k] == 1} - {None} for k in (1, 2))
    out = Counter()
    keys = set()
    for d, part, text in rows:
        text, part = text or "", part or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": d is not None and any(e is not None and e < d and (u or "") == text for e, _, u in rows),
        }
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                keys.add(key)
                out[key, "redundant"] += fails[f] and gone
                out[key, "unique_fails"] += [x for x in fails if fails[x]] == [f]
                if fails[f] and not gone:
                    out[key, "removed"] += 1
                    out[key, "good_lost"] += d in good
                    out[key, "toxic_lost"] += d in toxic
                    out[part, f] += 1
                    gone = True
                out[key, "kept"] += not gone
    return sorted((*key, *[out[key, c] for c in filter_audit.COUNTS[:-1]], out[key[0], key[1][key[2] - 1]]) for key in keys)


def test_audit_of_odd_rows(spark):
    rng = random.Random(2)
    long = " ".join(f"word{k}" for k in range(60))
    texts = [None, "", long, long + " $5", "UP DOWN", " ".join(["same"] * 80), "\x0b\x0c x\xa0y", "é É \x00", " ".join(f"W{k}" for k in range(3000))]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]), rng.choice(["a", None, "", "b c"]), rng.choice(texts)) for _ in range(120)]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, 1, 1), (None, 1, 1), (9, 1, 1), (4, None, None)]
    docs = spark.createDataFrame([(d, s, t, 7, b"x") for d, s, t in rows], "doc_id long, source string, text string, mask int, digest binary")
    told = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, good int")
    got = filter_audit.audit(docs, told)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS]
    assert sorted(tuple(r) for r in got.collect()) == judged(rows, labels)
    assert filter_audit.audit(docs.limit(0), told).count() == 0
    none = filter_audit.audit(docs, told.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.sum("removed")).first()
    assert none[0] == none[1] == 0 < none[2]


def test_audit_query_against_sql(spark, sf_dir):
    assert_same(queries.op12_filter_audit(spark, sf_dir), filter_audit.ORACLE, sf_dir)


def brute_topk(vectors, k, every=100):
    """(query, rank, id, score) by Python's own integers; rows are told apart by their place."""
    dim = max(len(v) for _, v in vectors)
    whole = [(i, [*(int(np.floor(np.float64(1024) * np.float64(x))) for x in v), *[0] * (dim - len(v))]) for i, v in vectors]
    out = []
    for q, (i, v) in enumerate(whole):
        if i is not None and i % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0, p) for p, (j, w) in enumerate(whole) if p != q]
            out += [(i, rank, None if null else j, -s) for rank, (s, null, j, _) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_topk_query_against_sql(spark, sf_dir):
    assert_same(queries.op13_exact_topk(spark, sf_dir), pivot_topk.ORACLE, sf_dir)


def test_topk_of_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rng = np.random.default_rng(1)
    fine = [(0, [1.0, 0.0]), (100, [-0.5, 0.5]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (200, [0.0, 0.0]), (300, []), (None, [1.0, 1.0]), (100, [3.0, 1e-9]), (7, [0.1])]
    fine += [(1000 + k, v) for k, v in enumerate(rng.normal(size=(150, 2)).round(1).tolist())]
    bad = [(400, None), (500, [nan, 1.0]), (600, [inf, 1.0]), (700, [None, 1.0])]
    table = spark.createDataFrame([(i, v, 1) for i, v in fine + bad], "vec_id long, embedding array<double>, rank int").repartition(3)
    got = pivot_topk.search(table, F.col("vec_id") % 100 == 0, k=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_topk(fine, 10)
    assert pivot_topk.search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert pivot_topk.search(table.where("vec_id = 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_topk_of_large_components(spark):
    vectors = [(k * 50, [(-1.0) ** k * 1e10 * k, 3e9 + k]) for k in range(12)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    clip = [(q, r, j, max(-(2**63), min(2**63 - 1, s))) for q, r, j, s in brute_topk(vectors, 12)]
    got = pivot_topk.search(table, F.col("vec_id") % 100 == 0, k=12).collect()
    assert sorted((r.query_id, r.score) for r in got) == sorted((q, s) for q, _, _, s in clip)


def test_clustered_vectors_leave_annuli_unopened(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "SLAB_ROWS", 300)
    monkeypatch.setattr(pivot_topk, "FIRST_ROWS", 128)
    monkeypatch.setattr(pivot_topk, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(20, 8))
    points = (np.repeat(middle / np.linalg.norm(middle, axis=1, keepdims=True), 100, axis=0) + rng.normal(size=(2000, 8)) * 0.01).tolist()
    points[500:1200] = [points[500]] * 700
    vectors = list(enumerate(points))
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    opened = []
    got = pivot_topk.search(table, F.col("vec_id") % 100 == 0, k=10, pivots=16, opened=opened)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_topk(vectors, 10)
    annuli = len(opened) and sum(opened)
    index = pivot_topk.indexed(pivot_topk.integers(table, F.lit(False), 1024, "vec_id", "embedding"), pivot_topk.space_of(pivot_topk.integers(table, F.lit(False), 1024, "vec_id", "embedding"), 16))
    assert annuli < 0.5 * 20 * index.select("annulus").distinct().count()
