"""Toxicity, quality, token counts and language-model scores."""

import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellstrand.llm import lm_scoring, quality, queries, token_counts, toxicity, wordhash
from tests.oracle import assert_same


def labelled(sf_dir, label):
    return duckdb.sql(f"select doc_id, text, {label} from '{sf_dir}/documents.parquet' join '{sf_dir}/labels.parquet' using (doc_id) order by doc_id").fetchall()


@pytest.fixture(scope="module")
def larger():
    import os

    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("the driver's tables are not here")
    return folder


def test_toxicity_held_out_accuracy(larger):
    rows = labelled(larger, "toxic")
    held = [zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in rows]
    learn = [r for r, h in zip(rows, held, strict=True) if not h]
    toxic, clean = [r for r in learn if r[2]], [r for r in learn if not r[2]]
    model = toxicity.train([r[1] for r in toxic + clean[: 2 * len(toxic)]], [1] * len(toxic) + [0] * min(len(clean), 2 * len(toxic)))
    test = [r for r, h in zip(rows, held, strict=True) if h]
    said = model.scores([r[1] for r in test]) >= queries.TOXIC_FROM
    truth = np.array([r[2] for r in test]) == 1
    assert said[truth].mean() > 0.75 and said[~truth].mean() < 0.05


def test_toxicity_hashes_a_gram_of_unseen_words_once(monkeypatch):
    weight = np.random.default_rng(1).normal(size=toxicity.BUCKETS).astype(np.float32).astype(float)
    words = ["fool", "fools", "foolish", "x", "über", "foolishness"]
    wanted = [weight[toxicity.subwords(w)].mean() for w in words]
    hashed, own = [], toxicity.bucket
    monkeypatch.setattr(toxicity, "bucket", lambda g: hashed.append(g) or own(g))
    assert toxicity.Model(weight, 0.0).word_numbers(words).tolist() == pytest.approx(wanted, abs=1e-14)
    assert "<foo" in hashed and len(hashed) == len(set(hashed))
    monkeypatch.setattr(toxicity, "REMEMBERED_GRAMS", 3)
    assert toxicity.Model(weight, 0.0).word_numbers(words).tolist() == pytest.approx(wanted, abs=1e-14)


def test_toxicity_edges():
    model = toxicity.train(["you idiot fool", "idiot here", "idiot"] * 5, [1] * 15)
    assert list(model.scores(["", "x"])) == [0.5, 0.5]
    texts = ["such an idiot today"] * 10 + ["a fine day today"] * 10
    model = toxicity.train(texts, [1] * 10 + [0] * 10)
    one, other, empty, marks, long = model.scores(["an idiot", "a fine day", "", "%% !!", "fine day " * 50_000 + "idiot"])
    assert one > other and empty == marks and 0 < empty < 1 and long > other
    # a misspelling that was never seen shares n-grams
    assert model.scores(["idiott"])[0] > model.scores(["sunny"])[0]


def test_spans_begin_at_every_word():
    numbers = np.array([0.0, 9, 9, 9, 9, 9, 0, 0, 1, 0])
    wanted = [numbers[k : k + toxicity.SPAN].mean() for k in range(len(numbers) - toxicity.SPAN + 1)]
    assert toxicity.span_means(numbers) == pytest.approx(wanted) and max(wanted) == 9
    assert list(toxicity.span_means(numbers[:3])) == [6.0]


def test_quality_held_out_accuracy(larger):
    rows = labelled(larger, "quality")
    held = [zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows]
    learn = [r for r, h in zip(rows, held, strict=True) if not h]
    model = quality.train([r[1] for r in learn], [r[2] for r in learn])
    test = [r for r, h in zip(rows, held, strict=True) if h]
    said = model.scores([r[1] for r in test]) >= queries.GOOD_FROM
    truth = np.array([r[2] for r in test]) == 1
    assert said[truth].mean() > 0.98 and said[~truth].mean() < 0.02


def test_quality_edges():
    assert list(quality.train(["a", "b"], [1, 1]).scores(["a", ""])) == [0.5, 0.5]
    model = quality.train(["one two three four. five six", "a a a a a a a"] * 4, [1, 0] * 4)
    scores = model.scores(["", "  ", "x", "\x00", "é" * 100_000])
    assert np.all((scores >= 0) & (scores <= 1)) and scores[0] == scores[1]


def test_scores_over_tables(spark):
    docs = spark.createDataFrame([(1, "an idiot", 5), (1, "an idiot", 5), (2, None, 5), (None, "a fine day", 5), (4, "", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, 0, None)], "doc_id long, toxic int, quality int")
    for module in (toxicity, quality):
        model = module.fit(docs, labels)
        rows = module.score(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert module.score(docs.limit(0), model).count() == 0
    kept = toxicity.below(docs, toxicity.train(["idiot"] * 5 + ["day"] * 5, [1] * 5 + [0] * 5), 2.0)
    assert kept.columns == docs.columns and kept.count() == 5


def test_very_long_texts_are_no_sample(spark):
    docs = spark.createDataFrame([(1, "an idiot " * 40_000), (2, "a fine day"), (3, "an idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, "toxic", F.lit(True))
    assert sample == [("a fine day", 0), ("an idiot", 1)]


def greedy(initial, continuation, word):
    at, found, pieces = 0, 0, initial
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, found, pieces = end, found + 1, continuation
    return found


def test_longest_match_against_greedy():
    rng = random.Random(3)

    def pieces():
        return {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 10))}

    for _ in range(300):
        initial, continuation = pieces(), pieces()
        own = token_counts.LongestMatch(initial, continuation)
        for _ in range(20):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12)))
            assert own.count(word) == greedy(initial, continuation, word)


def test_token_counts_over_a_table(spark, sf_dir):
    import json

    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    letters = token_counts.byte_of_letter()
    vocabulary = [bytes(letters[c] for c in t) for t in json.load(open(path, encoding="utf-8"))["model"]["vocab"] if all(c in letters for c in t)]
    initial, continuation = {v[1:] for v in vocabulary if v[:1] == b" " and len(v) > 1}, {v for v in vocabulary if v[:1] != b" "}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in queries.op2_token_counts(spark, sf_dir).collect()}
    for r in docs.collect():
        words = (r.text or "").encode().split()
        assert got[r.doc_id] == (len(words), sum(greedy(initial, continuation, w) for w in words))
    edge = spark.createDataFrame([(1, None, 1), (None, "", 1), (1, " \n", 1), (2, "z" * 20_000, 1)], "doc_id long, text string, n_words int")
    rows = token_counts.token_counts(edge, path).collect()
    assert [r.n_words for r in rows] == [0, 0, 0, 1] and rows[3].n_tokens > 1


def test_lm_scores_against_sql(spark, sf_dir):
    assert_same(queries.op4_lm_scoring(spark, sf_dir), lm_scoring.ORACLE, sf_dir)


def brute_scores(texts, order, alpha):
    from collections import Counter
    from math import log

    rows = [(t or "").lower().split() for t in texts]
    counts = [Counter(tuple(r[i : i + n]) for r in rows for i in range(len(r) - n + 1)) for n in range(1, order + 1)]
    total, out = sum(map(len, rows)), []
    for r in rows:
        own = [Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1)) for n in range(1, order + 1)]

        def c(g):
            return counts[len(g) - 1][g] - own[len(g) - 1][g]

        score = 0.0
        for i in range(len(r)):
            rest, value = total - len(r), 0.0
            for back, n in enumerate(range(min(order, i + 1), 0, -1)):
                gram = tuple(r[i - n + 1 : i + 1])
                if n == 1:
                    value = alpha**back * (c(gram) / rest if c(gram) else 1 / (rest + 1))
                elif c(gram):
                    value = alpha**back * c(gram) / c(gram[:-1])
                else:
                    continue
                break
            score += log(value)
        out.append((len(r), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_scores_against_brute_force(spark, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("AbCdE") for _ in range(rng.randint(0, 30))) for _ in range(40)] + [None, "", " ", "x", "x", "b " * 3000]
    docs = spark.createDataFrame([(k, t, "n") for k, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r.doc_id: (r.n_words, r.log_score) for r in lm_scoring.score(docs, order, chunk_bytes=200, part_grams=50).collect()}
    for k, (n, s) in enumerate(brute_scores(texts, order, lm_scoring.ALPHA)):
        assert got[k][0] == n and abs(got[k][1] - s) < 1e-6 * max(1, abs(s))
    assert lm_scoring.score(docs.limit(0), order).count() == 0


def test_n_grams_that_differ_in_low_bits_are_told_apart():
    gram = np.array([5 << 30, (5 << 30) + 1, 5 << 30, 9, (5 << 30) + 1], dtype=np.uint64)
    assert wordhash.ranked(gram).tolist() == [3, 0, 2, 1, 4]
    table = wordhash.Table.of(gram, gram > 0)
    assert table.distinct.tolist() == [9, 5 << 30, (5 << 30) + 1] and table.count.tolist() == [1, 2, 2]


def test_scores_of_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b d")], "doc_id long, text string")
    got = sorted((r.n_words, round(r.log_score, 6), str(r.doc_id)) for r in lm_scoring.score(docs).collect())
    wanted = brute_scores(["a b c", "a b c", "a b d"], 3, lm_scoring.ALPHA)
    assert got == sorted((n, round(s, 6), d) for (n, s), d in zip(wanted, ("None", "None", "3"), strict=True))


def test_registered_scores_with_trigrams(spark, tmp_path):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) for _ in range(40)] + ["a b", "a b c", None]
    pd.DataFrame({"doc_id": range(len(texts)), "text": texts}).to_parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.log_score) for r in queries.queries()["op4_lm_scoring"](spark, str(tmp_path)).collect()}
    assert got == {k: (n, pytest.approx(s, abs=1e-4)) for k, (n, s) in enumerate(brute_scores(texts, 3, lm_scoring.ALPHA))}
    two = brute_scores(texts, 2, lm_scoring.ALPHA)
    assert any(abs(got[k][1] - s) > 0.1 for k, (_, s) in enumerate(two))
