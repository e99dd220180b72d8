"""Near-copy join, repeated strings and decontamination, against brute force."""

import hashlib
import random
import shutil
import time

import numpy as np
import pytest

from cellstrand.llm import decontaminate, jaccard_join, queries, suffix_dedup, wordhash
from cellstrand.llm.components import components
from tests.oracle import assert_same


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute_join(rows):
    sets, parent = [(d, shingles(t)) for d, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(s), least[find(i)]) for i, (d, s) in enumerate(sets)}


def corpus(rng, size=120):
    vocabulary = [f"W{k}" for k in range(rng.choice([3, 30, 1000]))]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, 80))] for _ in range(6)]
    passage = [rng.choice(vocabulary) for _ in range(12)]
    rows = []
    for k in range(size):
        text = list(rng.choice(base)) if rng.random() < 0.8 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            if text:
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((1000 - k, " ".join(text + (passage if rng.random() < 0.2 else []))))
    return [*rows, (5000, None), (5001, " \t"), (5002, "")]


@pytest.mark.parametrize(("seed", "options"), [(0, {}), (1, {"block_weight": 300, "levels": 2}), (2, {"block_weight": 200, "levels": 0, "part_shingles": 50}), (3, {"block_weight": 60, "levels": 1, "slices": 2}), (4, {"block_weight": 100, "levels": 0, "slices": 4})])
def test_join_against_brute_force(spark, seed, options):
    rng = random.Random(seed)
    rows = corpus(rng)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, key int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(docs, chunk_bytes=rng.choice([300, 10**6]), **options).collect()}
    assert got == brute_join(rows)


def test_join_in_a_block_against_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        core = rng.integers(0, 1 << 60, 40)
        sets = [np.unique(np.where(rng.random(40) < rng.choice([0.02, 0.1, 0.2]), rng.integers(0, 1 << 60, 40), core)).astype(np.uint64) for _ in range(80)]
        own = jaccard_join.Sets(np.concatenate(sets), np.r_[0, np.cumsum([len(s) for s in sets])], np.array([len(s) for s in sets]))
        forest, wanted = jaccard_join.Forest(80), jaccard_join.Forest(80)
        jaccard_join.join_block(own, np.arange(80), forest)
        for x in range(80):
            for y in range(x):
                both, union = len(np.intersect1d(sets[x], sets[y])), len(np.union1d(sets[x], sets[y]))
                if 100 * both >= 75 * union:
                    wanted.link(x, y)
        assert [forest.find(x) for x in range(80)] == [wanted.find(x) for x in range(80)] and len(forest.edges) < 80


def sets_of(rows):
    return jaccard_join.Sets(np.concatenate(rows), np.r_[0, np.cumsum([len(r) for r in rows])], np.array([len(r) for r in rows]))


def test_lower_bounds_spare_most_distances():
    rng = np.random.default_rng(2)
    # unrelated sets that share a shingle, sets of many sizes, and clusters of near copies
    unrelated = [np.unique(np.r_[7, rng.integers(0, 1 << 60, 40)]).astype(np.uint64) for _ in range(1500)]
    clusters = []
    for _ in range(30):
        core = rng.integers(0, 1 << 60, int(rng.integers(20, 200)))
        clusters += [np.unique(np.r_[7, np.where(rng.random(len(core)) < 0.03, rng.integers(0, 1 << 60, len(core)), core)]).astype(np.uint64) for _ in range(40)]
    for rows in (unrelated, clusters):
        sets, forest, n = sets_of(rows), jaccard_join.Forest(len(rows)), len(rows)
        jaccard_join.join_block(sets, np.arange(n), forest)
        assert sets.distances < 0.05 * n * (n - 1) / 2
    assert len({forest.find(x) for x in range(n)}) == 30


def test_join_edges(spark):
    text = "a b c d e f g h"
    docs = spark.createDataFrame([(7, text), (7, text), (None, text.upper()), (9, "q r"), (8, "Q  R"), (None, ""), (None, "alone is this text here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(docs).collect()), key=str)
    assert got == sorted([(7, 4, 7), (7, 4, 7), (None, 4, 7), (9, 1, 8), (8, 1, 8), (None, 0, None), (None, 1, None)], key=str)
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in jaccard_join.representatives(docs).collect())
    assert kept == [(False, 7, text), (False, 8, "Q  R"), (True, 0, ""), (True, 0, "alone is this text here")]
    assert jaccard_join.join(docs.limit(0)).count() == 0 and jaccard_join.representatives(docs.limit(0)).count() == 0


def test_join_query_against_sql(spark, sf_dir):
    assert_same(queries.op3_jaccard_join(spark, sf_dir), jaccard_join.ORACLE, sf_dir)


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (6, 6), (9, 8), (8, 7), (7, 3), (None, 3)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{n: 1 for n in (2, 3, 7, 8, 9)}, 5: 4, **{101 + k: 100 for k in range(40)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_that_do_not_settle_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        components(chain, rounds=2)


def brute_repeats(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


@pytest.mark.parametrize(("seed", "length", "gram", "many"), [(0, 12, 4, 1000), (1, 9, 2, 3), (2, 12, 4, 2)])
def test_repeats_against_brute_force(spark, seed, length, gram, many):
    rng = random.Random(seed)
    letters = rng.choice(["abé", "abcdefghij kl"])
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(10, 60))) for _ in range(4)]
    texts = []
    for _ in range(60):
        text = list("".join(rng.choice([rng.choice(base), "".join(rng.choice(letters) for _ in range(rng.randint(0, 20)))]) for _ in range(rng.randint(0, 4))))
        for _ in range(rng.randint(0, 2)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(letters)
        texts.append("".join(text))
    texts += [*texts[:5], "", None]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_bytes int").repartition(3)
    options = {"length": length, "gram": gram, "chunk_bytes": rng.choice([100, 500]), "many": many}
    got = {r.doc_id: r for r in suffix_dedup.digests(docs, **options).collect()}
    raw = [(t or "").encode() for t in texts]
    for k, (t, gone) in enumerate(zip(raw, brute_repeats(raw, length), strict=True)):
        kept = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        assert (got[k].n_bytes, got[k].n_removed, got[k].n_spans, got[k].kept_sha256) == (len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    cut = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, **options).collect()}
    assert cut[len(texts) - 1] is None and all(cut[k] == np.frombuffer(t, dtype=np.uint8)[~g].tobytes().decode("utf-8", "ignore") for k, (t, g) in enumerate(zip(raw[:-1], brute_repeats(raw, length), strict=False)))


def test_anchors_with_few_zones_in_each_of_many_chunks_are_counted_by_strings(spark, monkeypatch):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefghij") for _ in range(30))
    texts = ["".join(rng.choice("klmnopqrst") for _ in range(8)) + passage + "".join(rng.choice("klmnopqrst") for _ in range(8)) for _ in range(30)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(30, "doc_id")
    made, codes = suffix_dedup.answered, []
    monkeypatch.setattr(suffix_dedup, "answered", lambda *given: codes.append(made(*given)) or codes[0])
    got = {r.doc_id: r.n_removed for r in suffix_dedup.digests(docs, length=12, gram=4, chunk_bytes=10, many=15).collect()}
    assert codes[0].where(f"code = {suffix_dedup.COUNTED}").count() > 0
    raw = [t.encode() for t in texts]
    assert got == {k: int(gone.sum()) for k, gone in enumerate(brute_repeats(raw, 12))}


def colliding_pair():
    """Printable texts whose polynomial hashes modulo 2^64 agree for any odd base, with the same 200 bytes behind."""
    differences = np.array([1])
    for power, times in ((32, 1), (16, 7), (8, 2), (4, 1), (2, 1), (1, 1)):
        factor = np.zeros(power + 1, dtype=int)
        factor[0], factor[-1] = -1, 1
        for _ in range(times):
            differences = np.convolve(differences, factor)
    middle = 80 + np.zeros(len(differences), dtype=int)
    high, low = middle + (differences + 1) // 2, middle - differences // 2
    assert (high - low == differences).all() and len(differences) == 168 and min(high.min(), low.min()) > 32 and max(high.max(), low.max()) < 127
    return bytes(high.tolist()), bytes(low.tolist())


def test_texts_with_equal_polynomial_hashes_are_told_apart(spark):
    one, other = colliding_pair()
    base = suffix_dedup.BASE
    assert sum((x - y) * pow(base, k, 1 << 64) for k, (x, y) in enumerate(zip(one, other, strict=True))) % (1 << 64) == 0
    rng = random.Random(3)
    for _ in range(300):
        tail = bytes(rng.randrange(33, 127) for _ in range(200))
        data = np.frombuffer(one + tail, dtype=np.uint8)
        if (suffix_dedup.zones_of(data, np.array([0]), np.array([len(data)]))[3] == len(one)).any():
            break
    docs = spark.createDataFrame([(1, (one + tail).decode()), (2, (other + tail).decode())], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in suffix_dedup.digests(docs).collect()} == {1: 200, 2: 200}
    assert {r.doc_id: r.n_removed for r in suffix_dedup.digests(docs, many=1).collect()} == {1: 200, 2: 200}


def test_anchors_are_chosen_alike_wherever_a_string_stands():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 101, 400).astype(np.uint8)
    short = suffix_dedup.zones_of(text, np.array([0]), np.array([400]))
    padded = np.concatenate([rng.integers(97, 101, 70_000).astype(np.uint8), text])
    long = suffix_dedup.zones_of(padded, np.array([0, 70_000]), np.array([70_000, 70_400]))
    own = long[0] == 1
    assert [(a - 70_000).tolist() for a in (long[1][own], long[2][own], long[3][own])] == [a.tolist() for a in short[1:4]]


def test_repeats_of_many_zones_of_one_anchor_take_little_more_than_linear_time():
    rng = random.Random(6)

    def zones(m):
        before = ["".join(rng.choice("ab") for _ in range(168)).encode() for _ in range(m)]
        suffix = sorted("".join(rng.choice("ab") for _ in range(168)).encode() for _ in range(m))
        return [0, *(32 + suffix_dedup.common(a, b, 0) for a, b in zip(suffix, suffix[1:], strict=False))], before

    def seconds(m):
        own, began = zones(m), time.perf_counter()
        suffix_dedup.repeats(*own, 200, 32)
        return time.perf_counter() - began

    seconds(100)
    assert seconds(16_000) < 12 * seconds(4_000)


def test_repeats_in_very_long_and_short_texts(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(2_300_000))
    docs = spark.createDataFrame([(1, long), (2, long[1_048_000:1_049_400]), (None, "x" * 199), (3, "y" * 201)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.digests(docs).collect()}
    assert got == {1: (1400, 1), 2: (1400, 1), None: (0, 0), 3: (201, 1)}
    assert suffix_dedup.digests(docs.limit(0)).count() == 0


def test_repeats_query_against_sql(spark, sf_dir):
    assert_same(queries.op5_suffix_dedup(spark, sf_dir), suffix_dedup.ORACLE, sf_dir)


def test_loser_tree_merges_and_shares():
    rng = random.Random(2)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(rng.randint(0, 20))) for _ in range(7)]
    coded = [[(s, 0 if k == 0 else suffix_dedup.common(run[k - 1], s, 0)) for k, s in enumerate(run)] for run in runs]
    merged = list(suffix_dedup.LoserTree([iter(c) for c in coded]))
    strings = [s for _, s, _ in merged]
    assert strings == sorted(s for run in runs for s in run)
    assert all(n == suffix_dedup.common(a, b, 0) for a, b, (_, _, n) in zip(strings, strings[1:], merged[1:], strict=False))


def test_front_coding_round_trip():
    strings, before = [b"", b"ab", b"abc", b"b"], [b"x", b"", b"yy", b"z"]
    out, left = suffix_dedup.decoded(suffix_dedup.front_coded(strings, before))
    assert [s for s, _ in out] == strings and left == before


def brute_hits(texts, items):
    out = []
    for text in texts:
        words = decontaminate.words_of(text)
        hit, found = [False] * len(words), set()
        for item, content in items:
            b = decontaminate.words_of(content)
            for a in range(max(1, len(b) - 9)):
                window = b[a : a + 10]
                for s in range(len(words) - len(window) + 1):
                    if window and words[s : s + len(window)] == window:
                        found.add(item)
                        hit[s : s + len(window)] = [True] * len(window)
        out.append((len(words), sum(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), any(hit)))
    return out


@pytest.mark.parametrize(("seed", "most"), [(0, 1 << 20), (1, 60)])
def test_decontamination_against_brute_force(spark, seed, most):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "d1", "E2"][: rng.randint(2, 5)]
    items = [(rng.randint(5, 15), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 13)))) for _ in range(8)]
    texts = ["-".join(rng.choice([*vocabulary, "zz"]) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", "a" * 100_000]
    docs = spark.createDataFrame([(k, t, "q") for k, t in enumerate(texts)], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame([*items, (None, "a B"), (3, None)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(docs, benchmark, most=most).collect()}
    wanted = brute_hits([(t or "").encode() for t in texts], [(i, t.encode()) for i, t in items])
    assert [got[k] for k in range(len(texts))] == wanted
    clean = sorted(r.doc_id for r in decontaminate.clean(docs, benchmark, most=most).collect())
    assert clean == [k for k, w in enumerate(wanted) if not w[4]]
    assert decontaminate.report(docs.limit(0), benchmark).count() == 0 and decontaminate.report(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_a_stored_index_serves_other_benchmarks_without_the_texts(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    index = decontaminate.build(spark.read.parquet(f"{tmp_path}/docs"), shard_bytes=200)
    shutil.rmtree(f"{tmp_path}/docs")
    for seed in (1, 2):
        rng = random.Random(seed)
        items = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))) for k in range(30)]
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(index, spark.createDataFrame(items, "item_id long, text string"), most=100).collect()}
        assert [got[k] for k in range(50)] == brute_hits([t.encode() for t in texts], [(i, t.encode()) for i, t in items])
    near = {(r.doc_id, r.word) for r in decontaminate.near_matches(index, ["a b c"], 2).collect()}
    assert near and all({"a", "b", "c"} <= set(texts[d].split()[max(0, w - 2) : w + 3]) for d, w in near)


def test_near_matches(spark):
    docs = spark.createDataFrame([(1, "cat x x dog y y y y cat"), (2, "dog"), (3, None)], "doc_id long, text string")
    got = {(r.doc_id, r.query, r.word) for r in decontaminate.near_matches(docs, ["Dog cat", "", "bird"], 3).collect()}
    assert got == {(1, 0, 3)}


def test_decontamination_query_against_sql(spark, sf_dir):
    assert_same(queries.op6_decontaminate(spark, sf_dir), decontaminate.ORACLE, sf_dir)


def alike_but_apart(n=150):
    """Sets of which none is far from any other, so that pivots part nothing, and few are near; their distinct elements and components."""
    rng = np.random.default_rng(1)
    own = [np.sort(np.r_[np.arange(60), 100 + rng.choice(80, 40, replace=False)]).astype(np.uint64) for _ in range(n)]
    forest = jaccard_join.Forest(n)
    for x in range(n):
        for y in range(x):
            both = len(np.intersect1d(own[x], own[y]))
            if 100 * both >= 75 * (200 - both):
                forest.link(x, y)
    return own, [forest.find(x) for x in range(n)]


def test_what_pivots_do_not_part_is_compared_once():
    own, wanted = alike_but_apart()
    sets, forest = jaccard_join.sets_of_rows([jaccard_join.packed(x) for x in own], [100] * len(own)), jaccard_join.Forest(len(own))
    jaccard_join.join_block(sets, np.arange(len(own)), forest)
    assert [forest.find(x) for x in range(len(own))] == wanted and 20 < len(set(wanted)) < len(own)
    assert sets.distances <= len(own) ** 2 / 2 + jaccard_join.PIVOTS * len(own)


def test_large_blocks_that_pivots_do_not_part_are_not_multiplied(spark, monkeypatch):
    own, wanted = alike_but_apart()
    rows = spark.createDataFrame([(7, k, 100, 100, bytearray(jaccard_join.packed(x))) for k, x in enumerate(own)], "block long, key long, weight long, n long, blob binary")
    members, real = [], jaccard_join.stored

    def stored(df, what):
        out = real(df, what)
        members.append(out.count() if what == "members" else 0)
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    links = jaccard_join.links_in_blocks(rows.select("block", "key", "weight"), rows.select("key", "n", "blob"), 4, 5000).collect()
    forest = jaccard_join.Forest(len(own))
    for r in links:
        forest.link(r.a, r.b)
    assert [forest.find(x) for x in range(len(own))] == wanted
    assert max(members) <= 2 * len(own)


def test_words_have_hashes_of_their_own():
    words = [b"a", b"a\x00", b"\x00", b"ab", b"ba", *(b"q" * k for k in range(7, 70)), *(b"q" * k + b"r" for k in range(7, 70)), "é".encode(), b"x" * 1000]
    texts = [b"", b" \t", b"\x0b".join(words), b"\n".join(w.upper() for w in words) + b"\r", *words, b""]
    value, count = wordhash.word_hashes(texts)
    n = len(words)
    assert count.tolist() == [0, 0, n, n, *[1] * n, 0]
    assert value[:n].tolist() == value[n : 2 * n].tolist() == value[2 * n :].tolist() and len(set(value.tolist())) == n
    assert len(wordhash.word_hashes([])[0]) == len(wordhash.word_hashes([b""])[0]) == 0
