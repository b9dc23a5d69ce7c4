"""All word n-grams against a plain recursive Katz model."""

import collections
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tripmart.llm import katz, ngram_chunks, ngrams


def plain(train, order):
    cut = lambda t: ["<s>", *(t or "").lower().split(), "</s>"]
    n = [collections.Counter() for _ in range(order + 1)]
    for t in train:
        w = cut(t)
        for i in range(1, len(w)):
            for o in range(1, order + 1):
                if i - o + 1 >= 0:
                    n[o][tuple(w[i - o + 1 : i + 1])] += 1
    f = [None] + [katz.good_turing(collections.Counter(n[o].values())) for o in range(1, order + 1)]
    keep = lambda o, g: n[o][g] * (f[o][n[o][g]] if n[o][g] <= katz.MAX_DISCOUNTED else 1)
    total = sum(n[1].values())
    kept = sum(keep(1, g) for g in n[1])
    norm = total if total and total - kept > 1e-9 * total else total + 1

    def p(g):
        o = len(g)
        if o == 1:
            return keep(1, g) / norm if g in n[1] else (norm - kept) / norm
        after = [x for x in n[o] if x[:-1] == g[:-1]]
        if not after:
            return p(g[1:])
        every, held = sum(n[o][x] for x in after), sum(keep(o, x) for x in after)
        if every - held < 1e-9:
            every += 1
        if g in n[o]:
            return keep(o, g) / every
        return (1 - held / every) / (1 - sum(p(x[1:]) for x in after)) * p(g[1:])

    def score(t):
        w = cut(t)
        return sum(math.log10(p(tuple(w[max(i - order + 1, 0) : i + 1]))) for i in range(1, len(w)))

    return score, p, n[1]


@pytest.mark.parametrize("order, known", [(2, 5), (2, 0), (3, 5)])
def test_against_plain(spark, order, known, monkeypatch):
    rng = random.Random(3)
    words = [f"w{int(rng.expovariate(0.15))}" for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) + rng.choice(["", " É\t", "\n"]) for _ in range(80)]
    texts += [None, "", "new word here", "w1 W1", "w1 W1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    counted = katz.stored(spark, ngrams.count_ngrams(df.filter("doc_id % 3 <> 0"), order), "t")
    table, totals = ngrams.fit(counted, order, known)
    score, p, seen = plain([t for i, t in enumerate(texts) if i % 3], order)
    for h in [("<s>",), ("w1",), ("w7",)]:
        assert math.isclose(sum(p((*h, *w)) for w in seen) + p((*h, "never")), 1.0, rel_tol=1e-9)
    out = ngrams.score(df, table, totals, order).collect()
    assert len(out) == len(texts)
    for r in out:
        assert math.isclose(r.score, score(texts[r.doc_id]), abs_tol=1e-8), r


def test_rare_words_in_seen_order(spark):
    """Two words seldomer than the 1,024 most frequent ones: their order counts."""
    rng = random.Random(5)
    words = [f"v{i}" for i in range(4000)]
    lines = [" ".join(rng.sample(words, 60)) for _ in range(300)] + ["rarea rareb"] * 2 + ["rarea", "rareb"]
    train = spark.createDataFrame([(t,) for t in lines], "text string")
    docs = spark.createDataFrame([(1, "v1 rarea rareb v2"), (2, "v1 rareb rarea v2")], "doc_id int, text string")
    of = {r.doc_id: r.score for r in katz.katz_scores(docs, train).collect()}
    assert of[1] > of[2] + 0.5


def test_keys(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**63), 2**63 - 1, (2, 50))
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long")
    want = [r[0] for r in df.selectExpr("xxhash64(a, b)").collect()]
    assert ngrams.pair_key(a.view(np.uint64), b.view(np.uint64)).view(np.int64).tolist() == want


@pytest.mark.parametrize("order, keys_per_range", [(2, 40), (2, 10**6), (3, 40), (1, 40)])
def test_chunks_against_plain(spark, order, keys_per_range):
    rng = random.Random(3)
    words = [f"w{int(rng.expovariate(0.15))}" for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) + rng.choice(["", " É\t", "\n"]) for _ in range(80)]
    texts += [None, "", "new word here", "w1 W1", "w1 W1", "w2 " * 5000]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id int, text string, chunk int").repartition(3)
    learned = [t for i, t in enumerate(texts) if i % 3]
    score, _, seen = plain(learned, order)
    out = ngram_chunks.scores_by_part(
        df, F.col("doc_id") % 3 != 0, keep=("doc_id", "chunk"), order=order, keys_per_range=keys_per_range
    ).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(texts)))
    total = sum(seen.values())
    for r in out:
        w = [*(texts[r.doc_id] or "").lower().split(), "</s>"]
        assert r.chunk == r.doc_id
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum((x,) in seen for x in w), total)
        base = sum(math.log10((seen[(x,)] + 1) / (total + len(seen) + 1)) for x in w)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score(texts[r.doc_id]), rel_tol=1e-9, abs_tol=1e-8), r


def test_chunks_of_edge_tables(spark):
    df = spark.createDataFrame([(1, "a b", None), (1, None, None), (2, "", False)], "doc_id int, text string, learn boolean")
    out = ngram_chunks.scores_by_part(df, F.col("learn")).collect()
    assert len(out) == 3 and all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0.0 for r in out)
    assert ngram_chunks.scores_by_part(df.limit(0), F.lit(True)).collect() == []
    assert ngram_chunks.scores_by_part(df, F.lit(True)).count() == 3


def test_packed():
    rng = np.random.default_rng(2)
    for n, top in [(0, 1), (1, 1), (5, 1), (1000, 200), (1000, 2**63)]:
        v = rng.integers(0, top, n).astype(np.uint64)
        assert (ngram_chunks.unpacked(ngram_chunks.packed(v)) == v).all()
        keys = np.unique(v * np.uint64(2) + np.uint64(1))
        assert (ngram_chunks.unpacked_keys(ngram_chunks.packed_keys(keys)) == keys).all()
        assert (ngram_chunks.unpacked_floats(ngram_chunks.packed_floats(v / 3)) == v / 3).all()
