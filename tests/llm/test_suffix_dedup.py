"""Removal of repeated passages against counting every window."""

import hashlib
import random

import pytest

from tripmart.llm.suffix_dedup import without_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = {}
    for t in data:
        for p in range(len(t) - length + 1):
            count[t[p : p + length]] = count.get(t[p : p + length], 0) + 1
    out = []
    for t in data:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("max_snippets", [20_000, 1])
def test_against_counting(spark, max_snippets):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    piece = lambda n: " ".join(word() for _ in range(n))
    shared = [piece(25) for _ in range(4)]
    texts = [piece(rng.randint(0, 20)) + rng.choice(shared)[rng.randint(0, 20):] + piece(rng.randint(0, 30)) for _ in range(60)]
    texts += [texts[0], texts[0], None, "", "a" * 300, "short", "ab" * 200, texts[1][:-3] + "x"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, texts[2], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id int, text string, kept string, tid int")
    out = without_repeats(df, length=80, gram=24, max_snippets=max_snippets, with_text=True).collect()
    want = brute([r[1] for r in rows], 80)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in out}
    assert len(out) == len(rows)
    for (i, *_), w in zip(rows, want):
        assert got[i] == w
    assert without_repeats(df.limit(0)).collect() == []
