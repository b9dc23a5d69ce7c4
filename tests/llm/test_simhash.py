"""Fingerprints and their groups against brute force."""

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tripmart.llm import simhash
from tripmart.llm.simhash import links, near_duplicate_groups, text_fingerprint


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(values, near):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    values = sorted(set(values))
    for i, a in enumerate(values):
        for b in values[:i]:
            if near(a, b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {v: top(v) for v in values}


@pytest.mark.parametrize("text", ["", " \t", "One", "one TWO", "A b\x0bC d a B c", "É é İ " * 40, "x " * 500])
def test_fingerprint(text):
    assert text_fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("bucket_rows", [60_000, 40])
def test_links(spark, bucket_rows):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(25)] + [0, 2**64 - 1]
    values = set(seeds)
    for s in seeds:  # some chains, some clusters, distances of zero to five
        at = s
        for _ in range(12):
            at = rng.choice([s, at])
            for b in rng.sample(range(64), rng.randint(1, 5)):
                at ^= 1 << b
            values.add(at)
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = links(df, bucket_rows).collect()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3
    pairs = {frozenset((r.u, r.v)) for r in found}
    assert grouped(signed, near) == grouped(signed, lambda a, b: frozenset((a, b)) in pairs)


def test_groups(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(3, base), (1, base + " w9"), (2, base.upper()), (8, None), (7, ""), (9, "  \n"),
            (5, "something else entirely here"), (5, "something else entirely here"), (None, "lone words of no id")]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, fp string, u long")
    out = near_duplicate_groups(df).collect()
    assert len(out) == len(rows)
    of = {r.doc_id: r for r in out}
    prints = {i: plain_fingerprint(t or "") for i, t in rows}
    roots = grouped([plain_fingerprint(t or "") for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 3)
    for i, p in prints.items():
        ids = [j for j, q in prints.items() if roots[q] == roots[p] and j is not None]
        assert of[i].fingerprint == f"{p:016x}"
        assert of[i].component_id == (min(ids) if ids else None)
    assert near_duplicate_groups(df.limit(0)).collect() == []


def test_deal_covers_all_variants():
    fp = np.array([0b1011], np.uint64)
    left = np.array([2], np.int8)
    rows = simhash._deal(fp, fp, left, left, 57, 64)
    assert len(rows[1]) == 1 + 7 + 21
    total = sum(len(simhash._masks(0, 57, k)) for k in (0, 1, 2))
    assert total == 1 + 57 + 57 * 56 // 2
