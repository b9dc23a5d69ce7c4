"""The manifest held against a plain tree over the same rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.llm.merkle import folded, manifest, proof_digest
from tripmart.llm.queries import manifest_digests

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, path string, pos int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, fanout):
    """Root and the siblings of every node, per level: (left, right)."""
    paths = [[] for _ in nodes]
    held = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_held = [], []
        for s in range(0, len(nodes), fanout):
            run = nodes[s:s + fanout]
            for j, members in enumerate(held[s:s + fanout]):
                for m in members:
                    paths[m].append((run[:j], run[j + 1:]))
            up.append(h(*run))
            up_held.append([m for members in held[s:s + fanout] for m in members])
        nodes, held = up, up_held
    return nodes[0] if nodes else None, paths


def plain(rows, fanout=2):
    out = []
    groups = {}
    for r in rows:
        leaf = h(*[enc(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])
        bad = zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 7 == 0
        chars = r["n_chars"] + 1 if bad and r["n_chars"] is not None else r["n_chars"]
        changed = h(*[enc(v) for v in (r["doc_id"], r["source"], r["lang"], chars, r["text"])])
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf, changed))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = []
    for g in names:
        leaves = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built.append((leaves, *climb([x[1] for x in leaves], fanout)))
    root, above = climb([b[1] for b in built], fanout)
    for (leaves, sub, paths), top in zip(built, above):
        for (i, leaf, changed), path in zip(leaves, paths):
            whole = path + top
            acc = changed
            for left, right in whole:
                acc = h(*left, acc, *right)
            out.append((i, leaf, sub, root, h(*[x for a, b in whole for x in a + b]), acc, acc == root))
    return sorted(out, key=str)


def rows_of(n, seed=1, langs=("en", "en", "en", "ä", "z", "", None)):
    r = random.Random(seed)
    made = []
    for i in range(n):
        made.append((
            r.choice([i, i, i, i // 2, None]), r.choice(["text", "", None, "é" * 50, "x" * 5000]), r.choice(langs),
            r.choice(["a", None, "b-"]), r.choice([3, None, -1]), "c", 1, "p", 2,
        ))
    return made


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def checked(make, made):
    names = SCHEMA.replace(",", "").split()[::2]
    got = manifest_digests(make(made, SCHEMA).repartition(5))
    assert got.columns == list(COLUMNS)
    return sorted(values(got), key=str), plain([dict(zip(names, m)) for m in made])


def test_equals_a_plain_tree_with_nulls_ties_and_clashing_names(make):
    # Repeated rows, repeated and null ids, a null and an empty group, columns named like those used inside.
    made = rows_of(150) + rows_of(20)
    got, want = checked(make, made)
    assert got == want
    assert any(not v[-1] for v in got) and any(v[-1] for v in got)


@pytest.mark.parametrize("made", [[], rows_of(1), rows_of(2, langs=("en",)), rows_of(5, langs=("en",)), rows_of(9, langs=tuple("abcdefg"))])
def test_small_tables(make, made):
    got, want = checked(make, made)
    assert got == want


@pytest.mark.parametrize("fanout", [3, 5])
def test_other_fanouts(make, fanout):
    made = rows_of(60, seed=4)
    names = SCHEMA.replace(",", "").split()[::2]
    docs = make(made, SCHEMA)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    found = manifest(docs, columns, "doc_id", "lang", keep=("doc_id",), fanout=fanout)
    got = values(found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), folded(F.col("leaf"), F.col("path"))))
    want = [v[:5] + (v[3],) for v in plain([dict(zip(names, m)) for m in made], fanout)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_run_of_one_is_refused(make):
    with pytest.raises(ValueError):
        manifest(make(rows_of(3), SCHEMA), ["doc_id"], "doc_id", "lang", fanout=1).count()
