"""Spelling variants held against all pairs of words compared one by one."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import values
from tripmart.llm.variants import spelling_variants

SCHEMA = "doc_id long, text string, lang string, word string, n int, side int, near string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def plain(rows, every=199, min_count=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def edited(word, r, letters):
    p = r.randrange(len(word) + 1)
    kind = r.randrange(3)
    if kind == 0:
        return word[:p] + r.choice(letters) + word[p:]
    return word[:p] + (r.choice(letters) if kind == 1 else "") + word[p + 1:]


def corpus(seed, letters="abÉ×ÿ", lengths=(5, 6, 7, 12), families=25):
    """Families of words around one, with counts that fall by steps so that chains of forms arise."""
    r = random.Random(seed)
    docs = [[] for _ in range(12)]
    for _ in range(families):
        word, n = "".join(r.choice(letters) for _ in range(r.choice(lengths))), r.choice([6, 30, 170, 900])
        while n >= 4:
            for _ in range(n):
                r.choice(docs).append(r.choice([word, word, word.upper() if word.isascii() else word]))
            word, n = edited(word, r, letters) or "aaaaaa", n // r.choice([2, 5, 6])
    texts = [r.choice([" ", "-", "1", "\n"]).join(r.sample(d, len(d))) for d in docs]
    return [(i if i % 4 else None, t, "en", "w", 1, 0, "x") for i, t in enumerate(texts)]


def checked(make, rows, **kw):
    found = spelling_variants(make(rows, SCHEMA).repartition(3), **kw)
    assert found.columns == list(COLUMNS)
    return sorted(values(found), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(make, seed):
    rows = corpus(seed)
    got, want = checked(make, rows), plain(rows)
    assert got == want
    assert any(v[1] != v[2] and v[1] for v in got), "a chain of forms"


def test_misspelt_words_and_two_letters_only(make):
    rows = corpus(3, letters="ab", families=20)
    assert checked(make, rows, every=3) == plain(rows, every=3)


def test_words_beyond_the_tries(make):
    rows = corpus(4, lengths=(9, 10, 11, 40), families=20)
    want = plain(rows)
    assert checked(make, rows, deep=10) == want  # short, long, and pairs across the border
    assert checked(make, rows) == want


def test_very_long_words_and_texts(make):
    long = "ab" * 1500
    text = " ".join([long] * 50 + [long[1:]] * 6 + [long[:700] + "x" + long[701:]] * 5)
    rows = [(1, text, "", "", 1, 1, ""), (2, "wordword " * 60_000 + "wordwerd " * 5, "", "", 1, 1, "")]
    got, want = checked(make, rows), plain(rows)
    assert got == want


def test_nulls_and_empty(make):
    assert checked(make, []) == []
    assert checked(make, [(None, None, None, None, None, None, None), (1, "", None, None, None, None, None), (2, "short wörd", None, None, None, None, None)]) == []
    rows = [(1, "abcdef " * 5, None, None, None, None, None)] * 2
    assert checked(make, rows) == plain(rows)
