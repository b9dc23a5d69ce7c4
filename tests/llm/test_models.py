"""Models, labels, fingerprints and hits on small tables: nulls, empty texts, ties, repeated
rows, empty tables, clashing columns."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest

from tripmart.llm import katz, language, toxicity
from tripmart.llm.decontamination import contamination
from tripmart.llm.licenses import license_labels
from tripmart.llm.winnowing import fingerprint_edits

ROW = "doc_id int, text string, lang string, score double, n int"


def test_katz_sums_to_one_and_matches_base(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("aBcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "a a", "a a"]
    df = spark.createDataFrame([(i, t, "x", 1.0, 0) for i, t in enumerate(texts)], ROW)
    train = df.filter("doc_id % 3 <> 0")
    counted = katz.stored(spark, katz.unigrams(train), "t")
    model = katz.fit(counted, train, classes=6, known=12)
    side = model.vocabulary.classes + 1
    for h in range(side + 1):
        p = 10 ** model.classes(np.full(side, h), np.arange(side))
        assert math.isclose(p.sum(), 1.0, rel_tol=1e-9), h
    tok = lambda t: (t or "").lower().split() + ["\n"]
    count = collections.Counter(w for i, t in enumerate(texts) if i % 3 for w in tok(t))
    n, v = sum(count.values()), len(count)
    out = {r.doc_id: r for r in katz.score(df, counted, model).collect()}
    for i, t in enumerate(texts):
        want = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tok(t))
        r = out[i]
        assert math.isclose(r.base_score, want, abs_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tok(t)), sum(count[w] > 0 for w in tok(t)), n)
        assert r.score < 0
    # All words of the class of others, unseen ones together, share one.
    others = counted.toPandas()
    own = set(model.vocabulary.words[model.vocabulary.of_class < 6].tolist())
    rest = others[~others.word.isin(own)].n.to_numpy()
    assert math.isclose((10 ** model.within(rest)).sum() + 10**model.unseen, 1.0, rel_tol=1e-9)
    nothing = katz.katz_scores(df, df.limit(0)).collect()
    assert len(nothing) == len(texts) and all(r.n_known == 0 and r.train_tokens == 0 for r in nothing)
    assert katz.katz_scores(df.limit(0), train).collect() == []


def test_good_turing():
    assert katz.good_turing({})[1] == 0.5
    found = katz.good_turing({1: 1000, 2: 400, 3: 220, 4: 140, 5: 100, 6: 75})
    assert all(0 < d < 1 for d in found[1:])


def test_language(spark):
    rng = random.Random(1)
    make = lambda parts: " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(30))
    parts = {"en": ["th", "er", "ing", "on"], "de": ["sch", "ü", "heit", "ei"]}
    rows = [(i, make(parts[g]), g, 0.5, 1) for i, g in enumerate(["en", "de"] * 30)]
    odd = [(100, None, "en", 0.5, 1), (101, "", None, 0.5, 1), (102, "12 .,", "de", 0.5, 1), (None, "Sch heit ÜEI", None, 0.5, 1), (103, "x", None, 0.5, 1)]
    df = spark.createDataFrame(rows + odd + [odd[3]], ROW)
    model = language.fit(df)
    assert model.languages == ("de", "en")
    out = collections.defaultdict(list)
    for r in language.predict(df, model).collect():
        out[r.doc_id].append(r)
        assert 0 <= r.score <= 1
    assert all(out[i][0].lang_pred == g for i, _, g, *_ in rows)
    assert [out[i][0].lang_pred for i in (100, 101, 102)] == ["und"] * 3
    assert [r.lang_pred for r in out[None]] == ["de", "de"] and out[103][0].lang_pred in ("de", "en")
    bare = language.fit(df.limit(0))
    assert {r.lang_pred for r in language.predict(df, bare).collect()} == {"und"}
    assert language.predict(df.limit(0), model).collect() == []


def test_toxicity(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices(["an", "ti", "ser", "lo", "men", "ka"], k=rng.randint(1, 4))) for _ in range(400)]
    bad = ["blorg", "snitfaz", "quexor"]
    rows, labels = [], []
    for i in range(240):
        text = rng.sample(words, rng.randint(5, 40))
        if i % 3 == 0:
            for _ in range(3):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), "x", 0.1, 1))
        labels.append((i, int(i % 3 == 0), 9))
    odd = [(500, "so blorg. and snixtfaz, men", "x", 0.1, 1), (501, "b.l.o.r.g men q u e x o r", "x", 0.1, 1), (502, None, "x", 0.1, 1), (503, "", "x", 0.1, 1), (None, "men lo", "x", 0.1, 1)]
    docs = spark.createDataFrame(rows + odd + [odd[0]], ROW)
    marked = spark.createDataFrame(labels + [(None, 1, 9), (3, None, 9)], "doc_id int, toxic int, n int")
    model = toxicity.fit(docs, marked)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + 6 and all(0 <= r.score <= 1 for r in out)
    of = {r.doc_id: r.score for r in out}
    assert all((of[i] >= 0.7) == (i % 3 == 0) for i in range(240))
    assert of[500] >= 0.7 and of[501] >= 0.7 and max(of[502], of[503], of[None]) < 0.5
    plain = toxicity.fit(docs, marked.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, plain).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_licenses(spark):
    texts = [None, "", "Apache License\nMIT-license, the mit license", "Released under the GNU\nGeneral Public License!",
             "x\nRedistribution and use in source and binary forms, with or without changes are permitted.",
             "cc by CC BY cc by", "no words here", "no words here"]
    df = spark.createDataFrame([(i, t, "x", 2.0, 3) for i, t in enumerate(texts)], ROW)
    out = {r.doc_id: r for r in license_labels(df).collect()}
    assert [out[i].n_base for i in range(8)] == [0, 0, 3, 1, 0, 3, 0, 0]
    assert (out[2].first_word, out[2].last_word, out[2].base_labels) == (0, 5, "apache,mit")
    assert out[4].labels == "bsd" and 0.8 <= out[4].score < 1 and out[4].first_word is None and out[4].blocks[0].line == 1
    assert out[0].n_words == 0 and out[0].labels == "" and out[0].score == 0
    assert license_labels(df.limit(0)).collect() == []


def test_contamination(spark):
    rng = random.Random(7)
    pool = ["The", "of", "a-b", "É", "x1", "end."]
    piece = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [piece(20), piece(13), piece(15), "x1", "", None, "of a", piece(6)]
    texts = [piece(rng.randint(0, 40)) for _ in range(30)] + [None, "", items[0], f"{piece(9)} {items[2]} {piece(3)} {items[2]}"]
    docs = spark.createDataFrame([(i, t, "x", 2.0, 3) for i, t in enumerate(texts)] + [(33, texts[33], "x", 2.0, 3)], ROW)
    bench = spark.createDataFrame([(i, t, i) for i, t in enumerate(items)] + [(1, items[1], 5)], "item_id int, text string, doc_id int")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    windows = [(i, tuple(w[s : s + 13])) for i, t in enumerate(items) for w in [cut(t)] if w for s in range(max(len(w) - 12, 1))]
    for rows in (1_000_000, 0):  # broadcast, and the shuffling form of the same joins
        found = contamination(docs, bench, broadcast_rows=rows).collect()
        assert len(found) == len(texts) + 1
        for r in found:
            w = cut(texts[r.doc_id])
            hit, held = set(), set()
            for i, win in windows:
                for s in range(len(w) - len(win) + 1):
                    if tuple(w[s : s + len(win)]) == win:
                        hit.update(range(s, s + len(win)))
                        held.add(str(i))
            assert (r.n_words, r.n_hit, r.n_items, r["items"]) == (len(w), len(hit), len(held), sorted(held))
            assert sorted(p for s in r.spans for p in range(s["first"], s["first"] + s["length"])) == sorted(hit)
    assert {r.n_hit for r in contamination(docs, bench.limit(0)).collect()} == {0}
    assert contamination(docs.limit(0), bench).collect() == []


def test_winnowing(spark):
    rng = random.Random(9)
    piece = lambda n: " ".join(str(rng.randint(0, 60)) for _ in range(n))
    texts = [piece(rng.choice([0, 1, 3, 9, 40])) for _ in range(25)] + [None, "", "Äé " * 30]
    df = spark.createDataFrame([(i, t, "x", 2.0, 3) for i, t in enumerate(texts)], ROW)
    order = [t or "" for t in reversed(texts)]
    for per_range in (2000, 3):
        out = {r.doc_id: r for r in fingerprint_edits(df, rows_per_range=per_range).collect()}
        assert len(out) == len(texts)
        for k, i in enumerate(reversed(range(len(texts)))):
            text, after, r = order[k], order[(k + 1) % len(order)], out[i]
            moved = len(text) // 3
            edited = text[: len(text) - moved] + after[:moved]
            assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            same = {x.text or "": out[x.doc_id].entries for x in df.collect() if (x.text or "") == text}
            assert r.entries == same[text] and 0 <= r.near_edited <= 1
            sets = [{e >> 23 for e in out[j].entries} for j in (i, (i - 1) % len(texts))]
            union = len(sets[0] | sets[1])
            assert math.isclose(r.near_next, len(sets[0] & sets[1]) / union if union else 1.0)
    # The guarantee: a shared run of gram + window - 1 = 12 words leaves a shared hash.
    run = piece(12)
    pair = spark.createDataFrame([(1, f"{piece(30)} {run} {piece(30)}"), (2, f"{piece(50)} {run}")], "doc_id int, text string")
    a, b = [{e >> 23 for e in r.entries} for r in fingerprint_edits(pair).collect()]
    assert a & b
    assert fingerprint_edits(df.limit(0)).collect() == []


@pytest.mark.parametrize("kind", ["string", "date", "binary"])
def test_fingerprints_of_ids_that_are_no_numbers(spark, kind):
    """The same neighbours whatever the number of ranges, nulls and equal ids included."""
    texts = [f"text number {i} with some words of its own {i * i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    as_id = {"string": "concat('document-', n)", "date": "date_add(date'2020-01-01', n)", "binary": "cast(concat('é', n) as binary)"}
    df = df.selectExpr(f"case when n = 7 then null when n = 8 then {as_id[kind].replace('n)', '9)')} else {as_id[kind]} end as doc_id", "text")
    one = sorted(map(str, fingerprint_edits(df, rows_per_range=1000).collect()))
    many = sorted(map(str, fingerprint_edits(df, rows_per_range=4).collect()))
    assert len(one) == 60 and one == many
    rows = sorted(df.collect(), key=lambda r: r.text)
    order = [r for r in rows if r.doc_id is not None]
    order.sort(key=lambda r: r.doc_id, reverse=True)
    order += [r for r in rows if r.doc_id is None]
    want = []
    for r, after in zip(order, [*order[1:], order[0]]):
        moved = len(r.text) // 3
        want.append(hashlib.sha256((r.text[: len(r.text) - moved] + after.text[:moved]).encode()).hexdigest())
    assert sorted(want) == sorted(r.edited_sha256 for r in fingerprint_edits(df, rows_per_range=4).collect())
