"""Notices wrapped over lines, against every run of words."""

import random

from tripmart.llm.licenses import TEMPLATES, THRESHOLD, license_labels, needed, plain

APACHE = """// Licensed under the Apache
// License, Version 2.0 (the "License"); you may not
// use this file except in compliance
// with the License."""


def brute(text):
    out = {}
    flat = plain(text or "")
    words = flat.split()
    for template, label in TEMPLATES.items():
        want, m = set(template.split()), len(template.split())
        blocks = [line.split() for line in flat.split("\n")] + [words[i : i + m] for i in range(len(words))]
        for b in blocks:
            held = len(want & set(b))
            if held >= needed(len(want), THRESHOLD):
                out[label] = max(out.get(label, 0.0), held / len(want))
    return out


def test_wrapped_notices(spark):
    rng = random.Random(8)
    texts = [APACHE, "Permission is hereby granted,\nfree of charge, to any\nperson obtaining a copy of this\nsoftware", None, ""]
    for _ in range(300):
        words = rng.choice(list(TEMPLATES)).split()
        words = [w for w in words if rng.random() > 0.1]
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randint(0, len(words)), rng.choice(["the", "of", "x", "license"]))
        words = ["lead"] * rng.randint(0, 5) + words + ["the", "of"] * rng.randint(0, 5)
        texts.append("".join(w + rng.choice([" ", " ", "\n", "\n * "]) for w in words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    wrapped = 0
    for r in license_labels(df, phrases={}).collect():
        want = brute(texts[r.doc_id])
        assert r.labels == ",".join(sorted(want)) and r.score == max(want.values(), default=0.0), texts[r.doc_id]
        got = {}
        for b in r.blocks:
            got[b.label] = max(got.get(b.label, 0.0), b.share)
        assert got == want
        wrapped += bool(want) and "\n" in texts[r.doc_id]
        if r.doc_id < 2:
            assert r.labels == ("apache", "mit")[r.doc_id] and r.blocks[0].line == 0
    assert wrapped > 100
