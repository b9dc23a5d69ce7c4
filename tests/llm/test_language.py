"""The sample of language training."""

import random

import numpy as np
from pyspark.sql import functions as F

from tripmart.llm import language


def test_copies_do_not_fill_the_sample(spark):
    rng = random.Random(6)
    make = lambda parts: " ".join("".join(rng.choices(parts, k=3)) for _ in range(20))
    texts = [(make(["th", "er", "ing", "on"]), "en") for _ in range(40)] + [(make(["sch", "ei", "heit", "au"]), "de") for _ in range(40)]
    df = spark.createDataFrame(texts, "text string, lang string")
    smallest = df.filter("lang = 'de'").orderBy(F.xxhash64("text")).first()
    copies = df.union(spark.createDataFrame([tuple(smallest)] * 100, df.schema))
    want, got = (language.fit(x, sample_per_language=30) for x in (df, copies))
    assert got.languages == want.languages == ("de", "en")
    assert np.array_equal(got.table, want.table) and got.false_share.min() > 0


def test_more_languages_than_bits_of_a_word(spark):
    rng = random.Random(7)
    rows = []
    for i in range(70):
        letters = [chr(0x4E00 + 40 * i + k) for k in range(6)]
        for _ in range(6):
            rows.append((" ".join("".join(rng.choices(letters, k=4)) for _ in range(30)), f"l{i:02}"))
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language.fit(df)
    assert model.languages == tuple(f"l{i:02}" for i in range(70))
    out = language.predict(df, model, keep=("lang",)).collect()
    assert len(out) == len(rows) and all(r.lang_pred == r.lang for r in out)
