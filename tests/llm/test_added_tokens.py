"""Ids and counts under edits of texts that hold the added token, against the unmodified file."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm.edits import apply_edits, edited_counts, grow, pieces
from tripmart.llm.packing import token_pieces
from tripmart.llm.tokens import WordEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKEN = "<|endoftext|>"
SIGNS = ["a", "B", "'s", " ", " ", "  ", "\n", "\n\n ", "é", "中", "<", "|>", " the", TOKEN, " " + TOKEN, "<|endof", "text|>"]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


def odd_text(rng, n):
    return "".join(rng.choice(SIGNS) for _ in range(n))


def test_ids(spark, reference):
    rng = random.Random(2)
    texts = [odd_text(rng, rng.randint(0, 20)) for _ in range(3000)] + [f"a {TOKEN} b", TOKEN]
    for text, ids in zip(texts, WordEncoder.of(PATH).encode_many(texts)):
        assert ids == b"".join(i.to_bytes(4, "little") for i in reference(text)), text
    row = token_pieces(spark.createDataFrame([(1, f"a {TOKEN} b")], "doc_id int, text string"), PATH).first()
    assert list(memoryview(bytes(row.ids)).cast("I")) == [64, 220, 50256, 275, 2]


@pytest.mark.parametrize("seed", range(300))
def test_edits(reference, seed):
    rng = random.Random(seed)
    text = odd_text(rng, rng.choice([5, 60, 200]))
    encoder = WordEncoder.of(PATH)
    parts = pieces(text, encoder.added)
    encoder.learn(set(parts[1:]))
    counts = [len(encoder.whole(parts[0])) // 4, *(len(encoder.cache[p]) // 4 for p in parts[1:])]
    tree = grow(text, counts, parts, 2)
    assert tree.total == len(reference(text))
    edits = [(rng.randint(0, len(text)), rng.choice([0, 1, 2, 9]), rng.choice(["", "", " ", "q", TOKEN, "\n "])) for _ in range(4)]
    done, _ = apply_edits(text, tree, edits, lambda t: len(encoder.whole(t)) // 4, len(TOKEN) + 1)
    assert tree.total == len(reference(done))


def test_edit_makes_the_token(spark, reference):
    text = "word " * 40 + "\n\n  <|endofXtext|> tail"
    df = spark.createDataFrame([(1, text, [(text.index("X"), 1, "")])], "doc_id int, text string, edits array<struct<start:int,length:int,text:string>>")
    for leaf_words in (1, 16):
        r = edited_counts(df, PATH, leaf_words=leaf_words).first()
        assert r.n_tokens == len(reference(text)) and r.edited_n_tokens == len(reference(text.replace("X", "")))
