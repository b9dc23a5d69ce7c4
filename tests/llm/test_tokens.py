"""Encoded words, counts under edits, and packing."""

import random
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripmart.llm.edits import CountTree, apply_edits, edited_counts, grow, pieces
from tripmart.llm.packing import pack_documents, packing_plan
from tripmart.llm.tokens import WordEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = list("aB'sté .,\n\t  1²ªßЯ中😀\r\x1c  -") + ["'s", "'ll", " the", "<|endoftext|>", "  ", "\n\n"]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


def odd_text(rng, n):
    return "".join(rng.choice(SIGNS) for _ in range(n))


def test_ids(reference):
    rng = random.Random(1)
    texts = [odd_text(rng, rng.randint(0, 40)) for _ in range(3000)] + ["", "Plain words, and more of them."]
    for text, ids in zip(texts, WordEncoder(PATH, cache_words=50).encode_many(texts)):
        assert ids == b"".join(i.to_bytes(4, "little") for i in reference(text)), text


def test_tree():
    tree = CountTree([3, 2, 5], [1, 2, 3])
    assert [tree.find(p) for p in (0, 2, 3, 5, 9, 99)] == [(0, 0), (0, 0), (1, 3), (2, 5), (2, 5), (2, 5)]
    tree.put(1, 0, 0)
    assert tree.total == 4 and tree.find(3) == (2, 3)


@pytest.mark.parametrize("seed", range(150))
def test_edits(reference, seed):
    rng = random.Random(seed)
    text = odd_text(rng, rng.choice([0, 5, 60, 200])) if seed % 2 else " ".join(rng.choice(["the", "of.", "x", "don't"]) for _ in range(80))
    parts = pieces(text)
    counts = [len(reference(p if i == 0 else " " + p)) for i, p in enumerate(parts)]
    tree = grow(text, counts, parts, 4)
    assert tree.total == len(reference(text))
    edits = [(rng.randint(0, len(text) + 3), rng.choice([0, 1, 9]), rng.choice(["", " ", "q", " new words", "\n "])) for _ in range(4)]
    done, at = [], 0
    for start, length, new in sorted(edits, key=lambda e: e[0]):
        a = min(max(start, at), len(text))
        done += [text[at:a], new]
        at = min(max(start + length, a), len(text))
    done = "".join([*done, text[at:]])
    got, _ = apply_edits(text, tree, edits, lambda t: len(reference(t)))
    assert got == done and tree.total == len(reference(done))


def test_edited_counts(spark, reference):
    rows = [(1, "one two three " * 30, [(4, 3, "2"), None, (20, 0, None)], 7), (2, None, None, 7), (2, "", [], 7), (None, "a b", [(0, 9, "z")], 7)]
    df = spark.createDataFrame(rows, "doc_id int, text string, edits array<struct<start:int,length:int,text:string>>, n_tokens int")
    out = edited_counts(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == sorted((i or 0, len(reference(t or ""))) for i, t, *_ in rows)
    one = next(r for r in out if r.doc_id == 1)
    assert one.edited_n_tokens == len(reference(rows[0][1][:4] + "2" + rows[0][1][7:])) and 0 < one.n_reencoded < one.n_chars
    assert sum(one.leaf_tokens) == one.edited_n_tokens
    assert edited_counts(df.limit(0), PATH).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 100, 1024])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))] + [rng.randint(1, capacity)] * rng.randint(0, 300)
    histogram = {n: sizes.count(n) for n in set(sizes)}
    load, large, used = {}, {}, {}
    for length, rank, pieces_, first, k, offset in packing_plan(histogram, capacity):
        assert used.get(length, 0) == rank
        used[length] = rank + pieces_
        for b in range(pieces_ // k):
            assert load.get(first + b, 0) == offset
            load[first + b] = offset + k * length
            large[first + b] = large.get(first + b, 0) + k * (3 * length > capacity)
    assert used == histogram and all(v <= capacity for v in load.values()) and all(v <= 2 for v in large.values())
    assert len(load) <= -(-sum(sizes) * 3 // (2 * capacity)) + sum(3 * n > capacity for n in sizes) // 2 + 1


def test_pack(spark, reference):
    texts = ["", None, "x " * 1500, "some words", "some words", "y" * 50, " tail " * 700]
    rows = [(i, t, 5, "seq") for i, t in enumerate(texts)] + [(3, "some words", 5, "seq"), (None, "no id", 5, "seq")]
    df = spark.createDataFrame(rows, "doc_id int, text string, length int, sequence_id string")
    out = pack_documents(df, PATH, capacity=64).collect()
    places = {}
    for r in out:
        ids = bytes(r.ids)
        assert len(ids) == 4 * r.length <= 256 and zlib.crc32(ids) == r.ids_crc32
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for of in places.values():
        of.sort()
        assert [o for o, _ in of] == [sum(n for _, n in of[:i]) for i in range(len(of))]
    for i, t in [(i, t) for i, t, *_ in rows if i != 3]:
        mine = sorted((r for r in out if r.doc_id == i), key=lambda r: r.piece)
        want = [*reference(t or ""), 2]
        assert [x for r in mine for x in memoryview(bytes(r.ids)).cast("I")] == want
        assert [r.start for r in mine] == [sum(q.length for q in mine[:k]) for k in range(len(mine))]
        assert all(r.length == 64 for r in mine[1:])
    assert len([r for r in out if r.doc_id == 3]) == 2
    assert pack_documents(df.limit(0), PATH).collect() == []
