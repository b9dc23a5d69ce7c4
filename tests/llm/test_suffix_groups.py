"""The suffix array and repeated windows against sorting and counting."""

import random

import pytest

from tripmart.llm.suffix_groups import repeated_windows, suffix_array


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array(seed):
    rng = random.Random(seed)
    s = [rng.randint(1, rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 120))]
    s = s + s[: rng.randint(0, len(s))] + [0]
    assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("seed", range(40))
def test_repeated_windows(seed):
    rng = random.Random(seed)
    letters = rng.choice([b"a", b"ab", bytes(range(97, 123))])
    piece = lambda n: bytes(rng.choice(letters) for _ in range(n))
    shared = [piece(rng.randint(30, 90) * (1 + 9 * (seed % 2))) for _ in range(3)]
    texts = [piece(rng.randint(0, 40)) + rng.choice(shared) + piece(rng.randint(0, 60)) for _ in range(6)]
    length = rng.choice([20, 40, 300])
    count = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            count[t[p : p + length]] = count.get(t[p : p + length], 0) + 1
    found = repeated_windows(texts, length)
    for t, marks in zip(texts, found):
        assert marks.tolist() == [count[t[p : p + length]] > 1 for p in range(len(t) - length + 1)]
