"""Token ids of texts, encoded once per distinct word of a task.

A byte-level BPE of this family first cuts a text into pre-tokens and never merges across
their borders, and a space before a visible character always begins a pre-token. Words recur,
so a text is cut at its spaces and only words that the task has not met yet are encoded, all of
a batch in one call. The table of words is a cache of bounded size; dropping it costs time only.
Texts with other white space next to a space are encoded as they are.

Added tokens of the file (``<|endoftext|>``) are cut out of texts first, as ``tokenizers`` does, and
what stands between them is encoded on its own. With ``encode_special_tokens``, which has the name and
the meaning it has there, their characters are ordinary text.

The vocabulary file is that of ``tokenizers``; its ids are computed through the same vocabulary
in ``tiktoken``'s form, which is several times faster (``tests/llm`` hold both equal).
"""

from __future__ import annotations

import re

import numpy as np

# A space that is not followed by visible ASCII or a Latin letter.
ODD_SPACE = re.compile(" (?![!-~À-ɏ])")
# The table of words may hold so many bytes; an entry costs its text, its ids and about as much again
# for the objects that hold them.
CACHE_BYTES = 64 << 20
ENTRY_BYTES = 190
_ENCODERS: dict[str, "WordEncoder"] = {}


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """Text and id of the added tokens of a vocabulary."""
    import json

    with open(tokenizer_path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens") or []
    for t in found:
        if t["lstrip"] or t["rstrip"] or t["single_word"] or not t["content"] or re.search(r"\s", t["content"]):
            raise ValueError(f"added token with white space, stripping or word borders: {t['content']!r}")
    return {t["content"]: t["id"] for t in found}


def json_ranks(tokenizer_path: str) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE vocabulary; each byte is written as one
    printable character, those that are not printable as the characters from 256 on."""
    import json

    with open(tokenizer_path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    to_byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    added = set(added_tokens(tokenizer_path))
    return {
        bytes(to_byte[c] for c in token): i
        for token, i in vocab.items()
        if all(c in to_byte for c in token) and token not in added
    }


class WordEncoder:
    """Ids of texts as little-endian 32-bit words."""

    def __init__(self, tokenizer_path: str, cache_bytes: int = CACHE_BYTES, encode_special_tokens: bool = True):
        import public_tokenizers
        import tiktoken

        ranks = json_ranks(tokenizer_path)
        self.encoding = tiktoken.Encoding(
            "pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.width[i] = len(token)
        added = {} if encode_special_tokens else added_tokens(tokenizer_path)
        self.added = {t: int(i).to_bytes(4, "little") for t, i in added.items()}
        # The longest of those that begin at a place.
        longest = sorted(self.added, key=lambda t: (-len(t), t))
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.cache: dict[str, bytes] = {}
        self.cache_bytes, self.held = cache_bytes, 0

    @classmethod
    def of(cls, tokenizer_path: str) -> "WordEncoder":
        """One encoder for each worker process, kept from task to task; it knows the added tokens."""
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = cls(tokenizer_path, encode_special_tokens=False)
        return _ENCODERS[tokenizer_path]

    def has_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def whole(self, text: str) -> bytes:
        if self.has_added(text):
            return b"".join(self.added.get(p) or self.whole(p) for p in self.cuts.split(text) if p)
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that follow a space and are new."""
        if self.held > self.cache_bytes:
            self.cache.clear()
            self.held = 0
        new = list(words.difference(self.cache))
        # A word of n bytes has at most n + 1 ids of four bytes.
        self.held += sum(ENTRY_BYTES + 5 * len(w) for w in new)
        if self.added:
            for word in filter(self.has_added, new):
                self.cache[word] = self.whole(" " + word)
            new = [w for w in new if w not in self.cache]
        if not new:
            return
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(new)), "<u4")
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in new), np.int64, len(new)))
        cuts = (4 * np.searchsorted(np.cumsum(self.width[ids]), ends, "left") + 4).tolist()
        buffer, at = ids.tobytes(), 0
        for word, cut in zip(new, cuts):
            self.cache[word] = buffer[at:cut]
            at = cut

    def encode_many(self, texts: list[str]) -> list[bytes]:
        cut = [None if ODD_SPACE.search(t) or self.has_added(t) else t.split(" ") for t in texts]
        words: set[str] = set()
        for parts in cut:
            if parts:
                words.update(parts[1:])
        self.learn(words)
        look, out = self.cache.__getitem__, []
        for text, parts in zip(texts, cut):
            if parts is None:
                out.append(self.whole(text))
            else:
                out.append(self.whole(parts[0]) + b"".join(map(look, parts[1:])))
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]
