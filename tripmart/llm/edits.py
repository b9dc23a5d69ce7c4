"""Token counts of documents under edits, without encoding them anew.

A document's pre-tokens are put together into leaves of some words; a segment tree over the leaves
keeps the code points and tokens of every subtree. An edit finds the leaves it touches by the code
points of subtrees, encodes these leaves with the edit in place, and updates the sums on their
paths to the root. Leaves begin at a space before a visible character, where a pre-token begins
whatever stands before. An edit within two characters of such a border may remove it, so the leaf on
the other side is encoded again too (boundary context). All other counts stand. No leaf begins at a
space before an added token, since white space before one is encoded together; as an edit may make
such a token, the context is longer than any of them.

Edits of a document are structs ``start, length, text`` in code points of the text before any
edit. They are applied in order of ``start``; one that starts inside the one before begins where
that one ends; places past the end mean the end. Null edits change nothing, null text is empty, null
replacements are empty. Repeated rows each get a row. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import slices
from tripmart.llm.tokens import ODD_SPACE, WordEncoder

LEAF_WORDS = 16
BORDER = re.compile(" (?=[!-~À-ɏ])")
CONTEXT = 2


def pieces(text: str, added: Collection[str] = ()) -> list[str]:
    """The text up to its first border, then what follows each border's space."""
    if any(t in text for t in added):
        return re.split(BORDER.pattern + "".join(f"(?!{re.escape(t)})" for t in added), text)
    return BORDER.split(text) if ODD_SPACE.search(text) else text.split(" ")


class CountTree:
    """Code points and tokens of leaves, with sums of all subtrees."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.width = 1
        while self.width < len(chars):
            self.width *= 2
        pad = [0] * (self.width - len(chars))
        self.chars = [0] * self.width + chars + pad
        self.tokens = [0] * self.width + tokens + pad
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place, and where it begins; the last one for later places."""
        place, i, begin = min(place, max(self.chars[1] - 1, 0)), 1, 0
        while i < self.width:
            i *= 2
            if place >= begin + self.chars[i]:
                begin += self.chars[i]
                i += 1
        return i - self.width, begin

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        i = leaf + self.width
        self.chars[i], self.tokens[i] = chars, tokens
        while i > 1:
            i //= 2
            self._sum(i)


def grow(text: str, counts: list[int], parts: list[str], leaf_words: int) -> CountTree:
    """Tree over leaves of some pieces, given the tokens of each piece."""
    chars, tokens = [], []
    for at in range(0, len(parts), leaf_words):
        part = parts[at : at + leaf_words]
        chars.append(sum(map(len, part)) + len(part) - (at == 0))
        tokens.append(sum(counts[at : at + leaf_words]))
    return CountTree(chars, tokens)


def apply_edits(
    text: str, tree: CountTree, edits: list[tuple[int, int, str]], count, context: int = CONTEXT
) -> tuple[str, int]:
    """The edited text and how many code points were encoded again. ``count`` gives the tokens
    of a text on its own."""
    done, encoded, shift = text, 0, 0
    at = 0
    for start, length, new in sorted(edits, key=lambda e: e[0]):
        a = min(max(start, at), len(text))
        b = min(max(start + length, a), len(text))
        at = b
        a, b = a + shift, b + shift
        shift += len(new) - (b - a)
        first, begin = tree.find(max(a - context, 0))
        last, end = tree.find(b + context)
        end += tree.chars[last + tree.width]
        region = done[begin:a] + new + done[b:end]
        done = done[:a] + new + done[b:]
        for leaf in range(first + 1, last + 1):
            tree.put(leaf, 0, 0)
        tree.put(first, len(region), count(region))
        encoded += len(region)
    return done, encoded


def edited_counts(
    docs: DataFrame,
    tokenizer_path: str,
    edits_col: str = "edits",
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_words: int = LEAF_WORDS,
) -> DataFrame:
    """``<id>, n_chars, n_tokens, edited_n_tokens, n_reencoded, edited_sha256, leaf_chars,
    leaf_tokens``: counts before and after the edits, code points encoded for the edits, and the
    leaves of the tree as the edits leave it."""
    source = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).alias("edits")
    )

    def run(batches):
        encoder = WordEncoder.of(tokenizer_path)
        count = lambda t: len(encoder.whole(t)) // 4
        context = max(CONTEXT, *(len(t) + 1 for t in encoder.added), 0)
        for part, texts in slices(batches, "text"):
            cut = [pieces(t, encoder.added) for t in texts]
            encoder.learn({w for p in cut for w in p[1:]})
            cache = encoder.cache
            out = [[] for _ in range(7)]
            for text, parts, edits in zip(texts, cut, part.column(2).to_pylist()):
                counts = [count(parts[0]), *[len(cache[w]) // 4 for w in parts[1:]]]
                tree = grow(text, counts, parts, leaf_words)
                before = tree.total
                wanted = [(e["start"] or 0, e["length"] or 0, e["text"] or "") for e in edits or [] if e]
                done, encoded = apply_edits(text, tree, wanted, count, context)
                leaves = slice(tree.width, tree.width + -(-len(parts) // leaf_words))
                digest = hashlib.sha256(done.encode()).hexdigest()
                for c, v in zip(out, (len(text), before, tree.total, encoded, digest, tree.chars[leaves], tree.tokens[leaves])):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 2
            names = ["n_chars", "n_tokens", "edited_n_tokens", "n_reencoded", "edited_sha256", "leaf_chars", "leaf_tokens"]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))], ["id", *names]
            )

    kind = source.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_chars long, n_tokens long, edited_n_tokens long, n_reencoded long, edited_sha256 string,"
        " leaf_chars array<int>, leaf_tokens array<int>"
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
