"""License labels of documents: phrases, and text blocks that contain a license template.

Phrases are counted at every place where their words stand one after another. The set
similarity join finds, for every block of a text, the templates of which it holds at least
``threshold`` of the distinct words. Blocks are the lines, and for each template all runs of as many
words as it has, across line ends, so that wrapped notices are found:

* Words are ordered by how many documents hold them, rarest first. Only the templates' words
  need a count, so the order is a table of the size of the templates, counted over all texts.
* A block that holds ``k`` of a template's ``n`` words must hold one of the ``n - k + 1`` rarest:
  these are the template's prefix. Blocks without any prefix word are never looked at (prefix filter).
* A block of fewer than ``k`` distinct words is dropped (length filter). If its first prefix word
  is at place ``i`` of the template, ``n - i`` words can still match; fewer than ``k`` drop it
  (positional filter). What is left is compared word by word.
* Runs are looked at only for templates of which the whole text holds ``k`` words. A run that holds the
  most can be taken to begin at one of them, so only the places of the template's words are gone through.

Null and empty texts have no words and no labels. Ties of rarity are ordered by word. Repeated rows
each get a row. An empty table yields no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import LOWER, UPPER, slices

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening sentences of licenses, and labels. Common notices, in their usual words.
TEMPLATES = {
    "this work is licensed under the gnu general public license version": "gpl",
    "this program is free software you can redistribute it and or modify it under the terms of the"
    " gnu general public license": "gpl",
    "licensed under the apache license version 2 0 you may not use this file except in compliance"
    " with the license": "apache",
    "licensed under the apache license version 2 0": "apache",
    "permission is hereby granted free of charge to any person obtaining a copy of this software":
        "mit",
    "released under the mit license": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted":
        "bsd",
    "licensed under a creative commons attribution license": "cc-by",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "all rights reserved no part of this publication may be reproduced without permission":
        "all-rights-reserved",
}
THRESHOLD = 0.8

# Whatever parts words becomes a blank, a line end stays one; both after A-Z became a-z.
_PART = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum() and c != 10)
_TABLE = str.maketrans(UPPER + _PART, LOWER + " " * len(_PART))


def plain(text: str) -> str:
    return text.translate(_TABLE)


# White space to Python that parts no words here.
_NO_BREAK = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def words_of(flat: str) -> list[str]:
    """Words of a plain text: cut at blanks and line ends only."""
    if _NO_BREAK.search(flat):
        return [w for w in flat.replace("\n", " ").split(" ") if w]
    return flat.split()


def needed(words: int, threshold: float) -> int:
    return math.ceil(threshold * words - 1e-9)


def document_counts(docs: DataFrame, vocabulary: set[str], text_col: str = "text") -> dict[str, int]:
    """How many texts hold each word of a vocabulary of bounded size."""

    def count(batches):
        counts = dict.fromkeys(vocabulary, 0)
        for _, texts in slices(batches, "text"):
            for text in texts:
                for word in vocabulary.intersection(words_of(plain(text))):
                    counts[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    found = source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return dict.fromkeys(vocabulary, 0) | {r.word: r.n for r in found.collect()}


class TemplateIndex:
    """Templates with their words in order of rarity, by prefix word."""

    def __init__(self, templates: Mapping[str, str], counts: Mapping[str, int], threshold: float):
        self.entries: dict[str, list[tuple]] = {}
        self.templates: list[tuple[frozenset[str], frozenset[str], int, int, str]] = []
        for template, label in sorted(templates.items()):
            words = sorted(set(template.split()), key=lambda w: (counts.get(w, 0), w))
            k = needed(len(words), threshold)
            prefix = frozenset(words[: len(words) - k + 1])
            self.templates.append((frozenset(words), prefix, k, len(template.split()), label))
            for i, word in enumerate(words[: len(words) - k + 1]):
                self.entries.setdefault(word, []).append((i, words, k, label))
        self.prefix = set(self.entries)

    def matches(self, block: set[str]) -> dict[str, float]:
        """Labels of the templates that a block contains, with the highest containment."""
        out: dict[str, float] = {}
        for word in self.prefix & block:
            for i, words, k, label in self.entries[word]:
                if len(block) < k or len(words) - i < k:
                    continue
                # The first prefix word of the block decides, so each pair is compared once.
                if any(w in block for w in words[:i]):
                    continue
                held = sum(w in block for w in words[i:])
                if held >= k:
                    out[label] = max(out.get(label, 0.0), held / len(words))
        return out


    def runs(self, words: list[str]) -> dict[tuple[int, str], float]:
        """Containment of the runs of words that contain a template, by first place and label."""
        text, out = set(words), {}
        for of, prefix, k, length, label in self.templates:
            if prefix.isdisjoint(text) or len(of & text) < k:
                continue
            places = [p for p, w in enumerate(words) if w in of]
            held: dict[str, int] = {}
            end = 0
            for begin in places:
                while end < len(places) and places[end] < begin + length:
                    w = words[places[end]]
                    held[w] = held.get(w, 0) + 1
                    end += 1
                if len(held) >= k:
                    out[begin, label] = max(out.get((begin, label), 0.0), len(held) / len(of))
                w = words[begin]
                held[w] -= 1
                if not held[w]:
                    del held[w]
        return out


def license_labels(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``<id>, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks``.

    ``blocks`` lists the lines that contain a template: number of the line, label, containment; after
    them, by the line where they begin, the runs of words that contain more than any line does.
    ``score`` is 1 with a phrase, else the highest containment found.
    """
    vocabulary = {w for t in templates for w in t.split()}
    counts = document_counts(docs, vocabulary, text_col)
    index = TemplateIndex(templates, counts, threshold)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def scan(text: str):
        flat = plain(text)
        words = words_of(flat)
        joined = " " + " ".join(words) + " "
        places, labels = [], set()
        for phrase, label in phrases.items():
            at, seen, before = joined.find(f" {phrase} "), 0, 0
            while at >= 0:
                before += joined.count(" ", seen, at)
                seen = at
                places.append(before)
                labels.add(label)
                at = joined.find(f" {phrase} ", at + 1)
        blocks = []
        if not index.prefix.isdisjoint(words):
            for line, block in enumerate(flat.split("\n")):
                for label, share in sorted(index.matches(set(words_of(block))).items()):
                    blocks.append({"line": line, "label": label, "share": share})
            best: dict[str, float] = {}
            for b in blocks:
                best[b["label"]] = max(best.get(b["label"], 0.0), b["share"])
            runs = {at: share for at, share in index.runs(words).items() if share > best.get(at[1], 0.0)}
            if runs:
                line_of = [line for line, block in enumerate(flat.split("\n")) for _ in words_of(block)]
                found: dict[tuple[int, str], float] = {}
                for (at, label), share in runs.items():
                    found[line_of[at], label] = max(found.get((line_of[at], label), 0.0), share)
                blocks += [{"line": line, "label": label, "share": x} for (line, label), x in sorted(found.items())]
        every = labels | {b["label"] for b in blocks}
        score = 1.0 if labels else max((b["share"] for b in blocks), default=0.0)
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(every)), score, blocks,
        )

    block_type = pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("share", pa.float64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), block_type]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]

    def run(batches):
        for part, texts in slices(batches, "text"):
            columns = list(zip(*map(scan, texts))) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))], ["id", *names]
            )

    kind = source.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string,"
        " labels string, score double, blocks array<struct<line: int, label: string, share: double>>"
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
