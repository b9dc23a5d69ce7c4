"""Language identification with bit-sliced Bloom filters of letter n-grams.

One Bloom filter per language, sliced by bits: cell ``i`` of the table holds a bit for every
language, so the AND of the cells of an n-gram is the set of all languages that contain it, in
two reads; a cell has one 64-bit word for each 64 languages. A text's score for a language is the share of its
n-grams that the language contains, corrected for the filter's share of false positives; the
highest corrected share decides.

A language contains an n-gram when at least ``min_documents`` of its training documents do and
its share of documents is at least ``min_ratio`` of the highest share of any language. Training
counts documents per language and n-gram cell in Spark; the table that reaches the driver has
``2 ** cell_bits`` cells at most, of as many bits as there are languages.

Training uses at most ``sample_per_language`` documents of each language, those with the smallest
hash of text, copies counted once; this bound is a parameter. Rows without language or letters are not used. Null
texts and texts without any letter get ``und`` and score 0. With no training rows all texts
with letters get ``und`` too. Repeated rows each get a row. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import slices

SAMPLE_PER_LANGUAGE = 3000
CELL_BITS = 20
UNKNOWN = "und"
NGRAM = 3
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _letter_classes() -> np.ndarray:
    """For every code point of the first plane: its lower-case code if a letter, else 0."""
    out = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        ch = chr(c)
        if ch.isalpha():
            out[c] = ord(ch.lower()[0])
    return out


_LETTERS: list[np.ndarray] = []


def grams(texts: list[str], n: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every n-gram of letters; words are led and closed by a blank and
    all other characters part words."""
    if not _LETTERS:
        _LETTERS.append(_letter_classes())
    joined = "\n\n" + "\n\n".join(texts) + "\n\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = codes > 0xFFFF
    letters = _LETTERS[0][np.where(beyond, 0, codes)]
    for i in np.nonzero(beyond)[0]:
        if chr(codes[i]).isalpha():
            letters[i] = codes[i]
    lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    last = len(owner) - n + 1
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # A gram begins at a blank or letter before a letter and has no blank inside.
    word = letters > 0
    whole = word[1 : 1 + last].copy()
    for k in range(2, n - 1):
        whole &= word[k : k + last]
    at = np.nonzero(whole)[0]
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        h = (h ^ letters[at + k].astype(np.uint64)) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return h, owner[at]


def cells(h: np.ndarray, which: int, cell_bits: int) -> np.ndarray:
    return (h * np.uint64(MULTIPLIERS[which])) >> np.uint64(64 - cell_bits)


@dataclass(frozen=True)
class LanguageFilters:
    """``table``: a bit mask of languages per cell, in 64-bit words; ``false_share``: per language, how often an
    n-gram that it lacks passes its filter."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_share: np.ndarray
    cell_bits: int

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of n-grams per text and language; number of n-grams per text."""
        h, owner = grams(texts)
        masks = self.table[cells(h, 0, self.cell_bits)] & self.table[cells(h, 1, self.cell_bits)]
        total = np.bincount(owner, minlength=len(texts))
        hits = np.stack([
            np.bincount(owner, weights=(masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), minlength=len(texts))
            for i in range(len(self.languages))
        ], axis=1) if self.languages else np.zeros((len(texts), 0))
        share = hits / np.maximum(total, 1)[:, None]
        return np.clip((share - self.false_share) / (1 - self.false_share), 0, 1), total


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    cell_bits: int = CELL_BITS,
    min_documents: int = 2,
    min_ratio: float = 0.25,
) -> LanguageFilters:
    """Filters from the rows of ``docs``, which are all training rows."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    first = Window.partitionBy("lang").orderBy("order")
    # Copies are one text, or a large group of them would fill the sample: they are combined first.
    edge = rows.select("lang", F.xxhash64("text").alias("order")).distinct()
    # A top-k per language, which Spark cuts before the shuffle: k hashes per task and language.
    edge = edge.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_per_language)
    # One row per language.
    limits = {r.lang: r.limit for r in edge.groupBy("lang").agg(F.max("order").alias("limit")).collect()}
    languages = sorted(limits)
    place = {lang: i for i, lang in enumerate(languages)}
    spark = docs.sparkSession
    kind = rows.schema["lang"].dataType.simpleString()
    ends = spark.createDataFrame([(x, limits[x]) for x in languages], f"lang {kind}, limit long")
    # Equal texts share a hash: one of each is enough.
    sample = rows.join(F.broadcast(ends), "lang").filter(F.xxhash64("text") <= F.col("limit"))
    sample = sample.select("lang", "text").dropDuplicates(["lang", "text"])

    def count(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, texts in slices([batch], "text"):
                langs = part.column(0).to_pylist()
                h, owner = grams(texts)
                # One count per document, language and n-gram.
                key = np.unique(np.stack([owner.astype(np.uint64), h], axis=1), axis=0)
                lang = np.array([place[x] for x in langs])[key[:, 0].astype(np.int64)]
                for i in np.unique(lang):
                    a = totals.setdefault(int(i), {})
                    values, n = np.unique(key[lang == i, 1], return_counts=True)
                    for v, c in zip(values.tolist(), n.tolist()):
                        a[v] = a.get(v, 0) + c
        for i, a in totals.items():
            h = np.fromiter(a, np.uint64, len(a)).view(np.int64)
            n = np.fromiter(a.values(), np.int64, len(a))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(h), i, np.int32)), pa.array(h), pa.array(n)], ["lang", "gram", "n"]
            )

    counted = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    sizes = {place[r.lang]: r.n for r in sample.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    docs_of = spark.createDataFrame(list(sizes.items()), "lang int, size long")
    kept = counted.filter(F.col("n") >= min_documents).join(F.broadcast(docs_of), "lang")
    kept = kept.select("gram", "lang", (F.col("n") / F.col("size")).alias("share"))
    best = kept.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("in"), F.max("share").alias("top"))
    # The set of languages of an n-gram as bits by word, OR-ed into the two cells of the n-gram.
    held = F.filter("in", lambda x: x["share"] >= F.col("top") * min_ratio)
    best = best.select("gram", F.explode(held).alias("x")).groupBy("gram", F.expr("x.lang div 64").cast("int").alias("word"))
    best = best.agg(F.bit_or(F.expr("shiftleft(1L, x.lang % 64)")).alias("bits"))

    def locate(batches):
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            both = np.concatenate([cells(h, 0, cell_bits), cells(h, 1, cell_bits)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both), *(pa.concat_arrays([c, c]) for c in batch.columns[1:])], ["cell", "word", "bits"]
            )

    placed = best.mapInArrow(locate, "cell long, word int, bits long")
    found = placed.groupBy("cell", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros((1 << cell_bits, max(1, -(-len(languages) // 64))), np.uint64)
    at = found.column("cell").to_numpy(), found.column("word").to_numpy()
    table[at] = found.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    filled = np.array([np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))])
    return LanguageFilters(tuple(languages), table, filled**2, cell_bits)


def predict(
    docs: DataFrame, model: LanguageFilters, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns with ``lang_pred`` and ``score``, the corrected share of n-grams that
    the language contains. Texts without an n-gram in any filter get the first language in
    order, with score 0, as they do have letters."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def batches_of(batches):
        filters = shared.value
        for part, texts in slices(batches, "_text"):
            score, total = filters.scores(texts)
            if filters.languages:
                best = score.argmax(axis=1)
                names = [filters.languages[b] if n else UNKNOWN for b, n in zip(best, total)]
                value = np.where(total > 0, score[np.arange(len(best)), best], 0.0)
            else:
                names, value = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(names, pa.string()), pa.array(value, pa.float64())],
                [*part.schema.names[:-1], "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(batches_of, f"{fields}, lang_pred string, score double")
