"""Katz backoff scores of texts: over all word n-grams (``katz_scores``, in ``ngrams.py``), and the
smaller model over word classes (``fit`` and ``score``), which the rest of this text is about.

Tokens are words and one end per text. Words fall into classes: each of the ``classes`` most
frequent ones is a class of its own, all others, unseen ones included, form one. The model is

    P(word | previous) = P(class | previous class) * P(word | class)

* ``P(class | previous)``: bigram counts, discounted by Good-Turing up to ``MAX_DISCOUNTED``;
  what the discount frees goes to classes not seen after the previous one, in proportion to their
  unigram share: ``backoff(previous) * P(class)``, with backoff weights that make each row
  sum to one exactly.
* ``P(word | class)``: one for a class of one word; in the class of all others the Good-Turing
  discounted share of the word, and what is freed for unseen words together.

All counts run over all training texts in Spark: unigrams per word without bound, stored as a
table; bigrams of classes, of which there are at most ``(classes + 2) ** 2``, whatever the input.
That bound lets the bigram table and the counts of the ``known`` most frequent words be sent to
every task; the counts of all other words meet the texts that hold them in a join on the word.
Words are kept as 64-bit hashes.

If the counts of counts give no valid discount (very small tables), a half is taken off each count
instead; a row without any freed share gets one further count. Null and empty texts are one end.
With no training rows every word is unseen. Repeated rows each get a row. Only the named
columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ASCII_LOWER, slices, stored

CLASSES = 1024
KNOWN = 200_000
MAX_DISCOUNTED = 5
CACHE_WORDS = 500_000
END = b"\n"  # no word holds white space


def word_hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    h = xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def tokens(text: str) -> list[bytes]:
    return [*text.encode().translate(ASCII_LOWER).split(), END]


def good_turing(counts: dict[int, int]) -> list[float]:
    """Factor for each count from 0 to ``MAX_DISCOUNTED``, from how many items have each count."""
    k = MAX_DISCOUNTED
    half = [1.0] + [(r - 0.5) / r for r in range(1, k + 1)]
    n = [counts.get(r, 0) for r in range(k + 2)]
    if not all(n[1 : k + 2]):
        return half
    tail = (k + 1) * n[k + 1] / n[1]
    if tail >= 1:
        return half
    found = [1.0] + [((r + 1) * n[r + 1] / n[r] / r - tail) / (1 - tail) for r in range(1, k + 1)]
    return found if all(0 < d < 1 for d in found[1:]) else half


def _discounted(count: Column, factors: list[float]) -> Column:
    out = count.cast("double")
    for r, f in enumerate(factors[1:], start=1):
        out = F.when(count == r, F.lit(f * r)).otherwise(out)
    return out


def unigrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n``: how often each word hash, ends included, occurs in all texts."""

    def count(batches):
        counts: dict[bytes, int] = {}

        def out():
            words = pa.array([word_hash(w) for w in counts], pa.int64())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for _, texts in slices(batches, "text"):
            for text in texts:
                for word in tokens(text):
                    counts[word] = counts.get(word, 0) + 1
            if len(counts) > CACHE_WORDS:
                yield out()
                counts.clear()
        yield out()

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words: sorted hashes, their counts, and their classes. Class ``classes``
    holds all other words, and ``classes + 1`` stands for the start of a text."""

    words: np.ndarray
    counts: np.ndarray
    of_class: np.ndarray
    classes: int

    @classmethod
    def of(cls, counted: DataFrame, classes: int, known: int) -> "Vocabulary":
        """The words of the highest bands of counts, as many bands as hold ``known`` words at most.
        A band is a sixteenth of a doubling, so there are 1,024 at most; a threshold instead of a
        top-k keeps each task from sending ``known`` rows of its own to the driver."""
        band = F.floor(F.log2(F.col("n").cast("double")) * 16)
        sizes = counted.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("m")).collect()
        lowest, held = float("inf"), 0
        for r in sorted(sizes, key=lambda r: -r.band):
            held += r.m
            if held > known:
                break
            lowest = r.band
        top = counted.filter(band >= F.lit(lowest)).toPandas()
        words, counts = top.word.to_numpy(np.int64), top.n.to_numpy(np.int64)
        order = np.lexsort([words, -counts])
        rank = np.empty(len(words), np.int64)
        rank[order] = np.minimum(np.arange(len(words)), classes)
        order = np.argsort(words)
        return cls(words[order], counts[order], rank[order], classes)

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0: not among these) and class of word hashes."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.full(len(hashes), self.classes)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = self.words[at] == hashes
        return np.where(found, self.counts[at], 0), np.where(found, self.of_class[at], self.classes)


class WordTable:
    """Words that a task has met: numbers, and arrays by number."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.of_class = np.zeros(0, np.int64)

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.clear()
        number, new = self.number, []
        for words in texts:
            for word in words:
                if word not in number:
                    number[word] = len(number)
                    new.append(word)
        if new:
            hashes = np.array([word_hash(w) for w in new], np.int64)
            counts, of_class = self.vocabulary.look(hashes)
            self.hashes = np.concatenate([self.hashes, hashes])
            self.counts = np.concatenate([self.counts, counts])
            self.of_class = np.concatenate([self.of_class, of_class])
        look = number.__getitem__
        return [np.fromiter(map(look, words), np.int64, len(words)) for words in texts]


def class_bigrams(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``h, w, n``: how often each class follows each class in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    side = vocabulary.classes + 2

    def count(batches):
        table = WordTable(shared.value)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, texts in slices(batches, "text"):
            found = []
            for numbers in table.numbers([tokens(t) for t in texts]):
                of = table.of_class[numbers]
                found.append(np.concatenate([[side - 1], of[:-1]]) * side + of)
            new, n = np.unique(np.concatenate(found), return_counts=True)
            keys, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    summed = source.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return summed.select(F.expr(f"key div {side}").alias("h"), (F.col("key") % side).alias("w"), "n")


@dataclass(frozen=True)
class KatzModel:
    """Log10 tables: ``bigram[h, w]`` (nan: not seen), ``backoff[h]``, ``unigram[w]``, and within the
    class of other words ``rare`` by discounted count and ``unseen``."""

    vocabulary: Vocabulary
    bigram: np.ndarray
    backoff: np.ndarray
    unigram: np.ndarray
    rare_total: float
    rare_factors: tuple[float, ...]
    unseen: float
    tokens: int
    types: int

    def classes(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Log10 probability of classes after classes: the bigram, or else back off."""
        found = self.bigram[h, w]
        return np.where(np.isnan(found), self.backoff[h] + self.unigram[w], found)

    def within(self, counts: np.ndarray) -> np.ndarray:
        """Log10 probability of words of the class of other words, by their training counts."""
        factor = np.ones(len(counts))
        low = counts <= MAX_DISCOUNTED
        factor[low] = np.array(self.rare_factors)[counts[low]]
        with np.errstate(divide="ignore"):
            seen = np.log10(factor * counts / max(self.rare_total, 1.0))
        return np.where(counts > 0, seen, self.unseen)


def _counts_of_counts(df: DataFrame) -> dict[int, int]:
    few = df.filter(F.col("n") <= MAX_DISCOUNTED + 1).groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    return {r.n: r.m for r in few.collect()}


def fit(counted: DataFrame, train: DataFrame, classes: int = CLASSES, known: int = KNOWN) -> KatzModel:
    """A model from the stored ``unigrams`` of the training texts and these texts themselves."""
    spark = train.sparkSession
    total, types = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    vocabulary = Vocabulary.of(counted, classes, known)
    own = vocabulary.of_class < classes
    single = spark.createDataFrame([(int(w),) for w in vocabulary.words[own]], "word long")
    others = counted.join(F.broadcast(single), "word", "left_anti")  # at most `classes` rows
    factors = good_turing(_counts_of_counts(others))
    kept, rare_total = others.agg(
        F.coalesce(F.sum(_discounted(F.col("n"), factors)), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    if rare_total and rare_total - kept < 1e-9 * rare_total:
        unseen, norm = math.log10(1 / (rare_total + 1)), rare_total + 1.0
    else:
        unseen, norm = (math.log10((rare_total - kept) / rare_total) if rare_total else 0.0), float(rare_total)
    # Unigrams of classes; the class of other words counts once at least.
    share = np.zeros(classes + 2)
    share[vocabulary.of_class[own]] = vocabulary.counts[own]
    share[classes] = max(rare_total, 1)
    share /= share.sum()
    bigrams = stored(spark, class_bigrams(train, vocabulary), "katz-bigrams")
    of_bigrams = good_turing(_counts_of_counts(bigrams))
    unigram = spark.createDataFrame([(i, float(s)) for i, s in enumerate(share)], "w long, share double")
    rows = bigrams.join(F.broadcast(unigram), "w").withColumn("kept", _discounted(F.col("n"), of_bigrams))
    sums = rows.groupBy("h").agg(
        F.sum("n").alias("all"), F.sum("kept").alias("kept"), F.sum("share").alias("seen")
    )
    # At most classes + 2 rows and (classes + 2) ** 2 rows.
    history, table = sums.toPandas(), rows.select("h", "w", "kept").toArrow()
    of_h, kept_h = history.h.to_numpy(np.int64), history.kept.to_numpy(float)
    everything = 1 - history.seen.to_numpy(float) < 1e-12
    norm_h = history["all"].to_numpy(float)
    norm_h = np.where(everything, kept_h, np.where(norm_h - kept_h < 1e-9, norm_h + 1, norm_h))
    divisor = np.ones(classes + 2)
    divisor[of_h] = norm_h
    backoff = np.zeros(classes + 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        free = np.where(everything, 0.0, (1 - kept_h / norm_h) / (1 - history.seen.to_numpy(float)))
        backoff[of_h] = np.log10(free)
        log_share = np.log10(share)
    bigram = np.full((classes + 2, classes + 2), np.nan)
    h, w = table.column("h").to_numpy(), table.column("w").to_numpy()
    bigram[h, w] = np.log10(table.column("kept").to_numpy() / divisor[h])
    return KatzModel(vocabulary, bigram, backoff, log_share, norm, tuple(factors), unseen, total, types)


def score(
    docs: DataFrame, counted: DataFrame, model: KatzModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns with ``n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text_col).cast("string").alias("text"))

    def run(batches):
        from pyspark import TaskContext

        m: KatzModel = shared.value
        table, row = WordTable(m.vocabulary), TaskContext.get().partitionId() << 40
        rare_class, start = m.vocabulary.classes, m.vocabulary.classes + 1
        for part, texts in slices(batches, "text"):
            cut = [tokens(t) for t in texts]
            columns = [[] for _ in range(7)]
            for numbers in table.numbers(cut):
                counts, of = table.counts[numbers], table.of_class[numbers]
                value = m.classes(np.concatenate([[start], of[:-1]]), of).sum()
                met = counts > 0
                value += m.within(counts[met & (of == rare_class)]).sum()
                words, n = np.unique(table.hashes[numbers[~met]], return_counts=True)
                for c, v in zip(columns, (row, len(numbers), int(met.sum()), float(np.log10(counts[met] + 1).sum()),
                                          float(value), words, n.astype(np.int32))):
                    c.append(v)
                row += 1
            ends = np.concatenate([[0], np.cumsum([len(w) for w in columns[5]])]).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(c)))
                for c in columns[5:]
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *(pa.array(c) for c in columns[:5]), *lists],
                [*part.schema.names[:-1], "_row", "n_tokens", "_met", "_base", "_value", "_words", "_n"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    rows = source.mapInArrow(
        run, f"{fields}, _row long, n_tokens long, _met long, _base double, _value double, _words array<long>, _n array<int>"
    )
    # Stored, so that row numbers stay what they are.
    rows = stored(spark, rows, "katz-texts")
    met = rows.select("_row", F.explode_outer(F.arrays_zip("_words", "_n")).alias("_r"))
    met = met.filter("_r is not null").select("_row", F.col("_r._words").alias("word"), F.col("_r._n").alias("m"))
    counts = met.join(counted, "word", "left").select("_row", "m", F.coalesce("n", F.lit(0)).alias("n"))
    # As KatzModel.within, for the words that only the join has counts of.
    seen = F.log10(_discounted(F.col("n"), list(model.rare_factors)) / F.lit(max(model.rare_total, 1.0)))
    within = F.when(F.col("n") > 0, seen).otherwise(F.lit(model.unseen))
    added = counts.groupBy("_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("_more"),
        F.sum(F.col("m") * F.log10(F.col("n") + 1.0)).alias("_base2"),
        F.sum(F.col("m") * within).alias("_value2"),
    )
    per_token = math.log10(model.tokens + model.types + 1)
    return rows.drop("_words", "_n").join(added, "_row", "left").select(
        *keep,
        "n_tokens",
        (F.col("_met") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_base2", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("_value") + F.coalesce("_value2", F.lit(0.0))).alias("score"),
    )


def katz_scores(
    docs: DataFrame,
    train: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    order: int = 2,
) -> DataFrame:
    """Scores of ``docs`` under all word n-grams of ``train`` (``ngrams.py``)."""
    from tripmart.llm import ngrams

    counted = stored(docs.sparkSession, ngrams.count_ngrams(train, order, text_col), "katz-ngrams")
    table, totals = ngrams.fit(counted, order)
    return ngrams.score(docs, table, totals, order, text_col, keep)


def katz_scores_by_part(
    docs: DataFrame, learn: Column, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), order: int = 2
) -> DataFrame:
    """Scores of all ``docs`` under all word n-grams of those where ``learn`` holds (``ngram_chunks.py``)."""
    from tripmart.llm import ngram_chunks

    return ngram_chunks.scores_by_part(docs, learn, text_col, keep, order)
