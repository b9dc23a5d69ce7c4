"""Toxicity by a subsequence string kernel, a linear machine on Nystroem landmarks.

The kernel of two words counts the letter triples that both hold in order, each weighted by a
decay for the characters skipped inside it (two at most), over the lengths of both feature
vectors. A word with an inserted or a dropped letter, a dot between its letters or another ending
still shares most triples with the plain word. Letters set apart by spaces are read as one word.

* Landmarks are words of the training texts: those that go with the label most, and others.
* A support vector machine with squared hinge loss is trained on the landmark features
  ``K(words, landmarks) K(landmarks, landmarks) ** -1/2``. Labels are given to whole texts, so a
  word counts as positive where texts that hold it are toxic beyond what chance gives to any
  of all words. Training repeats with the clean words that the machine scores highest added.
* The machine is linear in the landmarks' triples. Summed up once into a table of triples, it
  scores a word in one pass over its characters; each distinct word of a task is scored once.
* A text's features are its two highest word scores; logistic regression turns them into a
  probability.

Training takes at most ``sample_per_class`` labelled texts of each class, by the smallest hash
of the id; copies and near copies, which share the smallest hash of a shingle, count once. Words
are counted over these in Spark, and at most ``max_words`` of each kind reach the driver. Scoring reads whole texts. Null and empty texts are scored as texts without words.
Repeated rows each get a row; rows without a label are not trained on; without labels of
both classes every score is 0. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import slices, stored

SAMPLE_PER_CLASS = 3000
MAX_WORDS = 3000
LANDMARKS = 512
DECAY = 0.6
GAPS = tuple((a, b) for a in range(3) for b in range(3) if a + b <= 2)
FLOOR, CEILING = -1.5, 1.0
ROUNDS = 3
CODES = 32
SPACED = re.compile(r"(?<!\S)(?:[^\W\d_] ){2,}[^\W\d_](?!\S)")
CACHE_WORDS = 500_000


def _codes(text: str) -> np.ndarray:
    """A class for every character: 1-26 for a-z, 27-30 for other letters, 31 for the start of a
    word, 0 for what is no letter, 255 for blanks between words."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points), np.uint8)
    ascii_ = (points >= 97) & (points <= 122)
    out[ascii_] = points[ascii_] - 96
    other = points >= 0xAA
    out[other] = 27 + points[other] % 4
    out[points == 10] = 255
    out[points == 1] = 31
    return out


def triples(words: list[str]):
    """For every way to skip characters: (weight, places, word numbers, triple numbers)."""
    text = "\n".join("\x01" + w.replace("\n", " ") for w in words) + "\n"
    code = _codes(text)
    ends = code == 255
    word = np.cumsum(ends) - ends
    letter = (code > 0) & ~ends
    c = code.astype(np.int32)
    n = len(code)
    for a, b in GAPS:
        second, third = 1 + a, 2 + a + b
        m = n - third
        if m <= 0:
            continue
        # A start mark is followed at once: words agree in how they begin, not in what is skipped.
        good = letter[:m] & letter[second : second + m] & letter[third:] & (word[:m] == word[third:])
        at = np.nonzero(good & ((code[:m] != 31) | (a == 0)))[0]
        yield DECAY ** (a + b), word[at], (c[at] * CODES + c[at + second]) * CODES + c[at + third]


def entries(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature vectors of unit length as (word number, triple number, value) entries."""
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for weight, word, triple in triples(words):
        keys.append(word * CODES**3 + triple)
        weights.append(np.full(len(word), weight, np.float32))
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(place, np.concatenate(weights), len(key))
    word, triple = np.divmod(key, CODES**3)
    norm = np.sqrt(np.bincount(word, value**2, len(words)))
    return word, triple, value / norm[word]


@dataclass(frozen=True)
class Landmarks:
    """Feature rows over the triples that any of them has."""

    rows: np.ndarray
    column: np.ndarray  # for every triple its column, or -1
    triple: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> "Landmarks":
        word, triple, value = entries(words)
        used = np.unique(triple)
        column = np.full(CODES**3, -1)
        column[used] = np.arange(len(used))
        rows = np.zeros((len(words), len(used)), np.float32)
        rows[word, column[triple]] = value
        return cls(rows, column, used)

    def kernel(self, words: list[str], block: int = 500) -> np.ndarray:
        """Kernel of words and landmarks."""
        out = np.zeros((len(words), len(self.rows)), np.float32)
        for at in range(0, len(words), block):
            word, triple, value = entries(words[at : at + block])
            column = self.column[triple]
            known = column >= 0
            dense = np.zeros((len(words[at : at + block]), len(self.triple)), np.float32)
            dense[word[known], column[known]] = value[known]
            out[at : at + block] = dense @ self.rows.T
        return out


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 30):
    """Weights of a linear machine (last entry: bias) by Newton steps; ``y`` is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        miss = 1 - y * (x @ w)
        act = miss > 0
        xa, wa = x[act], weight[act]
        h = (xa * wa[:, None]).T @ xa + np.diag(penalty)
        new = np.linalg.solve(h, (xa * wa[:, None]).T @ y[act])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, rounds: int = 50):
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    table: np.ndarray  # the machine, summed up per triple
    bias: float
    curve: np.ndarray | None = None  # logistic weights of the two highest scores, and a constant

    def words(self, words: list[str]) -> np.ndarray:
        """Machine output for every word."""
        word, triple, value = entries(words)
        return np.bincount(word, self.table[triple] * value, len(words)) + self.bias

    def top_two(self, texts: list[str], cache: dict[str, float]) -> np.ndarray:
        """The two highest word scores of every text."""
        cut = [split(t) for t in texts]
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = list(set().union(*cut).difference(cache)) if cut else []
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            cache.update(zip(part, self.words(part).tolist()))
        out = np.full((len(texts), 2), FLOOR)
        for i, words in enumerate(cut):
            if words:
                of = np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
                first = of.argmax()
                out[i, 0] = of[first]
                of[first] = FLOOR
                out[i, 1] = of.max()
        return np.clip(out, FLOOR, CEILING)

    def probability(self, top: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(top))
        z = top @ self.curve[:2] + self.curve[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def split(text: str) -> list[str]:
    """Lower-case words, and runs of single letters joined into words."""
    text = text.lower()
    words = text.split()
    for run in SPACED.finditer(text):
        words.append(run.group().replace(" ", ""))
    return words


def least_shingle(text: str, n: int = 3) -> int:
    """Smallest hash of the text's word shingles: equal for most near copies."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    last = max(1, len(words) - n + 1)
    return min(xxh64_intdigest(" ".join(words[i : i + n])) for i in range(last)) >> 1


def diverse(words: list[str], k: int, limit: float) -> list[str]:
    """The first ``k`` words of a list of which no two have a kernel above ``limit``."""
    gram = Landmarks.of(words)
    near = gram.rows @ gram.rows.T >= limit
    free, chosen = np.ones(len(words), bool), []
    for i in range(len(words)):
        if free[i] and len(chosen) < k:
            chosen.append(words[i])
            free &= ~near[i]
    return chosen


def _machine(words: list[str], y: np.ndarray, weight: np.ndarray, marks: list[str]) -> ToxicityModel:
    landmarks = Landmarks.of(marks)
    values, vectors = np.linalg.eigh((landmarks.rows @ landmarks.rows.T).astype(np.float64))
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])
    w = squared_hinge(landmarks.kernel(words) @ root, y, weight)
    table = np.zeros(CODES**3, np.float32)
    table[landmarks.triple] = (root @ w[:-1]) @ landmarks.rows
    return ToxicityModel(table, float(w[-1]))


def _word_scores(words: DataFrame, model: ToxicityModel) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            of = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.words(of))], ["word", "score"])

    return words.select("word").mapInArrow(run, "word string, score double")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_per_class: int = SAMPLE_PER_CLASS,
    max_words: int = MAX_WORDS,
    n_landmarks: int = LANDMARKS,
) -> ToxicityModel:
    """A model from labelled rows; pass only training rows in ``labels``."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).filter(
        F.col("_id").isNotNull() & F.col("y").isin(0, 1)
    )
    totals = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return ToxicityModel(np.zeros(CODES**3, np.float32), 0.0)
    by_hash = Window.partitionBy("y").orderBy(F.xxhash64("_id"))
    sample = marked.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= sample_per_class)
    # At most 2 * sample_per_class rows.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample.drop("_n")), "_id"
    ).select("y", F.coalesce("text", F.lit("")).alias("text"))

    def with_key(batches):
        for part, found in slices(batches, "text"):
            keys = pa.array([least_shingle(t) for t in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns, keys], ["y", "text", "_key"])

    texts = texts.mapInArrow(with_key, "y int, text string, _key long")
    texts = texts.dropDuplicates(["y", "_key"]).select("y", "text")
    texts = stored(spark, texts, "toxicity-sample")

    def count(batches):
        counts: dict[str, list[int]] = {}
        for part, found in slices(batches, "text"):
            for y, text in zip(part.column(0).to_pylist(), found):
                for word in {w.strip(".,;:!?\"'()") for w in split(text)}:
                    counts.setdefault(word, [0, 0])[y] += 1
        names = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([counts[w][k] for w in names], pa.int64()) for k in (0, 1))],
            ["word", "clean", "toxic"],
        )

    counted = texts.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    ).filter(F.length("word").between(2, 40))
    counted = stored(spark, counted, "toxicity-words")
    n = {r.y: r.n for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Log-likelihood ratio against the share of toxic texts, beyond one in all words.
    p = n.get(1, 0) / max(1, sum(n.values()))
    seen = F.col("clean") + F.col("toxic")
    part = lambda k, e: F.when(k > 0, k * F.log(k / e)).otherwise(0.0)
    ratio = part(F.col("toxic"), seen * p) + part(F.col("clean"), seen * (1 - p))
    beyond = counted.withColumn("llr", ratio).filter(
        (F.col("toxic") >= 2) & (F.col("clean") * 20 <= F.col("toxic")) & (F.col("llr") >= math.log(max(2, counted.count())))
    )
    beyond = beyond.orderBy(F.desc("llr"), "word").limit(max_words)
    positive = [r.word for r in beyond.collect()]
    clean = counted.filter("clean >= 1").join(F.broadcast(beyond.select("word")), "word", "left_anti")
    common = clean.orderBy(F.desc("clean"), "word").limit(max_words).collect()
    other = clean.orderBy(F.xxhash64("word")).limit(max_words).collect()
    negative = list(dict.fromkeys(r.word for r in [*common, *other]))
    if not positive or not negative:
        return ToxicityModel(np.zeros(CODES**3, np.float32), 0.0)
    hardest = negative[::5]
    for step in range(ROUNDS):
        marks = diverse(positive, n_landmarks // 2, 0.7) + diverse(hardest, n_landmarks // 2, 0.8)
        words = positive + negative
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        weight = np.where(y > 0, 1 / len(positive), 1 / len(negative)) * max_words
        model = _machine(words, y, weight, marks)
        if step + 1 < ROUNDS:
            found = _word_scores(clean, model).orderBy(F.desc("score"), "word").limit(max_words // 2).collect()
            hardest = [r.word for r in found]
            negative = list(dict.fromkeys(negative + hardest))
    shared = spark.sparkContext.broadcast(model)

    def tops(batches):
        cache: dict[str, float] = {}
        for part, found in slices(batches, "text"):
            top = shared.value.top_two(found, cache)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(top[:, 0]), pa.array(top[:, 1])], ["y", "a", "b"])

    rows = texts.mapInArrow(tops, "y int, a double, b double").toPandas()
    y = rows.y.to_numpy(float)
    per = {k: totals[k] / max(1, (y == k).sum()) for k in (0, 1)}
    weight = np.where(y == 1, per[1], per[0]) * len(y) / sum(totals.values())
    return ToxicityModel(model.table, model.bias, logistic(rows[["a", "b"]].to_numpy(), y, weight))


def score(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``keep`` columns with ``score``, the probability of the label."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        cache: dict[str, float] = {}
        for part, texts in slices(batches, "_text"):
            found = shared.value.probability(shared.value.top_two(texts, cache))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(found)], [*part.schema.names[:-1], "score"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(run, f"{fields}, score double")
