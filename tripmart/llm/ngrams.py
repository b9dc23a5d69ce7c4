"""Katz backoff over all word n-grams of the training texts, as tables that stay in Spark.

Tokens are words and one end per text; a start leads each text and is never predicted. For an
n-gram of two or more tokens ``h`` is the key of all but its last token and ``s`` the key of all
but its first; its own key is ``xxhash64(h, s)``, that of a single token is the token's hash.

* Counting adds up equal n-grams of each chunk of texts in the map task, then all in a shuffle. No
  n-gram is left out, whatever its count.
* ``P(token | history) = kept / norm(history)``: counts discounted by Good-Turing. What the discount
  frees goes to tokens not seen after the history, ``weight(history) * P(token | shorter history)``.
  The weights make each history sum to one over all known tokens and the unseen ones together.
* The lower probability that a weight needs is that of the n-gram ``s``, which was counted as well.
  Tokens among the ``known`` most frequent are met by a broadcast, all others by a shuffle, so that
  frequent tokens are no hot keys; both get the same numbers.
* Scoring cuts the texts into chunks of some megabytes. Each chunk asks once for every key that it
  holds; the answers (n-grams, and weights of histories) come back to the chunk, which walks from
  the longest n-gram to shorter ones. A key is asked for once per chunk, however often it occurs.

Hashes have 64 bits; two n-grams that share one are counted as one. If the counts of counts give no
valid discount, a half is taken off each count; a history without freed share gets one further count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import slices, stored
from tripmart.llm.katz import _counts_of_counts, _discounted, good_turing

ORDER = 2
KNOWN = 200_000
SLICES_PER_CHUNK = 4
START, END = 1, 2  # keys of the start and the end of a text; word keys come from ``mix``

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def mix(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of a long under a seed."""
    with np.errstate(over="ignore"):
        h = (seed + _P5 + np.uint64(8)) ^ (_rotate(value * _P2, 31) * _P1)
        h = _rotate(h, 27) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def pair_key(h: np.ndarray, s: np.ndarray) -> np.ndarray:
    """``xxhash64(h, s)`` as Spark has it."""
    return mix(s, mix(h, np.full(len(h), 42, np.uint64)))


def sequence(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the tokens of all texts, start and end included; place in the text; text number.
    A word's key is the mixed sum of one pseudo-random number per place and byte."""
    data = [t.encode() for t in texts]
    raw = _LOWER[np.frombuffer(b"\n".join(data) + b"\n", np.uint8)]
    word = ~_BLANK[raw]
    edge = np.diff(np.concatenate([[False], word]).astype(np.int8))
    begins, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    at = np.nonzero(word)[0]
    lengths = ends - begins
    place = at - np.repeat(begins, lengths)
    with np.errstate(over="ignore"):
        code = mix(raw[at].astype(np.uint64), place.astype(np.uint64) * _P3)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code, dtype=np.uint64)])
        cut = np.concatenate([[0], np.cumsum(lengths)])
        words = mix(total[cut[1:]] - total[cut[:-1]], lengths.astype(np.uint64))
    text_ends = np.cumsum(np.fromiter((len(d) + 1 for d in data), np.int64, len(data)))
    owner = np.searchsorted(text_ends, begins, "right")
    size = np.bincount(owner, minlength=len(texts)) + 2
    first = np.cumsum(size) - size
    keys = np.full(int(size.sum()), END, np.uint64)
    keys[first] = START
    keys[np.arange(len(words)) + 2 * owner + 1] = words
    return keys, np.arange(len(keys)) - np.repeat(first, size), np.repeat(np.arange(len(texts)), size)


def orders(keys: np.ndarray, place: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: key of the n-gram that ends at each token, and whether there is one."""
    out = [(keys, place >= 1)]
    for k in range(2, order + 1):
        before = out[-1][0]
        out.append((pair_key(np.concatenate([before[:1], before[:-1]]), before), place >= max(1, k - 1)))
    return out


def count_ngrams(docs: DataFrame, order: int = ORDER, text_col: str = "text") -> DataFrame:
    """``o, h, s, n``: how often each n-gram of ``o`` tokens occurs in all texts (``h`` is 0 and
    ``s`` the token where ``o`` is 1)."""

    def batch_of(held):
        keys, place = (np.concatenate(x) for x in zip(*held))
        grams = orders(keys, place, order)
        for o in range(1, order + 1):
            valid = np.nonzero(grams[o - 1][1])[0]
            values, first, n = np.unique(grams[o - 1][0][valid], return_index=True, return_counts=True)
            ends = valid[first]
            below = grams[o - 2][0] if o > 1 else None
            h = below[ends - 1] if o > 1 else np.zeros(len(values), np.uint64)
            s = below[ends] if o > 1 else values
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), o, np.int32)), *(pa.array(x.view(np.int64)) for x in (h, s)), pa.array(n)],
                ["o", "h", "s", "n"],
            )

    def count(batches):
        held, parts = [], 0
        for _, texts in slices(batches, "text"):
            held.append(sequence(texts)[:2])
            parts += 1
            if parts == SLICES_PER_CHUNK:
                yield from batch_of(held)
                held, parts = [], 0
        if held:
            yield from batch_of(held)

    source = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = source.mapInArrow(count, "o int, h long, s long, n long")
    return rows.groupBy("o", "h", "s").agg(F.sum("n").alias("n"))


def _frequent(tokens: DataFrame, known: int) -> int:
    """The least count whose tokens are ``known`` at most; from counts per sixteenth of a doubling."""
    band = F.floor(F.log2(F.col("n").cast("double")) * 16)
    sizes = tokens.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).collect()
    held, least = 0, 1 << 62
    for r in sorted(sizes, key=lambda r: -r.band):
        held += r.m
        if held > known:
            break
        least = r.least
    return least


def fit(counted: DataFrame, order: int = ORDER, known: int = KNOWN) -> tuple[DataFrame, dict[str, float]]:
    """``key, kind, a, b`` and totals, from stored counts. Kind 0 is an n-gram: discounted count, and
    count; kind 1 a history: weight, and norm. Single tokens have the norm of the totals."""
    spark = counted.sparkSession
    level = {o: counted.filter(F.col("o") == o) for o in range(1, order + 1)}
    factors = {o: good_turing(_counts_of_counts(level[o])) for o in level}
    tokens = level[1].select(F.col("s").alias("key"), "n", _discounted(F.col("n"), factors[1]).alias("kept"))
    total, types, kept = tokens.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum("kept"), F.lit(0.0))
    ).first()
    norm = float(total) if total - kept >= 1e-9 * total and total else total + 1.0
    totals = {"tokens": total, "types": types, "norm": norm, "unseen": (norm - kept) / norm}
    least = _frequent(tokens, known)
    lower = tokens.select("key", "n", (F.col("kept") / norm).alias("p"))
    answers = [tokens.select("key", F.lit(0).alias("kind"), F.col("kept").alias("a"), F.col("n").cast("double").alias("b"))]
    for o in range(2, order + 1):
        rows = level[o].select("h", "s", "n", _discounted(F.col("n"), factors[o]).alias("kept"))
        often = F.broadcast(lower.filter(F.col("n") >= least).select(F.col("key").alias("s"), "p")) if o == 2 else None
        seldom = (lower.filter(F.col("n") < least) if o == 2 else lower).select(F.col("key").alias("s"), "p")
        if o == 2:
            met = rows.join(often, "s", "left")
            rows_p = met.filter("p is not null").unionByName(met.filter("p is null").drop("p").join(seldom, "s"))
        else:
            rows_p = rows.join(seldom, "s")
        sums = rows_p.groupBy("h").agg(
            F.sum("n").cast("double").alias("all"), F.sum("kept").alias("kept"), F.sum("p").alias("seen")
        )
        own = F.when(F.col("all") - F.col("kept") < 1e-9, F.col("all") + 1).otherwise(F.col("all"))
        sums = sums.withColumn("norm", own).withColumn(
            "weight", (1 - F.col("kept") / F.col("norm")) / F.greatest(1 - F.col("seen"), F.lit(1e-15))
        ).select("h", "norm", "weight")
        sums = stored(spark, sums, f"katz-histories-{o}")
        answers.append(sums.select(F.col("h").alias("key"), F.lit(1).alias("kind"), F.col("weight").alias("a"), F.col("norm").alias("b")))
        key = F.xxhash64("h", "s")
        answers.append(rows.select(key.alias("key"), F.lit(0).alias("kind"), F.col("kept").alias("a"), F.col("n").cast("double").alias("b")))
        if o < order:
            lower = rows.join(sums, "h").select(key.alias("key"), "n", (F.col("kept") / F.col("norm")).alias("p"))
            lower = stored(spark, lower, f"katz-lower-{o}")
    table = answers[0]
    for more in answers[1:]:
        table = table.unionByName(more)
    return table, totals


def log_probabilities(keys, place, order, found, weights, totals) -> tuple[np.ndarray, np.ndarray]:
    """Log10 probability and training count of every token; 0 at starts. ``found`` and ``weights``
    are sorted keys with their two values."""
    def look(table, wanted):
        known, a, b = table
        if not len(known):
            return np.zeros(len(wanted), bool), np.ones(len(wanted)), np.ones(len(wanted))
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return known[at] == wanted, a[at], b[at]

    grams = orders(keys, place, order)
    value, open_ = np.zeros(len(keys)), place >= 1
    for o in range(order, 1, -1):
        key, valid = grams[o - 1]
        here = np.nonzero(open_ & valid)[0]
        history = grams[o - 2][0][here - 1]
        led, weight, norm = look(weights, history)
        hit, kept, _ = look(found, key[here])
        # A history that was never seen leaves all to the shorter one.
        value[here] += np.where(hit, np.log10(np.where(hit, kept / norm, 1.0)), np.where(led, np.log10(weight), 0.0))
        open_[here[hit]] = False
    hit, kept, n = look(found, keys)
    single = np.log10(np.where(hit, kept / totals["norm"], totals["unseen"]))
    value[open_] += single[open_]
    return value, np.where(hit & (place >= 1), n, 0)


def score(
    docs: DataFrame, table: DataFrame, totals: dict[str, float], order: int = ORDER,
    text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The ``keep`` columns with ``n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    source = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def chunked(batches):
        from pyspark import TaskContext

        chunk, parts = TaskContext.get().partitionId() << 32, 0
        for part, _ in slices(batches, "_text"):
            names = [*part.schema.names, "_chunk"]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, chunk))], names)
            parts += 1
            chunk += parts % SLICES_PER_CHUNK == 0

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    # Stored, so that chunks stay what they are.
    texts = stored(spark, source.mapInArrow(chunked, f"{fields}{', ' * bool(keep)}_text string, _chunk long"), "katz-texts")

    def ask(batches):
        held, now = [], None

        def out():
            keys, place = (np.concatenate(x) for x in zip(*held))
            wanted = np.unique(np.concatenate([[np.uint64(START)], *(g[v] for g, v in orders(keys, place, order))]))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(wanted), now)), pa.array(wanted.view(np.int64))], ["_chunk", "key"]
            )

        for part, some in slices(batches, "_text"):
            chunks = part.column(1).to_numpy()
            for chunk in np.unique(chunks):
                if held and chunk != now:
                    yield out()
                    held = []
                now = chunk
                held.append(sequence([some[i] for i in np.nonzero(chunks == chunk)[0]])[:2])
        if held:
            yield out()

    asked = texts.select("_text", "_chunk").mapInArrow(ask, "_chunk long, key long")
    answers = asked.join(table, "key").select("_chunk", "key", "kind", "a", "b")
    per_token = math.log10(totals["tokens"] + totals["types"] + 1)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        kind, key = right.column("kind").to_numpy(), right.column("key").to_numpy().view(np.uint64)
        tables = []
        for k in (0, 1):
            mine = np.nonzero(kind == k)[0]
            mine = mine[np.argsort(key[mine])]
            tables.append((key[mine], right.column("a").to_numpy()[mine], right.column("b").to_numpy()[mine]))
        out = [[] for _ in range(4)]
        for batch in left.combine_chunks().to_batches():
            for _, some in slices([batch], "_text"):
                keys, place, owner = sequence(some)
                value, n = log_probabilities(keys, place, order, *tables, totals)
                real = place >= 1
                base = np.where(real, np.log10(n + 1) - per_token, 0.0)
                for c, weights in zip(out, (real, n > 0, base, value)):
                    c.append(np.bincount(owner, weights, len(some)))
        n_tokens, n_known, base, value = (np.concatenate(c) if c else np.zeros(0) for c in out)
        return pa.table(
            [*(left.column(c) for c in keep), pa.array(n_tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)),
             pa.array(np.full(len(base), totals["tokens"], np.int64)), pa.array(base), pa.array(value)],
            [*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = f"{fields}{', ' * bool(keep)}n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(finish, schema)
