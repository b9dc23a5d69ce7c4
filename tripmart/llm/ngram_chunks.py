"""Katz backoff scores of texts by a model learned from some of the same texts, in packed messages.

The model is that of ``ngrams.py``: all word n-grams, Good-Turing, weights that make each history sum
to one. There, n-grams are rows of a table that serves texts of any time. Here, texts that are learned
from and texts that are scored come together, so that an n-gram travels once for both:

1. Texts become chunks of some megabytes, one row each: the distinct word keys, and the number of
   the word at every place. Texts are not read again.
2. Each chunk sends its distinct n-grams with their counts in learned texts to ranges of keys, as one
   packed row per range: sorted, as gaps. A range adds up equal n-grams and keeps counts of counts.
3. It sends the totals back in the order of the question, so without keys. The first chunk that
   learned an n-gram is told so, and it alone adds the n-gram to the sums of its history.
4. Sums of histories are added up over chunks in the same way; weight and norm go back.
5. The chunk walks from the longest n-gram of each token to shorter ones.

A key is sent once per chunk, however often it occurs, and ranges cut hashed keys evenly: no frequent
word or history meets in one task. No n-gram is left out, whatever its count. The counts and weights
are tables by range and chunk in the workspace.

Null and empty texts are one end. Texts whose ``learn`` is null are not learned from. With nothing
to learn from, every word is unseen. Repeated rows each get a row. Only the named columns are read,
and they may have any names. Hashes have 64 bits; two n-grams that share one are counted as one.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import slices, stored_lean
from tripmart.llm.katz import MAX_DISCOUNTED, good_turing
from tripmart.llm.ngrams import ORDER, pair_key, sequence

SLICES_PER_CHUNK = 3  # of some 4 MB of text each
KEYS_PER_RANGE = 1_000_000
MAX_RANGES = 200_000  # beyond, ranges grow: messages would hold a handful of keys
_HEAD = struct.Struct("<IB")


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers of 64 bits, byte plane by byte plane, without the planes that are zero throughout."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return _HEAD.pack(len(values), width) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpacked(data: bytes) -> np.ndarray:
    n, width = _HEAD.unpack_from(data)
    out = np.zeros((n, 8), np.uint8)
    if n * width:
        planes = pa.decompress(data[_HEAD.size :], n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").ravel().astype(np.uint64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def packed_floats(values: np.ndarray) -> bytes:
    raw = values.astype(np.float64).tobytes()
    return len(raw).to_bytes(4, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpacked_floats(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    return np.frombuffer(pa.decompress(data[4:], size, codec="zstd", asbytes=True) if size else b"", np.float64)


def _ranges(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """Where the keys of each range begin among sorted keys, and the end."""
    of = ((keys >> np.uint64(32)) * np.uint64(n_ranges)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(n_ranges + 1, dtype=np.uint64))


def _kept(n: np.ndarray, factors: list[float]) -> np.ndarray:
    share = np.ones(MAX_DISCOUNTED + 2)
    share[: len(factors)] = factors
    return n * share[np.minimum(n, MAX_DISCOUNTED + 1).astype(np.int64)]


class _Chunk:
    """A chunk's tokens: place in the text, number of the text, whether they are learned, and n-grams by number."""

    def __init__(self, lengths, learn, words: bytes, ids: bytes):
        size = np.asarray(lengths, np.int64)
        self.owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
        starts = np.cumsum(size) - size
        self.place = (np.arange(int(size.sum())) - np.repeat(starts, size)).astype(np.int32)
        self.learn = np.repeat(np.asarray(learn, bool), size)
        self.words, self.ids = unpacked_keys(words), unpacked(ids).astype(np.int32)

    @classmethod
    def of(cls, row: pa.Table | pa.RecordBatch, i: int = 0) -> _Chunk:
        texts = row.column("texts")[i].values
        return cls(*(texts.field(k).to_numpy(zero_copy_only=False) for k in ("n", "learn")),
                   row.column("words")[i].as_py(), row.column("ids")[i].as_py())

    def levels(self, order: int):
        """For each order: the distinct n-grams, the places they end at, the number of the n-gram there, and
        from the second order on the distinct histories and the number of the history."""
        places = np.nonzero(self.place >= 1)[0]
        # The start has the smallest key and is no n-gram, but it is a history.
        yield self.words[1:], places, self.ids[places] - 1, None, None
        before, number = self.words, self.ids
        key = self.words[self.ids] if order > 1 else None
        for o in range(2, order + 1):
            key = pair_key(np.concatenate([key[:1], key[:-1]]), key)
            places = np.nonzero(self.place >= o - 1)[0]
            distinct, which = np.unique(key[places], return_inverse=True)
            led = number[places - 1]
            used = np.zeros(len(before), bool)
            used[led] = True
            which = which.astype(np.int32)
            yield distinct, places, which, before[used], (np.cumsum(used, dtype=np.int32) - 1)[led]
            before, number = distinct, np.zeros(len(key), np.int32)
            number[places] = which


def chunks(docs: DataFrame, learn: Column, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``chunk, tokens, texts, words, ids``, one row per chunk. ``texts`` holds the kept columns as ``k0, k1, ...``."""
    source = docs.select(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)],
        F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("text"),
    )
    held_names = [*source.columns[:-1], "n"]

    def run(batches):
        from pyspark import TaskContext

        chunk, held = TaskContext.get().partitionId() << 32, []

        def out():
            keys = np.concatenate([k for k, _ in held])
            distinct, which = np.unique(keys, return_inverse=True)
            texts = pa.concat_arrays([t for _, t in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([len(keys)]), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts),
                 pa.array([packed_keys(distinct)], pa.binary()), pa.array([packed(which.astype(np.uint64))], pa.binary())],
                ["chunk", "tokens", "texts", "words", "ids"],
            )

        for part, texts in slices(batches, "text"):
            keys, _, owner = sequence(texts)
            n = pa.array(np.bincount(owner, minlength=len(texts)).astype(np.int64))
            held.append((keys, pa.StructArray.from_arrays([*part.columns[:-1], n], held_names)))
            if len(held) == SLICES_PER_CHUNK:
                yield out()
                chunk, held = chunk + 1, []
        if held:
            yield out()

    fields = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(
        run, f"chunk long, tokens long, texts array<struct<{fields}, n: bigint>>, words binary, ids binary"
    )


def _asked(table: DataFrame, order: int, n_ranges: int) -> DataFrame:
    """``part, chunk, o, keys, n``: n-grams of each chunk and how often it learned them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                c = _Chunk.of(batch, i)
                number = batch.column("chunk")[i].as_py()
                for o, (distinct, places, which, _, _) in enumerate(c.levels(order), start=1):
                    n = np.bincount(which[c.learn[places]], minlength=len(distinct)).astype(np.uint64)
                    yield _messages(number, o, distinct, n_ranges, [n], ["n"])

    return table.select("chunk", "texts", "words", "ids").mapInArrow(
        run, "part int, chunk long, o int, keys binary, n binary"
    )


def _messages(chunk, o, keys, n_ranges, values, names) -> pa.RecordBatch:
    """One row per range that holds some of the sorted keys, with the values that go along."""
    cut = _ranges(keys, n_ranges)
    some = np.nonzero(np.diff(cut))[0]
    of = [slice(cut[p], cut[p + 1]) for p in some]
    pack = lambda v: packed(v) if v.dtype == np.uint64 else packed_floats(v)
    return pa.RecordBatch.from_arrays(
        [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), chunk, np.int64)), pa.array(np.full(len(some), o, np.int32)),
         pa.array([packed_keys(keys[s]) for s in of], pa.binary()), *(pa.array([pack(v[s]) for s in of], pa.binary()) for v in values)],
        ["part", "chunk", "o", "keys", *names],
    )


def _totals_of_range(group: pa.Table) -> pa.Table:
    """Answers to the messages of a range, and one row (chunk -1) per order with its counts of counts."""
    out = [[] for _ in range(6)]
    number, order = group.column("chunk").to_numpy(), group.column("o").to_numpy()
    part = group.column("part")[0].as_py()
    for o in np.unique(order).tolist():
        rows = np.nonzero(order == o)[0]
        rows = rows[np.argsort(number[rows], kind="stable")]
        keys = [unpacked_keys(group.column("keys")[r].as_py()) for r in rows.tolist()]
        n = np.concatenate([unpacked(group.column("n")[r].as_py()) for r in rows.tolist()]).astype(np.int64)
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, n, len(distinct)).astype(np.int64)
        learned = np.nonzero(n)[0][::-1]
        first = np.full(len(distinct), -1)
        first[which[learned]] = learned  # of equal numbers the last is kept, so the first that learned it
        own = np.zeros(len(n), np.uint64)
        own[first[first >= 0]] = 1
        answer = total[which].astype(np.uint64)
        at = 0
        for r, k in zip(rows.tolist(), keys):
            to = at + len(k)
            for c, v in zip(out, (part, int(number[r]), o, packed(answer[at:to]), packed(own[at:to]), None)):
                c.append(v)
            at = to
        seen = total[total > 0]
        few = np.bincount(seen[seen <= MAX_DISCOUNTED + 1], minlength=MAX_DISCOUNTED + 2)
        for c, v in zip(out, (part, -1, o, None, None, [int(seen.sum()), len(seen), *few[1:].tolist()])):
            c.append(v)
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], ["part", "chunk", "o", "n", "own", "counts"])


def _answer(rows: pa.Table, o: int, column: str, read=unpacked) -> np.ndarray:
    """The answers of all ranges to a chunk, in the order of its keys."""
    mine = np.nonzero(rows.column("o").to_numpy() == o)[0]
    mine = mine[np.argsort(rows.column("part").to_numpy()[mine])]
    values = [read(rows.column(column)[i].as_py()) for i in mine.tolist()]
    return np.concatenate(values) if values else np.zeros(0, np.uint64)


class _Level:
    """The n-grams of one order in a chunk, with what is known of them and of their histories."""

    def __init__(self, level, o: int, answers: pa.Table, weights: pa.Table | None):
        _, self.places, self.which, self.histories, self.led = level
        self.n = _answer(answers, o, "n").astype(np.int64)
        if weights is not None:
            self.norm = _answer(weights, o, "norm").astype(np.float64)
            self.weight = _answer(weights, o, "weight", unpacked_floats)


def _history_sums(table: DataFrame, answers: DataFrame, weights: DataFrame | None, o: int, model: dict, n_ranges: int) -> DataFrame:
    """``part, chunk, o, keys, every, kept, seen``: for the histories of each chunk the sums over the
    n-grams of ``o`` tokens that it has been told to add."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk.of(left)
        known = _split(right)
        *_, lower, level = c.levels(o)
        lower, level = _Level(lower, o - 1, known[0], known[1] if o > 2 else None), _Level(level, o, known[0], None)
        # One place of each n-gram, and what the shorter n-gram there has.
        place_of = np.zeros(len(level.n), np.int64)
        place_of[level.which] = np.arange(len(level.places))
        mine = np.nonzero(_answer(known[0], o, "own"))[0]
        at = place_of[mine]
        row_of = np.zeros(len(c.place), np.int32)
        row_of[lower.places] = np.arange(len(lower.places))
        below = row_of[level.places[at]]
        kept = _kept(lower.n[lower.which[below]], model["factors"][o - 1])
        p = kept / (model["norm"] if o == 2 else lower.norm[lower.led[below]])
        n, led = level.n[mine], level.led[at]
        size = len(level.histories)
        every = np.bincount(led, n, size).astype(np.uint64)
        return pa.Table.from_batches([_messages(
            left.column("chunk")[0].as_py(), o, level.histories, n_ranges,
            [every, np.bincount(led, _kept(n, model["factors"][o]), size), np.bincount(led, p, size)], ["every", "kept", "seen"],
        )])

    return _meet(table, answers, weights).applyInArrow(
        run, "part int, chunk long, o int, keys binary, every binary, kept binary, seen binary"
    )


def _weights_of_range(group: pa.Table) -> pa.Table:
    """``norm`` and ``weight`` of histories, in the order of each message; a norm of 0 where none was learned."""
    rows = np.argsort(group.column("chunk").to_numpy(), kind="stable").tolist()
    keys = [unpacked_keys(group.column("keys")[r].as_py()) for r in rows]
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    column = lambda name: np.bincount(which, np.concatenate([
        unpacked_floats(group.column(name)[r].as_py()) for r in rows
    ]))
    every = np.bincount(which, np.concatenate([unpacked(group.column("every")[r].as_py()) for r in rows]).astype(np.float64))
    kept, seen = column("kept"), column("seen")
    norm = np.where(every - kept < 1e-9, every + 1, every)
    weight = np.where(every > 0, (1 - kept / norm) / np.maximum(1 - seen, 1e-15), 1.0)
    norm = np.where(every > 0, norm, 0).astype(np.uint64)
    cut = np.cumsum([0, *map(len, keys)])
    of = [which[a:b] for a, b in zip(cut[:-1], cut[1:])]
    return pa.table(
        [*(group.column(c).take(pa.array(rows)) for c in ("part", "chunk", "o")),
         pa.array([packed(norm[w]) for w in of], pa.binary()), pa.array([packed_floats(weight[w]) for w in of], pa.binary())],
        ["part", "chunk", "o", "norm", "weight"],
    )


def _meet(table: DataFrame, answers: DataFrame, weights: DataFrame | None):
    """Chunks beside the answers to them."""
    none = F.lit(None).cast("binary")
    back = answers.filter("chunk >= 0").select("chunk", "part", "o", "n", "own", none.alias("norm"), none.alias("weight"))
    if weights is not None:
        back = back.unionByName(weights.select("chunk", "part", "o", none.alias("n"), none.alias("own"), "norm", "weight"))
    return table.groupBy("chunk").cogroup(back.groupBy("chunk"))


def _split(rows: pa.Table) -> tuple[pa.Table, pa.Table]:
    counted = rows.column("n").is_valid()
    return rows.filter(counted), rows.filter(rows.column("norm").is_valid())


def scores_by_part(
    docs: DataFrame,
    learn: Column,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    order: int = ORDER,
    keys_per_range: int = KEYS_PER_RANGE,
) -> DataFrame:
    """The ``keep`` columns with ``n_tokens, n_known, train_tokens, base_score, score`` of every row, by the
    n-grams of the rows where ``learn`` holds."""
    spark = docs.sparkSession
    # Stored, so that chunks stay what they are.
    table = stored_lean(spark, chunks(docs, learn, text_col, keep), "katz-chunks")
    tokens = table.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    n_ranges = min(MAX_RANGES, max(1, -(-tokens * order // keys_per_range)))
    asked = _asked(table, order, n_ranges).groupBy("part")
    schema = "part int, chunk long, o int, n binary, own binary, counts array<bigint>"
    answers = stored_lean(spark, asked.applyInArrow(_totals_of_range, schema), "katz-counts")
    sums = [F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(MAX_DISCOUNTED + 3)]
    counts = {r.o: r for r in answers.filter("chunk < 0").groupBy("o").agg(*sums).collect()}  # one row per order
    of = lambda o, i: counts[o][f"c{i}"] if o in counts else 0
    factors = {o: good_turing({r: of(o, r + 1) for r in range(1, MAX_DISCOUNTED + 2)}) for o in range(1, order + 1)}
    total, types = of(1, 0), of(1, 1)
    kept = total - sum(r * of(1, r + 1) * (1 - factors[1][r]) for r in range(1, MAX_DISCOUNTED + 1))
    norm = float(total) if total - kept >= 1e-9 * total and total else total + 1.0
    model = {"factors": factors, "norm": norm, "unseen": (norm - kept) / norm, "tokens": total}
    weights = None
    for o in range(2, order + 1):
        asked = _history_sums(table, answers, weights, o, model, n_ranges).groupBy("part")
        found = asked.applyInArrow(_weights_of_range, "part int, chunk long, o int, norm binary, weight binary")
        found = stored_lean(spark, found, f"katz-weights-{o}")
        weights = found if weights is None else weights.unionByName(found)
    per_token = math.log10(total + types + 1)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _Chunk.of(left)
        known = _split(right)
        levels = list(c.levels(order))
        value, open_ = np.zeros(len(c.place)), c.place >= 1
        for o in range(order, 1, -1):
            level = _Level(levels.pop(), o, *known)
            at = np.nonzero(open_[level.places])[0]
            here, led = level.places[at], level.led[at]
            n, history = level.n[level.which[at]], level.norm[led]
            hit = n > 0
            # A history that was never seen leaves all to the shorter one.
            value[here] += np.log10(np.where(hit, _kept(n, factors[o]) / np.maximum(history, 1), np.where(history > 0, level.weight[led], 1.0)))
            open_[here[hit]] = False
        level = _Level(levels.pop(), 1, known[0], None)
        n = np.zeros(len(c.place), np.int64)
        n[level.places] = level.n[level.which]
        single = np.log10(np.where(n > 0, _kept(n, factors[1]) / norm, model["unseen"]), where=open_, out=np.zeros(len(n)))
        value += single
        real = c.place >= 1
        base = np.where(real, np.log10(n + 1.0) - per_token, 0.0)
        texts = left.column("texts")[0].values
        n_tokens, n_known, base, value = (
            np.bincount(c.owner, w, len(texts)) for w in (real, real & (n > 0), base, value)
        )
        return pa.table(
            [*(texts.field(f"k{i}") for i in range(len(keep))), pa.array(n_tokens.astype(np.int64)),
             pa.array(n_known.astype(np.int64)), pa.array(np.full(len(texts), total, np.int64)), pa.array(base), pa.array(value)],
            [*(f"k{i}" for i in range(len(keep))), "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    kept_fields = "".join(f"k{i} {docs.select(k).schema[0].dataType.simpleString()}, " for i, k in enumerate(keep))
    out = _meet(table, answers, weights).applyInArrow(
        finish, f"{kept_fields}n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], *out.columns[len(keep) :])
