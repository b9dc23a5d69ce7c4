"""Removal of byte passages that occur at more than one place of a corpus.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else, in the same
text or another one. Strings are judged on the input, and none crosses a text.

1. Equal texts are one text with a number of copies, stored in buckets of their digest, so that
   the joins below never shuffle texts again. A text with copies goes whole.
2. The windows of a text are handed to *keys*: each window of ``length`` bytes belongs to the
   place in it whose ``GRAM`` next bytes have the smallest hash (the rightmost of equal ones).
   Equal windows have equal keys and lie alike around them. Consecutive windows of one key
   form a snippet. Keys that occur once in the corpus end here.
3. Equal snippets of a key are one snippet; those that occur twice are repeated throughout. The
   distinct snippets of a key, mostly the edges of passages, are sorted with the suffix
   array of ``suffix_groups``, which tells their repeated windows.
4. A key with more than ``max_snippets`` distinct snippets is not gathered: its windows are
   counted one by one by digest, in a shuffle that combines equal ones in the map tasks.
5. Repeated windows become runs of bytes per text, and texts go back to the rows they came from.

Null text is empty. Texts below ``length`` bytes hold no window and stay as they are. Repeated rows
are copies of one another, and each gets a row. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import shuffle_partitions, stored
from tripmart.llm.suffix_groups import repeated_windows

LENGTH = 400
GRAM = 128
MAX_SNIPPETS = 20_000
CHUNK_BYTES = 1 << 18
BATCH_SNIPPET_BYTES = 2 << 20
ODD = 0xD1342543DE82EF95
MASK = (1 << 64) - 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    if n not in _POWERS:
        inverse = pow(ODD, -1, 1 << 64)
        out = []
        for base in (ODD, inverse):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS.clear()
        _POWERS[n] = tuple(out)
    return _POWERS[n]


def gram_hashes(buffer: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from every place on."""
    n = len(buffer)
    size = 1 << max(16, (n - 1).bit_length())
    power, inverse = _powers(size)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * power[:n])])
    h = (sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


def _sliding(v: np.ndarray, width: int, ufunc) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive entries."""
    n = len(v)
    blocks = -(-n // width)
    padded = np.full(blocks * width, v[-1], v.dtype)
    padded[:n] = v
    padded = padded.reshape(blocks, width)
    ahead = ufunc.accumulate(padded, axis=1).ravel()
    behind = ufunc.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(behind[: n - width + 1], ahead[width - 1 : n])


def window_keys(texts: list[bytes], length: int, gram: int):
    """For runs of windows with one key: text number, hash, place of the key, and the first and
    last window start, all places within the text."""
    long = [i for i, t in enumerate(texts) if len(t) >= length]
    empty = [np.zeros(0, np.int64)] * 5
    if not long:
        return empty
    sizes = np.array([len(texts[i]) for i in long])
    starts = np.cumsum(sizes) - sizes
    h = gram_hashes(np.frombuffer(b"".join(texts[i] for i in long), np.uint8), gram)
    width = length - gram + 1
    least = _sliding(h, width, np.minimum)
    valid = np.zeros(len(least), bool)
    for a, n in zip(starts.tolist(), sizes.tolist()):
        valid[a : a + n - length + 1] = True
    # Places that are the minimum of some valid window.
    top = np.where(valid, least, np.uint64(0))
    around = np.concatenate([np.zeros(width - 1, np.uint64), top, np.zeros(width - 1, np.uint64)])
    is_key = (_sliding(around, width, np.maximum) == h)
    keys = np.nonzero(is_key)[0]
    p = np.nonzero(valid)[0]
    at = np.cumsum(is_key)[p + width - 1] - 1
    while len(wrong := np.nonzero(h[keys[at]] != least[p])[0]):
        at[wrong] -= 1
    # A run ends where the key changes or the text does.
    cut = np.nonzero((np.diff(at) != 0) | (np.diff(p) != 1))[0] + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
    text = np.searchsorted(starts, p[first], "right") - 1
    base = starts[text]
    place = keys[at[first]]
    return np.array(long)[text], h[place].view(np.int64), place - base, p[first] - base, p[last] - base


def _chunks(texts: list[bytes]):
    """Ranges of consecutive texts of some size."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true entries."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0] - 1


def _digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"|".join(parts), digest_size=16).digest()


def _bucketed(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Store as a table in buckets of a key; joins on it need no shuffle of this side."""
    spark = df.sparkSession
    name = f"suffix_dedup_{uuid.uuid4().hex}"
    df.write.bucketBy(partitions, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def find_keys(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``tid, key, place, first, last`` of all windows of ``tid, text``."""

    def run(batches):
        for batch in batches:
            found = batch.column(1).to_pylist()
            for a, b in _chunks(found):
                text, *columns = window_keys(found[a:b], length, gram)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(text, pa.int64())), *(pa.array(c.astype(np.int64)) for c in columns)],
                    ["tid", "key", "place", "first", "last"],
                )
        # Workers live on: what the task's batches shared goes with its last one.
        _POWERS.clear()

    return texts.mapInArrow(run, "tid string, key long, place long, first long, last long")


def _cut_snippets(rows: DataFrame, length: int, with_bytes: bool) -> DataFrame:
    """One row per snippet of ``tid, text, found``: its digest, or also its bytes."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                tid, text, found = (batch.column(k)[i].as_py() for k in range(3))
                cut = [text[f["first"] : f["last"] + length] for f in found]
                ids = [f["sid"] if with_bytes else _digest(str(f["place"] - f["first"]).encode(), c) for f, c in zip(found, cut)]
                columns = [
                    pa.array([tid] * len(found), pa.string()),
                    pa.array([f["key"] for f in found], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([f["first"] for f in found], pa.int64()),
                    pa.array([f["last"] for f in found], pa.int64()),
                ]
                if with_bytes:
                    columns.append(pa.array(cut, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["tid", "key", "sid", "first", "last", "snippet"][: len(columns)])

    schema = "tid string, key long, sid binary, first long, last long" + (", snippet binary" if with_bytes else "")
    return rows.mapInArrow(run, schema)


def _sorted_marks(length: int):
    """Repeated windows of sorted ``key, sid, snippet`` rows; whole groups of keys are put
    together until they make a suffix array worth building."""

    def flush(ids, texts):
        out = [[], [], []]
        for sid, marks in zip(ids, repeated_windows(texts, length)):
            for a, b in zip(*_runs(marks)):
                for c, v in zip(out, (sid, int(a), int(b))):
                    c.append(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["sid", "a", "b"]
        )

    def run(batches):
        ids, texts, size, last = [], [], 0, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for key, sid, snippet in zip(keys, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if key != last and size > BATCH_SNIPPET_BYTES:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
                ids.append(sid)
                texts.append(snippet)
                size += len(snippet)
                last = key
        if ids:
            yield flush(ids, texts)

    return run


def _window_digests(length: int):
    """Every window of ``sid, snippet`` rows with a digest."""

    def run(batches):
        for batch in batches:
            for sid, snippet in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = len(snippet) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([sid] * n, pa.binary()), pa.array(range(n), pa.int64()),
                     pa.array([_digest(snippet[p : p + length]) for p in range(n)], pa.binary())],
                    ["sid", "a", "digest"],
                )

    return run


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """``tid, text, copies`` in buckets of ``tid``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(text.alias("text")).select(F.md5("text").alias("tid"), "text")
    merged = rows.groupBy("tid").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return _bucketed(merged, "tid", shuffle_partitions(docs.sparkSession))


def repeated_runs(
    texts: DataFrame, length: int = LENGTH, gram: int = GRAM, max_snippets: int = MAX_SNIPPETS
) -> DataFrame:
    """``tid, a, b``: windows that start at ``a`` to ``b`` occur at another place too."""
    spark = texts.sparkSession
    able = texts.filter(F.octet_length("text") >= length)
    keys = stored(spark, find_keys(able.select("tid", "text"), length, gram), "suffix-keys")
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    found = keys.join(often, "key").groupBy("tid").agg(
        F.collect_list(F.struct("key", "place", "first", "last")).alias("found")
    )
    cut = _cut_snippets(able.join(found, "tid").select("tid", "text", "found"), length, False)
    snippets = stored(spark, cut, "suffix-snippets")
    distinct = snippets.groupBy("key", "sid").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("tid", "first", "last")).alias("at")
    )
    distinct = stored(spark, distinct.select("key", "sid", "n", "at.*"), "suffix-distinct")
    groups = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    unsure = distinct.join(groups, "key").groupBy("tid").agg(
        F.collect_list(F.struct("key", "sid", "first", "last", "m")).alias("found")
    )
    cut = _cut_snippets(able.join(unsure, "tid").select("tid", "text", "found"), length, True)
    crowded = groups.filter(F.col("m") > max_snippets).select("key")
    cut = stored(spark, cut.select("key", "sid", "snippet"), "suffix-edges")
    sortable = cut.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    marks = sortable.mapInArrow(_sorted_marks(length), "sid binary, a long, b long")
    singly = cut.join(crowded, "key", "left_semi").select("sid", "snippet")
    singly = singly.mapInArrow(_window_digests(length), "sid binary, a long, digest binary")
    twice = singly.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest")
    marks = marks.unionByName(singly.join(twice, "digest").select("sid", "a", F.col("a").alias("b")))
    # A snippet that occurs twice is repeated throughout; others as far as marked.
    whole = distinct.filter("n > 1").select("sid", F.lit(0).cast("long").alias("a"), (F.col("last") - F.col("first")).alias("b"))
    marks = stored(spark, marks.unionByName(whole), "suffix-marks")
    return snippets.join(marks, "sid").select("tid", (F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("b")).alias("b"))


def without_repeats(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    length: int = LENGTH,
    gram: int = GRAM,
    max_snippets: int = MAX_SNIPPETS,
    with_text: bool = False,
) -> DataFrame:
    """The ``keep`` columns with ``n_bytes, n_removed, n_spans, kept_sha256`` and, when asked,
    ``kept``: the bytes that stay, runs cut inside a character included."""
    texts = distinct_texts(docs, text_col)
    runs = repeated_runs(texts, length, gram, max_snippets).groupBy("tid").agg(
        F.collect_list(F.struct("a", "b")).alias("runs")
    )

    def cut(batches):
        for batch in batches:
            out = [[] for _ in range(5)]
            for text, copies, found in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                gone = np.zeros(len(text) + 1, np.int32)
                if copies > 1 and len(text) >= length:
                    gone[[0, len(text)]] = 1, -1
                for f in found or []:
                    gone[f["a"]] += 1
                    gone[f["b"] + length] -= 1
                removed = np.cumsum(gone[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~removed].tobytes()
                spans = len(_runs(removed)[0])
                for c, v in zip(out, (len(text), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(out, kinds))],
                ["tid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    done = texts.join(runs, "tid", "left").select("tid", "text", "copies", "runs").mapInArrow(
        cut, "tid string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    if not with_text:
        done = stored(docs.sparkSession, done.drop("kept"), "suffix-texts")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(*[F.col(k).alias(f"_keep{i}") for i, k in enumerate(keep)], F.md5(text).alias("tid"))
    return rows.join(done, "tid").select(
        *[F.col(f"_keep{i}").alias(k) for i, k in enumerate(keep)], *[c for c in done.columns if c != "tid"]
    )
