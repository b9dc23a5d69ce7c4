"""Near duplicates by SimHash fingerprints and meeting balls.

A fingerprint is the bitwise majority of the XXH64 hashes of all word shingles. Two
fingerprints at a distance of at most three meet half-way: one is at most one flip and the
other at most two flips from some value between them. Parity tells who goes how far:

* distance 1 or 3: one fingerprint has an even number of bits set, the other an odd one. The
  even one emits itself and all variants with two flips, the odd one those with one flip.
* distance 2 (equal parity): both emit their variants with one flip.

Variants meet in a shuffle on their leading bits; the variants that share these bits are made
in the task from the fingerprint that was sent, so a fingerprint is sent once per variant of
its *leading* bits instead of once per variant. All that meet on one value are at most three
apart if one of them came by a single flip, which is checked on the bits. A task returns a
spanning forest of its links, never all pairs of a group. Buckets with too many fingerprints
are dealt again by further bits.

Null and empty texts have fingerprint zero, which links like any other. Repeated rows each get
a row. An empty table yields no rows. Only the named columns are read.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ASCII_LOWER, slices, stored
from tripmart.llm.components import component_roots

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
BUCKET_ROWS = 60_000
STEP_BITS = 6


def text_fingerprint(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit majority fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    w = min(words_per_shingle, len(words))
    starts = np.concatenate([[0], ends[: len(ends) - w] + 1]).tolist()
    hashes = np.array(
        [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[w - 1 :].tolist())],
        np.uint64,
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(BITS, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, fp``: the fingerprint of every text, as a signed long."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def compute(batches):
        for part, texts in slices(batches, "text"):
            found = np.array([text_fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["id", "fp"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(compute, f"id {kind}, fp long").withColumnRenamed("id", id_col)


@lru_cache(maxsize=64)
def _masks(low: int, high: int, flips: int) -> np.ndarray:
    """Values with ``flips`` bits set, all within bit positions ``low`` to ``high - 1``."""
    found = [sum(1 << b for b in c) for c in combinations(range(low, high), flips)]
    return np.array(found, np.uint64)


def _deal(fp: np.ndarray, value: np.ndarray, left: np.ndarray, exact: np.ndarray, low: int, high: int):
    """One row for each way to use some of the flips that are left on the bits of a range."""
    out = []
    for flips in (0, 1, 2):
        may = np.nonzero(left >= flips)[0]
        masks = _masks(low, high, flips)
        if len(may) and len(masks):
            rows = np.repeat(may, len(masks))
            out.append((fp[rows], value[rows] ^ np.tile(masks, len(may)), left[rows] - flips, exact[rows]))
    return [np.concatenate(c) for c in zip(*out)]


# A row on its way: the fingerprint, its variant so far, flips still to be used below the bits
# already dealt, and the total of flips; an even fingerprint with two flips is also its own variant.
ROUTE = "bucket long, fp long, value long, flips_left int, flips int"


def _emit(low: int):
    """Rows of the first deal, over the bits from ``low`` up."""

    def deal(frames):
        for f in frames:
            fp = f["fp"].to_numpy(np.int64).view(np.uint64)
            for at in range(0, len(fp), 5000):
                part = fp[at : at + 5000]
                even = np.bitwise_count(part) % 2 == 0
                sent = np.concatenate([part, part[even]])
                flips = np.concatenate([np.ones(len(part), np.int8), np.full(even.sum(), 2, np.int8)])
                yield _route(*_deal(sent, sent, flips, flips, low, BITS), low)

    return deal


def _route(fp, value, left, flips, low: int) -> pd.DataFrame:
    shifted = (value >> np.uint64(low)).view(np.int64)
    return pd.DataFrame({
        "bucket": shifted, "fp": fp.view(np.int64), "value": value.view(np.int64),
        "flips_left": left.astype(np.int32), "flips": flips.astype(np.int32),
    })


def _redeal(low: int, high: int):
    """Deal rows of crowded buckets by the bits from ``low`` to ``high - 1`` too."""

    def deal(frames):
        for f in frames:
            columns = [f["fp"].to_numpy(np.int64).view(np.uint64), f["value"].to_numpy(np.int64).view(np.uint64),
                       f["flips_left"].to_numpy(np.int8), f["flips"].to_numpy(np.int8)]
            for at in range(0, len(f), 20_000):
                part = [c[at : at + 20_000] for c in columns]
                yield _route(*_deal(*part, low, high), low)

    return deal


def _labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, among ``n`` nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, u, least)
        np.minimum.at(label, v, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def _variants(value: np.ndarray, left: np.ndarray, flips: np.ndarray, low: int):
    """Row numbers and final variants of rows whose remaining flips go to the bits below ``low``."""
    rows, out = [], []
    for k in (0, 1, 2):
        # Two flips in all also stand for none: the even fingerprint itself.
        of = np.nonzero((left == k) | ((k == 0) & (left == 2) & (flips == 2)))[0]
        masks = _masks(0, low, k)
        if len(of) and len(masks):
            rows.append(np.repeat(of, len(masks)))
            out.append((value[of][:, None] ^ masks[None, :]).ravel())
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(out)


def meet(fp: np.ndarray, value: np.ndarray, left: np.ndarray, flips: np.ndarray, low: int) -> np.ndarray:
    """Links of one bucket, as a spanning forest: an array of (fingerprint, smallest linked one)."""
    nodes, at = np.unique(fp, return_inverse=True)
    one = np.nonzero(flips == 1)[0]
    rows, single = _variants(value[one], left[one], flips[one], low)
    owner = at[one][rows]
    order = np.argsort(single, kind="stable")
    single, owner = single[order], owner[order]
    if not len(single):
        return np.zeros((0, 2), np.uint64)
    same = single[1:] == single[:-1]
    links = [np.stack([owner[1:][same], owner[:-1][same]])]
    # A small table of hash bits tells most variants by two flips apart from all of these.
    size = np.uint64(64 - max(10, int(len(single) * 8).bit_length()))
    spread = np.uint64(0x9E3779B97F4A7C15)
    there = np.zeros(1 << int(64 - size), bool)
    there[(single * spread) >> size] = True
    two = np.nonzero(flips == 2)[0]
    for start in range(0, len(two), 1000):
        part = two[start : start + 1000]
        rows, double = _variants(value[part], left[part], flips[part], low)
        hit = np.nonzero(there[(double * spread) >> size])[0]
        place = np.searchsorted(single, double[hit])
        found = single[np.minimum(place, len(single) - 1)] == double[hit]
        pairs = np.stack([at[part][rows[hit[found]]], owner[place[found]]])
        links.append(np.unique(pairs, axis=1))
    u, v = np.concatenate(links, axis=1)
    apart = np.bitwise_count(nodes[u] ^ nodes[v])
    assert not len(apart) or apart.max() <= 3
    label = _labels(len(nodes), u, v)
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return np.stack([nodes[moved], nodes[label[moved]]], axis=1)


def _in_bucket(low: int):
    def forest(f: pd.DataFrame) -> pd.DataFrame:
        of = [f[c].to_numpy(np.int64).view(np.uint64) for c in ("fp", "value")]
        found = meet(*of, f["flips_left"].to_numpy(), f["flips"].to_numpy(), low)
        return pd.DataFrame(found.view(np.int64), columns=["u", "v"])

    return forest


def links(distinct: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``u, v``: links that connect all fingerprints at a distance of at most three."""
    spark = distinct.sparkSession
    total = distinct.count()
    bits = min(24, max(2, int(total * 30 // bucket_rows).bit_length()))
    low = BITS - bits
    routed = distinct.select("fp").mapInPandas(_emit(low), ROUTE)
    found, schema = [], "u long, v long"
    while True:
        routed = stored(spark, routed, "simhash-variants")
        sizes = routed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        crowded = stored(spark, sizes.filter(F.col("n") > bucket_rows).select("bucket"), "simhash-crowded")
        again = low > 12 and not crowded.isEmpty()
        ready = routed.join(crowded, "bucket", "left_anti") if again else routed
        found.append(ready.groupBy("bucket").applyInPandas(_in_bucket(low), schema))
        if not again:
            break
        step = min(STEP_BITS, low)
        routed = routed.join(crowded, "bucket", "left_semi").select("fp", "value", "flips_left", "flips")
        routed = routed.mapInPandas(_redeal(low - step, low), ROUTE)
        low -= step
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``<id>, fingerprint, component_id``: hex fingerprint, and the smallest id that links
    reach from the document, itself included."""
    spark = docs.sparkSession
    rows = stored(spark, fingerprints(docs, id_col, text_col), "simhash-fingerprints")
    distinct = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    distinct = stored(spark, distinct, "simhash-distinct")
    roots = component_roots(links(distinct, bucket_rows), "simhash-links")
    rooted = distinct.join(roots, F.col("fp") == F.col("u"), "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(groups, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
