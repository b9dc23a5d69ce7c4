"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Which document goes where depends on lengths only, and there are at most ``capacity`` of them.
So the plan is made from the histogram of lengths (a frame of ``capacity`` rows at most) and
then applied to all pieces in parallel:

1. Pieces longer than a third of the capacity are matched greedily, longest first, each with
   the longest other one that still fits beside it; no sequence holds more than two of them.
2. Shorter pieces, longest first, go to the fullest sequence that still takes them.
3. Every piece gets its rank among the pieces of its length, from counts per hash bucket and
   ranks within the bucket; a length that holds a third of all pieces is spread over all tasks.
4. The plan maps (length, rank) to a sequence and a place in it.

Null text is empty text and yields its end id alone. Repeated rows are separate documents. An
empty table yields no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import slices, stored
from tripmart.llm.tokens import WordEncoder

CAPACITY = 1024
END_ID = 2
ROWS_PER_BUCKET = 100_000


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``<id>, piece, start, length, ids``: token ids (little-endian 32-bit) of every document
    and its end id; documents longer than the capacity are cut, the first piece being the
    short one."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches):
        encoder = WordEncoder.of(tokenizer_path)
        for part, texts in slices(batches, "text"):
            keys, numbers, starts, lengths, ids = [], [], [], [], []
            for row, encoded in enumerate(encoder.encode_many(texts)):
                data = encoded + end
                n = len(data) // 4
                first = (n - 1) % capacity + 1
                bounds = [0, *range(first, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    keys.append(row)
                    numbers.append(piece)
                    starts.append(a)
                    lengths.append(b - a)
                    ids.append(data[4 * a : 4 * b])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(keys, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["id", "piece", "start", "length", "ids"],
            )

    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids binary"
    return source.mapInArrow(pieces, schema).withColumnRenamed("id", id_col)


def match_large(counts: Counter, capacity: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Sequences of one or two large pieces: (contents as (length, how many), sequences)."""
    lengths = sorted(counts)
    while lengths:
        x = lengths[-1]
        at = bisect.bisect_right(lengths, capacity - x) - 1
        if at < 0:
            yield [(x, 1)], counts[x]
            lengths.pop()
            continue
        y = lengths[at]
        if x == y:
            pairs, used = counts[x] // 2, 2
        else:
            pairs, used = min(counts[x], counts[y]), 1
        if pairs:
            yield ([(x, 2)] if x == y else [(x, 1), (y, 1)]), pairs
        counts[x] -= used * pairs
        if x == y and counts[x]:  # one is left; its partner is shorter
            below = lengths[at - 1] if at else None
            if below is None:
                yield [(x, 1)], 1
            else:
                yield [(x, 1), (below, 1)], 1
                counts[below] -= 1
                if not counts[below]:
                    lengths.remove(below)
            counts[x] = 0
        if x != y:
            counts[y] -= pairs
            if not counts[y]:
                lengths.remove(y)
        if not counts[x]:
            lengths.remove(x)


def packing_plan(histogram: Mapping[int, int], capacity: int) -> list[tuple[int, ...]]:
    """``(length, first rank, pieces, first sequence, pieces per sequence, offset)`` rows, from
    how many pieces have each length. Its work depends on the number of lengths only."""
    large = Counter({n: c for n, c in histogram.items() if 3 * n > capacity and c})
    shapes: list[list] = [[items, count] for items, count in match_large(large, capacity)]
    by_gap: dict[int, list[int]] = {}
    for i, (items, _) in enumerate(shapes):
        by_gap.setdefault(capacity - sum(n * k for n, k in items), []).append(i)
    gaps = sorted(by_gap)

    def place(shape: int, gap: int) -> None:
        if gap not in by_gap:
            by_gap[gap] = []
            bisect.insort(gaps, gap)
        by_gap[gap].append(shape)

    small = [n for n, c in histogram.items() if 3 * n <= capacity and c]
    for size in sorted(small, reverse=True):
        need = histogram[size]
        while need:
            at = bisect.bisect_left(gaps, size)
            if at == len(gaps):
                fits = capacity // size
                full, rest = divmod(need, fits)
                if full:
                    shapes.append([[(size, fits)], full])
                    place(len(shapes) - 1, capacity - fits * size)
                if rest:
                    shapes.append([[(size, rest)], 1])
                    place(len(shapes) - 1, capacity - rest * size)
                break
            gap = gaps[at]
            shape = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.pop(at)
            items, count = shapes[shape]
            fits = gap // size
            full = min(count, need // fits)
            rest = need - full * fits if full < count else 0
            if full:
                shapes.append([[*items, (size, fits)], full])
                place(len(shapes) - 1, gap - fits * size)
            if rest:
                shapes.append([[*items, (size, rest)], 1])
                place(len(shapes) - 1, gap - rest * size)
            shapes[shape][1] = left = count - full - bool(rest)
            if left:
                place(shape, gap)
            need -= full * fits + rest
    plan, sequence, ranks = [], 0, Counter()
    for items, count in shapes:
        offset = 0
        for length, k in items if count else []:
            plan.append((length, ranks[length], k * count, sequence, k, offset))
            ranks[length] += k * count
            offset += k * length
        sequence += count
    return plan


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    length_col: str = "length",
    order_by: tuple[str, ...] = ("doc_id", "piece"),
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``sequence_id, offset`` to a stored table of pieces (it is read more than once)."""
    spark = pieces.sparkSession
    buckets = max(1, pieces.count() // rows_per_bucket)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order_by), F.lit(buckets)))
    counts = keyed.groupBy(F.col(length_col).alias("_n"), F.col("_bucket").alias("_b")).agg(
        F.count(F.lit(1)).alias("_count")
    )
    counts = stored(spark, counts, "packing-counts")
    before = Window.partitionBy("_n").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("_base", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    # At most `capacity` rows.
    histogram = {r[0]: r[1] for r in counts.groupBy("_n").agg(F.sum("_count")).collect()}
    plan = packing_plan(histogram, capacity)
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)
    inside = Window.partitionBy(length_col, "_bucket").orderBy(*order_by)
    ranked = keyed.withColumn("_row", F.row_number().over(inside) - 1).join(
        base, (F.col(length_col) == F.col("_n")) & (F.col("_bucket") == F.col("_b"))
    )
    ranked = ranked.select(*pieces.columns, (F.col("_row") + F.col("_base")).alias("_rank"))
    # One sortable number per (length, rank), so that one search finds the row of the plan.
    shift = np.int64(2**44)
    firsts = table[:, 0] * shift + table[:, 1]

    def assign(batches):
        for batch in batches:
            n = batch.column(batch.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            at = np.searchsorted(firsts, n * shift + rank, "right") - 1
            row = table[at]
            inner = rank - row[:, 1]
            columns = batch.columns[:-1] + [
                pa.array(row[:, 3] + inner // row[:, 4]),
                pa.array(row[:, 5] + inner % row[:, 4] * n),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(assign, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = True,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset`` of all documents.

    The pieces are stored once, so the tokenizer runs once. Without ``keep_ids`` only their
    checksums are stored.
    """
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id)
    pieces = pieces.withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    pieces = stored(docs.sparkSession, pieces, "packing-pieces")
    return pack(pieces, capacity, order_by=("doc_id", "piece", "ids_crc32"))
