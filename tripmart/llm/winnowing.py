"""Document fingerprints by winnowing, in DataFrame functions.

A text's words are hashed in runs of ``gram_words`` and each window of ``window_grams`` runs
keeps its smallest hash, the rightmost one if there are several. Texts that share a run of
``gram_words + window_grams - 1`` words share a kept hash; where it stands is kept too.

An entry is the upper 41 bits of a hash and, below these, its place counted backwards, so that the
smallest entry of a window is its smallest hash with the rightmost tie. Windows are formed by
doubling: the minima of windows of 2, 4 and 8 from those of half the size.

Words are maximal runs of characters other than white space and ASCII punctuation, in lower case.
Texts of fewer words than a run are one run; texts without words have no hash. Null is empty
text. Two texts without hashes are alike (1.0), one without is unlike all others (0.0).
Repeated rows each get a row. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

GRAM_WORDS = 5
DOUBLINGS = 3  # windows of 8 runs
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ROWS_PER_RANGE = 2_000
MAX_RANGES = 10_000
IDS_PER_RANGE = 20
PLACES = 2**23  # places below a hash; a longer text counts them modulo this number


def _bind(value: Column, use) -> Column:
    """``use(value)``, the value being computed once for all its uses."""
    return F.transform(F.array(value), use)[0]


def _pairs(values: Column, gap: int) -> Column:
    """Minimum of each entry and the one ``gap`` further on."""

    def least(v: Column) -> Column:
        first = F.slice(v, 1, F.greatest(F.size(v) - gap, F.lit(0)))
        return F.transform(first, lambda x, i: F.least(x, F.get(v, i + gap)))

    return _bind(values, least)


def winnow(text: Column, gram_words: int = GRAM_WORDS, doublings: int = DOUBLINGS) -> Column:
    """``array<long>``: the kept entries of a text, in order; ``kept`` takes them apart."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")

    def entries(w: Column) -> Column:
        runs = F.greatest(F.size(w) - gram_words + 1, F.least(F.size(w), F.lit(1)))
        return F.transform(
            F.slice(w, 1, runs),
            lambda x, i: F.shiftleft(F.xxhash64(F.slice(w, i + 1, gram_words)), 23).bitwiseOR(
                (F.lit(PLACES - 1) - i.bitwiseAND(F.lit(PLACES - 1))).cast("long")
            ),
        )

    def minima(e: Column) -> Column:
        least = e
        for k in range(doublings):
            least = _pairs(least, 2**k)
        # Fewer runs than a window are one window.
        whole = F.filter(F.array(F.array_min(e)), lambda x: x.isNotNull())
        return F.array_distinct(F.when(F.size(e) < 2**doublings, whole).otherwise(least))

    return _bind(_bind(words, entries), minima)


def kept(entries: Column) -> Column:
    """``array<struct<hash, pos>>`` of winnowed entries: hash and number of the first word."""
    return F.transform(
        entries,
        lambda x: F.struct(
            F.shiftright(x, 23).alias("hash"),
            (F.lit(PLACES - 1) - x.bitwiseAND(F.lit(PLACES - 1))).cast("int").alias("pos"),
        ),
    )


def hash_set(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda x: F.shiftright(x, 23)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _below(bounds: list, value: Column) -> Column:
    """How many of the sorted bounds are below a value, by a search of two levels."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    several = lambda row: F.array(*[F.lit(b) for b in row])
    count = lambda row: F.aggregate(row, F.lit(0), lambda n, b: n + (b < value).cast("int"))
    full = count(several([b[-1] for b in blocks]))
    inside = F.get(F.array(*[several(b) for b in blocks]), full)
    return full * step + F.coalesce(count(inside), F.lit(0))


def ranges(df: DataFrame, id_col: str, rows_per_range: int = ROWS_PER_RANGE) -> Column:
    """Number of a row's range of ids, counted from the highest ids down; at most ``MAX_RANGES``.
    The cuts between numbers come from a quantile sketch over all rows. Ids of other types, text for
    one, are cut at values of their own type: at quantiles of the distinct ids whose hash is low,
    some ``IDS_PER_RANGE`` a range. Cuts decide only which task orders a row."""
    n = df.count()
    parts = min(MAX_RANGES, math.ceil(n / rows_per_range))
    cuts: list = []
    if isinstance(df.schema[id_col].dataType, NumericType):
        order = F.col(id_col).cast("double")
        if parts > 1:
            shares = [i / parts for i in range(1, parts)]
            found = df.agg(F.percentile_approx(order, shares, 20 * parts)).first()[0] or []
            cuts = sorted({float(c) for c in found})
    else:
        order = F.col(id_col)
        if parts > 1:
            low = F.shiftrightunsigned(F.xxhash64(order), 11) <= int(min(1.0, IDS_PER_RANGE * parts / n) * (1 << 53))
            some = sorted(r[0] for r in df.filter(order.isNotNull() & low).select(order).distinct().collect())
            cuts = sorted({some[i * len(some) // parts] for i in range(1, parts)}) if some else []
    return F.when(order.isNull(), F.lit(len(cuts))).otherwise(len(cuts) - _below(cuts, order))


def fingerprint_edits(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Fingerprints of every text and of its edited form, whose last third of code points is
    replaced by as many of the next text's first ones: ``<id>, n_chars, edited_sha256,
    entries, edited_entries, near_edited, near_next``.

    The next text is that of the next lower id; the last row is followed by the first. Ids are
    cut into ranges, each ordered on its own in one task. The first row of a range is also sent
    to the range before, where it follows the last row. Equal ids are ordered by text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", ranges(rows, "id", rows_per_range)).withColumn("extra", F.lit(0))
    # One row per range, at most MAX_RANGES + 1, and without texts.
    heads = rows.groupBy("part").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n")).select("part", "id")
    heads = heads.withColumn(
        "before", F.lag("part").over(Window.partitionBy(F.lit(0)).orderBy("part"))
    ).withColumn("last", F.max("part").over(Window.partitionBy(F.lit(0))))
    heads = heads.select("id", F.coalesce("before", "last").alias("before"), F.col("part").alias("of"))
    first = rows.join(
        F.broadcast(heads), (rows["id"].eqNullSafe(heads["id"])) & (rows["part"] == heads["of"])
    ).groupBy("before").agg(F.min("text").alias("text"))
    extra = first.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "text", F.col("before").alias("part"), F.lit(1).alias("extra"))
    order = Window.partitionBy("part").orderBy("extra", F.col("id").desc_nulls_last(), "text")
    both = rows.unionByName(extra).withColumn("next", F.lead("text").over(order))
    n, moved = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - moved), F.substring(F.coalesce("next", F.lit("")), F.lit(1), moved))
    worked = both.select(
        "id", "part", "extra", "text", n.cast("long").alias("n_chars"), edited.alias("edited"),
        winnow(F.col("text")).alias("entries"),
    )
    worked = worked.select(
        "id", "part", "extra", "text", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "entries",
        winnow(F.col("edited")).alias("edited_entries"),
    ).withColumn("next_entries", F.lead("entries").over(order))
    own = hash_set(F.col("entries"))
    return worked.filter("extra = 0").select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", "entries", "edited_entries",
        likeness(own, hash_set(F.col("edited_entries"))).alias("near_edited"),
        likeness(own, hash_set(F.col("next_entries"))).alias("near_next"),
    )
