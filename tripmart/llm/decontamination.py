"""Benchmark passages in documents, as a prefix-filtered set join of DataFrames.

A window is a run of ``window_words`` words of a benchmark item (a shorter item is one window). A
document contains a window only if it contains every shingle of it, so one shingle per window
has to be looked for: the necessary prefix of a set that must be contained whole has length one.

1. Every document shingle that occurs in the benchmark at all is kept with its place. This one
   pass over the corpus also yields how rare each shingle is.
2. Each window takes its rarest shingle as prefix token; equal windows are one window.
3. Matches of prefix tokens give where the window would have to start. Places before the
   document's start or past its end are dropped (positional and length bound).
4. The words at each place left are compared with the window, word by word.

Rarity order matters for speed only. The benchmark side is broadcast if its counted rows are
below ``broadcast_rows``; beyond that the same joins shuffle, and adaptive execution splits hot
shingles. Every step is a DataFrame operation.

Null and empty texts have no words and no hits; items without words have no window. Repeated
rows each get a row. Either table may be empty. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import ascii_lower, stored

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
BROADCAST_ROWS = 1_000_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words; ASCII other than digits and letters parts them."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def word_hashes(words: Column) -> Column:
    """Hash of every word of an array column."""
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hash(hashes: Column, at: Column, n: int) -> Column:
    """Hash of the ``n`` words from place ``at`` (from 0) on, made from their word hashes; no array
    of words is built for a place."""
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(n)))


def shingle_hashes(hashes: Column, n: int) -> Column:
    """Hash of the ``n`` words from every place of an array of word hashes on."""
    last = F.size(hashes) - n + 1
    return F.when(
        last > 0, F.transform(F.slice(hashes, 1, F.greatest(last, F.lit(1))), lambda h, i: shingle_hash(hashes, i, n))
    ).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window_words: int, n: int) -> DataFrame:
    """``item, window_id, words``: the windows of every item."""
    words = items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window_words + 1, F.lit(1)))
    cut = words.select("item", "w", F.explode(starts).alias("s"))
    cut = cut.select("item", F.slice("w", F.col("s"), window_words).alias("words"))
    return cut.select("item", F.md5(F.array_join("words", " ")).alias("window_id"), "words")


def _tokens(windows: DataFrame, n: int) -> DataFrame:
    """``window_id, words, n, offset, token``: the shingles of every distinct window; windows
    shorter than a shingle are one shingle of their own length."""
    distinct = windows.dropDuplicates(["window_id"]).select(
        "window_id", "words", F.least(F.size("words"), F.lit(n)).alias("n")
    )
    places = F.sequence(F.lit(0), F.size("words") - F.col("n"))
    cut = distinct.select("*", word_hashes(F.col("words")).alias("hashes"), F.explode(places).alias("offset"))
    token = F.when(F.lit(False), F.lit(None).cast("long"))
    for k in range(1, n + 1):
        token = token.when(F.col("n") == k, shingle_hash(F.col("hashes"), F.col("offset"), k))
    return cut.withColumn("token", token).drop("hashes")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
    broadcast_rows: int = BROADCAST_ROWS,
    with_text: bool = False,
) -> DataFrame:
    """``<id>, n_words, n_hit, n_items, items`` (sorted item ids) and ``spans`` (hit words as
    first word and length) of every document; ``text`` too when asked."""
    spark = docs.sparkSession
    windows = stored(
        spark, benchmark_windows(benchmark, item_col, item_text_col, window_words, shingle_words), "benchmark-windows"
    )
    tokens = stored(spark, _tokens(windows, shingle_words), "benchmark-tokens")
    sizes = sorted(r.n for r in tokens.select("n").distinct().collect())  # at most `shingle_words` values
    small = tokens.count() <= broadcast_rows

    def beside(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    # Rows may repeat, so that an id alone does not name a row.
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("id", "text"))
    worded = keyed.select("key", word_hashes(words_of(F.col("text"))).alias("hw"))
    found = None
    wanted = tokens.select("token", "n").distinct()
    for n in sizes:
        hashed = worded.select("key", F.size("hw").alias("n_words"), shingle_hashes(F.col("hw"), n).alias("h"))
        # The outer form: for the plain one Spark infers a filter on the array and would compute
        # the words again for every place.
        placed = hashed.select("key", "n_words", F.posexplode_outer("h").alias("pos", "token"))
        hits = placed.join(beside(wanted.filter(F.col("n") == n).select("token")), "token")
        hits = hits.withColumn("n", F.lit(n))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = spark.createDataFrame([], "token long, key long, n_words int, pos int, n int")
    found = stored(spark, found.dropDuplicates(["key", "pos", "n"]), "benchmark-matches")
    rarity = found.groupBy("token", "n").agg(F.count(F.lit(1)).alias("seen"))
    # A window with a shingle that no document has is not in any document.
    ranked = tokens.join(rarity, ["token", "n"], "left")
    by_window = Window.partitionBy("window_id").orderBy(F.coalesce("seen", F.lit(0)), "offset")
    prefix = ranked.withColumn("rank", F.row_number().over(by_window)).filter("rank = 1 and seen is not null")
    prefix = stored(spark, prefix.select("token", "n", "window_id", "words", "offset"), "benchmark-prefixes")
    places = found.join(beside(prefix), ["token", "n"]).select(
        "key", (F.col("pos") - F.col("offset")).alias("start"), F.size("words").alias("length"),
        "n_words", "window_id", "words",
    ).filter("start >= 0 and start + length <= n_words")
    candidates = places.groupBy("key").agg(
        F.collect_list(F.struct("start", "length", "window_id", "words")).alias("candidates")
    )
    candidates = stored(spark, candidates, "benchmark-candidates")
    few = candidates.agg(F.count(F.lit(1)), F.sum(F.size("candidates"))).first()
    few = few[0] <= broadcast_rows // 10 and (few[1] or 0) <= broadcast_rows // 4
    all_words = keyed.withColumn("w", words_of(F.col("text")))
    joined = all_words.join(F.broadcast(candidates) if few else candidates, "key", "left")
    true = F.filter(
        "candidates", lambda c: F.slice(F.col("w"), c["start"] + 1, c["length"]) == c["words"]
    )
    verified = joined.select(
        "key", "id", F.size("w").alias("n_words"), true.alias("true"), *(["text"] if with_text else [])
    )
    # Runs of hit words: sorted places, each joined to the last run if it touches it.
    sorted_places = F.array_sort(F.transform("true", lambda c: F.struct(c["start"].alias("a"), (c["start"] + c["length"]).alias("b"))))
    empty = F.array().cast("array<struct<a:int,b:int>>")
    runs = F.aggregate(
        sorted_places,
        empty,
        lambda done, p: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["b"] >= p["a"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(
                    F.element_at(done, -1)["a"].alias("a"),
                    F.greatest(F.element_at(done, -1)["b"], p["b"]).alias("b"),
                )),
            ),
        ).otherwise(F.concat(done, F.array(p))),
    )
    result = verified.select(
        "key", "id", "n_words", F.coalesce(runs, empty).alias("spans"), *(["text"] if with_text else []),
        F.transform("true", lambda c: c["window_id"]).alias("windows"),
    )
    # Which items: few rows, one per document, window and item.
    holding = result.filter(F.size("windows") > 0).select("key", F.explode(F.array_distinct("windows")).alias("window_id")).distinct()
    of_items = holding.join(beside(windows.select("item", "window_id").distinct()), "window_id")
    items = of_items.groupBy("key").agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    items = stored(spark, items, "benchmark-items")
    with_items = result.join(F.broadcast(items) if few else items, "key", "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda t, r: t + r["b"] - r["a"])
    return with_items.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long"),
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.transform("spans", lambda r: F.struct(r["a"].alias("first"), (r["b"] - r["a"]).alias("length"))).alias("spans"),
        *(["text"] if with_text else []),
    )
