"""Words that are one edit apart, by a relational frontier over tries, and the spelling each stands for.

The *edge table* is a trie as rows: a node (a prefix) with the characters of its edges and whether each leads to a word.
The *frontier* is a table of states (word, position, node, edits). Each level joins all states with the
edge table on the node: a state without an edit goes on along its word and also spends its edit on every
other edge (a replaced or inserted character) or on none (a deleted one); a state with an edit only follows its word.
States that end on a word with one edit spent are neighbours.

An edit lies in the first or in the second half of a word. Two tries, one of the words and one of the reversed words, are
searched from the middle on, each for the edits beyond it. So no state ever stands at a root, which all
words share, and each level keeps a handful of states a word. Levels are stored; their number is bounded by
``DEEP``. Words longer than that are joined exactly in another way: by hash of all their texts with one character
deleted and the place of that character, verified on the words themselves.

Null texts have no words, a null id counts as empty text. Ties of counts go to the smaller word in code-point order.
An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import ascii_lower, stored

# Longest words, in code points, that the tries hold.
DEEP = 32
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5


def misspelt(word: Column, doc_id: Column, every: int) -> Column:
    """The word, or where ``every`` divides the checksum of id and word, the word without the character that the
    checksum chooses."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (mark % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(mark % every == 0, shorter).otherwise(word)


def word_counts(docs: DataFrame, every: int = 199, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: words of the texts that are long and frequent enough. Counts are combined in the map tasks."""
    # Shorter runs cannot become words: a misspelling only shortens.
    runs = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(rf"[A-Za-zÀ-ÿ]{{{min_length},}}"), 0)
    found = docs.select("doc_id", F.explode(runs).alias("run"))
    words = found.select(misspelt(F.col("run"), F.col("doc_id"), every).alias("word"))
    return (
        words.filter(F.length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )


def edge_table(oriented: DataFrame, depth: int) -> DataFrame:
    """``side, node, ends, kids``: the nodes of both tries from ``depth`` on, whether a word ends there, and the edges
    as (character, whether a word ends behind it, the characters of the edges behind it): at most one per letter."""
    steps = oriented.select(
        "side", "w", F.explode(F.sequence(F.lit(depth), F.length("w"))).alias("at")
    ).select(
        "side",
        F.substring("w", F.lit(1), F.col("at")).alias("node"),
        F.substring("w", F.col("at") + 1, F.lit(1)).alias("c"),
        F.substring("w", F.col("at") + 2, F.lit(1)).alias("d"),
        (F.col("at") + 1 == F.length("w")).alias("t"),
    )
    edges = steps.groupBy("side", "node", "c").agg(F.max("t").alias("t"), F.array_join(F.collect_set("d"), "").alias("behind"))
    edge = F.when(F.col("c") != "", F.struct("c", "t", "behind"))
    return edges.groupBy("side", "node").agg(F.max(F.col("c") == "").alias("ends"), F.collect_list(edge).alias("kids"))


def _advanced(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level on. ``edits`` 2: found, the node is the neighbour."""
    of = edges.select(F.col("side").alias("_side"), F.col("node").alias("_node"), "ends", "kids")
    at = frontier.join(of, (F.col("side") == F.col("_side")) & (F.col("node") == F.col("_node")))
    pos, node, kids, length = F.col("pos"), F.col("node"), F.col("kids"), F.length("w")

    def letter(shift: int) -> Column:
        return F.substring("w", pos + shift + 1, F.lit(1))

    def moved(steps: int, to: Column, is_word: Column, behind: Column) -> Column:
        """A state with its edit spent; -1 where the edges behind it show that it leads nowhere."""
        done = pos + steps == length
        edits = F.when(done & is_word, 2).when(~done & F.contains(behind, letter(steps)), 1).otherwise(-1)
        return F.struct((pos + steps).alias("pos"), to.alias("node"), edits.alias("edits"))

    def over(edges: Column, steps: int) -> Column:
        return F.transform(edges, lambda k: moved(steps, F.concat(node, k["c"]), k["t"], k["behind"]))

    def along(c: Column, steps: int) -> Column:
        return over(F.filter(kids, lambda k: k["c"] == c), steps)

    others = F.filter(kids, lambda k: k["c"] != letter(0))  # past the last letter: all
    none = F.slice(F.array(moved(0, node, F.lit(False), F.lit(""))), 1, 0)
    more = pos < length
    kept = F.array(F.struct((pos + 1).alias("pos"), F.concat(node, letter(0)).alias("node"), F.lit(0).alias("edits")))
    inserted, replaced = over(others, 0), over(others, 1)
    last = F.array(moved(1, node, F.col("ends"), F.lit("")))
    deleted = F.when(pos + 1 == length, last).otherwise(along(letter(1), 2))
    nexts = F.when(
        F.col("edits") == 0,
        F.concat(inserted, F.when(more, F.concat(kept, replaced, deleted)).otherwise(none)),
    ).otherwise(along(letter(0), 1))
    return at.select("side", "w", F.inline(F.filter(nexts, lambda s: s["edits"] >= 0)))


def trie_neighbours(words: DataFrame, deep: int, name: str) -> DataFrame:
    """``word, near``: all pairs at one edit, in both directions, among words of at most ``deep`` code points."""
    spark = words.sparkSession
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("w"), F.floor(F.length("word") / 2).cast("int").alias("pos")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("w"), F.ceil(F.length("word") / 2).cast("int").alias("pos")),
    )
    oriented = words.filter(F.length("word") <= deep).select(F.inline(both))
    shape = oriented.agg(F.min("pos"), F.max(F.length("w") - F.col("pos"))).first()
    if shape[0] is None:
        return words.select("word", F.col("word").alias("near")).filter("false")
    edges = stored(spark, edge_table(oriented, shape[0]), name)
    states = oriented.select(
        "side", "w", "pos", F.substring("w", F.lit(1), F.col("pos")).alias("node"), F.lit(0).alias("edits")
    )
    found = []
    # One level per letter behind the middle, and one for a letter put behind the last.
    for _ in range(shape[1] + 1):
        states = stored(spark, _advanced(states, edges), name)
        found.append(states.filter("edits = 2"))
        states = states.filter("edits < 2")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)

    def turned(text: str) -> Column:
        return F.when(F.col("side") == 0, F.col(text)).otherwise(F.reverse(text))

    return pairs.select(turned("w").alias("word"), turned("node").alias("near")).distinct()


def long_neighbours(words: DataFrame, deep: int) -> DataFrame:
    """``word, near``: the pairs at one edit of which at least one word is longer than ``deep``."""
    long = words.filter(F.length("word") >= deep).select("word", F.xxhash64("word").alias("id"))
    without = F.transform(
        F.sequence(F.lit(1), F.length("word")),
        lambda i: F.struct(
            i.alias("at"), F.xxhash64(F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word")))).alias("hash")
        ),
    )
    cut = long.select("id", F.inline(without))
    other = cut.select(F.col("id").alias("near_id"), F.col("at").alias("_at"), F.col("hash").alias("_hash"))
    # Words alike but for one place: as many as there are letters at most.
    replaced = cut.join(other, (F.col("hash") == F.col("_hash")) & (F.col("at") == F.col("_at")) & (F.col("id") != F.col("near_id")))
    shorter = long.select(F.col("id").alias("near_id"))
    deleted = cut.select("id", "hash").join(shorter, F.col("hash") == F.col("near_id")).select("id", "near_id")
    ids = replaced.select("id", "near_id").union(deleted).union(deleted.select(F.col("near_id").alias("id"), F.col("id").alias("near_id"))).distinct()
    near = long.select(F.col("word").alias("near"), F.col("id").alias("near_id"))
    return (
        ids.join(long, "id").join(near, "near_id")
        .filter((F.levenshtein("word", "near", 1) == 1) & (F.greatest(F.length("word"), F.length("near")) > deep))
        .select("word", "near")
    )


def final_forms(forms: DataFrame, name: str) -> DataFrame:
    """``word, root``: where the chain of forms of every word of ``word, form`` ends. Counts grow along a chain, so
    it has an end, and every round doubles the length that is known."""
    spark = forms.sparkSession
    now = stored(spark, forms.select("word", F.col("form").alias("root")), name)
    while True:
        ahead = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        step = now.join(ahead, F.col("root") == F.col("_word"), "left")
        if step.filter(F.col("_root").isNotNull()).isEmpty():
            return now
        now = stored(spark, step.select("word", F.coalesce("_root", "root").alias("root")), name)


def spelling_variants(
    docs: DataFrame,
    every: int = 199,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    deep: int = DEEP,
    name: str = "variants",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word, its most frequent neighbour if that is at least ``ratio``
    times as frequent, and the last word of the chain of forms."""
    spark = docs.sparkSession
    words = stored(spark, word_counts(docs, every, min_length, min_count), name)
    pairs = trie_neighbours(words, deep, name).union(long_neighbours(words, deep))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = pairs.join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    likely = -F.col("best.less") >= ratio * F.col("n")
    known = stored(spark, words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.less")).alias("form_n"),
    ), name)
    roots = final_forms(known.filter("form is not null"), name)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
