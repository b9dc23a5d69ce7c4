"""Merkle manifest of a table: one tree per group over its rows, one over the groups' roots.

*Leaves* are digests of chosen columns. They are ranked within their group by range counts
(``operators.scans``), so that a group with a third of all rows is spread like any other.

*Levels* are built by sibling-shift self-joins: every node is joined by equality with the nodes at the
computed indices of its siblings (its own index XOR 1 in binary trees, the other slots of its run in
turn otherwise); the rows of slot zero, which then hold the whole run, emit the parents. A level is stored before
the next one reads it. The number of levels is the logarithm of the largest group.

*Proofs* go down again: a node's path is its own siblings and then its parent's path, joined by parent
index. Levels shrink by the fan-out, so all joins together carry little more than the lowest one.

Nulls are written as ``-``, so a null and an empty value differ. A null group is a group, the first. Rows of
one key are ordered by their digest; rows equal in all digested columns are interchangeable leaves, each with its own
place and proof. A table without rows gives no rows. Columns that are neither digested nor kept are not read,
and kept ones may have any names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.operators.scans import with_positions

# Levels of proofs that are joined in one plan; the last one of them is stored.
LEVELS_PER_PLAN = 4


def field(value: Column) -> Column:
    """A value with its length before it: UTF-8 byte count, ``:``, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the concatenated fields, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _hex(digests: Column) -> Column:
    return F.coalesce(F.lower(F.hex(digests)), F.lit(""))


def _combined(left: Column, own: Column, right: Column) -> Column:
    """The parent of a run of digests, as hex text; ``own`` is hex text already."""
    return F.sha2(F.concat(_hex(left), own, _hex(right)), 256)


def _with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """``tree, pos, n, digest, left, right``: each node with the joined digests of the other nodes of its
    run before and after it (null where there are none)."""
    slot = F.col("pos") % fanout
    found = nodes
    for shift in range(1, fanout):
        at = F.col("pos").bitwiseXOR(1) if fanout == 2 else F.col("pos") - slot + (slot + shift) % fanout
        side = nodes.select(
            F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("digest").alias(f"d{shift}")
        )
        found = found.join(side, (F.col("tree") == F.col("_tree")) & (at == F.col("_pos")), "left").drop("_tree", "_pos")
    # The sibling of slot s is the one at shift (s - slot) mod fanout.
    by_slot = F.array(
        *[F.struct(((slot + d) % fanout).alias("slot"), F.col(f"d{d}").alias("digest")) for d in range(1, fanout)]
    )
    ordered = F.sort_array(F.filter(by_slot, lambda e: e["digest"].isNotNull()))

    def joined(kept: Column) -> Column:
        run = F.aggregate(kept, F.lit(b""), lambda acc, e: F.concat(acc, e["digest"]))
        return F.when(F.size(kept) > 0, run)

    return found.select(
        "tree", "pos", "n", "digest",
        joined(F.filter(ordered, lambda e: e["slot"] < slot)).alias("left"),
        joined(F.filter(ordered, lambda e: e["slot"] > slot)).alias("right"),
    )


def tree_levels(nodes: DataFrame, fanout: int, name: str) -> list[DataFrame]:
    """All levels of all trees, lowest first, as stored tables of ``tree, pos, n, digest, left, right``.

    ``nodes`` has ``tree, pos, n, digest``: place in the tree from 0 and the number of nodes of the tree. The last
    level has one node per tree. A tree that has come down to one node stays as it is.
    """
    if fanout < 2:
        raise ValueError("a run holds two nodes at least")
    spark = nodes.sparkSession
    largest = nodes.agg(F.max("n")).first()[0] or 0
    levels = []
    while largest > 1:
        level = stored(spark, _with_siblings(nodes, fanout), name)
        levels.append(level)
        parent = F.unhex(_combined(F.lit(None).cast("binary"), _hex(F.col("digest")), F.col("right")))
        nodes = level.filter(F.col("pos") % fanout == 0).select(
            "tree",
            F.floor(F.col("pos") / fanout).cast("long").alias("pos"),
            F.ceil(F.col("n") / fanout).cast("long").alias("n"),
            F.when(F.col("n") > 1, parent).otherwise(F.col("digest")).alias("digest"),
        )
        largest = -(-largest // fanout)
    none = F.lit(None).cast("binary")
    levels.append(stored(spark, nodes.select("tree", "pos", "n", "digest", none.alias("left"), none.alias("right")), name))
    return levels


def _paths(levels: list[DataFrame], top: DataFrame, fanout: int, name: str) -> DataFrame:
    """``tree, pos, path``: the siblings of every lowest node on its way up, level by level, then those
    of ``top`` (``tree, path``: where the root of each tree goes on)."""
    spark = top.sparkSession
    above = levels[-1].select("tree", "pos").join(top, "tree").select("tree", "pos", "path")
    for i, level in enumerate(reversed(levels[:-1]), start=1):
        up = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("path").alias("_path"))
        own = F.array(F.struct("left", "right"))
        above = (
            level.join(up, (F.col("tree") == F.col("_tree")) & (F.floor(F.col("pos") / fanout) == F.col("_pos")))
            .select("tree", "pos", F.when(F.col("n") > 1, F.concat(own, F.col("_path"))).otherwise(F.col("_path")).alias("path"))
        )
        if i % LEVELS_PER_PLAN == 0 and i < len(levels) - 1:
            above = stored(spark, above, name)
    return above


def manifest(
    rows: DataFrame,
    columns: Sequence[Column | str],
    key: str,
    group: str,
    keep: Sequence[str] = (),
    changed: Sequence[Column | str] | None = None,
    fanout: int = 2,
    name: str = "merkle",
) -> DataFrame:
    """The kept columns and ``leaf, subroot, root`` (hex digests), ``path`` (array of ``left, right``: joined digests of the
    siblings before and after, lowest level first) and ``changed_leaf``.

    Leaves ascend by ``key`` within a group, subroots by group. ``changed`` lists the values of
    ``columns`` as another copy of the table has them: ``changed_leaf`` is their digest, for `folded`.
    """
    spark = rows.sparkSession
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    other = [F.col(c) if isinstance(c, str) else c for c in (changed or columns)]
    leaves = stored(spark, rows.select(
        F.col(group).alias("group"), F.col(key).alias("key"),
        digest(named).alias("digest"), digest(other).alias("changed"),
        *[F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)],
    ), name)
    placed = with_positions(leaves, ["group", "key", "digest"], "place")
    sizes = stored(spark, placed.groupBy("group").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n")), name)
    groups = stored(spark, with_positions(sizes, ["group"], "tree"), name)
    of = groups.select(F.col("group").alias("of"), "start", "n", "tree")
    nodes = stored(spark, placed.join(of, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("place") - F.col("start")).alias("pos"), "n", "digest", "changed",
        *[f"keep{i}" for i in range(len(keep))],
    ), name)
    levels = tree_levels(nodes.select("tree", "pos", "n", "digest"), fanout, name)
    subroots = levels[-1].select("tree", F.col("digest").alias("subroot"))
    count = F.lit(groups.count())
    upper = tree_levels(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), count.alias("n"), F.col("subroot").alias("digest")),
        fanout, name,
    )
    top = upper[-1].select("digest").first()
    root = _hex(F.lit(bytes(top[0]) if top else None).cast("binary"))
    ends = F.array().cast("array<struct<left:binary,right:binary>>")
    start = upper[-1].select("tree", ends.alias("path"))
    upper_paths = _paths(upper, start, fanout, name).select(F.col("pos").alias("tree"), "path")
    per_tree = stored(spark, upper_paths.join(subroots, "tree"), name)
    paths = _paths(levels, per_tree.select("tree", "path"), fanout, name).select(
        F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), "path"
    )
    roots = per_tree.select(F.col("tree").alias("_of"), "subroot")
    return (
        nodes.join(paths, (F.col("tree") == F.col("_tree")) & (F.col("pos") == F.col("_pos")))
        .join(roots, F.col("tree") == F.col("_of"))
        .select(
            *[F.col(f"keep{i}").alias(c) for i, c in enumerate(keep)],
            _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), root.alias("root"),
            "path", _hex(F.col("changed")).alias("changed_leaf"),
        )
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its siblings lead to, as hex text."""
    return F.aggregate(path, leaf, lambda acc, s: _combined(s["left"], acc, s["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the hex digests of all siblings, level by level, left to right."""
    whole = F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"])))
    return F.sha2(F.array_join(whole, ""), 256)
