"""Dense keys that stay the same from build to build, kept in a stored map.

The map holds one row per natural key ever seen: its columns and a 64-bit number. Extending it finds the
natural keys it does not hold yet, numbers them in their own order behind the largest number so far, and
publishes them as the map's next state. Numbers start at 1 and have no gap, whatever fails in between: a load that
fails publishes nothing, and of two that run at once only one is published (``ConflictingLoad``).

A number is a place in range-partitioned slices, each told how many rows lie before it, so no task numbers all
keys. Copies of a natural key are combined in the map tasks; a key that makes up a third of the rows
costs no more than others. Nulls are values: two rows with null in the same columns have the same
key. Without rows, or without new keys, the numbers stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.scans import with_positions
from tripmart.sources.publish import publish, published_version, read_published


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _same(columns: Sequence[str]) -> Column:
    """Equality of ``columns`` with those of the map, which are called ``_0``, ``_1`` and so on behind ``known.``"""
    return reduce(lambda a, b: a & b, [F.col(f"rows.`{c.replace('`', '``')}`").eqNullSafe(F.col(f"known._{i}")) for i, c in enumerate(columns)])


def _known(keys: DataFrame, natural: Sequence[str], out: str) -> DataFrame:
    return keys.select(*[_name(c).alias(f"_{i}") for i, c in enumerate(natural)], _name(out).alias("_out")).alias("known")


def extend_key_map(rows: DataFrame, natural: Sequence[str], path: str, out: str = "key", slices: int | None = None) -> int:
    """Give every natural key of ``rows`` that the map at ``path`` lacks the next numbers, in the order of
    ``natural``; return the map's state. A map that does not exist is begun."""
    if out.lower() in {c.lower() for c in natural}:
        raise ValueError(f"the natural key has a column {out}")
    spark = rows.sparkSession
    version = published_version(spark, path)
    new = rows.select(*[_name(c) for c in natural]).distinct()
    before = F.lit(0).cast("long")
    if version:
        keys = read_published(spark, path, version=version)
        new = new.alias("rows").join(_known(keys, natural, out), _same(natural), "left_anti")
        # One number: the largest so far.
        before = F.lit(keys.agg(F.coalesce(F.max(_name(out)), F.lit(0)).alias("n")).first()["n"]).cast("long")
    placed = with_positions(new, list(map(_name, natural)), out, slices)
    numbered = placed.select(*[_name(c) for c in natural], (_name(out) + before + 1).alias(out))
    return publish(numbered, path, replace="nothing", since=version)


def compact_key_map(spark: SparkSession, path: str) -> int:
    """Publish the map again as one load, after many small ones."""
    version = published_version(spark, path)
    return publish(read_published(spark, path, version=version), path, replace="table", since=version)


def with_keys(rows: DataFrame, keys: DataFrame, natural: Sequence[str], out: str = "key") -> DataFrame:
    """Add the number of each row's natural key as first column; null where the map does not hold it.

    No side is forced into memory: a small map is broadcast by its size, otherwise both are shuffled by the
    natural key, and adaptive execution splits a hot one.
    """
    if out.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"the rows have a column {out}")
    joined = rows.alias("rows").join(_known(keys, natural, out), _same(natural), "left")
    return joined.select(F.col("known._out").alias(out), *[F.col(f"rows.`{c.replace('`', '``')}`") for c in rows.columns])
