"""Star-schema building blocks: keys, dimensions, star joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def surrogate_key(
    df: DataFrame, out: str, kind: str = "sequence", columns: Sequence[str] | None = None
) -> DataFrame:
    """Add a key as first column.

    ``sequence``  bigint, always unique, no shuffle, but not the same from run to run.
    ``hash64``    bigint from the row's values: the same on every run. Two different rows
                  may share it once there are billions of them.
    ``hash128``   hexadecimal text from the row's values: the same on every run, and
                  collisions stay out of reach at any table size.
    """
    over = list(columns or df.columns)
    if kind == "sequence":
        key = F.monotonically_increasing_id()
    elif kind == "hash64":
        key = F.xxhash64(*over)
    elif kind == "hash128":
        key = F.md5(F.to_json(F.struct(*over), {"ignoreNullFields": "false"}))
    else:
        raise ValueError(f"unknown key kind: {kind}")
    return df.select(key.alias(out), *df.columns)


def dimension(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Distinct combinations of the columns, sorted when asked."""
    rows = df.select(*columns).distinct()
    return rows.orderBy(*order_by) if order_by else rows


def role_dimension(df: DataFrame, roles: Sequence[str], out: str, ordered: bool = True) -> DataFrame:
    """One dimension for several columns that hold the same kind of key.

    The columns are exploded from one scan instead of being read once each and united.
    """
    keys = df.select(F.explode(F.array(*roles)).alias(out)).distinct()
    return keys.orderBy(out) if ordered else keys


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by position; names and number of columns come from the first frame."""
    head, *rest = frames
    for frame in rest:
        head = head.union(frame)
    return head


def star_join(
    fact: DataFrame, dimensions: Mapping[str, tuple[DataFrame, Column]], how: str = "inner"
) -> DataFrame:
    """Join a fact to its dimensions, given as name -> (frame, condition).

    No side is forced into memory. Spark broadcasts a dimension when its size is known to be
    below ``spark.sql.autoBroadcastJoinThreshold``, at planning or from the measured size at
    run time, and otherwise sorts and merges, splitting skewed keys.
    """
    for frame, condition in dimensions.values():
        fact = fact.join(frame, condition, how)
    return fact


def aggregate_by_key(fact: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Pre-aggregate a fact on its foreign keys, so that a join meets each key once.

    A key that holds a third of all rows is combined on the map side and reaches the join
    as one row.
    """
    return fact.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
