"""A fact and a dimension stored so that joining them shuffles neither.

Both are written in the same number of buckets of the key, so the rows of a key lie in files of one number and a
join reads them side by side. A bucket is read by one task, which a hot key would fill: a key with more than a
bucket's share of the fact's rows is therefore cut into parts of about that share, and its dimension rows are
stored once for each part. Every fact row is in one part, so the join gives each pair once. There are fewer hot
keys than buckets, whatever the data, and no key has more parts than there are buckets.

The fact should be read from files without a shuffle of its own: a row's part depends on its place in the
input, which is then the same when a task is repeated. Null keys meet nothing; a left join keeps their
rows, and many of them are cut into parts too. Empty tables give empty buckets. Column names of the inputs are
never met by those used inside.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.workspace import workspace


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def hot_keys(fact: DataFrame, key: str, buckets: int) -> DataFrame:
    """``hot_key, parts``: keys with more than 1 / ``buckets`` of the rows, fewer than ``buckets`` of them, and into
    how many parts they are to be cut. Keys are counted in the map tasks."""
    counted = fact.groupBy(_name(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    total = fact.agg(F.count(F.lit(1)).alias("total"))
    return (
        counted.join(F.broadcast(total), F.col("n") * buckets > F.col("total"))  # one row
        .select("hot_key", F.ceil(F.col("n") * buckets / F.col("total")).cast("int").alias("parts"))
    )


@dataclass(frozen=True)
class CoBucketed:
    """Names of two stored tables with the same buckets, and the columns they were made of."""

    fact: str
    dimension: str
    fact_columns: tuple[str, ...]
    dimension_columns: tuple[str, ...]
    buckets: int

    def join(self, spark: SparkSession, how: str = "inner", where: Column | str | None = None) -> DataFrame:
        """Fact rows with their dimension rows, without a shuffle. ``where`` is a condition on the fact.

        The key comes once, from the fact. Other columns keep their names; one that both sides have is there
        twice, as after any join.
        """
        if how not in ("inner", "left"):
            raise ValueError("only inner and left joins keep the parts of a key apart")
        fact, dimension = (spark.table(t).alias(a) for t, a in ((self.fact, "f"), (self.dimension, "d")))
        if where is not None:
            fact = fact.filter(where)
        both = (F.col("f._bucket_key") == F.col("d._bucket_key")) & (F.col("f._bucket_part") == F.col("d._bucket_part"))
        joined = fact.join(dimension.hint("merge"), both, how)
        sides = (("f", self.fact_columns), ("d", self.dimension_columns))
        return joined.select(*[F.col(f"{a}.`{c.replace('`', '``')}`") for a, columns in sides for c in columns])

    def drop(self, spark: SparkSession) -> None:
        """Forget both tables; their files stay in the folder of intermediate tables."""
        for name in (self.fact, self.dimension):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _write(df: DataFrame, kind: str, buckets: int) -> str:
    spark, name = df.sparkSession, f"{kind}_{uuid.uuid4().hex}"
    keys = ["_bucket_key", "_bucket_part"]
    # One task per bucket, so that a bucket is one file.
    gathered = df.repartition(buckets, *keys)
    gathered.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", workspace(spark, name)).saveAsTable(name)
    return name


def co_bucket(
    fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str | None = None, buckets: int | None = None
) -> CoBucketed:
    """Store both tables in buckets of the key. ``buckets`` is by default the session's number of shuffle
    partitions; a bucket should fit a task. Two shuffles, once for any number of joins."""
    spark, other = fact.sparkSession, dimension_key or key
    for side in (fact, dimension):
        clash = {c.lower() for c in side.columns} & {"_bucket_key", "_bucket_part"}
        if clash:
            raise ValueError(f"columns have names of the layout: {', '.join(sorted(clash))}")
    kind = fact.select(_name(key)).schema[0].dataType
    if kind != dimension.select(_name(other)).schema[0].dataType:
        raise ValueError("the keys have different types, so equal ones would lie in different buckets")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(fact, key, count)
    path = workspace(spark, "hot-keys")
    hot.write.parquet(path)
    # Fewer rows than buckets.
    hot = F.broadcast(spark.read.schema(hot.schema).parquet(path)).alias("hot")
    place = F.xxhash64(F.monotonically_increasing_id())
    part = F.when(F.col("hot.parts").isNull(), 0).otherwise(F.pmod(F.col("_place"), F.col("hot.parts"))).cast("int")
    parts = F.coalesce(F.sequence(F.lit(0), F.col("hot.parts") - 1), F.array(F.lit(0)))
    named = [[F.col(f"rows.`{c.replace('`', '``')}`") for c in side.columns] for side in (fact, dimension)]
    placed = fact.select(_name(key).alias("_bucket_key"), place.alias("_place"), F.struct(*map(_name, fact.columns)).alias("rows"))
    cut = placed.join(hot, F.col("_bucket_key").eqNullSafe(F.col("hot.hot_key")), "left")
    copied = dimension.select(_name(other).alias("_bucket_key"), F.struct(*map(_name, dimension.columns)).alias("rows"))
    copied = copied.filter(F.col("_bucket_key").isNotNull()).join(hot, F.col("_bucket_key") == F.col("hot.hot_key"), "left")
    kept = tuple(c for c in dimension.columns if not (dimension_key is None and c == key))
    return CoBucketed(
        _write(cut.select("_bucket_key", part.alias("_bucket_part"), *named[0]), "fact", count),
        _write(copied.select("_bucket_key", F.explode(parts).alias("_bucket_part"), *named[1]), "dimension", count),
        tuple(fact.columns),
        kept,
        count,
    )
