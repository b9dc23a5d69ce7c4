import pytest
from pyspark.sql import functions as F

from checks.queries import stored
from tests.conftest import values
from tripmart.operators.layout import co_bucket, hot_keys
from tripmart.plans.warehouse import FACT, trips_at_times

SF = "/root/testdata/sf0.001"


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def made(spark, tmp_path):
    """A third of the rows share one key, another third has none, and some keys meet nothing."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id") % 97).alias("k"), F.lit("same").alias("v")
    )
    rows.write.parquet(str(tmp_path / "f"))
    dimension = spark.range(-5, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"), F.lit("x").alias("v2"))
    dimension = dimension.union(dimension.filter("k = -1")).union(dimension.filter("k = 3").selectExpr("CAST(null AS bigint)", "w", "v2"))
    return spark.read.parquet(str(tmp_path / "f")), dimension


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_of_buckets_is_the_plain_join_without_a_shuffle(spark, tmp_path, how):
    fact, dimension = made(spark, tmp_path)
    laid = co_bucket(fact, dimension, "k", buckets=8)
    found = laid.join(spark, how)
    plain = fact.join(dimension, "k", how)
    assert found.columns == plain.columns
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0
    plan = plan_of(found)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert "Exchange" not in plan_of(laid.join(spark, how, "k = -1"))
    laid.drop(spark)


def test_hot_keys_are_spread_over_buckets(spark, tmp_path):
    fact, dimension = made(spark, tmp_path)
    assert dict(values(hot_keys(fact, "k", 8))) == {-1: 3, None: 3}
    laid = co_bucket(fact, dimension, "k", buckets=8)
    parts = spark.table(laid.fact).groupBy("_bucket_key", "_bucket_part").count().filter("_bucket_key IS NULL OR _bucket_key = -1")
    sizes = [n for _, _, n in values(parts)]
    assert len(sizes) == 6 and max(sizes) < 1000
    assert spark.table(laid.dimension).filter("_bucket_key = -1").count() == 6
    laid.drop(spark)


def test_edges(spark, make, tmp_path):
    fact, dimension = made(spark, tmp_path)
    laid = co_bucket(fact.filter("false"), dimension.withColumnRenamed("k", "id"), "k", "id", buckets=3)
    assert laid.join(spark).columns == ["k", "v", "id", "w", "v2"] and laid.join(spark, "left").count() == 0
    with pytest.raises(ValueError, match="inner and left"):
        laid.join(spark, "full")
    laid.drop(spark)
    laid = co_bucket(fact, dimension.filter("false"), "k", buckets=3)
    assert laid.join(spark).count() == 0 and laid.join(spark, "left").count() == 6000
    laid.drop(spark)
    odd = make([(1, 2, 3, 4)], "rows long, hot long, parts long, `a.b` long")
    laid = co_bucket(odd, odd.select("rows", F.lit(9).alias("n")), "rows", buckets=2)
    assert values(laid.join(spark)) == [(1, 2, 3, 4, 9)]
    laid.drop(spark)
    with pytest.raises(ValueError, match="types"):
        co_bucket(make([(1,)], "k int"), dimension, "k")
    with pytest.raises(ValueError, match="names"):
        co_bucket(make([(1, 1)], "k long, _Bucket_part int"), dimension, "k")


def test_a_condition_on_the_date_dimension_prunes_months(spark):
    built = stored(spark, SF)
    fact, times = built.table(spark, FACT), built.table(spark, "dim_time")
    found = trips_at_times(fact, times, "is_weekend AND pickup_date < '2024-01-15'")
    plan = plan_of(found)
    assert "dynamicpruning" in plan and "PartitionFilters" in plan
    plain = fact.filter("is_weekend AND pickup_date < '2024-01-15'")
    assert found.columns == fact.columns and found.count() == plain.count() > 0
    assert found.exceptAll(plain).count() == 0
