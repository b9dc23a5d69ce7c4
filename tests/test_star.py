import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.functions import row_count
from tripmart.operators import star


def test_keys_are_unique_and_hashes_are_stable(make):
    df = make([(i, None if i % 2 else "x") for i in range(50)], "a int, b string").repartition(7)
    for kind in ("sequence", "hash64", "hash128"):
        keyed = star.surrogate_key(df, "k", kind)
        assert keyed.columns == ["k", "a", "b"]
        assert keyed.select("k").distinct().count() == 50
    for kind in ("hash64", "hash128"):
        once = dict(values(star.surrogate_key(df, "k", kind), "a", "k"))
        again = dict(values(star.surrogate_key(df.repartition(3), "k", kind), "a", "k"))
        assert once == again
    with pytest.raises(ValueError):
        star.surrogate_key(df, "k", "other")


def test_hash128_tells_nulls_and_columns_apart(make):
    df = make([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert star.surrogate_key(df, "k", "hash128").select("k").distinct().count() == 3


def test_dimensions(make):
    df = make([(1, 2), (2, 3), (1, 2), (None, 3)], "pu int, do int")
    assert values(star.dimension(df, ["pu", "do"], ["pu", "do"])) == [(None, 3), (1, 2), (2, 3)]
    assert values(star.role_dimension(df, ["pu", "do"], "id")) == [(None,), (1,), (2,), (3,)]


def test_union_all_is_positional_and_keeps_copies(make):
    a, b = make([(1, "x")], "i int, s string"), make([(1, "x"), (2, "y")], "j int, t string")
    out = star.union_all([a, b])
    assert out.columns == ["i", "s"] and out.count() == 3


def test_star_join_inner_left_and_unmatched(make):
    fact = make([(1, 10.0), (1, 5.0), (2, 1.0), (None, 7.0)], "k int, v double")
    dim = make([(1, "one")], "id int, name string")
    condition = fact["k"] == dim["id"]
    assert star.star_join(fact, {"d": (dim, condition)}).count() == 2
    left = star.star_join(fact, {"d": (dim, condition)}, "left")
    assert sorted(values(left, "v", "name")) == [(1.0, None), (5.0, "one"), (7.0, None), (10.0, "one")]


def test_star_join_without_broadcast_gives_the_same(spark, make):
    fact = make([(i % 5, float(i)) for i in range(100)], "k int, v double")
    dim = make([(i, f"n{i}") for i in range(4)], "id int, name string")
    frame = star.aggregate_by_key(fact, ["k"], {"n": row_count(), "s": F.sum("v")})
    joined = star.star_join(frame, {"d": (dim, frame["k"] == dim["id"])})
    small = sorted(values(joined, "name", "n", "s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = star.star_join(frame, {"d": (dim, frame["k"] == dim["id"])})
        assert "SortMergeJoin" in again._jdf.queryExecution().executedPlan().toString()
        assert sorted(values(again, "name", "n", "s")) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
