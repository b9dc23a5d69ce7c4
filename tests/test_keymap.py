import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import values
from tripmart.operators import keymap
from tripmart.operators.keymap import compact_key_map, extend_key_map, with_keys
from tripmart.sources.publish import ConflictingLoad, publish, read_published

SCHEMA = "a int, b string, extra int"


def numbers(spark, path):
    return {(r["a"], r["b"]): r["key"] for r in read_published(spark, path).collect()}


def test_old_keys_stay_and_new_ones_continue(spark, make, tmp_path):
    path = str(tmp_path / "m")
    first = [(2, "x", 1), (1, "y", 2), (2, "x", 3), (None, "x", 4), (1, None, 5), (None, None, 6), (None, None, 7)]
    extend_key_map(make(first, SCHEMA), ["a", "b"], path, slices=3)
    old = numbers(spark, path)
    # Nulls come first, as Spark sorts them.
    assert old == {(None, None): 1, (None, "x"): 2, (1, None): 3, (1, "y"): 4, (2, "x"): 5}
    extend_key_map(make([*first, (0, "z", 1), (None, "a", 1), (0, "z", 2)], SCHEMA), ["a", "b"], path)
    assert numbers(spark, path) == {**old, (None, "a"): 6, (0, "z"): 7}
    keyed = values(with_keys(make([*first, (9, "new", 0)], SCHEMA), read_published(spark, path), ["a", "b"]))
    assert sorted(keyed, key=str) == sorted([(old.get((a, b)), a, b, e) for a, b, e in [*first, (9, "new", 0)]], key=str)
    extend_key_map(make(first, SCHEMA), ["a", "b"], path)
    extend_key_map(make([], SCHEMA), ["a", "b"], path)
    compact_key_map(spark, path)
    assert numbers(spark, path) == {**old, (None, "a"): 6, (0, "z"): 7}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=st.lists(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["", "a", "é", None])), max_size=12), min_size=1, max_size=3))
def test_loads_of_any_keys_leave_no_gap(spark, make, tmp_path_factory, loads):
    path = str(tmp_path_factory.mktemp("m") / "map")
    expected = {}
    for load in loads:
        extend_key_map(make([(*r, 0) for r in load], SCHEMA), ["a", "b"], path)
        new = sorted(set(load) - set(expected), key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode()))
        expected |= {r: len(expected) + i for i, r in enumerate(new, start=1)}
        assert numbers(spark, path) == expected


def test_a_key_that_most_rows_share_and_many_new_keys(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(20_000).selectExpr("IF(id % 3 = 0, -1, id) AS `odd.name`", "id AS key2")
    extend_key_map(rows, ["odd.name"], path, out="n")
    found = read_published(spark, path)
    distinct = rows.select("`odd.name`").distinct().count()
    assert found.selectExpr("count(DISTINCT n)", "min(n)", "max(n)").first() == (distinct, 1, distinct)
    assert with_keys(rows, found, ["odd.name"], "n").filter("n IS NULL").count() == 0


def test_of_two_extensions_at_once_one_is_refused(spark, make, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    extend_key_map(make([(1, "x", 0)], SCHEMA), ["a", "b"], path)

    def overtaken(df, where, **how):
        monkeypatch.setattr(keymap, "publish", publish)
        extend_key_map(make([(3, "z", 0)], SCHEMA), ["a", "b"], path)
        return publish(df, where, **how)

    monkeypatch.setattr(keymap, "publish", overtaken)
    with pytest.raises(ConflictingLoad):
        extend_key_map(make([(2, "y", 0)], SCHEMA), ["a", "b"], path)
    assert numbers(spark, path) == {(1, "x"): 1, (3, "z"): 2}
    extend_key_map(make([(2, "y", 0)], SCHEMA), ["a", "b"], path)
    assert numbers(spark, path)[(2, "y")] == 3


def test_clashing_names_are_refused(make, tmp_path, spark):
    with pytest.raises(ValueError):
        extend_key_map(make([(1,)], "key int"), ["key"], str(tmp_path / "m"))
    keys = make([(1, 1)], "a int, key long")
    with pytest.raises(ValueError):
        with_keys(make([(1, 2)], "a int, Key int"), keys, ["a"])
    found = with_keys(make([(1, 2, 3)], "a int, _0 int, _out int"), keys, ["a"])
    assert found.columns == ["key", "a", "_0", "_out"] and values(found) == [(1, 1, 2, 3)]


def test_no_window_and_no_cross_join(spark, make, tmp_path):
    path = str(tmp_path / "m")
    extend_key_map(make([(1, "x", 0)], SCHEMA), ["a", "b"], path)
    keys = read_published(spark, path)
    plan = with_keys(make([(1, "x", 0)], SCHEMA), keys, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoop|Cartesian|Window", plan)
