import pathlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.sources import publish as p
from tripmart.sources.publish import ConflictingLoad, publish, published_version, read_published

SCHEMA = "y int, m string, v int"
FIRST = [(2023, "1", 10), (2023, "2", 20), (2024, "1", 30)]


def rows(spark, path, **how):
    return sorted(map(tuple, values(read_published(spark, path, **how).select("y", "m", "v"))), key=str)


@pytest.fixture
def landed(make, tmp_path):
    path = str(tmp_path / "t")
    assert publish(make(FIRST, SCHEMA), path, ["y", "m"]) == 1
    return path


def test_partitions_are_replaced_and_others_stay(spark, make, landed):
    assert rows(spark, landed) == FIRST
    assert publish(make([(2023, "2", 21), (2023, "2", 22), (2025, "1", 40)], SCHEMA), landed, ["y", "m"]) == 2
    assert rows(spark, landed) == [(2023, "1", 10), (2023, "2", 21), (2023, "2", 22), (2024, "1", 30), (2025, "1", 40)]
    assert rows(spark, landed, version=1) == FIRST
    assert publish(make([(1, "x", 1)], SCHEMA), landed, ["y", "m"], replace="table") == 3
    assert rows(spark, landed) == [(1, "x", 1)]
    assert publish(make([(1, "x", 1)], SCHEMA), landed, ["y", "m"], replace="nothing") == 4
    assert rows(spark, landed) == [(1, "x", 1), (1, "x", 1)]


def test_a_load_that_fails_half_way_shows_nothing(spark, landed):
    numbers = spark.range(0, 1000, 1, 8)
    bad = numbers.select(
        F.lit(2023).alias("y"), F.lit("1").alias("m"),
        F.when(F.col("id") == 990, F.raise_error("broken row").cast("int")).otherwise(F.col("id").cast("int")).alias("v"),
    )
    with pytest.raises(Exception, match="broken row"):
        publish(bad, landed, ["y", "m"], gather=False)
    assert rows(spark, landed) == FIRST and published_version(spark, landed) == 1


def test_a_load_that_dies_before_its_commit_shows_nothing(spark, make, landed, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(p._Files, "create", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            publish(make([(2023, "1", 99)], SCHEMA), landed, ["y", "m"])
    assert rows(spark, landed) == FIRST
    assert publish(make([(2023, "1", 99)], SCHEMA), landed, ["y", "m"]) == 2
    assert rows(spark, landed)[0] == (2023, "1", 99)


def test_a_manifest_that_was_cut_off_is_passed_over(spark, make, landed):
    (pathlib.Path(landed) / "manifests" / "00000002").write_text('{"columns"')
    assert rows(spark, landed) == FIRST
    assert publish(make([(2024, "1", 31)], SCHEMA), landed, ["y", "m"]) == 3
    assert rows(spark, landed)[-1] == (2024, "1", 31)


def test_of_two_loads_from_one_state_the_second_fails(spark, make, landed, monkeypatch):
    late = make([(2023, "1", 12)], SCHEMA)
    real = p._Files.create

    def overtaken(self, name, text):
        monkeypatch.setattr(p._Files, "create", real)
        publish(make([(2023, "1", 11)], SCHEMA), landed, ["y", "m"])
        real(self, name, text)

    monkeypatch.setattr(p._Files, "create", overtaken)
    with pytest.raises(ConflictingLoad):
        publish(late, landed, ["y", "m"])
    assert rows(spark, landed)[0] == (2023, "1", 11)
    with pytest.raises(ConflictingLoad):
        publish(late, landed, ["y", "m"], since=1)
    assert publish(late, landed, ["y", "m"], since=2) == 3


def test_edges(spark, make, landed, tmp_path):
    odd = [(None, "a/b c=%", 1), (2023, None, 2), (2023, "é", 3)]
    path = str(tmp_path / "odd dir")
    publish(make(odd, SCHEMA), path, ["y", "m"])
    assert rows(spark, path) == sorted(odd, key=str)
    publish(make([(2023, "é", 4)], SCHEMA), path, ["y", "m"])
    assert (2023, "é", 3) not in rows(spark, path) and len(rows(spark, path)) == 3
    publish(make([], SCHEMA), landed, ["y", "m"])
    assert rows(spark, landed) == FIRST
    publish(make([], SCHEMA), landed, ["y", "m"], replace="table")
    assert rows(spark, landed) == []
    plain = str(tmp_path / "plain")
    publish(make(FIRST, SCHEMA), plain)
    publish(make(FIRST[:1], SCHEMA), plain)
    assert rows(spark, plain) == FIRST[:1]
    with pytest.raises(ValueError, match="load"):
        publish(make([(1,)], "Load int"), plain)
    with pytest.raises(ValueError, match="columns differ"):
        publish(make([(1,)], "z int"), plain)
    with pytest.raises(FileNotFoundError):
        read_published(spark, plain, version=9)
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def test_conditions_on_partitions_leave_out_folders(spark, landed):
    found = read_published(spark, landed, where="y = 2024")
    found.collect()
    assert "PartitionFilters: [isnotnull(y" in found._jdf.queryExecution().executedPlan().toString()
    assert len(found.inputFiles()) == 3 and rows(spark, landed, where="y = 2024") == [(2024, "1", 30)]
