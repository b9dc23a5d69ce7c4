import gzip
import hashlib
import os
import pathlib
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import values
from tripmart.operators import validation
from tripmart.sources import landing, readers, sinks
from tripmart.sources.workspace import workspace


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    (folder / "a.csv").write_text("h\n1\n2\n")
    (folder / "deep" / "b.JSON").write_text('{"x": 1}\n')
    (folder / "empty.csv").write_text("")
    (folder / "odd.xyz").write_bytes(bytes(range(256)) * 40)
    (folder / "with space+%41.csv").write_text("x")
    (folder / "c.csv.gz").write_bytes(gzip.compress(b"h\n1\n"))
    return folder


@pytest.mark.parametrize("opened_by_caller", [False, True])
def test_manifest_matches_direct_hashing(spark, landed, opened_by_caller):
    def local(path):
        return open(path.removeprefix("file://"), "rb")

    out = landing.landing_manifest(spark, str(landed), open_stream=local if opened_by_caller else None)
    got = {r["file_name"]: r for r in out.collect()}
    files = [p for p in landed.rglob("*") if p.is_file()]
    assert sorted(got) == sorted(p.name for p in files)
    for path in files:
        row, data = got[path.name], path.read_bytes()
        assert row["md5"] == hashlib.md5(data).hexdigest()
        assert row["size_bytes"] == len(data)
        assert row["non_empty"] == bool(data)
    assert {n: r["extension"] for n, r in got.items()} == {
        "a.csv": ".csv", "b.JSON": ".json", "empty.csv": ".csv", "odd.xyz": ".xyz", "c.csv.gz": ".gz",
        "with space+%41.csv": ".csv",
    }
    assert [n for n, r in got.items() if not r["extension_ok"]] == ["odd.xyz"]


def test_task_function_needs_no_package_on_the_executors(tmp_path):
    data = cloudpickle.dumps(landing._stream_digests(landing._streams()))
    code = "import pickle, sys; pickle.loads(sys.stdin.buffer.read())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], input=data, cwd=tmp_path, env=env, check=True)


def test_manifest_refuses_unknown_stores_before_reading(spark):
    with pytest.raises(ValueError, match="open_stream"):
        landing.landing_manifest(spark, "dbfs:/nowhere")
    assert landing.SCHEMES["s3a"] == "s3"


def test_manifest_without_checksum(spark, landed):
    out = landing.landing_manifest(spark, str(landed), checksum=False)
    sizes = {r["file_name"]: r["size_bytes"] for r in out.collect()}
    assert sizes == {p.name: p.stat().st_size for p in landed.rglob("*") if p.is_file()}
    assert out.filter("md5 IS NOT NULL").count() == 0
    assert [n for (n,) in values(out.filter("NOT non_empty"), "file_name")] == ["empty.csv"]


def test_rows_per_text_file_without_header(spark, landed):
    lines = spark.read.option("pathGlobFilter", "*.csv").text(str(landed))
    out = landing.rows_per_file(lines, min_rows=2, header_lines=1)
    assert sorted(values(out, "file_name", "row_count", "enough_rows")) == [
        ("a.csv", 2, True),
        ("empty.csv", 0, False),
        ("with space+%41.csv", 0, False),
    ]


def test_rows_per_parquet_file_reads_no_column(spark, make, tmp_path):
    path = str(tmp_path / "t")
    make([(i,) for i in range(10)], "a int").repartition(3).write.parquet(path)
    out = landing.rows_per_file(spark.read.parquet(path), min_rows=4)
    assert sum(n for n, in values(out, "row_count")) == 10
    assert "ReadSchema: struct<>" in out._jdf.queryExecution().executedPlan().toString()


def test_parquet_file_without_rows_counts_zero(spark, make, tmp_path):
    make([(i,) for i in range(5)], "a int").coalesce(1).write.parquet(str(tmp_path / "t"))
    make([], "a int").coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    out = landing.rows_per_file(spark.read.parquet(str(tmp_path / "t")), min_rows=5)
    assert sorted(values(out, "row_count", "enough_rows")) == [(0, False), (5, True)]


def test_existing_folder_without_table_is_raised(spark, make, tmp_path):
    good = sinks.write_table(make([(1,)], "a int"), str(tmp_path / "good"))
    (tmp_path / "bare").mkdir()
    with pytest.raises(AnalysisException):
        readers.read_first_available(spark, [str(tmp_path / "bare"), good])
    with pytest.raises(AnalysisException):
        readers.read_available(spark, {"bare": str(tmp_path / "bare")})


def test_landing_keeps_other_months(spark, make, tmp_path):
    dated = lambda *days: make([(d,) for d in days], "d string").select(F.to_timestamp("d").alias("t"))
    for days in (["2023-01-05", "2023-01-06"], ["2023-02-01"], ["2023-01-09"]):
        path = landing.land_by_month(dated(*days), "t", str(tmp_path), "trips")
    assert sorted(values(readers.read_table(spark, path).selectExpr("CAST(t AS DATE) || ''"))) == [
        ("2023-01-09",), ("2023-02-01",)
    ]


def test_fallback_moves_on_only_for_missing_paths(spark, make, tmp_path):
    good = sinks.write_table(make([(1, "x")], "a int, b string"), str(tmp_path / "good"))
    df = readers.read_first_available(spark, [str(tmp_path / "none"), good])
    assert values(readers.load_summary(df, "t")) == [("t", 1, 2, "a,b")]
    with pytest.raises(AnalysisException):
        readers.read_first_available(spark, [str(tmp_path / "none"), str(tmp_path / "none2")])
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception) as error:
        readers.read_first_available(spark, [str(broken), good]).collect()
    assert not isinstance(error.value, AnalysisException)


def test_optional_tables_and_views(spark, make, tmp_path):
    good = sinks.write_table(make([(1,)], "a int"), str(tmp_path / "g"))
    found, missing = readers.read_available(spark, {"g": good, "n": str(tmp_path / "n")})
    assert list(found) == ["g"] and missing == ["n"]
    readers.register_views({"g_view": found["g"]})
    assert values(spark.sql("SELECT a FROM g_view")) == [(1,)]


def test_landing_layout_and_partition_filter(spark, make, tmp_path):
    df = make([("2022-12-31",), ("2023-01-01",), ("2023-01-02",)], "d string").select(F.to_timestamp("d").alias("t"))
    path = landing.land_by_month(df, "t", str(tmp_path), "trips")
    names = sorted(str(p.relative_to(tmp_path)) for p in pathlib.Path(path).glob("year=*/month=*"))
    assert names == ["trips/year=2022/month=12", "trips/year=2023/month=1"]
    january = readers.read_table(spark, path, "year = 2023 AND month = 1")
    assert january.count() == 2
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "month" in plan


def test_partitioned_overwrite_replaces_everything(spark, make, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(make([(1, "a"), (2, "b")], "i int, p string"), path, ["p"])
    sinks.write_table(make([(3, "c")], "i int, p string"), path, ["p"])
    assert values(readers.read_table(spark, path)) == [(3, "c")]
    assert list(pathlib.Path(path).glob("p=c/*.snappy.parquet"))


def test_named_tables_fail_on_the_first_error(make, tmp_path):
    blocked = tmp_path / "base"
    blocked.write_text("a file, not a folder")
    with pytest.raises(Exception):
        sinks.write_tables({"a": make([(1,)], "a int")}, str(blocked))


def test_csv_has_a_header_and_no_index(spark, make, tmp_path):
    df = make([("x", 1.5), (None, 2.0)], "a string, b double").orderBy("b")
    path = sinks.write_csv(df, str(tmp_path / "r"), single_file=True)
    (part,) = pathlib.Path(path).glob("part-*.csv")
    assert part.read_text().splitlines() == ["a,b", "x,1.5", ",2.0"]


def test_audit_partition(spark, make, tmp_path):
    df = make([("Night", 5.0), ("Night", 1.0), ("Morning", 9.0)], "time_of_day string, pct double")
    path = sinks.write_audit(df, F.col("pct") > 3, str(tmp_path / "audit"), ["time_of_day"])
    assert sorted(values(spark.read.parquet(path), "time_of_day", "pct")) == [("Morning", 9.0), ("Night", 5.0)]


def test_workspace_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "t"), workspace(spark, "t")
    assert first.startswith(base) and first != second


def test_table_checks(make):
    good = make([(1, "a")], "k int, v string")
    nulls = make([(None, "a"), (1, None)], "k int, v string")
    empty = make([], "k int, v string")
    keys = {"good": ["k"], "nulls": ["k", "v"], "empty": ["k"]}
    summary = validation.validate_tables({"good": good, "nulls": nulls, "empty": empty}, keys, {"good": "/g"})
    assert values(summary) == [
        ("good", 1, 0, "OK", "/g"),
        ("nulls", 2, 2, "WARN", None),
        ("empty", 0, 0, "FAIL", None),
    ]
    with pytest.raises(ValueError, match="empty"):
        validation.require_rows(summary)
    validation.require_rows(summary.filter("table_name <> 'empty'"))
    assert values(validation.key_nulls(nulls, "nulls", ["k", "v"])) == [("nulls", "k", 1), ("nulls", "v", 1)]


def test_reconciliation(make):
    raw, kept = make([(i,) for i in range(8)], "a int"), make([(i,) for i in range(7)], "a int")
    assert values(validation.reconcile(raw, kept)) == [(8, 7, 1, 12.5)]
    none = make([], "a int")
    assert values(validation.reconcile(none, none)) == [(0, 0, 0, 0.0)]


def test_verdict_per_landed_file(spark, tmp_path):
    folder = tmp_path / "landed in"
    spark.range(30).coalesce(1).write.parquet(str(folder / "whole"))
    spark.range(30).filter("id < 0").coalesce(1).write.parquet(str(folder / "no rows"))
    for kind in ("whole", "no rows"):
        (part,) = (folder / kind).glob("part-*.parquet")
        part.rename(folder / f"{kind}.parquet")
    sound = (folder / "whole.parquet").read_bytes()
    (folder / "cut.parquet").write_bytes(sound[: len(sound) // 2])
    (folder / "noise.parquet").write_bytes(b"PAR1" + bytes(40) + b"\x10\x00\x00\x00PAR1")
    (folder / "nothing.parquet").write_bytes(b"")
    (folder / "lines.csv").write_text("a\n1\n")
    (folder / "x.exe").write_text("a")
    found = {
        r.file_name: r for r in landing.file_verdicts(spark, str(folder), min_rows=10, glob="*.*").collect()
        if not r.file_name.startswith(("_", "."))
    }
    assert set(found) == {"whole.parquet", "no rows.parquet", "cut.parquet", "noise.parquet", "nothing.parquet", "lines.csv", "x.exe"}
    assert {n for n, r in found.items() if r.accepted} == {"whole.parquet", "lines.csv"}
    assert (found["whole.parquet"].row_count, found["no rows.parquet"].row_count) == (30, 0)
    assert found["no rows.parquet"].enough_rows is False and found["lines.csv"].enough_rows is None
    for broken in ("cut.parquet", "noise.parquet", "nothing.parquet"):
        assert found[broken].row_count is None and found[broken].fault
    assert found["whole.parquet"].fault is None and found["whole.parquet"].md5
    assert landing.file_verdicts(spark, str(folder), checksum=False, glob="*.csv").first().md5 is None


def test_footers_are_spread_over_tasks(spark, tmp_path):
    spark.range(400).repartition(40).write.parquet(str(tmp_path / "t"))
    found = landing.footer_rows(spark, str(tmp_path / "t"), "*.parquet")
    assert found.agg(F.sum("row_count")).first()[0] == 400
    tasks = found.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" not in plan
