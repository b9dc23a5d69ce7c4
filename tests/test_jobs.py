import csv
import pathlib

import pytest

from checks.trip_source import raw_trips
from tripmart import jobs
from tripmart.plans.reports import REPORTS
from tripmart.sources.sinks import write_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips")
    return write_table(raw_trips(spark, SF), path)


def csv_rows(folder):
    rows = []
    for part in sorted(pathlib.Path(folder).glob("part-*.csv")):
        with open(part) as f:
            rows += list(csv.DictReader(f))
    return rows


def test_build_then_report(spark, raw_path, tmp_path, capfd):
    out, results = tmp_path / "wh", tmp_path / "reports"
    jobs.main(["build", "--raw", str(tmp_path / "absent"), raw_path, "--out", str(out)])
    assert {p.name for p in out.iterdir()} == {
        "fact_trips", "dim_time", "dim_location", "dim_payment", "dim_vendor"
    }
    jobs.main(["report", "--warehouse", str(out), "--out", str(results), "--where", "pickup_year = 2024"])
    written = {p.name for p in results.iterdir()}
    assert set(REPORTS) | {"audit", "fare_alerts", "chart_vendor_grid"} <= written
    trend = csv_rows(results / "revenue_trend")
    assert len(trend) == 30 and trend[0]["pickup_date"] == "2024-01-01"
    audit = spark.read.parquet(str(results / "audit"))
    assert {r["payment_label"] for r in audit.collect()} == {"Dispute", "No Charge"}


def test_profile(raw_path, tmp_path):
    jobs.main(["profile", "--raw", raw_path, "--order-by", "tpep_pickup_datetime", "--out", str(tmp_path / "p")])
    assert len(csv_rows(tmp_path / "p" / "schema")) == 19
    assert len(csv_rows(tmp_path / "p" / "histograms")) == 250


def test_land(spark, raw_path, tmp_path):
    base = tmp_path / "base"
    jobs.main(["land", "--source", raw_path, "--base", str(base), "--dataset", "trips"])
    assert (base / "trips" / "year=2024" / "month=1").is_dir()
    landed = spark.read.parquet(str(base / "trips"))
    assert landed.count() == spark.read.parquet(raw_path).count()


def test_land_refuses_empty_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x.parquet").write_bytes(b"")
    with pytest.raises(ValueError, match="x.parquet"):
        jobs.land(spark, str(folder), str(tmp_path / "b"), "trips")


def test_build_refuses_an_empty_result(spark, raw_path, tmp_path):
    nothing = spark.read.parquet(raw_path).filter("trip_distance > 1e9")
    with pytest.raises(ValueError, match="fact_trips"):
        jobs.build(spark, nothing, str(tmp_path / "wh"))
