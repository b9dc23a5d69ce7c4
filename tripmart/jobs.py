"""Jobs to submit: ``land``, ``profile``, ``build`` and ``report``.

    spark-submit tripmart/jobs.py build --raw /data/raw --out /data/warehouse
    python -m tripmart.jobs report --warehouse /data/warehouse --out /data/reports

The session comes from the submitter; nothing here sets a master or memory.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators import profile
from tripmart.operators.validation import (
    counted_checks,
    counted_key_nulls,
    counted_reconciliation,
    require_rows,
)
from tripmart.plans import charts, reports
from tripmart.plans.trip_rules import DISTRIBUTION_COLUMNS, CleaningRules
from tripmart.plans.warehouse import DIMENSIONS, FACT, Warehouse, build_warehouse_counted
from tripmart.sources import landing
from tripmart.sources.readers import read_available, read_first_available
from tripmart.sources.sinks import write_csv, write_table


def land(
    spark: SparkSession,
    source: str,
    base: str,
    dataset: str,
    ts: str = "tpep_pickup_datetime",
    min_rows: int = landing.MIN_ROWS,
) -> dict[str, DataFrame]:
    """Check landed Parquet files, then lay their rows out by year and month.

    Files are refused as a whole if one of them is empty; an unexpected extension or too few
    rows only shows in the returned tables.
    """
    sizes = landing.landing_manifest(spark, source, checksum=False)
    empty = sizes.filter(~F.col("non_empty")).select("file_name").take(1)
    if empty:
        raise ValueError(f"empty file: {empty[0]['file_name']}")
    rows = spark.read.parquet(source)
    landing.land_by_month(rows, ts, base, dataset)
    return {
        "manifest": landing.landing_manifest(spark, source),
        "rows_per_file": landing.rows_per_file(rows, min_rows),
    }


def profile_tables(
    raw: DataFrame, order_by: str | None = None, rules: profile.QualityRules = profile.QualityRules()
) -> dict[str, DataFrame]:
    """Every table of the profile report."""
    shown = [c for c in DISTRIBUTION_COLUMNS if c in raw.columns]
    tables = {
        "schema": profile.schema_table(raw, order_by),
        "missing": profile.missing_table(raw),
        "missing_chart": profile.missing_chart(raw),
        "numeric_summary": profile.numeric_summary(raw),
        "issues": profile.quality_issues(raw, rules),
    }
    if shown:
        tables["histograms"] = profile.histograms(raw, shown)
        tables["densities"] = profile.densities(raw, shown)
    return tables


def build(
    spark: SparkSession, raw: DataFrame, out: str, rules: CleaningRules = CleaningRules()
) -> dict[str, DataFrame]:
    """Build the warehouse, refuse it if a table has no rows, and return the checks.

    All counts come with the writes: raw trips are read once, stored tables not at all.
    """
    built, counts = build_warehouse_counted(spark, raw, out, rules)
    summary = counted_checks(spark, counts.tables, built.paths)
    require_rows(summary)
    raw_rows = counts.load["raw_rows"]
    load = [("raw", raw_rows, len(raw.columns), ",".join(raw.columns))]
    return {
        "load": spark.createDataFrame(load, "table_name string, row_count long, column_count int, column_names string"),
        "tables": summary,
        "key_nulls": counted_key_nulls(spark, counts.tables),
        "removed": spark.createDataFrame(list(counts.removed().items()), "reason string, removed_rows long"),
        "reconciliation": counted_reconciliation(spark, raw_rows, counts.tables[FACT]["row_count"]),
    }


def report_tables(fact: DataFrame) -> dict[str, DataFrame]:
    """The eight reports and the datasets of their charts."""
    return {
        **reports.run_reports(fact),
        "fare_alerts": reports.fare_alerts(fact),
        "chart_hour_weekday_grid": charts.hour_weekday_grid(fact),
        "chart_top_zones": charts.top_zones(fact),
        "chart_bucket_volume": charts.bucket_volume(fact),
        "chart_anomaly_volume": charts.anomaly_volume(fact),
        "chart_fare_trend_line": charts.fare_trend_line(fact),
        "chart_vendor_grid": charts.vendor_grid(fact),
        "chart_payment_tips": charts.display_sorted(
            reports.payment_tips(fact), "avg_tip_pct", "payment_label"
        ),
    }


def open_warehouse(spark: SparkSession, base: str) -> Warehouse:
    """A stored warehouse; dimensions that are missing are left out."""
    root = base.rstrip("/")
    found, _ = read_available(spark, {n: f"{root}/{n}" for n in DIMENSIONS})
    return Warehouse({n: f"{root}/{n}" for n in (FACT, *found)})


def write_reports(tables: dict[str, DataFrame], out: str) -> dict[str, str]:
    return {name: write_csv(df, f"{out.rstrip('/')}/{name}") for name, df in tables.items()}


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmart")
    commands = parser.add_subparsers(dest="command", required=True)
    command = commands.add_parser("land", help="check landed files and lay them out by month")
    command.add_argument("--source", required=True)
    command.add_argument("--base", required=True)
    command.add_argument("--dataset", required=True)
    command.add_argument("--min-rows", type=int, default=landing.MIN_ROWS)
    command = commands.add_parser("profile", help="profile raw trips")
    command.add_argument("--raw", nargs="+", required=True, help="the first path that exists is read")
    command.add_argument("--order-by", help="column that orders the sample values")
    command.add_argument("--out", required=True)
    command = commands.add_parser("build", help="clean raw trips and write the star schema")
    command.add_argument("--raw", nargs="+", required=True, help="the first path that exists is read")
    command.add_argument("--quantiles", choices=["exact", "approx"], default="exact")
    command.add_argument("--out", required=True)
    command = commands.add_parser("report", help="write the reports of a stored warehouse")
    command.add_argument("--warehouse", required=True)
    command.add_argument("--where", help="condition on the partition columns, such as pickup_year = 2023")
    command.add_argument("--audit-above", type=float, default=3.0, help="dispute percentage to audit from")
    command.add_argument("--out", required=True)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"tripmart-{args.command}").getOrCreate()
    if args.command == "land":
        for table in land(spark, args.source, args.base, args.dataset, min_rows=args.min_rows).values():
            table.show(truncate=False)
    elif args.command == "profile":
        raw = read_first_available(spark, args.raw)
        write_reports(profile_tables(raw, args.order_by), args.out)
    elif args.command == "build":
        raw = read_first_available(spark, args.raw)
        for table in build(spark, raw, args.out, CleaningRules(quantile_method=args.quantiles)).values():
            table.show(truncate=False)
    else:
        stored = open_warehouse(spark, args.warehouse)
        stored.register(spark)
        fact = stored.table(spark, FACT, args.where)
        write_reports(report_tables(fact), args.out)
        segments = reports.segment_anomalies(fact).filter(F.col("dispute_pct") > args.audit_above)
        write_table(segments, f"{args.out.rstrip('/')}/audit", ["time_of_day"])


if __name__ == "__main__":
    main()
