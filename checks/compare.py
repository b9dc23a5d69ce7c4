"""Run registered queries and their SQL side by side and compare all rows.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmart-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def plain(value):
    """One spelling per value: integers and floats that mean the same compare equal."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null" if value is None else "nan"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df: DataFrame, con, sql: str) -> tuple[bool, str]:
    left_columns, left = df.columns, [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    right_columns, right = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(left_columns) != sorted(right_columns):
        return False, f"columns {sorted(left_columns)} vs {sorted(right_columns)}"
    if len(left) != len(right):
        return False, f"{len(left)} rows vs {len(right)}"
    a, b = rows_of(left_columns, left), rows_of(right_columns, right)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return not wrong, f"{len(a)} rows" if not wrong else f"{len(wrong)} differ, e.g. {wrong[0]}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = session(), oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                ok, note = compare(df, con, ORACLE[name])
            else:
                ok, note = True, f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
