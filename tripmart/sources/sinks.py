"""Writing tables and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def gather_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows with equal partition values together before a partitioned write.

    Without it every task writes a file into every partition it meets. Adaptive execution
    splits a value that holds too many rows over several tasks and merges small ones.
    """
    return df.hint("rebalance", *columns)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    compression: str = "snappy",
    gather: bool = True,
    sort_within: Sequence[str] = (),
    replace: str = "table",
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> str:
    """Overwrite a Parquet table, partitioned when asked.

    ``replace="partitions"`` replaces only the partitions that the rows belong to and leaves
    the others of the table alone.

    ``gather=False`` is for rows that have been brought together already. ``sort_within``
    orders the rows of each task, so that a filter on these columns can pass over the row
    groups of a file by their minimum and maximum; no shuffle is added.

    ``observed`` holds aggregates over the rows as they are written, and who is told of them.
    They are taken behind the last shuffle, where only the first success of a task counts.
    """
    if partition_by and gather:
        df = gather_by(df, partition_by)
    if observed:
        df = df.observe(observed[0], *observed[1])
    if sort_within:
        # Led by the partition columns, this is also the order the writer needs.
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    if replace not in ("table", "partitions"):
        raise ValueError(f"unknown extent of replacement: {replace}")
    writer = df.write.mode("overwrite").option("compression", compression)
    writer = writer.option("partitionOverwriteMode", "static" if replace == "table" else "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def told(seen: Observation) -> dict[str, int] | None:
    """What was observed, or None where the plan turned out to be empty before anything ran that
    could count; PySpark cannot convert the answer then."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return None


def write_counted(
    df: DataFrame, path: str, keys: Sequence[str] = (), partition_by: Sequence[str] = (), **how
) -> dict[str, int]:
    """Overwrite a table; return its ``row_count`` and, by column, the nulls in ``keys``.

    The counts come from the write itself. Only a table that turned out empty at planning, so that nothing
    ran which could count, is asked for its rows.
    """
    seen = Observation()
    names = [k for k in keys if k in df.columns]
    measures = [F.count(F.lit(1)).alias("row_count"), *[F.count_if(F.col(k).isNull()).alias(f"nulls{i}") for i, k in enumerate(names)]]
    write_table(df, path, partition_by, observed=(seen, measures), **how)
    found = told(seen)
    if found is None:
        found = df.sparkSession.read.schema(df.schema).parquet(path).agg(*measures).first().asDict()
    return {"row_count": found["row_count"]} | {k: found[f"nulls{i}"] for i, k in enumerate(names)}


def write_tables(
    tables: Mapping[str, DataFrame],
    base: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, str]:
    """Write a named set of tables; return name -> path. The first failure is raised."""
    parts = partition_by or {}
    return {
        name: write_table(df, f"{base.rstrip('/')}/{name}", parts.get(name, ()))
        for name, df in tables.items()
    }


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Overwrite a CSV report with a header. ``single_file`` is for reports of a few rows:
    it sends all of them through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", "true").csv(path)
    return path


def write_audit(
    df: DataFrame, condition, path: str, partition_by: Sequence[str]
) -> str:
    """Route the rows that satisfy a condition to their own partitioned table."""
    return write_table(df.filter(condition), path, partition_by)
