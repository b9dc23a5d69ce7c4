"""Reading tables: fallback paths, optional tables, named relations, load summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmart.functions.aggregates import row_count


def read_table(
    spark: SparkSession, path: str, where: str | None = None, schema: StructType | None = None
) -> DataFrame:
    """Parquet scan. Partition columns are discovered from the directory names; a condition
    on them selects directories before any file is opened. With a known schema no footer is
    read at planning, and a partitioned table without rows, hence without files, can be read."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.filter(where) if where else df


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if the path does not exist. Any other failure is raised, such as a
    folder that exists and holds no table."""
    try:
        return read_table(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_first_available(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Scan the first path that exists."""
    for path in paths[:-1]:
        if (found := _read_if_there(spark, path)) is not None:
            return found
    return read_table(spark, paths[-1])


def read_available(
    spark: SparkSession, paths: Mapping[str, str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Read every table that exists; return the frames and the names that were missing."""
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name, path in paths.items():
        table = _read_if_there(spark, path)
        if table is None:
            missing.append(name)
        else:
            found[name] = table
    return found, missing


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def load_summary(df: DataFrame, name: str) -> DataFrame:
    """One row: table, rows, number of columns, column names. The row count needs no column,
    so only file footers are read."""
    return df.agg(row_count().alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )
