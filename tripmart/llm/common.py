"""Helpers that the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.workspace import workspace

# ASCII letters in upper case and what they become; all other code points stay.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

BATCH_BYTES = 4 << 20


ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Tasks import this package; where it is not installed they find it beside the driver's.
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared workspace and read back: later stages start from files, so that a
    lost executor costs no earlier stage."""
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_lean(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """As ``stored``; what was shuffled for the table goes from the disks when it is written, not when
    the driver's memory is next cleaned."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return stored(spark, df, name)
    finally:
        spark.conf.set(setting, before)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, null to empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut batches where their texts pass some megabytes; nulls in the column become ``""``."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        start, size = 0, 0
        lengths = batch.column(at).nbytes // max(1, batch.num_rows)
        step = max(1, min(batch.num_rows, BATCH_BYTES // max(1, lengths)))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, [t or "" for t in part.column(at).to_pylist()]
