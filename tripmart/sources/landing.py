"""Checks on files that have landed, and the dated landing layout."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import BinaryIO
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.aggregates import row_count
from tripmart.sources.publish import publish
from tripmart.sources.sinks import write_table

# Accepted file types and the fewest rows a landed file should have.
ALLOWED_EXTENSIONS = (".parquet", ".csv", ".json", ".gz")
MIN_ROWS = 500_000

CHUNK_BYTES = 8 * 1024 * 1024
# Spellings of URI schemes that the file system library has under another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
READABLE = ("file", "s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")

OpenStream = Callable[[str], BinaryIO]


def _streams(seekable: bool = False) -> OpenStream:
    """Opens a file of a store for reading, by its URI; ``seekable`` ones may be read at any place.

    It carries all it needs, so the executors need no copy of this package.
    """
    schemes = dict(SCHEMES)

    def open_stream(path: str):
        from pyarrow import fs

        if path.startswith("file:"):
            filesystem, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            scheme, _, rest = path.partition(":")
            filesystem, inner = fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{rest}")
        if seekable:
            return filesystem.open_input_file(inner)
        return filesystem.open_input_stream(inner, compression=None)

    return open_stream


def _stream_digests(open_stream: OpenStream, chunk_bytes: int = CHUNK_BYTES):
    """A task function that reads files in chunks and adds their MD5."""

    def add_digests(batches):
        import hashlib

        for batch in batches:
            found = []
            for path in batch["path"]:
                md5 = hashlib.md5()
                with open_stream(path) as stream:
                    while chunk := stream.read(chunk_bytes):
                        md5.update(chunk)
                found.append(md5.hexdigest())
            yield batch.assign(md5=found)

    return add_digests


def _read_footers(open_file: OpenStream):
    """A task function that reads the number of rows from the footers of Parquet files."""

    def add_rows(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            rows, faults = [], []
            for path in batch.column(0).to_pylist():
                try:
                    with open_file(path) as file:
                        rows.append(pq.ParquetFile(file).metadata.num_rows)
                    faults.append(None)
                except (pa.ArrowInvalid, OSError) as error:
                    rows.append(None)
                    faults.append(f"{type(error).__name__}: {str(error).splitlines()[0][:200]}")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.int64()), pa.array(faults, pa.string())], ["path", "row_count", "fault"]
            )

    return add_rows


def _listed(df: DataFrame) -> DataFrame:
    """``path``: every file that a scan was planned from, as ``file:///x`` or another full URI.

    Scans pass over files without bytes or rows, so these are only found among the names that
    planning has listed on the driver anyway. No row of data is among them.
    """
    names = [(unquote(p),) for p in df.inputFiles()]
    paths = df.sparkSession.createDataFrame(names, "path string")
    return paths.select(_full_uri(F.col("path")).alias("path"))


def _full_uri(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/(?!/)", "file:///")


def _check_stores(roots: Sequence[str], instead: str) -> None:
    for root in roots:
        scheme = root.partition(":")[0] if ":" in root.split("/")[0] else "file"
        if SCHEMES.get(scheme, scheme) not in READABLE:
            raise ValueError(f"no reader for {root}: pass {instead}")


def _files(spark: SparkSession, roots: Sequence[str], glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(list(roots))


def landing_manifest(
    spark: SparkSession,
    path: str | Sequence[str],
    allowed: Sequence[str] = ALLOWED_EXTENSIONS,
    glob: str | None = None,
    checksum: bool = True,
    open_stream: OpenStream | None = None,
) -> DataFrame:
    """One row per file: size, extension, MD5, and whether it is accepted.

    Files are spread over the cluster and, whatever their size, each is read in chunks by one
    task. ``open_stream`` opens a file by its URI; by default the usual stores are opened with
    the credentials of the executors' environment. A path in a store that this cannot read is
    refused before any file is read. Without ``checksum`` no file is opened and ``md5`` is null.
    """
    roots = [path] if isinstance(path, str) else list(path)
    if checksum and open_stream is None:
        _check_stores(roots, "open_stream, or checksum=False")
        open_stream = _streams()
    files = _files(spark, roots, glob)
    sized = files.select(_full_uri(F.col("path")).alias("path"), "length")
    if checksum:
        sized = sized.mapInPandas(_stream_digests(open_stream), "path string, length long, md5 string")
    else:
        sized = sized.withColumn("md5", F.lit(None).cast("string"))
    of_nothing = F.when(F.col("length").isNull() & F.lit(checksum), F.md5(F.lit("")))
    all_files = _listed(files).join(sized, "path", "left").select(
        "path",
        F.coalesce("length", F.lit(0)).alias("length"),
        F.coalesce("md5", of_nothing).alias("md5"),
    )
    name = F.element_at(F.split("path", "/"), -1)
    extension = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return all_files.select(
        "path",
        name.alias("file_name"),
        F.col("length").alias("size_bytes"),
        extension.alias("extension"),
        "md5",
        (F.col("length") > 0).alias("non_empty"),
        extension.isin(*allowed).alias("extension_ok"),
    )


def rows_per_file(
    df: DataFrame, min_rows: int = MIN_ROWS, header_lines: int = 0
) -> DataFrame:
    """Rows in each source file and whether they reach the minimum.

    On Parquet no column is read. For text files pass ``spark.read.text(...)`` and the number
    of header lines. Files without any row count 0.
    """
    # The path arrives URL-encoded, with a plus sign standing for itself.
    path = F.url_decode(F.replace(F.col("encoded"), F.lit("+"), F.lit("%2B")))
    counted = (
        df.groupBy(F.col("_metadata.file_path").alias("encoded"))
        .agg(row_count().alias("n"))
        .select(_full_uri(path).alias("path"), "n")
    )
    rows = F.greatest(F.coalesce("n", F.lit(0)) - F.lit(header_lines), F.lit(0))
    return _listed(df).join(counted, "path", "left").select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        rows.alias("row_count"),
        (rows >= min_rows).alias("enough_rows"),
    )


def footer_rows(
    spark: SparkSession, path: str | Sequence[str], glob: str | None = None, open_file: OpenStream | None = None
) -> DataFrame:
    """``path, row_count, fault``: rows of every Parquet file, from its footer; no row is read.

    The footers are spread over the cluster. A file whose footer cannot be read has a null count and
    says why in ``fault``; it stops nothing. ``open_file`` opens a file by its URI, at any place.
    """
    roots = [path] if isinstance(path, str) else list(path)
    if open_file is None:
        _check_stores(roots, "open_file")
        open_file = _streams(seekable=True)
    paths = _listed(_files(spark, roots, glob)).filter(F.lower("path").endswith(".parquet"))
    # A number of partitions that is given is not merged at run time, however short the rows.
    spread = paths.repartition(spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(_read_footers(open_file), "path string, row_count long, fault string")


def file_verdicts(
    spark: SparkSession,
    path: str | Sequence[str],
    min_rows: int = MIN_ROWS,
    allowed: Sequence[str] = ALLOWED_EXTENSIONS,
    glob: str | None = None,
    checksum: bool = True,
    open_stream: OpenStream | None = None,
    open_file: OpenStream | None = None,
) -> DataFrame:
    """One row per landed file: the columns of its manifest, ``row_count``, ``fault``, ``enough_rows``
    and ``accepted``.

    Only Parquet files tell their rows; for others ``row_count`` and ``enough_rows`` are null and say nothing
    against the file.
    """
    manifest = landing_manifest(spark, path, allowed, glob, checksum, open_stream)
    rows = footer_rows(spark, path, glob, open_file)
    enough = F.col("row_count") >= min_rows
    sound = F.col("non_empty") & F.col("extension_ok") & F.col("fault").isNull()
    return manifest.join(rows, "path", "left").withColumns(
        {"enough_rows": enough, "accepted": sound & F.coalesce(enough, F.lit(True))}
    )


def land_by_month(df: DataFrame, ts: str, base: str, dataset: str) -> str:
    """Write under ``<base>/<dataset>/year=Y/month=M/`` and return the dataset path.

    Months that the rows belong to are replaced; other months of the dataset stay.
    Small months are gathered into few files; a month that holds a large part of the data is
    split over several tasks.
    """
    dated = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    return write_table(dated, f"{base.rstrip('/')}/{dataset}", ["year", "month"], replace="partitions")


def land_published(df: DataFrame, ts: str, base: str, dataset: str) -> str:
    """``land_by_month`` for datasets that are read while they are landed: the months show together, once all
    of them are written. Read with ``publish.read_published``."""
    path = f"{base.rstrip('/')}/{dataset}"
    publish(df.withColumns({"year": F.year(ts), "month": F.month(ts)}), path, ["year", "month"])
    return path
