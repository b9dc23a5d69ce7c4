"""Tables whose new state shows only once all of it is written.

A published table lies in one folder:

    <path>/data/<partition>=<value>/.../load=<id>/part-*.parquet
    <path>/manifests/00000012

A load first writes its rows into folders of its own, which no reader looks at. Then one small file, the next
manifest, lists the folders that make up the table. Readers take the newest whole manifest, so they see all of
a load or nothing of it, however it ends: a load that fails half-way leaves files that no manifest names.
Writing the manifest is the commit. A file of its number is created only if there is none, so of two loads
that start from one state the second fails with ``ConflictingLoad`` and may be tried again. A manifest whose last
line is missing was cut off while it was written; it counts as taken and is passed over.

A manifest has one line per partition value, which is also what the driver lists: hundreds of months, not rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmart.sources.sinks import write_table

LOAD = "load"
END = "end of manifest"


class ConflictingLoad(RuntimeError):
    """Another load was published since this one read the table's state."""


class _Files:
    """The few file operations of a store that a commit needs, on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def folders(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in self.fs.globStatus(self.path(pattern)) or [])

    def full(self, name: str) -> str:
        return self.fs.makeQualified(self.path(name)).toString()

    def read(self, name: str) -> str:
        size = self.fs.getFileStatus(self.path(name)).getLen()
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if there is such a file."""
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


def _parse(text: str) -> dict | None:
    *lines, end = text.rstrip("\n").split("\n")
    if end != END:
        return None
    head, *folders = (json.loads(x) for x in lines)
    return {"schema": head, "folders": folders}


def _state(files: _Files, path: str, version: int | None = None) -> tuple[int, int, dict | None]:
    """The last number that is taken, and the newest whole manifest (up to ``version``) with its number."""
    taken = [int(n) for n in files.names(f"{path}/manifests") if n.isdigit()]
    for number in sorted(taken, reverse=True):
        if version is not None and number > version:
            continue
        if found := _parse(files.read(f"{path}/manifests/{number:08d}")):
            return max(taken), number, found
    return max(taken, default=0), 0, None


def _stored_schema(schema: StructType, partition_by: Sequence[str]) -> StructType:
    """The schema as it is read back: partition columns last, with the hidden one."""
    fields = {f.name: f for f in schema}
    ordered = [f for f in schema if f.name not in partition_by] + [fields[p] for p in partition_by]
    return StructType([*[StructField(f.name, f.dataType) for f in ordered], StructField(LOAD, StringType())])


def published_version(spark: SparkSession, path: str) -> int:
    """Number of the newest published state, 0 if there is none."""
    path = path.rstrip("/")
    return _state(_Files(spark, path), path)[1]


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replace: str = "partitions",
    since: int | None = None,
    **how,
) -> int:
    """Write rows and make them the table's next state; return its number.

    ``replace="partitions"`` replaces the partitions that the rows belong to and keeps the others;
    ``"table"`` leaves nothing else; ``"nothing"`` adds the rows to what is there. ``since`` is the state
    that the rows were derived from (by default the newest one when the call starts): if a later one has been
    published by the time of the commit, ``ConflictingLoad`` is raised and the table stays as it is.
    Without rows, ``"table"`` publishes an empty table and the others publish the same folders again.
    The columns must be those of the table. A column called ``load`` is refused.
    """
    if replace not in ("partitions", "table", "nothing"):
        raise ValueError(f"unknown extent of replacement: {replace}")
    if LOAD in {c.lower() for c in df.columns}:
        raise ValueError(f"a published table cannot have a column {LOAD}")
    spark, path = df.sparkSession, path.rstrip("/")
    files = _Files(spark, path)
    taken, newest, old = _state(files, path)
    if since is not None and since != newest:
        raise ConflictingLoad(f"{path} is at state {newest}, not {since}")
    schema = _stored_schema(df.schema, partition_by)
    described = {"columns": schema.jsonValue(), "partition_by": list(partition_by)}
    if old and replace != "table" and old["schema"] != described:
        raise ValueError(f"columns differ from those of {path}")
    load = uuid.uuid4().hex
    write_table(
        df.withColumn(LOAD, F.lit(load)), f"{path}/data", [*partition_by, LOAD], replace="partitions", **how
    )
    root = files.full(f"{path}/data") + "/"
    written = [f.removeprefix(root) for f in files.folders(f"{path}/data/{'*/' * len(partition_by)}{LOAD}={load}")]
    kept = old["folders"] if old and replace != "table" else []
    if replace == "partitions":
        replaced = {f.rpartition("/")[0] for f in written}
        kept = [f for f in kept if f.rpartition("/")[0] not in replaced]
    number = taken + 1
    lines = [json.dumps(x) for x in (described, *kept, *written)]
    try:
        files.create(f"{path}/manifests/{number:08d}", "\n".join([*lines, END, ""]))
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        raise ConflictingLoad(f"state {number} of {path} was published by another load") from error
    return number


def read_published(spark: SparkSession, path: str, where: str | None = None, version: int | None = None) -> DataFrame:
    """The newest published state of a table, or the one with the given number.

    Folders that the manifest does not list are never opened; a condition on partition columns leaves out
    further ones before any file is read.
    """
    path = path.rstrip("/")
    files = _Files(spark, path)
    _, number, found = _state(files, path, version)
    if found is None or version not in (None, number):
        raise FileNotFoundError(f"no published state {'' if version is None else version} of {path}")
    schema = StructType.fromJson(found["schema"]["columns"])
    root = files.full(f"{path}/data")
    if not found["folders"]:
        df = spark.createDataFrame([], schema)
    else:
        df = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in found["folders"]])
    df = df.drop(LOAD)
    return df.filter(where) if where else df
