"""Parquet datasets that come back as they were written: staged data, manifests, and a swap at the end.

A versioned dataset's folder holds ``data-<id>`` folders and ``_manifests/<version>.json``. A write stages its data
in a folder of its own and then adds the next manifest; the highest manifest is the dataset. So a write
that fails leaves the dataset as it was, readers never see half of one, and of two writers that start
from one version the second is told so (``VersionConflict``). The last ``keep`` versions stay, so a
query that reads the version before goes on.

The manifest keeps the schema (names, types, column metadata) and the column order; nothing is inferred
from folder names. Partition columns become folders of encoded strings, which hold apart what plain
folder names cannot: the empty string, NULL, and '01' next to '1'. Reading decodes them in a projection
over the folder values, so a filter on a partition column still prunes folders.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, MapType, StringType, StructField, StructType,
                               TimestampType, VariantType)

MANIFESTS = "_manifests"  # of a dataset with versions
MANIFEST = "_dataset.json"  # of a folder without


class VersionConflict(RuntimeError):
    """Another writer has added the version this one was about to add."""


class _Folder:
    """A folder on whatever Hadoop file system holds it; small files only, from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def names(self, name: str | None = None) -> list[str]:
        path = self.at(name) if name else self.root
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, name: str, text: str) -> None:
        """Writes a new file under a temporary name and renames it; an existing one is an error."""
        draft = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        keep_existing = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.at(name)), keep_existing)
        except Exception as exc:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(exc) or self.fs.exists(self.at(name)):
                raise VersionConflict(f"{name} was written by someone else") from exc
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the dataset that are there, oldest first; none for a plain Parquet folder."""
    return [int(n[:-5]) for n in _Folder(spark, path).names(MANIFESTS) if n.endswith(".json")]


def _manifest(folder: _Folder, version: int) -> dict:
    return json.loads(folder.read(f"{MANIFESTS}/{version:010d}.json"))


# -- partition values as folder names ----------------------------------------------------------------

def _encoded(col: Column, kind: DataType) -> Column:
    """A partition value as a non-empty string; NULL stays NULL."""
    if isinstance(kind, StringType):
        return F.concat(F.lit("s"), col)
    if isinstance(kind, BinaryType):
        return F.concat(F.lit("s"), F.hex(col))
    if isinstance(kind, TimestampType):  # a string would depend on the session's time zone
        return F.unix_micros(col).cast("string")
    return col.cast("string")


def _decoded(col: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return F.substring(col, 2, 1 << 30).cast(kind)
    if isinstance(kind, BinaryType):
        return F.unhex(F.substring(col, 2, 1 << 30))
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(col.cast("bigint"))
    return col.cast(kind)


def _folder_names(df: DataFrame, partition_by: list[str]) -> dict[str, str]:
    taken = {c.lower() for c in df.columns}
    if len(taken) < len(df.columns):
        raise ValueError("a dataset cannot hold two columns whose names differ in case only")
    named = {}
    for column in partition_by:
        if column not in df.columns or column in named:
            raise ValueError(f"not a column to partition by (or named twice): {column!r}")
        if isinstance(df.schema[column].dataType, (ArrayType, MapType, StructType, VariantType)):
            raise ValueError(f"nested column {column!r} cannot be partitioned by")
        name = f"by{len(named)}"
        while name in taken:
            name += "_"
        named[column] = name
    return named


# -- one folder of Parquet files ------------------------------------------------------------------------

def _write_files(df: DataFrame, path: str, partition_by: list[str] | None, sort_within: list[str] | None) -> dict:
    """Writes ``df`` to a new folder; what ``_read_files`` needs to give it back."""
    schema, folders = df.schema, _folder_names(df, partition_by or [])
    out = df.withColumns({name: _encoded(F.col(f"`{c}`"), schema[c].dataType) for c, name in folders.items()}) if folders else df
    if folders:
        out = out.hint("rebalance", *folders.values())
    if sort_within:
        out = out.sortWithinPartitions(*folders.values(), *[F.col(f"`{c}`") for c in sort_within])
    held = [c for c in df.columns if c not in folders]
    filler = None
    if not held:  # Parquet needs a column beside the folders
        filler = "row"
        while filler in df.columns:
            filler += "_"
    out = out.select(*[F.col(f"`{c}`") for c in held], *([F.lit(True).alias(filler)] if filler else []), *folders.values())
    (out.write.partitionBy(*folders.values()) if folders else out.write).parquet(path)
    return {"schema": json.loads(schema.json()), "folders": folders, "filler": filler}


def _read_files(spark: SparkSession, path: str, manifest: dict) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = manifest["folders"]
    stored = [StructField(f.name, f.dataType, True) for f in schema if f.name not in folders]
    if manifest["filler"]:
        stored.append(StructField(manifest["filler"], BooleanType(), True))
    stored += [StructField(name, StringType(), True) for name in folders.values()]
    df = spark.read.schema(StructType(stored)).parquet(path)
    columns = []
    for f in schema:
        col = _decoded(F.col(f"`{folders[f.name]}`"), f.dataType) if f.name in folders else F.col(f"`{f.name}`")
        columns.append(col.alias(f.name, metadata=f.metadata or {}))
    return df.select(*columns)


# -- versions ------------------------------------------------------------------------------------------

def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None, keep: int = 2) -> int:
    """Stages ``df`` as Parquet and makes it the dataset's next version; returns its number.

    A folder name holds at most 255 bytes on most file systems; a longer partition value fails the
    write (and leaves the dataset as it was).
    """
    spark = df.sparkSession
    folder = _Folder(spark, path)
    known = versions(spark, path)
    version = (known[-1] if known else 0) + 1
    data = f"data-{uuid.uuid4().hex}"
    try:
        manifest = _write_files(df, f"{path.rstrip('/')}/{data}", partition_by, sort_within)
        folder.add(f"{MANIFESTS}/{version:010d}.json", json.dumps({"version": version, "data": data, **manifest}))
    except BaseException:
        folder.delete(data)
        raise
    if not known:  # what an unversioned write left in the folder is replaced now
        for name in folder.names():
            if name != MANIFESTS and not name.startswith("data-"):
                folder.delete(name)
    for old in [v for v in known if v <= version - keep]:
        stale = _manifest(folder, old)
        folder.delete(f"{MANIFESTS}/{old:010d}.json")
        folder.delete(stale["data"])
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The dataset as it was written: all rows, columns in order, types, column metadata (nullable, as files are)."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no version {version or ''} of a dataset in {path}")
    manifest = _manifest(_Folder(spark, path), version or known[-1])
    return _read_files(spark, f"{path.rstrip('/')}/{manifest['data']}", manifest)


# -- one folder without versions -----------------------------------------------------------------------

def replace_folder(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_within: list[str] | None = None) -> None:
    """A Parquet folder that other tools can read too, replaced only when the new one is complete.

    The rows are staged beside it and swapped in by renames; a failed write leaves the old folder. Its
    manifest lies in the folder, hidden from Parquet readers. If the driver is lost between the renames,
    the staged folder still holds the whole result.
    """
    spark = df.sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex
    staged, former = f".{name}.new-{mark}", f".{name}.old-{mark}"
    folder = _Folder(spark, parent or ("/" if path.startswith("/") else "."))
    try:
        manifest = _write_files(df, folder.at(staged).toString(), partition_by, sort_within)
        folder.add(f"{staged}/{MANIFEST}", json.dumps(manifest))
    except BaseException:
        folder.delete(staged)
        raise
    had = folder.fs.exists(folder.at(name))
    if had and not folder.fs.rename(folder.at(name), folder.at(former)):
        folder.delete(staged)
        raise OSError(f"{path} could not be set aside")
    if not folder.fs.rename(folder.at(staged), folder.at(name)):
        if had:
            folder.fs.rename(folder.at(former), folder.at(name))
        raise OSError(f"{staged} could not be renamed; it holds the whole result")
    if had:
        folder.delete(former)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """What ``replace_folder`` wrote, as it was; a plain Parquet folder or file with the schema of its footers."""
    folder = _Folder(spark, path)
    if not folder.fs.exists(folder.at(MANIFEST)):
        return spark.read.parquet(path)
    return _read_files(spark, path, json.loads(folder.read(MANIFEST)))
