"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.session import scratch_path
from vantage.sources.tables import table_path

# The contracts' white space: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, table))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder, with its file system: a path without one is the cluster's
    default for Spark, but a machine's own disk for Python."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(rows: DataFrame, name: str, key: str, only: DataFrame) -> Iterator[DataFrame]:
    """The ``rows`` whose ``key`` is in ``only`` (distinct keys), as a table bucketed by ``key`` in the shared folder.

    Joins by ``key`` leave the table where it is and exchange the other side alone. The rows are exchanged once, here.
    The catalog knows the table inside the ``with`` block only.
    """
    spark = rows.sparkSession
    # as many buckets as a join by shuffle has partitions, else Spark exchanges both sides
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"spark_catalog.default.vantage_{uuid.uuid4().hex}"
    (rows.repartition(buckets, key).join(only, key).write.bucketBy(buckets, key)
     .option("path", scratch(spark, name)).format("parquet").saveAsTable(table))
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder on whatever file system holds it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def row_struct(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``df`` but ``without`` as one struct, so that none can clash with a working column."""
    dropped = {c.lower() for c in without}
    names = [c for c in df.columns if c.lower() not in dropped]
    return F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(1).alias("_"))


def blank(text: Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(text, F.lit(""))


def slices(data: bytes, step: int):
    """The text in pieces of about ``step`` bytes, cut before ASCII blanks."""
    import re

    blank = re.compile(rb"[ \t-\r]")
    a = 0
    while a < len(data):
        cut = blank.search(data, a + step) if a + step < len(data) else None
        b = cut.start() if cut else len(data)
        yield data[a:b]
        a = b


def number_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The distinct rows of ``df`` with ``rank`` 0, 1, 2 … in ascending order of ``keys``.

    A range-partitioned sort numbers each partition by itself; the partitions' bases are prefix
    sums over one row per partition. No task sees all rows.
    """
    local = df.distinct().sort(*keys).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    local = written(local, name)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = local.groupBy("part").agg((F.max("at") + 1).alias("size")).select(
        "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    # one row per partition of the sort: bounded by the partition count
    return local.join(F.broadcast(bases), "part").withColumn("rank", F.col("base") + F.col("at")).drop("part", "at", "base")


def with_classes(rows: DataFrame, classes: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of their class; ``classes`` has ``key``, ``n`` (the rows of the class) and others.

    A class with over one ``share``-th of all rows would put them into one task. There are fewer than
    ``share`` such classes, so they are broadcast; the rows of the others are joined by shuffle.
    """
    others = [c for c in classes.columns if c not in (key, "n")]
    least = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // share
    large = F.broadcast(classes.where(F.col("n") > least).select(key, F.struct(*others).alias("_large")))
    marked = rows.join(large, key, "left")
    rest = marked.where(F.col("_large").isNull()).drop("_large").join(classes.where(F.col("n") <= least).drop("n"), key)
    return marked.where(F.col("_large").isNotNull()).select(*rows.columns, "_large.*").unionByName(rest.select(*rows.columns, *others))


def release() -> None:
    """In a task: gives memory that this Python worker has freed back to the system.

    Spark keeps a worker for later tasks, and its allocators keep what large arrays and lists leave behind.
    """
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def ship(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers, wherever they start.

    The package goes to the executors as a zip, as ``--py-files`` would send it; once per session.
    """
    import os
    import tempfile
    import zipfile

    import vantage

    context = spark.sparkContext
    if getattr(context, "_vantage_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(vantage.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="vantage-"), "vantage.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("vantage", os.path.relpath(path, root)))
    context.addPyFile(target)
    context._vantage_shipped = True
