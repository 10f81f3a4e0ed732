"""Datasets in and out (Parquet), lookups and registration against the ``datasets`` catalog,
column metadata, and source-timestamp normalization.

Reads and writes go through Spark's Parquet source: files are split by block across tasks and
nothing passes through the driver. Lookups are joins of a request table with the catalog, so a
batch of a million lookups is one shuffle (or one broadcast of the request side when it is small),
not a million calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.expressions import normalize_source_timestamp
from vantage.sources.versions import read_folder, read_version, replace_folder, versions, write_version

DATASET_COLUMNS = ("id", "solution_id", "name", "description", "source", "slug", "documentation")


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The whole dataset as a DataFrame, as ``write_dataset`` got it; a folder of plain Parquet
    files is read with the schema of their footers."""
    return read_version(spark, path) if versions(spark, path) else read_folder(spark, path)


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  sort_within: list[str] | None = None) -> None:
    """S3: write as Parquet, replacing what was there once the write is complete; a failed write leaves
    the old dataset (``versions.py``).

    ``partition_by`` gives folder-level pruning on low-cardinality columns of any flat type; their
    values come back as they were, NULL and the empty string included. ``sort_within`` sorts
    each output file by the columns queries usually filter on, which keeps Parquet row-group
    min/max statistics tight, so pushed-down filters skip most row groups. It is a per-task sort.
    Rows are rebalanced on ``partition_by`` first, so a value's rows do not scatter over one file
    per task, and adaptive execution splits a value that holds more than a task's share.
    """
    replace_folder(df, path, partition_by, sort_within)


def lookup_by_id(catalog: DataFrame, requests: DataFrame, id_col: str = "id") -> DataFrame:
    """S4 in bulk: catalog rows for the requested ids; unknown ids are absent (see ``missing``)."""
    return catalog.join(requests.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").select(*catalog.columns)


def lookup_by_slug(catalog: DataFrame, requests: DataFrame) -> DataFrame:
    """S5 in bulk: catalog rows for requested (solution_id, slug) pairs."""
    keys = requests.select("solution_id", "slug").distinct()
    return catalog.join(keys, ["solution_id", "slug"], "left_semi").select(*catalog.columns)


def missing(catalog: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """Requests with no catalog row (the error rows of a lookup)."""
    return requests.join(catalog.select(*keys), keys, "left_anti").select(*requests.columns)


def get_or_create(catalog: DataFrame, wanted: DataFrame, id_prefix: str = "ds", separator: str = "|") -> DataFrame:
    """S6 in bulk: the id per wanted (solution_id, slug); an existing registration wins, otherwise a
    new row is created. Several wanted rows for one key inside the batch create one dataset: the
    first by ``seq`` (or by name when there is no seq column), ties by the other columns.

    Returns ``catalog ∪ created`` with a ``created`` flag.
    """
    key = ["solution_id", "slug"]
    order = F.col("seq") if "seq" in wanted.columns else F.col("name")
    rest = [c for c in wanted.columns if c not in key]
    # min_by over a grouped aggregate: partial aggregation reduces a hot key map-side, where a
    # row_number window would pull all of its rows into one task.
    first = (wanted.groupBy(*key)
             .agg(F.min_by(F.struct(*rest), F.struct(order.alias("_order"), *rest)).alias("_first"))
             .select(*key, "_first.*"))
    new = first.join(catalog.select(*key), key, "left_anti")
    created = new.select(
        F.concat(F.lit(id_prefix + "_"), F.sha2(F.concat_ws(separator, *key), 256).substr(1, 16)).alias("id"),
        *[F.col(c) if c in new.columns else F.lit(None).cast("string").alias(c) for c in DATASET_COLUMNS[1:]],
    )
    return (catalog.select(*DATASET_COLUMNS).withColumn("created", F.lit(False))
            .unionByName(created.withColumn("created", F.lit(True))))


def with_column_metadata(df: DataFrame, columns: dict[str, dict]) -> DataFrame:
    """S7 write for one frame: attach metadata to named columns (unknown names are an error)."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise KeyError(f"no such columns: {sorted(unknown)}")
    for name, meta in columns.items():
        df = df.withMetadata(name, meta)
    return df


def column_metadata(df: DataFrame) -> dict[str, dict]:
    """S7 read for one frame; columns without metadata read as ``{}``."""
    return {f.name: dict(f.metadata or {}) for f in df.schema.fields}


def normalized_source_timestamps(df: DataFrame, col: str = "source_timestamp", parsed: bool = False) -> DataFrame:
    """S8 over a table of datasets: adds ``<col>_norm``; with ``parsed``, also ``<col>_ts``, the
    normalized value as ``timestamp_ntz`` (NULL when it is not an ISO timestamp)."""
    out = df.withColumn(f"{col}_norm", normalize_source_timestamp(F.col(col)))
    if parsed:
        ts = F.try_to_timestamp(F.col(f"{col}_norm"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
        out = out.withColumn(f"{col}_ts", ts.cast("timestamp_ntz"))
    return out


class DatasetStore:
    """Datasets kept as Parquet folders under one root (on a shared file system), addressed by id.

    ``store.write(id, df)`` is the upload (S3), ``store.read(id)`` the download (S1); the store
    itself is a resolver, so it plugs into ``run_insight``, ``execute_sql`` and ``export``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, dataset_id: str) -> str:
        if not dataset_id or "/" in dataset_id or dataset_id in (".", ".."):
            raise ValueError(f"invalid dataset id {dataset_id!r}")
        return f"{self.root}/{dataset_id}"

    def write(self, dataset_id: str, df: DataFrame, partition_by: list[str] | None = None,
              sort_within: list[str] | None = None) -> str:
        """The dataset's next version; readers see it once it is complete."""
        path = self.path(dataset_id)
        write_version(df, path, partition_by, sort_within)
        return path

    def read(self, dataset_id: str, version: int | None = None) -> DataFrame:
        """The last version, or an earlier one that is still kept."""
        path = self.path(dataset_id)
        return read_dataset(self.spark, path) if version is None else read_version(self.spark, path, version)

    def versions(self, dataset_id: str) -> list[int]:
        return versions(self.spark, self.path(dataset_id))

    __call__ = read
