"""Change stream applied with Structured Streaming.

The fold of ``vantage.operators.changes`` is a grouped ``max`` over (seq, value) structs, so on a stream it
is a streaming aggregation: Spark keeps each key's fold in its state store, under the query's checkpoint,
and a micro-batch reads and updates the keys it names only. The result is exact whatever order or grouping
the changes arrive in. Each micro-batch writes the folds of its keys to the shared folder (the same
rows if it is replayed after a failure). Folds only grow, so the records are read from the maximum of all
of them; ``compact_folds`` puts them together.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vantage.operators.changes import _field_schema, finalize_fold, fold_changes


def start_change_stream(spark: SparkSession, source_dir: str, change_schema: StructType | str,
                        fields: StructType, fold_root: str, checkpoint: str, key: str = "key",
                        payload: str = "payload", files_per_batch: int | None = None,
                        available_now: bool = True):
    """Fold change files arriving in ``source_dir`` (Parquet) into ``fold_root``; returns the query.

    The state store is the session's (``spark.sql.streaming.stateStore.providerClass``; RocksDB for many keys), and
    its partitions are ``spark.sql.shuffle.partitions`` of the first run."""
    reader = spark.readStream.schema(change_schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folded = fold_changes(reader.parquet(source_dir), fields, key, payload)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(fold_root, f"batch={batch_id}"))

    writer = folded.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def _exists(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def current_folds(spark: SparkSession, fold_root: str, key: str = "key") -> DataFrame:
    """Each key's fold after every batch so far: the maximum of the folds that batches have written."""
    written = spark.read.parquet(fold_root)
    columns = [c for c in written.columns if c not in (key, "batch")]
    return written.groupBy(key).agg(*[F.max(c).alias(c) for c in columns])


def compact_folds(spark: SparkSession, fold_root: str, key: str = "key") -> None:
    """One row per key instead of one per batch and key. Run it between runs of the query, not beside one: the
    compacted rows replace the batches read, and later batches are added to them."""
    folds = current_folds(spark, fold_root, key)
    mark = uuid.uuid4().hex
    staged, former = f"{fold_root.rstrip('/')}.new-{mark}", f"{fold_root.rstrip('/')}.old-{mark}"
    folds.write.parquet(os.path.join(staged, "batch=-1"))
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(fold_root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(fold_root), path(former)) or not fs.rename(path(staged), path(fold_root)):
        raise OSError(f"folds could not be swapped; {staged} and {former} hold them")
    fs.delete(path(former), True)


def current_records(spark: SparkSession, state: DataFrame, fold_root: str, key: str = "key") -> DataFrame:
    """Records after every change folded so far."""
    return finalize_fold(state, current_folds(spark, fold_root, key), key) if _exists(spark, fold_root) else state


def fields_of(state: DataFrame, key: str = "key") -> StructType:
    return _field_schema(state, key)
