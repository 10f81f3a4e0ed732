"""Documents in chunk files, and exchange of compact hash arrays between chunks.

Operators that must count every window of every text write the documents once into chunk files of
bounded size on the shared folder. Later passes run one task row per chunk, open its file, and
send only arrays of hashes: for each bucket of the hash space a sorted array of the chunk's
distinct hashes. A bucket's task answers each chunk with one byte per hash. So neither texts nor
positions are shuffled, a chunk sends a hash once however often it holds it, and a lost task reads
the same chunk again.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import release, scratch, ship

_LAST = (1 << 63) - 1  # stands for a null doc_id: such rows come last


def local_path(uri: str) -> str | None:
    parts = urlsplit(uri)
    return parts.path if parts.scheme in ("", "file") else None


def remote(uri: str):
    """Arrow's file system of a path that is not mounted, and the path in it."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def save_chunk(uri: str, table) -> None:
    import pyarrow.parquet as pq

    path = local_path(uri)
    if path is not None:  # seen whole or not at all, should two attempts of a task write it
        os.makedirs(os.path.dirname(path), exist_ok=True)
        draft = f"{path}.{uuid.uuid4().hex}.tmp"
        pq.write_table(table, draft, compression="zstd")
        os.replace(draft, path)
        return
    store, key = remote(uri)
    store.create_dir(os.path.dirname(key), recursive=True)
    pq.write_table(table, key, compression="zstd", filesystem=store)


def open_table(uri: str):
    import pyarrow.parquet as pq

    path = local_path(uri)
    if path is not None:
        return pq.read_table(path)
    store, key = remote(uri)
    return pq.read_table(key, filesystem=store)


def load_chunk(uri: str) -> tuple[list[int], list[bytes]]:
    """Ids and texts (UTF-8) of a chunk in ascending order of id."""
    table = open_table(uri)
    return table.column("doc_id").to_pylist(), table.column("text").to_pylist()


def write_chunks(docs: DataFrame, name: str, chunk_bytes: int) -> DataFrame:
    """Chunk files of about ``chunk_bytes`` of text (a longer text is a chunk); the manifest (chunk, path, n_bytes)."""
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, name)

    def cut(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        held: list = []
        size = 0

        def flush():
            table = pa.concat_tables(held)
            table = table.take(pa.array(np.argsort(table.column("doc_id").to_numpy(), kind="stable")))
            # rows of one id are in the order of their chunks: by content first, so that it does not change
            mark = hashlib.blake2b(digest_size=8)
            for part in table.column("text").chunks:
                mark.update(part.buffers()[2] or b"")
            chunk = mark.hexdigest() + uuid.uuid4().hex
            save_chunk(f"{folder}/files/{chunk}.parquet", table)
            return pa.RecordBatch.from_pylist([{"chunk": chunk, "path": f"{folder}/files/{chunk}.parquet", "n_bytes": size}])

        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(_LAST)
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1])
            a = 0
            while a < len(sizes):
                b = a + max(1, int(np.searchsorted(np.cumsum(sizes[a:]), max(chunk_bytes - size, 0), "right")))
                if size and size + int(sizes[a:b].sum()) > chunk_bytes:
                    b = a  # the next text goes to a chunk of its own
                if b > a:
                    held.append(pa.table({"doc_id": ids.slice(a, b - a), "text": texts.slice(a, b - a)}))
                    size += int(sizes[a:b].sum())
                a = b
                if a < len(sizes) or size >= chunk_bytes:
                    if held:
                        yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        cut, "chunk string, path string, n_bytes long")
    rows.write.parquet(f"{folder}/manifest")
    return spark.read.schema(rows.schema).parquet(f"{folder}/manifest")


def bucket_bits(n_hashes: float, per_bucket: int = 1_000_000) -> int:
    return max(4, math.ceil(math.log2(max(n_hashes, 1) / per_bucket)) if n_hashes > per_bucket else 4)


def split_buckets(sorted_hashes, bits: int):
    """(bucket, from, to) of the stretches of a sorted hash array that lie in one bucket of the top ``bits``."""
    import numpy as np

    bucket = sorted_hashes >> np.uint64(64 - bits)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate(([0], cuts)) if len(bucket) else np.zeros(0, np.int64)
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(starts, np.append(cuts, len(bucket)))]


def low_words(sorted_hashes, bits: int):
    """The 32 bits after the top ``bits``: with the bucket they make a hash of 32 + ``bits`` bits."""
    import numpy as np

    return ((sorted_hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _distinct(ascending):
    """The distinct values of an array that is in order."""
    import numpy as np

    return ascending[np.concatenate(([True], ascending[1:] != ascending[:-1]))] if len(ascending) else ascending


def dealt(rows: DataFrame, key: str, groups: int, per_task: int = 4) -> DataFrame:
    """``rows`` with each ``key`` in one of as many partitions as ``per_task`` groups a task take.

    The work on a group is Python's and goes with its bytes many times over, so partitions must not be
    put together by size, as adaptive execution does where the number is not given.
    """
    return rows.repartition(min(100_000, max(1, -(-groups // per_task))), key)


def count_chunks(manifest: DataFrame, n_chunks: int, bits: int, hashes: Callable) -> DataFrame:
    """(chunk, bucket, codes): for each distinct hash of a chunk, in order, how many chunks hold it (255: or more).

    ``hashes(path)`` gives a chunk's sorted distinct 64-bit hashes. Only 32 + ``bits`` bits are
    compared, so a count can be too high (by about one hash in 4,000), never too low.
    """

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                own = hashes(row["path"])
                low = low_words(own, bits)
                parts = split_buckets(own, bits)
                for i in range(0, len(parts), 64):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in parts[i:i + 64]], pa.int32()),
                         pa.array([row["chunk"]] * len(parts[i:i + 64])),
                         pa.array([low[a:b].tobytes() for _, a, b in parts[i:i + 64]], pa.binary())],
                        ["bucket", "chunk", "low"])
                del own, low
        release()

    def answer(key, table):
        import numpy as np
        import pyarrow as pa

        blobs = [_distinct(np.frombuffer(x.as_py(), np.uint32)) for x in table.column("low")]
        values, held = np.unique(np.concatenate(blobs), return_counts=True)
        codes = np.minimum(held, 255).astype(np.uint8)
        found = [codes[np.searchsorted(values, np.frombuffer(x.as_py(), np.uint32))].tobytes() for x in table.column("low")]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "codes": pa.array(found, pa.binary())})

    sent = manifest.select("chunk", "path").repartition(max(1, n_chunks)).mapInArrow(
        send, "bucket int, chunk string, low binary")
    return sent.groupBy("bucket").applyInArrow(answer, "chunk string, bucket int, codes binary")


def by_chunk(manifest: DataFrame, answers: dict[str, DataFrame]) -> DataFrame:
    """Rows (chunk, path, kind, bucket, codes): each chunk's manifest row and the answers it got."""
    rows = manifest.select("chunk", "path", F.lit("").alias("kind"), F.lit(-1).alias("bucket"),
                           F.lit(None).cast("binary").alias("codes"))
    for kind, frame in answers.items():
        rows = rows.unionByName(frame.select("chunk", F.lit(None).cast("string").alias("path"),
                                             F.lit(kind).alias("kind"), "bucket", "codes"))
    return rows


def received(table, kind: str):
    """The answers of one kind that a chunk got, in bucket order, as one array; and the chunk's path."""
    import numpy as np

    rows = sorted((b, c) for k, b, c in zip(table.column("kind").to_pylist(), table.column("bucket").to_pylist(),
                                            table.column("codes").to_pylist()) if k == kind)
    return np.frombuffer(b"".join(c for _, c in rows), np.uint8)


def path_of(table) -> str:
    return next(p for p in table.column("path").to_pylist() if p is not None)
