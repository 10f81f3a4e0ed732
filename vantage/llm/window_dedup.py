"""Substring deduplication: Rabin-Karp hashes of every window of ``size`` words, counted in Spark.

Pass 1 counts, for every distinct window hash of a chunk, in how many chunks it stands (32 bits
and the bucket are compared, so all repeats and a few others are found). Pass 2 sends 64 more hash
bits and the first ``doc_id`` of those only, and learns which chunks hold a window that starts
earlier elsewhere. Pass 3 merges the repeated windows of each document into maximal intervals and
removes their words. Repeats inside a chunk are settled in the chunk. A window that stands in
every document is sent once per chunk.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import scratch
from vantage.llm.chunks import (_LAST, bucket_bits, by_chunk, count_chunks, load_chunk, path_of, received,
                                split_buckets, write_chunks)


class _Chunk:
    """The words and window hashes of one chunk."""

    def __init__(self, path: str, size: int):
        import numpy as np

        from vantage.llm.hashing import inside, window_hashes, word_hashes

        self.ids, texts = load_chunk(path)
        self.words = [t.split() for t in texts]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        hashed = [word_hashes(own) for own in _groups(self.words)]
        flat = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        self.starts = inside(self.counts, size)
        self.flat = flat
        hashes = window_hashes(flat, size)[self.starts]
        # distinct hashes, the first window that has each, and each window's place among them
        self.hashes, self.first, self.place = np.unique(hashes, return_index=True, return_inverse=True)

    def again(self):
        """Windows whose hash stands earlier in the chunk."""
        import numpy as np

        out = np.ones(len(self.starts), bool)
        out[self.first] = False
        return out


def _groups(words: list[list[bytes]], most: int = 50_000):
    held: list[bytes] = []
    for own in words:
        held += own
        if len(held) >= most:
            yield held
            held = []
    if held:
        yield held


def dedup_windows(docs: DataFrame, size: int = 20, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Remove every word covered by a window of ``size`` words that also starts earlier.

    Earlier is a smaller ``doc_id``, or an earlier start in the same document; windows are judged on
    the input. Words are runs of anything but the ASCII blanks. Returns ``doc_id``, ``text`` (kept
    words joined by a space), ``n_words``, ``n_removed`` and ``spans`` (maximal removed intervals of
    word positions, end exclusive); other columns are left out. A null or empty text has no words.
    Null ids come after all others, and rows sharing an id follow one another in the order of their
    chunks' contents, which is the same as long as the table is read in the same splits: equal rows lose
    all windows but those of the first. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    manifest = write_chunks(docs, "window-chunks", chunk_bytes)
    n_chunks, n_bytes = manifest.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    bits = bucket_bits(n_bytes / 6)

    def distinct(path: str):
        return _Chunk(path, size).hashes

    def candidates(table):
        import numpy as np
        import pyarrow as pa

        from vantage.llm.hashing import window_hashes

        own = _Chunk(path_of(table), size)
        shared = received(table, "count") >= 2
        hashes = own.hashes[shared]
        starts = own.starts[own.first[shared]]
        more = window_hashes(own.flat, size, 1)[starts] if len(starts) else hashes
        doc = np.asarray(own.ids, np.int64)[np.searchsorted(np.cumsum(own.counts), starts, "right")]
        parts = split_buckets(hashes, bits)
        chunk = table.column("chunk")[0].as_py()
        return pa.table({
            "bucket": pa.array([x[0] for x in parts], pa.int32()), "chunk": pa.array([chunk] * len(parts), pa.string()),
            "hash": pa.array([hashes[a:b].tobytes() for _, a, b in parts], pa.binary()),
            "more": pa.array([more[a:b].tobytes() for _, a, b in parts], pa.binary()),
            "doc": pa.array([doc[a:b].tobytes() for _, a, b in parts], pa.binary())})

    def earliest(key, table):
        import numpy as np
        import pyarrow as pa

        order = np.argsort(np.array(table.column("chunk").to_pylist()))
        table = table.take(pa.array(order))
        blobs = {n: [np.frombuffer(x.as_py(), np.uint64 if n != "doc" else np.int64) for x in table.column(n)]
                 for n in ("hash", "more", "doc")}
        sizes = np.array([len(x) for x in blobs["hash"]])
        h, m, d = (np.concatenate(blobs[n]) for n in ("hash", "more", "doc"))
        rank = np.lexsort((np.repeat(np.arange(len(sizes)), sizes), d, m, h))
        later = np.zeros(len(h), np.uint8)
        later[rank[1:]] = (h[rank[1:]] == h[rank[:-1]]) & (m[rank[1:]] == m[rank[:-1]])
        ends = np.cumsum(sizes)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "codes": pa.array([later[b - n:b].tobytes() for n, b in zip(sizes, ends)], pa.binary())})

    def remove(table):
        import numpy as np
        import pyarrow as pa

        own = _Chunk(path_of(table), size)
        gone = own.again()
        late = np.zeros(len(own.hashes), bool)
        late[np.flatnonzero(received(table, "count") >= 2)] = received(table, "later").astype(bool)
        gone |= late[own.place]
        total = int(own.counts.sum())
        cover = np.zeros(total + 1, np.int64)
        np.add.at(cover, own.starts[gone], 1)
        np.add.at(cover, own.starts[gone] + size, -1)
        out = np.cumsum(cover)[:total] > 0
        ends = np.cumsum(own.counts)
        texts, removed, spans = [], [], []
        for words, a, b in zip(own.words, ends - own.counts, ends):
            mask = out[a:b]
            n = int(mask.sum())
            removed.append(n)
            if not n:
                texts.append(b" ".join(words))
                spans.append([])
                continue
            texts.append(b" ".join([w for w, x in zip(words, mask.tolist()) if not x]))
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": pa.array([None if i == _LAST else i for i in own.ids], pa.int64()),
                         "text": pa.array(texts, pa.binary()).cast(pa.string()),
                         "n_words": pa.array(own.counts), "n_removed": pa.array(removed, pa.int64()),
                         "spans": pa.array(spans, kind)})

    folder = scratch(spark, "window-answers")
    counted = _kept(count_chunks(manifest, n_chunks, bits, distinct), f"{folder}/count")
    sent = by_chunk(manifest, {"count": counted}).groupBy("chunk").applyInArrow(
        candidates, "bucket int, chunk string, hash binary, more binary, doc binary")
    later = _kept(sent.groupBy("bucket").applyInArrow(earliest, "chunk string, bucket int, codes binary"),
                  f"{folder}/later")
    return by_chunk(manifest, {"count": counted, "later": later}).groupBy("chunk").applyInArrow(
        remove, "doc_id long, text string, n_words long, n_removed long, spans array<struct<start:long,end:long>>")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
