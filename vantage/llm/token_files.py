"""Token ids in flat binary files with 64-bit document offsets.

A dataset is a folder of shards. Shard k has ``<name>.bin`` (ids of its documents one after
another, little-endian unsigned 16-bit, or 32-bit when the vocabulary needs it), ``<name>.off``
(n_docs + 1 little-endian unsigned 64-bit positions in the whole dataset) and ``<name>.doc``
(64-bit document ids; the first ``n_null`` documents of a shard have none). The table ``manifest``
lists the shards. Shards are in ascending ``doc_id`` order: documents are range-partitioned, each
task appends its sorted documents to one shard, and the shards' bases are prefix sums over the
manifest. Only shards listed in the manifest count, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.llm.base import ship
from vantage.llm.chunks import remote

_MANIFEST = "shard long, name string, n_docs long, n_null long, n_tokens long, width int"


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    return parts.path if parts.scheme in ("", "file") else None


def _write(uri: str):
    """A binary file for writing, on a mounted or a remote file system."""
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    store, key = remote(uri)
    store.create_dir(os.path.dirname(key), recursive=True)
    return store.open_output_stream(key)


def _mapped(uri: str, dtype: str):
    """The file as an array: memory-mapped where it is mounted, read otherwise."""
    import numpy as np

    path = _local(uri)
    if path is not None:
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    store, key = remote(uri)
    with store.open_input_file(key) as file:
        return np.frombuffer(file.read_buffer(), dtype)


_BETWEEN = "\0"  # stands between words while their pieces are cut


class WordEncoder:
    """Encodes distinct words for a tokenizer that drops white space and splits words by a pattern.

    A new word is cut into the tokenizer's own pieces (one of letters alone is a piece), and distinct
    pieces are encoded many at a time by the same model, without normalizing and cutting them again: the
    word-end suffix of the vocabulary tells where each piece's ids end. Words with characters beyond
    Latin, and tokenizers without such a pattern or suffix, are encoded word by word.
    """

    def __init__(self, path: str, limit: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        import json

        import numpy as np
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        from vantage.llm.unit_cache import UnitCache

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        pattern = steps[0].get("pattern", {}).get("Regex") if steps[0].get("invert") else None
        suffix = spec["model"].get("end_of_word_suffix")
        self.pattern = regex.compile(pattern) if pattern and suffix else None
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.beyond = re.compile("[^\x00-\u024f]").search  # a character beyond Latin
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.normal = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else str
        if self.pattern and self.pattern.findall(f"a {_BETWEEN} b") != ["a", _BETWEEN, "b"]:
            self.pattern = None
        letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
        self.run = bool(self.pattern) and self.pattern.findall(letters) == [letters]  # letters stay together
        if self.pattern:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.CharDelimiterSplit(" "), *[self.tokenizer.pre_tokenizer[i] for i in range(1, len(steps))]])
        self.cache = UnitCache(self._pieces, limit)

    def _alone(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[str]):
        """The ids of distinct pieces and how many each has; the mark between words has none."""
        import numpy as np

        ids, lens = [np.zeros(0, np.uint32)], []
        for a in range(0, len(pieces), 500):
            part = [p for p in pieces[a:a + 500] if p != _BETWEEN]
            own = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[own]) + 1
            if len(ends) == len(part) and (not len(part) or ends[-1] == len(own)):
                size = np.diff(ends, prepend=0)
            else:
                alone = self._alone(part)
                own, size = np.fromiter(chain.from_iterable(alone), np.uint32), np.array([len(x) for x in alone], np.int64)
            if len(part) < len(pieces[a:a + 500]):
                size = np.insert(size, pieces.index(_BETWEEN, a) - a, 0)
            ids.append(own)
            lens.append(size)
        return np.concatenate(ids), np.concatenate(lens)

    def __call__(self, words: list[bytes]):
        import numpy as np

        texts = [w.decode() for w in words]
        if self.pattern is None:
            return self._alone(texts)
        runs, cut, rest = ([], []), ([], []), ([], [])  # positions and texts: of letters alone, to cut, others
        for i, text in enumerate(texts):
            if _BETWEEN in text or "<" in text and any(x in text for x in self.special):
                kind = rest
            elif text.isascii():
                text = text.lower()
                kind = runs if self.run and text.isalpha() else cut
            elif not self.beyond(text):
                text = self.normal(text)
                kind = runs if self.run and text.isalpha() and not self.beyond(text) else cut
            else:
                kind = rest
            kind[0].append(i)
            kind[1].append(text)
        found = [(runs[0], *self.cache(runs[1]))]
        if cut[0]:
            pieces = self.pattern.findall(f" {_BETWEEN} ".join(cut[1]))
            ids, lens = self.cache(pieces)
            ends = np.flatnonzero(lens == 0)  # the marks
            if len(ends) != len(cut[1]) - 1:  # a piece has no ids, or holds a mark
                return self._alone(texts)
            sums = np.concatenate(([0], np.cumsum(lens)))
            found.append((cut[0], ids, np.diff(sums[np.concatenate(([0], ends, [len(lens)]))])))
        if rest[0]:
            alone = self._alone(rest[1])
            found.append((rest[0], np.fromiter(chain.from_iterable(alone), np.uint32), np.array([len(x) for x in alone])))
        size = np.zeros(len(texts), np.int64)
        for at, _, own in found:
            size[at] = own
        starts = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.uint32)
        for at, ids, own in found:
            out[np.arange(len(ids)) + np.repeat(starts[at] - (np.cumsum(own) - own), own)] = ids
        return out, size


_kept: dict[str, tuple] = {}


def worker_encoder(path: str) -> tuple:
    """The encoder and its word cache of this Python worker; Spark uses a worker for many tasks."""
    from vantage.llm.unit_cache import UnitCache

    if path not in _kept:
        _kept.clear()
        encoder = WordEncoder(path)
        _kept[path] = encoder, UnitCache(encoder, 1_000_000)
    return _kept[path]


def write_token_files(docs: DataFrame, out_dir: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode every text, append ``end_id``, write the shards below ``out_dir``; returns the manifest.

    Ids equal ``Tokenizer.encode(text, add_special_tokens=False)`` of the whole text: words (runs of
    anything but the ASCII blanks) are encoded apart, which is the same for a tokenizer that drops
    white space; in every slice of texts the shortest non-empty one is also encoded whole, and a
    difference is an error. A null text is empty (only the end id). Null ids come first; rows
    sharing an id are in text order. An empty table has an empty manifest.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    width = 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def encode(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from vantage.llm.token_files import worker_encoder
        from vantage.llm.unit_cache import text_slices

        encoder, cache = worker_encoder(tokenizer_path)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:8]}"
        n_docs = n_null = n_tokens = 0
        files = None
        for part in text_slices(batches, "text"):
            if files is None:
                files = [_write(f"{out_dir}/{name}.{end}") for end in ("bin", "cnt", "doc")]
            words, counts = [], np.zeros(part.num_rows, np.int64)
            whole = None
            for i, text in enumerate(part.column(1).cast(pa.binary()).to_pylist()):
                own = (text or b"").split()
                counts[i] = len(own)
                words += own
                if own and (whole is None or len(own) < counts[whole]):
                    whole = i
            ids, lens = cache(words)
            ends = np.concatenate(([0], np.cumsum(lens)))[np.cumsum(counts)]  # where each document's ids end
            if whole is not None:
                alone = encoder.tokenizer.encode(part.column(1)[whole].as_py(), add_special_tokens=False).ids
                if alone != ids[(ends[whole - 1] if whole else 0):ends[whole]].tolist():
                    raise ValueError(f"{tokenizer_path} does not encode words independently")
            n = np.diff(ends, prepend=0) + 1
            out = np.full(len(ids) + len(n), end_id, f"<u{width}")
            keep = np.ones(len(out), bool)
            keep[np.cumsum(n) - 1] = False
            out[keep] = ids
            doc = part.column(0)
            files[0].write(out.tobytes())
            files[1].write(n.astype("<u8").tobytes())
            files[2].write(np.asarray(doc.fill_null(0)).astype("<i8").tobytes())
            n_docs, n_null, n_tokens = n_docs + len(n), n_null + doc.null_count, n_tokens + len(out)
        if files is not None:
            for file in files:
                file.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "name": name, "n_docs": n_docs, "n_null": n_null,
                                               "n_tokens": n_tokens, "width": width}], schema=pa.schema(
                [("shard", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()),
                 ("n_tokens", pa.int64()), ("width", pa.int32())]))

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(encode, _MANIFEST).write.parquet(f"{out_dir}/shards")
    shards = spark.read.schema(_MANIFEST).parquet(f"{out_dir}/shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def offsets(batches: Iterator) -> Iterator:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                counts = _mapped(f"{out_dir}/{row['name']}.cnt", "<u8")
                with _write(f"{out_dir}/{row['name']}.off") as file:
                    file.write((np.concatenate(([0], np.cumsum(counts))) + row["base"]).astype("<u8").tobytes())
            yield batch

    based.mapInArrow(offsets, based.schema).write.parquet(f"{out_dir}/manifest")
    return read_manifest(spark, out_dir)


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(f"{_MANIFEST}, base long").parquet(f"{out_dir}/manifest")


def read_token_files(spark: SparkSession, out_dir: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the memory-mapped files: doc_id, start, n_tokens, ids_crc32[, ids].

    ``ids_crc32`` is the CRC of the ids as little-endian unsigned 32-bit integers.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                path = f"{out_dir}/{row['name']}"
                ids, off, doc = (_mapped(f"{path}.{end}", kind) for end, kind in (
                    ("bin", f"<u{row['width']}"), ("off", "<u8"), ("doc", "<i8")))
                off = np.asarray(off).astype(np.int64)
                for a in range(0, row["n_docs"], 20_000):
                    b = min(a + 20_000, row["n_docs"])
                    own = [np.asarray(ids[off[i] - row["base"]:off[i + 1] - row["base"]]).astype("<u4")
                           for i in range(a, b)]
                    columns = [pa.array(doc[a:b], pa.int64(), mask=np.arange(a, b) < row["n_null"]),
                               pa.array(off[a:b]), pa.array(np.diff(off[a:b + 1])),
                               pa.array([zlib.crc32(x) for x in own], pa.int64())]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    ship(spark)
    manifest = read_manifest(spark, out_dir)
    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, schema)
