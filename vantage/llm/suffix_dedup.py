"""Suffix-array deduplication of byte strings: shard Burrows-Wheeler transforms merged by interleave refinement.

Documents are cut into chunk files. A text that an earlier document has whole is known by its digest
and removed whole; the passes below work on the other texts. Pass 1 takes each chunk's anchors, the smallest hash of
``_GRAM`` bytes in every ``_INNER`` bytes, and counts in how many chunks each stands. Equal strings
hold equal anchors, so a string with an anchor that stands once in the whole table cannot repeat:
it takes no part any more. Pass 2 puts what is left of a chunk in suffix order, keeps the first of
each repeated string of ``size`` bytes, and sends the others' text, cut where the anchor of the
string changes, to the anchor's bucket. There every chunk's pieces are a shard; the shards'
transforms are merged (``suffix_arrays.merged_classes``), and strings with a common prefix of
``size`` bytes learn which starts first. Pass 3 joins the repeated strings of each document into
maximal spans and removes them.

A string whose anchor stands in ``_HOT`` chunks or more goes by its own hash instead, one string a
piece, so that a passage of a third of all documents is spread over all buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import delete_path, scratch, written
from vantage.llm.chunks import (_LAST, bucket_bits, by_chunk, count_chunks, dealt, load_chunk, path_of, received,
                                open_table, save_chunk, write_chunks)

_GRAM, _INNER = 24, 50
_HOT = 200
_KEPT = {"runs": "<u4", "place": "<i4", "hashes": "<u8", "copies": "<u1"}  # a chunk's anchors between two passes


def _sliding(values, width: int, pick):
    """The smallest or largest (``pick``) of every ``width`` neighbours."""
    out, own = values, 1
    while 2 * own <= width:
        out, own = pick(out[:-own], out[own:]), 2 * own
    rest = width - own
    return pick(out[:-rest], out[rest:]) if rest else out


def _texts(address: str) -> tuple[list[int], list[bytes], dict[int, bytes]]:
    """Ids and texts of a chunk, whole copies of earlier documents as empty; and those copies' texts.

    The address is the chunk's path, ``#`` and the places of the copies.
    """
    path, _, places = address.rpartition("#")
    ids, texts = load_chunk(path)
    copies = {int(i): texts[int(i)] for i in places.split(",") if i}
    return ids, [b"" if i in copies else t for i, t in enumerate(texts)], copies


def _without_copies(manifest: DataFrame, size: int) -> DataFrame:
    """The manifest with each chunk's address: the places of texts that an earlier document has whole.

    All strings of such a text start earlier, so it needs no search. One row of digests per text is
    shuffled, no text; a group of copies is reduced to its first before the shuffle.
    """

    def digests(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids, texts = load_chunk(row["path"])
                at = [i for i, t in enumerate(texts) if len(t) >= size]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * len(at), pa.string()), pa.array(at, pa.int32()),
                     pa.array([ids[i] for i in at], pa.int64()),
                     pa.array([hashlib.sha256(texts[i]).digest() for i in at], pa.binary())],
                    ["chunk", "place", "doc", "digest"])

    rows = manifest.select("chunk", "path").mapInArrow(digests, "chunk string, place int, doc long, digest binary")
    rows = written(rows, "suffix-digests")
    firsts = rows.groupBy("digest").agg(F.min(F.struct("doc", "chunk", "place")).alias("first")).select("first.*")
    copies = rows.join(firsts, ["chunk", "place"], "left_anti").groupBy("chunk").agg(
        F.array_join(F.collect_list("place"), ",").alias("copies"))  # bounded by a chunk's documents
    return written(manifest.join(copies, "chunk", "left").select(
        "chunk", F.concat("path", F.lit("#"), F.coalesce("copies", F.lit(""))).alias("path"), "n_bytes"), "suffix-manifest")


class _Chunk:
    """The bytes of a chunk's documents and the anchors of every ``_INNER`` bytes."""

    def __init__(self, address: str, known: str | None = None):
        """``known``: the file an earlier pass has kept the anchors in."""
        import numpy as np

        from vantage.llm.hashing import window_hashes

        self.ids, texts, _ = _texts(address)
        self.lens = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(self.lens)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.data)
        self.left = np.repeat(self.ends, self.lens) - np.arange(n)  # bytes up to the end of the document
        # per run of equal anchors its length and its anchor's place among the hashes: places are in hash order
        self.runs, self.place = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.hashes, self.copies = np.zeros(0, np.uint64), np.zeros(0, np.uint8)
        if n < _INNER:
            return
        if known:
            table = open_table(known)
            self.runs, self.place, self.hashes, self.copies = (
                np.frombuffer(table.column(c)[0].as_py(), d) for c, d in _KEPT.items())
            return
        grams = window_hashes(self.data, _GRAM)
        width = _INNER - _GRAM + 1
        anchor = _sliding(grams, width, np.minimum)
        own = np.where(self.left[:len(anchor)] >= _INNER, anchor, np.uint64(0))  # 0: crosses documents
        spread = np.concatenate((np.zeros(width - 1, np.uint64), own, np.zeros(width - 1, np.uint64)))
        taken = grams[_sliding(spread, width, np.maximum) == grams]
        # as anchors are small hashes, they are mixed again before buckets are read from their top bits
        self.hashes, copies = np.unique(_again(taken), return_counts=True)
        self.copies = np.minimum(copies, 2).astype(np.uint8)
        if not len(self.hashes):  # no text is long enough
            return
        cuts = np.concatenate(([0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1))
        self.runs = np.diff(np.append(cuts, len(anchor)))
        # the place of an anchor that crosses documents is any; no string looks there
        self.place = np.minimum(np.searchsorted(self.hashes, _again(anchor[cuts])), len(self.hashes) - 1).astype(np.int32)

    def keep(self, uri: str) -> None:
        """Keeps the anchors, run by run, for the next pass."""
        import pyarrow as pa

        columns = {"runs": self.runs, "place": self.place, "hashes": self.hashes, "copies": self.copies}
        save_chunk(uri, pa.table({k: pa.array([v.astype(_KEPT[k]).tobytes()], pa.large_binary()) for k, v in columns.items()}))

    def looked_up(self, codes):
        """For each position: in how many chunks its anchor stands, and whether it repeats at all."""
        import numpy as np

        held = codes[self.place]
        return np.repeat(held, self.runs), np.repeat((held >= 2) | (self.copies[self.place] >= 2), self.runs)


def _again(hashes):
    from vantage.llm.hashing import mix

    return mix(hashes, 5)


def _all_of(flags, width: int):
    """Whether the ``width`` flags from each position on are all set."""
    import numpy as np

    sums = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(~flags, out=sums[1:])
    return sums[width:] == sums[:-width]


def _gathered(data, starts, lens):
    import numpy as np

    return data[np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(int(lens.sum()))]


def _ranges(flags):
    """Starts and ends of the runs of set flags."""
    import numpy as np

    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def dedup_substrings(docs: DataFrame, size: int = 100, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Remove every byte covered by a string of ``size`` bytes that also starts earlier.

    Earlier is a smaller ``doc_id``, or an earlier start in the same document; strings are judged on
    the input (UTF-8), may overlap, and never cross documents. ``size`` is at least ``_INNER`` and has
    a divisor from 16 to 64. Returns ``doc_id``, ``kept`` (the remaining bytes, which may end inside
    a character), ``n_bytes``, ``n_removed`` and ``spans`` (maximal removed runs of byte positions,
    end exclusive); other columns are left out. A null text is empty; an empty or short text keeps
    all. Null ids come after all others, and rows sharing an id follow one another in the order of
    their chunks' contents, which is the same as long as the table is read in the same splits: equal rows
    lose all strings but those of the first. An empty table gives an empty
    result. A task holds one chunk, or one text if that is longer, at about 100 bytes per byte.
    """
    from vantage.llm.suffix_arrays import step_of

    step = step_of(size)
    if size < _INNER:
        raise ValueError(f"size must be at least {_INNER}")
    spark = docs.sparkSession
    manifest = write_chunks(docs, "suffix-chunks", chunk_bytes)
    n_chunks, n_bytes = manifest.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    manifest = _without_copies(manifest, size)
    bits = bucket_bits(n_bytes * 2 / (_INNER - _GRAM + 2))
    piece_bits = bucket_bits(n_bytes, 2 << 20)

    folder = scratch(spark, "suffix-answers")

    def kept_anchors(address: str) -> str:
        return f"{folder}/anchors/{address.rpartition('#')[0].rpartition('/')[2]}"

    def anchors(path: str):
        own = _Chunk(path)
        own.keep(kept_anchors(path))
        return own.hashes

    def send(table):
        import numpy as np
        import pyarrow as pa

        from vantage.llm.hashing import window_hashes
        from vantage.llm.suffix_arrays import gram_ranks, suffix_ranks

        address = path_of(table)
        own = _Chunk(address, kept_anchors(address))
        codes = received(table, "count")
        held, repeats = own.looked_up(codes)
        span = size - _INNER + 1
        none = np.zeros(0, np.int64)
        first, gone = none, none
        if len(held) >= span:
            able = own.left[:len(held) - span + 1] >= size
            open_ = np.flatnonzero(able & _all_of(repeats, span))
            if len(open_):
                cover = np.zeros(len(own.data) + 1, np.int32)
                cover[open_] += 1
                cover[open_ + size] -= 1
                kept = np.cumsum(cover, dtype=np.int32)[:-1] > 0
                compact = np.cumsum(kept, dtype=np.int32)[open_] - 1
                text = own.data[kept]
                grams = gram_ranks(text, np.arange(len(text), 0, -1), step)
                # each suffix's rank by ``size`` bytes; the smallest position of a rank is its first
                rank = suffix_ranks(grams, step, size)[compact]
                at = np.full(int(rank.max()) + 1, -1)
                at[rank[::-1]] = np.arange(len(rank))[::-1]  # the smallest position of a rank is written last
                again = np.ones(len(open_), bool)
                again[at[at >= 0]] = False
                gone = open_[again]
                first = open_[~again]
                first = first[_all_of(held >= 2, span)[first]]
        rows = {n: [] for n in ("bucket", "text", "lens", "doc")}
        starts, lens = none, none
        if len(first):
            least = _sliding(np.repeat(own.place, own.runs), span, np.minimum)[first]  # places are in hash order
            new = np.concatenate(([True], least[1:] != least[:-1]))
            hot, route = codes[least] >= _HOT, own.hashes[least]
            if hot.any():
                route[hot] = window_hashes(own.data, size)[first[hot]]
            cut = np.concatenate(([True], (first[1:] != first[:-1] + 1) | new[1:] | hot[1:] | hot[:-1]))
            run = np.arange(len(first)) - np.maximum.accumulate(np.where(cut, np.arange(len(first)), 0))
            cut |= run % size == 0  # a piece may end anywhere: each string is whole in one
            cuts = np.flatnonzero(cut)
            starts, lens = first[cuts], np.diff(np.append(cuts, len(first))) + size - 1
            bucket = (route[cuts] >> np.uint64(64 - piece_bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            starts, lens, bucket = starts[order], lens[order], bucket[order]
            doc = np.asarray(own.ids, np.int64)[np.searchsorted(own.ends, starts, "right")]
            edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
            for a, b in zip(edges[:-1], edges[1:]):
                rows["bucket"].append(int(bucket[a]))
                rows["text"].append(_gathered(own.data, starts[a:b], lens[a:b]).tobytes())
                rows["lens"].append(lens[a:b].astype(np.int32).tobytes())
                rows["doc"].append(doc[a:b].tobytes())
        # a row for pass 3: the strings that repeat inside the chunk, and the sent ones in their order;
        # it goes through the exchange as a bucket of its own
        flags = np.zeros(len(own.data), bool)
        flags[gone] = True
        state = [x.astype(np.int64).tobytes() for x in (*_ranges(flags), starts, lens)]
        n = len(rows["bucket"])
        chunk = table.column("chunk")[0].as_py()
        return pa.table({
            "chunk": pa.array([chunk] * (n + 1), pa.string()),
            "bucket": pa.array(rows["bucket"] + [-1 - int(chunk[:8], 16) % (1 << piece_bits)], pa.int32()),
            **{k: pa.array(rows[k] + [None], pa.binary()) for k in ("text", "lens", "doc")},
            "state": pa.array([None] * n + [state], pa.list_(pa.binary()))})

    def merge(key, table):
        import numpy as np
        import pyarrow as pa

        from vantage.llm.suffix_arrays import merged_classes

        if table.column("bucket")[0].as_py() < 0:
            return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                             "codes": pa.nulls(table.num_rows, pa.binary()), "state": table.column("state")})
        table = table.take(pa.array(np.argsort(np.array(table.column("chunk").to_pylist()))))
        lens = [np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in table.column("lens")]
        # pieces are cut by their content, so a passage is the same pieces in every chunk: each takes part once
        known: dict[bytes, int] = {}
        piece, shards = [], []
        for text, own in zip(table.column("text"), lens):
            text, a, new = text.as_py(), 0, []
            for b in np.cumsum(own).tolist():
                part, a = text[a:b], b
                at = known.get(part)
                if at is None:
                    at = known[part] = len(known)
                    new.append(part)
                piece.append(at)
            if new:
                shards.append(np.frombuffer(b"".join(new), np.uint8))
        docs_ = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("doc")])
        strings = np.array([int((x - size + 1).sum()) for x in lens])
        count = np.concatenate(lens) - size + 1
        flat = np.fromiter(map(len, known), np.int64, len(known))
        start = (np.cumsum(flat) - flat)[piece]
        at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        group = merged_classes(shards, size)[at]
        # the first of a class has the smallest document, then the smallest place
        doc = np.repeat(np.searchsorted(np.sort(docs_), docs_), count)
        key = doc << 32 | np.arange(len(at))
        low = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, key)
        later = (key != low[group]).astype(np.uint8)
        ends = np.cumsum(strings)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"),
                         "codes": pa.array([later[b - n:b].tobytes() for n, b in zip(strings, ends)], pa.binary()),
                         "state": pa.nulls(table.num_rows, pa.list_(pa.binary()))})

    def remove(table):
        import numpy as np
        import pyarrow as pa

        ids, texts, copies = _texts(path_of(table))
        a, b, starts, lens = (np.frombuffer(x, np.int64) for x in next(
            x for x in table.column("state").to_pylist() if x is not None))
        count = lens - size + 1
        at = np.repeat(starts - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        at = at[received(table, "later").astype(bool)]
        total = sum(map(len, texts))
        cover = np.zeros(total + 1, np.int64)
        np.add.at(cover, a, 1)
        np.add.at(cover, b + size - 1, -1)
        cover[at] += 1
        cover[at + size] -= 1
        out = np.cumsum(cover)[:total] > 0
        data = np.frombuffer(b"".join(texts), np.uint8)
        kept, removed, spans, end = [], [], [], 0
        for i, text in enumerate(texts):
            start, end = end, end + len(text)
            if i in copies:
                removed.append(len(copies[i]))
                kept.append(b"")
                spans.append([{"start": 0, "end": len(copies[i])}])
                continue
            mask = out[start:end]
            n = int(mask.sum())
            removed.append(n)
            kept.append(data[start:end][~mask].tobytes() if n else text)
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(*_ranges(mask))] if n else [])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": pa.array([None if i == _LAST else i for i in ids], pa.int64()),
                         "kept": pa.array(kept, pa.binary()), "n_bytes": pa.array([len(copies.get(i, t)) for i, t in enumerate(texts)], pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, kind)})

    counted = _kept(count_chunks(manifest, n_chunks, bits, anchors), f"{folder}/count")
    # the exchange between the two steps is the only copy of the pieces' text
    sent = dealt(by_chunk(manifest, {"count": counted}), "chunk", n_chunks).groupBy("chunk").applyInArrow(
        send, "chunk string, bucket int, text binary, lens binary, doc binary, state array<binary>")
    later = _kept(dealt(sent, "bucket", 1 << piece_bits, 2).groupBy("bucket").applyInArrow(
        merge, "chunk string, bucket int, codes binary, state array<binary>"), f"{folder}/later")
    for name in ("count", "anchors"):
        delete_path(spark, f"{folder}/{name}")  # read by nothing any more
    rows = by_chunk(manifest, {"later": later.where("bucket >= 0")}).withColumn("state", F.lit(None).cast("array<binary>"))
    rows = rows.unionByName(later.where("bucket < 0").select("chunk", "state"), allowMissingColumns=True)
    return dealt(rows, "chunk", n_chunks).groupBy("chunk").applyInArrow(
        remove, "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>")


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
