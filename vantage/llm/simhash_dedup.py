"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where over half of its shingles' 64-bit hashes have it. Documents
with one fingerprint are one class, so copies cost one row from then on. The fingerprint is cut into
segments; if two fingerprints differ in ``distance`` bits or fewer, they differ in few bits of some
segment (``segment_plan``). Every class stands in each segment's table under its own value, and looks
up the values of a small Hamming ball around it. Of two classes the one with the smaller value looks
the other up, so a pair meets once; what meets is compared over all 64 bits.

Only connection matters, so no group of near copies is compared pair by pair. First every table entry
has a hub (its smallest fingerprint) that all who meet there are compared with, and each class stands
for the smallest hub it is near: links in proportion to rows. Only entries where classes that stand for
different ones still meet are compared exhaustively, and their links are reported between those.
An entry with many classes is cut into blocks; a task compares two blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import ship, slices, with_classes, written
from vantage.llm.components import connected_components

_SLICE = 1 << 22  # bytes of a text that are cut into words at a time
_SEED = 42


def shingle_hashes(data: bytes, size: int, step: int = _SLICE) -> Iterator:
    """XXH64 of every ``size``-word shingle of a lower-cased text, repeats included, in arrays of bounded size."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest
    held: list[bytes] = []
    sent = False
    for part in slices(data, step):
        held += part.split()  # of bytes: ASCII blanks only
        if len(held) < size:
            continue
        joined = b" ".join(held)
        ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(held) - size + 1].tolist()
        yield np.fromiter((digest(joined[a:b], _SEED) for a, b in zip(starts, ends[size - 1:].tolist())), np.uint64, len(starts))
        sent = True
        held = held[len(held) - size + 1:] if size > 1 else []
    if held and not sent:
        yield np.array([digest(b" ".join(held), _SEED)], np.uint64)


def bit_counts(hashes):
    """How many of the hashes have each of the 64 bits set, lowest bit first."""
    import numpy as np

    rows = 255  # as many as an unsigned byte can count
    padded = np.zeros(-(-len(hashes) // rows) * rows, "<u8")
    padded[:len(hashes)] = hashes
    bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(-1, rows, 64)
    return bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def simhash(data: bytes, size: int, step: int = _SLICE) -> int:
    """The fingerprint of a lower-cased text as an unsigned 64-bit integer; zero without words."""
    import numpy as np

    counts, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(data, size, step):
        counts += bit_counts(hashes)
        n += len(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """(doc_id, fp) for every row: the fingerprint's 64 bits as a signed long."""
    ship(docs.sparkSession)

    def mark(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = np.fromiter((simhash((t.as_py() or b"").lower(), size) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(mark, "doc_id long, fp long")


def segment_plan(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(lowest bit, width, radius) of each segment.

    With a = distance div segments, a pair within ``distance`` has a segment within its radius if the
    first ``distance - a * segments + 1`` segments allow a bits and the others a - 1 (radius -1: the
    segment is not needed).
    """
    a = distance // segments
    full = distance - a * segments + 1
    cuts = [round(64 * i / segments) for i in range(segments + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], a if i < full else a - 1) for i in range(segments)]


def _masks(width: int, radius: int) -> list[int]:
    """The bit patterns of up to ``radius`` differences in ``width`` bits, none first."""
    return [sum(1 << i for i in bits) for r in range(radius + 1) for bits in itertools.combinations(range(width), r)]


def _meetings(classes: DataFrame, distance: int, segments: int) -> DataFrame:
    """(seg, value, fp, home): where each class stands (home) and which larger values of its balls it looks up."""
    parts = None
    own, mask = F.col("own"), F.col("mask")
    for i, (low, width, radius) in enumerate(segment_plan(distance, segments)):
        if radius < 0:
            continue
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        ball = F.lit(_masks(width, radius)).cast("array<bigint>")
        part = classes.select("fp", value.alias("own"), F.explode(ball).alias("mask")).where(own.bitwiseXOR(mask) >= own)
        part = part.select(F.lit(i).alias("seg"), own.bitwiseXOR(mask).alias("value"), "fp", (mask == 0).alias("home"))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _component_links(met: DataFrame, distance: int, block_rows: int, pack_rows: int) -> DataFrame:
    """Distinct (a, b): ``comp`` values of which two classes that meet are near. ``met`` has seg, value, fp, home, comp."""
    sizes = met.groupBy("seg", "value").agg(F.count("*").alias("rows"), F.max("home").alias("known"),
                                            F.min("comp").alias("low"), F.max("comp").alias("high"))
    sizes = written(sizes.where("known and low <> high")
                    .select("seg", "value", "rows", F.ceil(F.col("rows") / block_rows).cast("int").alias("blocks")), "simhash-open")
    total = sizes.agg(F.coalesce(F.sum(F.when(F.col("blocks") == 1, F.col("rows"))), F.lit(0))).first()[0]
    packs = -(-total // pack_rows) or 1
    placed = met.join(sizes.select("seg", "value", "blocks"), ["seg", "value"])
    single = F.col("blocks") == 1  # entries of one block share tasks
    placed = placed.withColumn("block", F.when(single, F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("blocks"))).cast("int"))
    placed = placed.withColumn("other", F.explode(F.when(single, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
    placed = placed.select(F.when(single, F.pmod(F.xxhash64("seg", "value"), F.lit(packs)).cast("int")).alias("pack"),
                           F.when(~single, F.col("seg")).alias("part"), F.when(~single, F.col("value")).alias("entry"),
                           F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                           "seg", "value", "block", "fp", "home", "comp")

    def compare(table):
        import numpy as np
        import pyarrow as pa

        seg, value, block, fp, home, comp, i, j = (
            table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
            for c in ("seg", "value", "block", "fp", "home", "comp", "i", "j"))
        order = np.lexsort((~home.astype(bool), value, seg))  # those at home first
        seg, value, block, fp, home, comp = (x[order] for x in (seg, value, block, fp, home, comp))
        fp = fp.view(np.uint64)
        new = np.ones(len(fp), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (value[1:] != value[:-1])
        ends = np.append(np.flatnonzero(new)[1:], len(fp))[np.cumsum(new) - 1]
        first = np.flatnonzero(home.astype(bool) & (ends - np.arange(len(fp)) > 1))
        across = bool(i[0] != j[0])
        pairs, step = [np.zeros((0, 2), np.int64)], 1
        while len(first):
            second = first + step
            near = np.bitwise_count(fp[first] ^ fp[second]) <= distance
            near &= comp[first] != comp[second]
            if across:
                near &= block[first] != block[second]
            if near.any():
                pairs.append(np.unique(np.sort(np.stack((comp[first[near]], comp[second[near]]), 1), 1), axis=0))
            if len(pairs) > 64:
                pairs = [np.unique(np.concatenate(pairs), axis=0)]
            step += 1
            first = first[first + step < ends[first]]
        found = np.unique(np.concatenate(pairs), axis=0)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})

    return placed.groupBy("pack", "part", "entry", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def link_components(docs: DataFrame, size: int = 4, distance: int = 4, segments: int | None = None,
                    block_rows: int = 4096, pack_rows: int = 200_000) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Words lie between ASCII blanks, A-Z lower-cased; shingles are ``size`` words joined by one space,
    repeats included (a shorter text: all its words). Rows link when their fingerprints (16 hex digits)
    differ in ``distance`` bits or fewer; ``component_id`` is the smallest ``doc_id`` reachable by links,
    itself included. ``segments`` is the number of segments: by default three, from 2^25 distinct fingerprints
    on two, whose tables have more rows and fewer chance meetings. The result is the same.

    A null, empty or blank text has fingerprint zero and links like any other. Rows with a null id take
    part and get the smallest id they reach, or null. Rows sharing an id are separate documents that
    only have the id in common. A text of any length is read in slices. Other columns are left out. An
    empty table gives an empty result.
    """
    rows = written(fingerprints(docs, size), "simhash-rows")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-classes")
    if segments is None:
        segments = 3 if classes.count() <= 1 << 25 else 2
    met = written(_meetings(classes.select("fp"), distance, segments), "simhash-met")

    hubs = met.where("home").groupBy("seg", "value").agg(F.min("fp").alias("hub"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= distance
    own = (met.join(hubs, ["seg", "value"]).where((F.col("hub") < F.col("fp")) & near)
           .groupBy("fp").agg(F.min("hub").alias("hub")))
    own = written(own, "simhash-hubs")
    # a class stands for the smallest hub it is near, and that one for its own
    comp = own.join(own.select(F.col("fp").alias("hub"), F.col("hub").alias("next")), "hub", "left").select(
        "fp", F.coalesce("next", "hub").alias("comp"))
    comp = written(comp, "simhash-comps")
    known = met.join(comp, "fp", "left").select("seg", "value", "fp", "home", F.coalesce("comp", "fp").alias("comp"))
    links = comp.select(F.col("fp").alias("a"), F.col("comp").alias("b")).unionByName(
        _component_links(written(known, "simhash-known"), distance, block_rows, pack_rows))
    label = written(connected_components(links, "simhash-components"), "simhash-labels")

    named = classes.join(label, F.col("fp") == F.col("node"), "left").select("fp", "low", "n", F.coalesce("component", "fp").alias("comp"))
    named = written(named, "simhash-named")
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    of = written(named.join(lowest, "comp").select("fp", "n", "component_id"), "simhash-lowest")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return with_classes(rows, of, "fp").select("doc_id", digits, "component_id")
