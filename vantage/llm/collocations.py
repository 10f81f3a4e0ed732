"""Phrase collocations by weighted acyclic automata.

Texts are cut into shards of bounded size; a shard's words are numbered and its token numbers kept in a
file. The automaton that counts phrases grows by one layer (one word) a round. The first layer, the words
themselves, is united by hash: words have no common order yet. From then on each shard builds its
layer from its sorted n-grams, taking only n-grams whose two shorter parts are frequent: a phrase is at
most as frequent as its parts, so nothing that counts is left out. The shards' layers are cut at common
bounds into prefix ranges; a range's task unites them, sums the weights of equal arcs, keeps the frequent
ones and numbers them. Every shard is told the states its n-grams have reached, and goes on from there.

The parts of a phrase are looked up by following the automaton: its first words lie on the phrase's own
path, and its last words on the path of the state without the first word, which each arc points back to.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.base import delete_path, scratch, ship, slices, written
from vantage.llm.chunks import by_chunk, dealt, open_table, save_chunk

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_MARK = b"\xff"  # in no UTF-8 text
_TABLE = bytes.maketrans(_BREAKS, _MARK * len(_BREAKS))
_SLICE = 1 << 22


def pieces(data: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a mark where a piece ends."""
    return data.lower().translate(_TABLE).replace(_MARK, b" " + _MARK + b" ").split()  # only spaces and tabs are left


def _packed(values) -> bytes:
    """An array of integers for the exchange, compressed."""
    import pyarrow as pa

    return len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind: str):
    import numpy as np
    import pyarrow as pa

    size = int.from_bytes(blob[:8], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True), kind)


def _save(uri: str, *arrays) -> None:
    """Arrays of integers as one file."""
    import pyarrow as pa

    save_chunk(uri, pa.table({f"a{i}": pa.array([_packed(x)], pa.large_binary()) for i, x in enumerate(arrays)}))


def _arrays(uri: str, *kinds: str):
    """The first arrays of a file; ``kinds`` are their types."""
    table = open_table(uri)
    return [_unpacked(table.column(f"a{i}")[0].as_py(), k) for i, k in enumerate(kinds)]


def shards(docs: DataFrame, folder: str, shard_bytes: int) -> DataFrame:
    """Writes each shard's token numbers (-1: a piece ends) below ``folder``; its words (chunk, at, words, n).

    A row has the words numbered from ``at`` on, as language, tab and word, and their counts.
    """
    ship(docs.sparkSession)

    def tokenise(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa

        class Numbers(dict):
            """Token numbers of one language; all languages of a shard count on."""

            def __missing__(self, word):
                at = self[word] = len(names)
                names.append(self.lead + word)
                return at

        names: list = []
        numbers: dict = {}
        tokens: list = []
        size = 0

        def flush():
            chunk = uuid.uuid4().hex
            ids = np.concatenate(tokens)
            _save(f"{folder}/tokens/{chunk}.parquet", ids.astype("<i4"))
            n = np.bincount(ids[ids >= 0], minlength=len(names)).astype("<i8")
            step = 50_000
            starts = range(0, len(names), step)
            words = [pa.array(names[a:a + step], pa.binary()).cast(pa.string()) for a in starts]
            ends = np.cumsum([0, *map(len, words)]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(words)), pa.array(list(starts), pa.int32()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(words)),
                 pa.array([n[a:a + step].tobytes() for a in starts], pa.binary())], ["chunk", "at", "words", "n"])

        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for lang, text in zip(batch.column(0).to_pylist(), texts):
                if lang not in numbers:
                    numbers[lang] = Numbers({_MARK: -1})
                    numbers[lang].lead = f"{lang}\t".encode()
                number = numbers[lang].__getitem__
                for data in slices(text.as_py() or b"", _SLICE):
                    words = pieces(data)
                    tokens.append(np.fromiter(map(number, words), np.int32, len(words)))
                    size += len(data)
                tokens.append(np.array([-1], np.int32))
                if size >= shard_bytes:
                    if names:
                        yield flush()
                    names, numbers, tokens, size = [], {}, [], 0
        if names:
            yield flush()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(tokenise, "chunk string, at int, words array<string>, n binary")


def _words(shard_words: DataFrame, least: int, bucket_words: int) -> DataFrame:
    """Unites the shards' words by hash bucket.

    Rows (bucket, chunk, at, codes): the shard's frequent words of a bucket and their numbers among the bucket's
    frequent ones; and per bucket a row without chunk: ``words`` and ``counts`` of the frequent ones, and
    the occurrences of all its words by language (``langs``, ``sums``).
    """
    total = shard_words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    n_buckets = max(1, -(-total // bucket_words))

    def send(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(2)[i].values.cast(pa.binary()).to_pylist()
                n, at = np.frombuffer(batch.column(3)[i].as_py(), "<i8"), batch.column(1)[i].as_py()
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n_buckets
                order = np.argsort(bucket, kind="stable")
                found, starts = np.unique(bucket[order], return_index=True)
                ends = np.append(starts[1:], len(order))
                own = [words[k] for k in order.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.astype(np.int32)), pa.array([batch.column(0)[i].as_py()] * len(found)),
                     pa.array([_packed((order[a:b] + at).astype("<i4")) for a, b in zip(starts, ends)], pa.binary()),
                     pa.array([_packed(n[order[a:b]].astype("<u4")) for a, b in zip(starts, ends)], pa.binary()),
                     pa.array([_packed(np.frombuffer(_MARK.join(own[a:b]), np.uint8)) for a, b in zip(starts, ends)], pa.binary())],
                    ["bucket", "chunk", "at", "n", "words"])

    def unite(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = [_unpacked(x.as_py(), "u1").tobytes().split(_MARK) for x in table.column("words")]
        held = pa.array([w for own in lists for w in own], pa.binary()).cast(pa.string()).dictionary_encode()
        code, known = held.indices.to_numpy(), held.dictionary
        n = np.concatenate([_unpacked(x.as_py(), "<u4") for x in table.column("n")])
        sums = np.zeros(len(known), np.int64)
        np.add.at(sums, code, n)
        langs: dict[str, int] = {}
        for word, own in zip(known.to_pylist(), sums.tolist()):
            lang = word.rpartition("\t")[0]
            langs[lang] = langs.get(lang, 0) + own
        frequent = np.flatnonzero(sums >= least)
        frequent = frequent[pc.sort_indices(known.take(pa.array(frequent))).to_numpy()]
        number = np.full(len(known), -1, np.int64)
        number[frequent] = np.arange(len(frequent))
        code = number[code]
        ends = np.cumsum([len(own) for own in lists])
        at, codes = [], []
        for a, b, x in zip(np.concatenate(([0], ends[:-1])), ends, table.column("at")):
            own = np.flatnonzero(code[a:b] >= 0)
            at.append(_unpacked(x.as_py(), "<i4")[own].tobytes())
            codes.append(code[a:b][own].astype("<i4").tobytes())
        rows = table.num_rows
        return pa.table({
            "bucket": pa.array([table.column("bucket")[0].as_py()] * (rows + 1), pa.int32()),
            "chunk": pa.array(table.column("chunk").to_pylist() + [None], pa.string()),
            "at": pa.array(at + [None], pa.binary()), "codes": pa.array(codes + [None], pa.binary()),
            "words": pa.array([None] * rows + [known.take(pa.array(frequent)).to_pylist()], pa.list_(pa.string())),
            "counts": pa.array([None] * rows + [sums[frequent].tolist()], pa.list_(pa.int64())),
            "langs": pa.array([None] * rows + [list(langs)], pa.list_(pa.string())),
            "sums": pa.array([None] * rows + [list(langs.values())], pa.list_(pa.int64()))})

    sent = shard_words.mapInArrow(send, "bucket int, chunk string, at binary, n binary, words binary")
    return written(dealt(sent, "bucket", n_buckets, 1).groupBy("bucket").applyInArrow(
        unite, "bucket int, chunk string, at binary, codes binary, words array<string>, counts array<bigint>, "
               "langs array<string>, sums array<bigint>"), "phrase-words")


def _bases(united: DataFrame, size, count: int) -> list[int]:
    """The first number of every part, and the total; ``size`` is that of a part's row without chunk."""
    sizes = {r.bucket: r.n for r in united.where("chunk IS NULL").select("bucket", size.cast("long").alias("n")).collect()}  # one row per part
    bases = [0]
    for i in range(count):
        bases.append(bases[-1] + sizes.get(i, 0))
    return bases


_LAYER = "chunk string, n_arcs long, sample array<bigint>"


def _next_layer(folder: str, chunk: str, level: int, at, state, word, every: int):
    """Saves the layer of ``level + 1``-word n-grams: both parts of a phrase of one word more have to be frequent.

    ``at``: positions of the shard's frequent ``level``-word n-grams in order, with their states and last words.
    """
    import numpy as np
    import pyarrow as pa

    from vantage.llm import count_transducer as ct

    near = np.flatnonzero(at[1:] == at[:-1] + 1) if len(at) else np.zeros(0, np.int64)
    arcs, weights, back, which = ct.build(ct.pack(state[near], word[near + 1]), state[near + 1])
    # places and arcs ascend, so their steps are kept; a shard has fewer than 2^32 words
    _save(f"{folder}/grams-{level + 1}/{chunk}.parquet", np.diff(at[near], prepend=0).astype("<u4"), which.astype("<i4"))
    _save(f"{folder}/arcs-{level + 1}/{chunk}.parquet", np.diff(arcs, prepend=0).astype("<i8"), weights.astype("<u4"),
          back[:0] if level == 1 else back)  # a word's state has its number
    return pa.table({"chunk": pa.array([chunk]), "n_arcs": pa.array([len(arcs)], pa.int64()),
                     "sample": pa.array([arcs[every // 2::every]], pa.list_(pa.int64()))})


def _first_layer(united: DataFrame, bases: list[int], folder: str, n_chunks: int, every: int) -> DataFrame:
    """Each shard learns the numbers of its frequent words and builds its layer of two-word n-grams."""

    def receive(table):
        import numpy as np

        chunk = table.column("chunk")[0].as_py()
        token, = _arrays(f"{folder}/tokens/{chunk}.parquet", "<i4")
        number = np.full(max(int(token.max(initial=-1)) + 2, 1), -1, np.int64)  # the last one is that of -1
        for bucket, at, codes in zip(table.column("bucket").to_pylist(), table.column("at"), table.column("codes")):
            number[np.frombuffer(at.as_py(), "<i4")] = np.frombuffer(codes.as_py(), "<i4") + bases[bucket]
        state = number[token]
        held = np.flatnonzero(state >= 0)
        return _next_layer(folder, chunk, 1, held.astype(np.int64), state[held], state[held], every)

    found = united.where("chunk IS NOT NULL").select("chunk", "bucket", "at", "codes")
    return dealt(found, "chunk", n_chunks, 1).groupBy("chunk").applyInArrow(receive, _LAYER)


def _united(layer: DataFrame, folder: str, level: int, least: int, range_arcs: int) -> tuple[DataFrame, list[int]]:
    """Unites the shards' layers by prefix range.

    Rows (range, chunk, codes): for each arc a shard has in a range the arc's number among the range's frequent
    ones or -1; and per range a row without chunk: arcs, weights and back links of its frequent ones. Also the
    first state number of every range.
    """
    n_chunks, n_arcs = layer.agg(F.count("*"), F.coalesce(F.sum("n_arcs"), F.lit(0))).first()
    n_ranges = max(1, -(-n_arcs // range_arcs))
    bounds: list[int] = []
    if n_ranges > 1:
        shares = [i / n_ranges for i in range(1, n_ranges)]
        cuts = layer.select(F.explode("sample").alias("arc")).agg(
            F.percentile_approx("arc", shares, F.lit(max(10_000, 20 * n_ranges))).alias("cuts")).first()[0]
        bounds = sorted(set(cuts or []))

    def send(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from vantage.llm import count_transducer as ct

        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                steps, weights, back = _arrays(f"{folder}/arcs-{level}/{chunk}.parquet", "<i8", "<u4", "<i8")
                arcs, back = np.cumsum(steps), back if level > 2 else None
                cuts = ct.cut(arcs, np.array(bounds, np.int64))
                full = [(i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                for k in range(0, len(full), 64):
                    part = full[k:k + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i for i, _, _ in part], pa.int32()), pa.array([chunk] * len(part)),
                         pa.array([_packed(np.diff(arcs[a:b], prepend=0)) for _, a, b in part], pa.binary()),
                         pa.array([_packed(weights[a:b]) for _, a, b in part], pa.binary()),
                         pa.array([None if back is None else _packed(back[a:b]) for _, a, b in part], pa.binary())],
                        ["range", "chunk", "arcs", "weights", "back"])

    def unite(table):
        import numpy as np
        import pyarrow as pa

        from vantage.llm import count_transducer as ct

        layers = []
        for a, w, k in zip(*(table.column(c).to_pylist() for c in ("arcs", "weights", "back"))):
            arcs = np.cumsum(_unpacked(a, "<i8"))
            layers.append((arcs, _unpacked(w, "<u4"), ct.word_of(arcs) if k is None else _unpacked(k, "<i8")))
        arcs, weights, back = ct.union(layers, least)
        own = table.column("range")[0].as_py()
        codes = [ct.find(arcs, x[0]).astype(np.int32).tobytes() for x in layers]
        n = len(layers)
        blobs = {k: pa.array([None] * n + [x.tobytes()], pa.binary()) for k, x in (("arcs", arcs), ("weights", weights), ("back", back))}
        return pa.table({"bucket": pa.array([own] * (n + 1), pa.int32()),
                         "chunk": pa.array(table.column("chunk").to_pylist() + [None], pa.string()),
                         "codes": pa.array(codes + [None], pa.binary()), **blobs})

    sent = layer.select("chunk").repartition(max(1, n_chunks)).mapInArrow(
        send, "range int, chunk string, arcs binary, weights binary, back binary")
    united = dealt(sent, "range", n_ranges, 1).groupBy("range").applyInArrow(
        unite, "bucket int, chunk string, codes binary, arcs binary, weights binary, back binary")
    united = written(united, "phrase-ranges")
    return united, _bases(united, F.length("arcs") / 8, len(bounds) + 1)


def _grown(manifest: DataFrame, united: DataFrame, bases: list[int], folder: str, level: int, n_chunks: int, every: int) -> DataFrame:
    """Each shard learns the states its ``level``-word n-grams have reached and builds its next layer."""

    def receive(table):
        import numpy as np

        from vantage.llm import count_transducer as ct

        chunk = table.column("chunk")[0].as_py()
        own = sorted((b, c) for b, c in zip(table.column("bucket").to_pylist(), table.column("codes").to_pylist()) if c is not None)
        codes = [np.frombuffer(c, np.int32).astype(np.int64) for _, c in own]
        states = [np.where(c >= 0, c + bases[b], -1) for (b, _), c in zip(own, codes)]
        reached = np.concatenate(states) if states else np.zeros(0, np.int64)
        steps, arc = _arrays(f"{folder}/grams-{level}/{chunk}.parquet", "<u4", "<i4")
        at = np.cumsum(steps, dtype=np.int64)
        arcs = np.cumsum(_arrays(f"{folder}/arcs-{level}/{chunk}.parquet", "<i8")[0])
        held = np.flatnonzero(reached[arc] >= 0)
        return _next_layer(folder, chunk, level, at[held], reached[arc[held]], ct.word_of(arcs[arc[held]]), every)

    rows = by_chunk(manifest.select("chunk", F.lit(folder).alias("path")), {"codes": united.where("chunk IS NOT NULL")})
    return dealt(rows, "chunk", n_chunks, 1).groupBy("chunk").applyInArrow(receive, _LAYER)


def _states(united: DataFrame, bases: list[int]) -> DataFrame:
    """(id, start, back, word, a): a layer's frequent arcs by the number of the state they lead to."""

    def spread(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from vantage.llm import count_transducer as ct

        for batch in batches:
            for own, *blobs in zip(*[c.to_pylist() for c in batch.columns]):
                arcs, weights, back = (np.frombuffer(x, np.int64) for x in blobs)
                ids = bases[own] + np.arange(len(arcs), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, ct.start_of(arcs), back, ct.word_of(arcs), weights)],
                                                 ["id", "start", "back", "word", "a"])

    return united.where("chunk IS NULL").select("bucket", "arcs", "weights", "back").mapInArrow(
        spread, "id long, start long, back long, word long, a long")


def _counted(states: DataFrame, shorter: DataFrame) -> DataFrame:
    """The states of a layer with the counts of their phrases' first (heads) and last words (tails).

    Composition with the layer before: the start state is the phrase without its last word, the back link
    the phrase without its first.
    """
    head = shorter.select(F.col("id").alias("start"), "lang", F.col("heads").alias("_heads"))
    tail = shorter.select(F.col("id").alias("back"), F.col("tails").alias("_tails"))
    return states.join(head, "start").join(tail, "back").select(
        "id", "start", "back", "word", "lang", "a", F.concat("_heads", F.array("a")).alias("heads"),
        F.concat("_tails", F.array("a")).alias("tails"))


def _scored(phrases: DataFrame, longer: DataFrame | None, percent: int, totals: DataFrame) -> DataFrame:
    """Candidates of one length that no longer one makes superfluous, with their lowest cut.

    If any longer candidate that holds a phrase is frequent enough, so is one that is longer by one word:
    it leads on from the phrase's state, or points back to it.
    """
    if longer is not None:
        most = longer.select(F.col("start").alias("id"), "a").unionByName(longer.select(F.col("back").alias("id"), "a"))
        most = most.groupBy("id").agg(F.max("a").alias("_most"))
        phrases = phrases.join(most, "id", "left").where(
            F.col("_most").isNull() | (100 * F.col("_most") < percent * F.col("a")))
    # products of counts may pass 64 bits: decimals of 38 digits hold 1000 * a * n and l * r exactly
    cuts = F.expr("""array_min(transform(sequence(1, size(heads) - 1), k -> named_struct(
        'score', (1000BD * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)))
                 div (cast(heads[k - 1] as decimal(19, 0)) * cast(tails[size(heads) - k - 1] as decimal(19, 0))),
        'k', k, 'l', heads[k - 1], 'r', tails[size(heads) - k - 1])))""")
    # one row per language of the corpus: joined as Spark sees fit
    return phrases.join(totals, "lang").withColumn("_cut", cuts).select(
        "lang", "start", "word", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))


def _best(rows: DataFrame, top: int, rank, order: list, salt: str) -> DataFrame:
    """Rows with a ``rank`` of up to ``top`` in their language: in salted parts first, so that no task ranks all of one."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(64)))
    for keys in (["lang", "_salt"], ["lang"]):
        placed = rank.over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        rows = rows.withColumn("rank", placed).where(F.col("rank") <= top)
    return rows.drop("_salt")


def _spelled(rows: DataFrame, layers: dict[int, DataFrame], words: DataFrame) -> DataFrame:
    """The phrases of ``rows`` (length, start, word): from each state back along its path to the root."""
    rows = rows.withColumn("phrase", F.lit(None).cast("string"))
    carried = None
    for length in range(max(layers), 0, -1):
        own = rows.where(F.col("length") == length)
        own = own if carried is None else carried.unionByName(own)
        own = own.join(words.select(F.col("id").alias("word"), F.col("word").alias("_word")), "word")
        own = own.withColumn("phrase", F.concat_ws(" ", "_word", "phrase")).drop("word", "_word")
        if length > 1:  # the start state is the phrase without its last word; that of one word has the word's number
            path = (layers[length - 1].select("id", "start", "word") if length > 2
                    else words.select("id", F.lit(None).cast("long").alias("start"), F.col("id").alias("word")))
            own = own.withColumnRenamed("start", "id").join(path, "id").drop("id")
        carried = own
    return carried.drop("length", "start")


def top_phrases(docs: DataFrame, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000,
                shard_bytes: int = 16 << 20, bucket_words: int = 400_000, range_arcs: int = 500_000,
                sample_every: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest`` words.

    Texts, A-Z lower-cased, are split into pieces at ``.,;:!?`` and line ends, those into words at spaces
    and tabs. n counts the words of the language, a the phrase inside pieces, overlaps included (``least``
    or more). Cut after k words, a phrase scores floor(1000 * a * n / (l * r)) with the counts l and r of
    its two parts; the lowest cut counts, of equal ones the first. A phrase goes if a candidate of up to
    ``longest`` words holds it and has ``percent`` of its count or more. Order: score and a descending,
    phrase ascending by UTF-8 bytes.

    A null language is ``und``; a null or empty text has no words. Repeated rows and rows sharing an id
    count as often as they stand. A text is cut into words in slices, but it is never spread over two
    shards. Other columns are left out. An empty table gives an empty result. The automaton holds up to
    2^28 frequent words and 2^35 frequent phrases of a length; more are an error.
    """
    from vantage.llm import count_transducer as ct

    spark = docs.sparkSession
    folder, kept = scratch(spark, "phrase-shards"), scratch(spark, "phrase-shard-words")
    found = shards(docs, folder, shard_bytes)
    found.write.option("compression", "zstd").parquet(kept)
    shard_words = spark.read.schema(found.schema).parquet(kept)
    manifest = written(shard_words.select("chunk").distinct(), "phrase-manifest")
    n_chunks = max(1, manifest.count())
    united = _words(shard_words, least, bucket_words)
    delete_path(spark, kept)  # read by nothing any more
    parts = united.where("chunk IS NULL")
    totals = written(parts.select(F.explode(F.arrays_zip("langs", "sums")).alias("x")).groupBy(F.col("x.langs").alias("lang"))
                     .agg(F.sum("x.sums").alias("n")), "phrase-totals")
    bases = _bases(united, F.size("words"), (parts.agg(F.max("bucket")).first()[0] or 0) + 1)
    if bases[-1] > 1 << ct.WORD_BITS:
        raise OverflowError("too many frequent words")
    base = F.element_at(F.lit(bases).cast("array<bigint>"), F.col("bucket") + 1)
    named = F.substring_index("x.words", "\t", -1)
    frequent = parts.select(base.alias("base"), F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "x"))
    words = written(frequent.select(
        (F.col("base") + F.col("pos")).alias("id"), F.expr("left(x.words, char_length(x.words) - char_length(substring_index(x.words, '\t', -1)) - 1)").alias("lang"),
        named.alias("word"), F.col("x.counts").alias("a")), "phrase-frequent")
    shorter = words.select("id", "lang", F.array("a").alias("heads"), F.array("a").alias("tails"))
    layer = written(_first_layer(united, bases, folder, n_chunks, sample_every), "phrase-layer")
    delete_path(spark, f"{folder}/tokens")
    layers: dict[int, DataFrame] = {}
    for level in range(2, longest + 1):
        united, bases = _united(layer, folder, level, least, range_arcs)
        if bases[-1] > 1 << ct.STATE_BITS:
            raise OverflowError("too many frequent phrases")
        layers[level] = shorter = written(_counted(_states(united, bases), shorter), "phrase-states")
        if level < longest:
            layer = written(_grown(manifest, united, bases, folder, level, n_chunks, sample_every), "phrase-layer")
        for name in (f"arcs-{level}", f"grams-{level}"):
            delete_path(spark, f"{folder}/{name}")  # read by nothing any more
    order = [F.desc("score"), F.desc("a")]
    every = None
    for level, own in layers.items():
        scored = _scored(own, layers.get(level + 1), percent, totals).withColumn("length", F.lit(level))
        every = scored if every is None else every.unionByName(scored)
    # ties of the last place stay until the words decide
    best = written(_best(every.withColumn("_key", F.struct("length", "start", "word")), top, F.rank(), order, "_key").drop("rank", "_key"),
                   "phrase-best")
    spelled = _spelled(best, layers, words)
    return _best(spelled, top, F.row_number(), [*order, F.asc("phrase")], "phrase").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
