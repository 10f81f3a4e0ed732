"""N-gram Jaccard join with prefix filters under several global token orders.

Tokens are the distinct word shingles of a document. A token that stands in one document only can
be in no intersection, so the join works on the others (the core); whether a token is repeated is
counted over all documents, exactly but for a few hash matches that only leave a token in the core.
Documents with the same core and the same set size form a class: whether two documents link depends
on their classes alone. So exact copies, and copies that differ in words of their own, are one class.

Two classes that reach the threshold share a token among the first ``core - ceil(t * size) + 1``
of each, under any token order that is the same for all documents. Two orders are used, both by
rising frequency (the number of chunks that hold the token), with ties broken by different hashes.
Candidates share a prefix token in both; then the intersection is counted.

Groups are linked through hubs first: every prefix token has a hub (the class with the largest share
of repeated tokens, later a random one), and each class is paired with the best hub it meets. Only pairs whose
classes are not connected by then are proposed exhaustively, so no link between components is lost
and a large group of near copies costs links in proportion to its size. Tokens whose classes are all
connected leave after each round.

The token sets are the bulk of the data. They are dealt out once, into a table bucketed by class, so
only the sets of candidates move again, and those of classes whose links are counted.

The links of each document are counted over all pairs of classes of a component, as every link is
inside one. Components are cut into blocks of classes; a task compares two blocks and returns counts,
not pairs. This takes comparisons in proportion to the square of a component's classes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import bucketed, delete_path, scratch, with_classes, written
from vantage.llm.chunks import (_LAST, bucket_bits, by_chunk, count_chunks, dealt, load_chunk, path_of, received,
                                write_chunks)
from vantage.llm.components import connected_components


class _Chunk:
    """Distinct shingle hashes of each document of one chunk."""

    def __init__(self, path: str, size: int):
        import numpy as np

        from vantage.llm.hashing import inside, mix, window_hashes, word_hashes

        self.ids, texts = load_chunk(path)
        self.texts = texts
        counts = np.zeros(len(texts), np.int64)
        parts, words = [], []
        for i, text in enumerate(texts):
            own = text.lower().split()  # of bytes: A-Z only, ASCII blanks only
            counts[i] = len(own)
            words += own
            if len(words) >= 50_000:
                parts.append(word_hashes(words))
                words = []
        if words:
            parts.append(word_hashes(words))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        ends = np.cumsum(counts)
        starts = inside(counts, size)
        hashes = [window_hashes(flat, size)[starts]]
        docs = [np.searchsorted(ends, starts, "right")]
        for n in range(1, size):  # shorter documents are one shingle
            which = np.flatnonzero(counts == n)
            if len(which):
                hashes.append(mix(window_hashes(flat, n)[(ends - counts)[which]], n))
                docs.append(which)
        h, d = np.concatenate(hashes), np.concatenate(docs)
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.token, self.doc = h[new], d[new]  # by document, then by hash
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self.hashes, self.place, self.held = np.unique(self.token, return_inverse=True, return_counts=True)


_NODE = "doc_id long, body long, n long, class_id string, core array<long>, pre1 array<long>, pre2 array<long>"


def _nodes(docs: DataFrame, size: int, percent: int, chunk_bytes: int) -> DataFrame:
    """Per document its set size, class and a number; one document of each class and chunk carries the arrays."""
    manifest = write_chunks(docs, "shingle-chunks", chunk_bytes)
    n_chunks, n_bytes = manifest.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    bits = bucket_bits(n_bytes / 6)
    answers = scratch(docs.sparkSession, "shingle-counts")
    count_chunks(manifest, n_chunks, bits, lambda path: _Chunk(path, size).hashes).write.parquet(answers)
    counted = docs.sparkSession.read.parquet(answers)

    def nodes(table):
        import hashlib

        import numpy as np
        import pyarrow as pa
        import xxhash

        from vantage.llm.hashing import mix

        own = _Chunk(path_of(table), size)
        body = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in own.texts), np.uint64, len(own.texts))
        codes = received(table, "count")
        # the frequency all chunks agree on: chunks that hold the token, or documents of the only chunk
        often = np.where(codes >= 2, codes, np.minimum(own.held, 255)).astype(np.uint8)[own.place]
        core = often >= 2
        token, doc, often = own.token[core], own.doc[core], often[core]
        k = np.bincount(doc, minlength=len(own.ids))
        need = (percent * own.sizes + 99) // 100
        able = (own.sizes > 0) & (k >= need)
        pick = able[doc]
        token, doc, often = token[pick], doc[pick], often[pick]
        lens = np.where(able, k, 0)
        ends = np.cumsum(lens)
        token_i = token.view(np.int64)
        orders = [token_i[np.lexsort((mix(token, salt), often, doc))] for salt in (11, 12)]
        cls: list = [None] * len(own.ids)
        arrays: list[list] = [[None] * len(own.ids) for _ in range(3)]
        seen = set()
        for i in np.flatnonzero(able):
            a, b = ends[i] - lens[i], ends[i]
            cls[i] = hashlib.blake2b(token[a:b].tobytes() + int(own.sizes[i]).to_bytes(8, "little"), digest_size=16).hexdigest()
            if cls[i] not in seen:
                seen.add(cls[i])
                arrays[0][i] = token_i[a:b]
                for out, order in zip(arrays[1:], orders):
                    out[i] = order[a:a + lens[i] - need[i] + 1]
        kind = pa.list_(pa.int64())
        return pa.table({"doc_id": pa.array([None if i == _LAST else i for i in own.ids], pa.int64()),
                         "body": pa.array(body.view(np.int64)), "n": pa.array(own.sizes, pa.int64()), "class_id": pa.array(cls, pa.string()),
                         **{c: pa.array(x, kind) for c, x in zip(("core", "pre1", "pre2"), arrays)}})

    found = dealt(by_chunk(manifest, {"count": counted}), "chunk", n_chunks).groupBy("chunk").applyInArrow(nodes, _NODE)
    found = written(found.withColumn("place", F.monotonically_increasing_id()), "shingle-nodes")
    delete_path(docs.sparkSession, answers)  # read by nothing any more
    return found


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that also share a prefix token in the second order and reach the threshold.

    The prefixes are compared first; only pairs that pass both filters get their sets. ``sets`` is bucketed by
    class, so what is exchanged goes with the pairs.
    """
    def side(end: str, *columns: str) -> DataFrame:
        return sets.select(F.col("cls").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

    both = pairs.join(side("a", "pre2"), "a").join(side("b", "pre2"), "b").where(F.arrays_overlap("pre2_a", "pre2_b"))
    both = both.select("a", "b").join(side("a", "n", "core"), "a").join(side("b", "n", "core"), "b")
    shared = F.size(F.array_intersect("core_a", "core_b"))
    return (both.select("a", "b", "n_a", "n_b", shared.alias("shared"))
            .where(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b"))


def _near(percent: int):
    """The sizes allow the threshold."""
    return 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")


def _hub_pairs(posts: DataFrame, goodness, percent: int) -> DataFrame:
    hubs = written(posts.groupBy("token").agg(F.max(F.struct(goodness.alias("good"), "cls", "comp", "n")).alias("hub"),
                                              F.min("comp").alias("low"), F.max("comp").alias("high"))
                   .where("low <> high").select("token", "hub.good", "hub.cls", "hub.comp", "hub.n"), "shingle-hubs")
    met = (posts.alias("x").join(hubs.alias("y"), "token").where(F.col("x.comp") != F.col("y.comp")).where(_near(percent))
           .groupBy(F.col("x.cls").alias("x")).agg(F.max(F.struct("y.good", "y.cls")).alias("y")))
    return met.select(F.least("x", "y.cls").alias("a"), F.greatest("x", "y.cls").alias("b")).distinct()


def _open(posts: DataFrame) -> DataFrame:
    """The rows of tokens that stand in several components; the others can propose nothing any more."""
    several = (posts.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
               .where("low <> high").select("token"))
    return written(posts.join(several, "token", "left_semi"), "open-posts")


def _components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes that link with others."""
    posts = written(sets.select("cls", "n", F.size("core").alias("k"), (F.size("core") / F.col("n")).alias("share"),
                                F.posexplode("pre1").alias("at", "token")), "shingle-posts")
    posts = _open(posts.withColumn("comp", F.col("cls")))
    links = components = None
    for goodness in (F.col("share"), F.xxhash64("cls"), F.xxhash64("cls", F.lit(1))):
        found = written(_verified(written(_hub_pairs(posts, goodness, percent), "hub-pairs"), sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        if components is None or not found.isEmpty():
            components = written(connected_components(links), "link-components")
            posts = _open(written(posts.drop("comp").join(components.withColumnRenamed("node", "cls"), "cls", "left")
                                  .withColumn("comp", F.coalesce("component", "cls")).drop("component"), "shingle-posts"))
    pairs = (posts.alias("x").join(posts.alias("y"), "token")
             .where((F.col("x.cls") < F.col("y.cls")) & (F.col("x.comp") != F.col("y.comp"))).where(_near(percent))
             # at the first token two linked classes share, enough of both must be left
             .where((100 + percent) * F.least(F.col("x.k") - F.col("x.at"), F.col("y.k") - F.col("y.at"))
                    >= percent * (F.col("x.n") + F.col("y.n")))
             .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
    found = written(_verified(written(pairs, "open-pairs"), sets, percent), "links")
    return components if found.isEmpty() else written(connected_components(links.unionByName(found)), "link-components")


def _linked_rows(sets: DataFrame, members: DataFrame, percent: int, pack_rows: int, block_rows: int, block_tokens: int) -> DataFrame:
    """(cls, linked): documents of other classes of its component each class links with.

    ``sets`` has cls, n, core and is bucketed by cls; ``members`` has cls, comp, rows.

    Every pair of classes of a component meets in one task: that of their two blocks. Components of up to
    ``pack_rows`` classes share tasks; a larger one is cut into blocks of ``block_rows`` classes or ``block_tokens``
    tokens, and each block goes to as many tasks as there are blocks. Sets move only then, and only those of
    components of several classes.
    """
    members = written(members.join(sets.select("cls", "n", F.size("core").alias("k")), "cls"), "class-members")
    n, tokens = F.count("*"), F.sum("k")
    sizes = members.groupBy("comp").agg(n.alias("classes"), (n <= min(pack_rows, block_rows)).alias("small"), F.ceil(F.greatest(
        n / block_rows, tokens / block_tokens)).cast("int").alias("blocks")).where("classes > 1")
    total = sizes.agg(F.coalesce(F.sum(F.when(F.col("small"), F.col("classes"))), F.lit(0))).first()[0]
    packs = F.lit(-(-total // pack_rows) or 1)
    placed = members.join(sizes, "comp").withColumn("block", F.when(
        F.col("small"), F.pmod(F.xxhash64("comp"), packs)).otherwise(F.pmod(F.xxhash64("cls"), F.col("blocks"))).cast("int"))
    others = F.when(F.col("small"), F.array("block")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (placed.withColumn("other", F.explode(others))
           .select(F.when(~F.col("small"), F.col("comp")).otherwise(-1).alias("part"), F.least("block", "other").alias("i"),
                   F.greatest("block", "other").alias("j"), "block", "cls", "n", "rows")
           .join(sets.select("cls", "core"), "cls"))

    def count(table):
        import numpy as np
        import pyarrow as pa

        cls = table.column("cls").combine_chunks()
        n, rows, block, i, j = (table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("n", "rows", "block", "i", "j"))
        core = table.column("core").combine_chunks()
        lens = np.asarray(core.value_lengths())
        column = np.unique(core.flatten().to_numpy(), return_inverse=True)[1]
        doc = np.repeat(np.arange(len(n)), lens)
        order = np.argsort(column, kind="stable")
        column, doc = column[order], doc[order]
        x = np.flatnonzero(block == i)
        y = x if i[0] == j[0] else np.flatnonzero(block == j)
        at_x, at_y = np.full(len(n), -1), np.full(len(n), -1)
        at_x[x], at_y[y] = np.arange(len(x)), np.arange(len(y))
        shared = np.zeros((len(x), len(y)), np.int64)
        width = 2048  # columns at a time
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            low, high = np.searchsorted(column, (a, a + width))
            sides = []
            for at, m in ((at_x, len(x)), (at_y, len(y))):
                own = at[doc[low:high]]
                held = np.zeros((m, width), np.float32)
                held[own[own >= 0], column[low:high][own >= 0] - a] = 1
                sides.append(held)
            shared += (sides[0] @ sides[1].T).astype(np.int64)
        links = 100 * shared >= percent * (n[x][:, None] + n[y] - shared)
        linked = np.zeros(len(n), np.int64)
        if y is x:
            np.fill_diagonal(links, False)
        else:
            linked[y] = links.T @ rows[x]
        linked[x] = links @ rows[y]
        some = np.flatnonzero(linked)
        return pa.table({"cls": cls.take(pa.array(some)), "linked": pa.array(linked[some], pa.int64())})

    found = met.groupBy("part", "i", "j").applyInArrow(count, "cls long, linked long")
    return found.groupBy("cls").agg(F.sum("linked").alias("linked"))


def link_components(docs: DataFrame, size: int = 5, percent: int = 80, chunk_bytes: int = 4 << 20, with_links: bool = False,
                    pack_rows: int = 128, block_rows: int = 1024, block_tokens: int = 2_000_000, with_rows: bool = False) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) for every row of ``docs``; ``with_links`` adds n_links.

    ``with_rows`` adds body, the XXH64 of the text as Spark's ``xxhash64`` gives it, and group_id: the same for rows
    of one component, whatever their ids; null for a row that can link with nothing.

    Two rows link when 100 * shared >= percent * union over their distinct ``size``-word shingles
    (words without ASCII blanks, A-Z lower-cased; a shorter text is one shingle). ``component_id`` is
    the smallest ``doc_id`` reachable by links, itself included; ``class_id`` names rows whose links
    are the same by construction (null: too few repeated shingles to link with anything). ``n_links``
    is the number of other rows that the row links with, those of its own class included.

    A null or blank text has no shingles and links with nothing. Rows with a null id take part and
    get the smallest id they reach, or null. Rows sharing an id are separate documents. Other columns
    are left out. An empty table gives an empty result.
    """
    nodes = _nodes(docs, size, percent, chunk_bytes)
    # a class is known by the number of its first document that carries the arrays
    classes = written(nodes.where("class_id IS NOT NULL").groupBy("class_id").agg(
        F.min(F.when(F.col("core").isNotNull(), F.col("place"))).alias("cls"), F.min("doc_id").alias("low"),
        F.count("*").alias("rows")), "classes")
    carriers = nodes.where("core IS NOT NULL").select(F.col("place").alias("cls"), "n", "core", "pre1", "pre2")
    with bucketed(carriers, "shingle-sets", "cls", only=classes.select("cls")) as sets:
        components = _components(sets, percent)
        # a class without links to others is a component if its own members link with each other
        shared = F.size("core")
        alone = written(sets.where(100 * shared >= percent * (2 * F.col("n") - shared)).select("cls"), "class-alone")
        label = (alone.join(components, F.col("cls") == F.col("node"), "full")
                 .select(F.coalesce("cls", "node").alias("cls"), F.coalesce("component", "cls").alias("comp")))
        label = written(label.join(classes, "cls"), "class-components")
        if with_links:
            members = label.select("cls", "comp", "rows")
            linked = _linked_rows(sets, members, percent, pack_rows, block_rows, block_tokens)
            own = alone.join(members, "cls").select("cls", (F.col("rows") - 1).alias("linked"))
            linked = written(linked.unionByName(own).groupBy("cls").agg(F.sum("linked").alias("n_links")), "class-links")
    of = label.groupBy("comp").agg(F.min("low").alias("component_id"), F.min("class_id").alias("group_id"))
    of = label.join(written(of, "component-lowest"), "comp").select("cls", "component_id", "group_id")
    columns = ["doc_id", "n_shingles", "class_id", F.coalesce("component_id", "doc_id").alias("component_id")]
    if with_links:
        of = of.join(linked, "cls", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    if with_rows:
        columns += ["body", "group_id"]
    # rows without a class have nothing to look up, and would all meet in one task
    rows = nodes.select("doc_id", "body", F.col("n").alias("n_shingles"), "class_id")
    answers = written(classes.select("class_id", "cls", F.col("rows").alias("n")).join(of, "cls", "left").drop("cls"), "class-answers")
    found = with_classes(rows.where("class_id IS NOT NULL"), answers, "class_id")
    return found.unionByName(rows.where("class_id IS NULL"), allowMissingColumns=True).select(*columns)
