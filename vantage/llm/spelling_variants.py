"""Spelling variants: words one edit apart, by composing the vocabulary's acceptor with a one-edit transducer.

The acceptor of the whole vocabulary is never in one place. Two words one edit apart agree before the
edit and behind it, so of the shorter one's n letters either the first n/2 or the last n - n/2 are also
in the other one. A partition is one initial state: what lies behind a given prefix (edit in the second
half), or, read backwards, what lies before a given suffix (edit in the first half). A task sorts a
partition's words, builds the minimal acceptor of their open middle, composes it with the one-edit
transducer and itself again, and enumerates the accepted pairs. A pair is found in one partition only.

A partition with too many words is cut again the same way: its open middle is halved, each word goes to
both halves with a longer prefix or suffix. An open middle of one letter ends this; its words are
bounded by the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import release, ship, written

_FLUSH = 400_000  # distinct words a task counts before it sends them on
_SLICE = 1 << 22
_PAIRS = 20_000  # pairs a task holds before it sends them on


def doc_words(doc_id: int | None, text: str, typo_every: int = 97, least: int = 5) -> dict[str, int]:
    """Counts of a text's words: runs of letters, A-Z lower-cased, one letter deleted where the rule says so."""
    import re
    import zlib
    from collections import Counter

    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)
    low = text.encode().lower().decode()  # of bytes: A-Z only
    counts = Counter(runs.findall(low) if len(low) <= _SLICE else (m.group() for m in runs.finditer(low)))
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: dict[str, int] = {}
    for run, n in counts.items():
        h = zlib.crc32(run.encode(), head)
        if h % typo_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        found[run] = found.get(run, 0) + n
    return found


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): distinct words and their occurrences; a task counts its documents' words before the shuffle."""
    ship(docs.sparkSession)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[str, int] = {}

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in doc_words(doc_id, text.as_py() or "", least=least_length).items():
                    held[word] = held.get(word, 0) + n
                if len(held) >= _FLUSH:
                    yield flush()
                    held = {}
        if held:
            yield flush()
        held.clear()
        release()

    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the partition: the prefix of ``lo`` letters, the suffix of ``hi`` letters, and what is open between them."""
    size = F.char_length("word")
    return rows.withColumns({
        "prefix": F.expr("substring(word, 1, lo)"),
        "suffix": F.expr("substring(word, char_length(word) - hi + 1, hi)"),
        "open": F.substr("word", F.col("lo") + 1, size - F.col("lo") - F.col("hi"))})


def _halves(rows: DataFrame) -> DataFrame:
    """Both halves of a partition: the open middle of the shorter word is ``short - lo - hi`` letters long."""
    half = F.floor((F.col("short") - F.col("lo") - F.col("hi")) / 2).cast("int")
    more = F.explode(F.array(
        F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("lo").alias("lo"), (F.col("short") - F.col("lo") - half).alias("hi")))).alias("_to")
    return rows.select("word", "n", "short", more).select("word", "n", "short", "_to.*")


_KEY = ["short", "lo", "hi", "prefix", "suffix"]


def partitions(words: DataFrame, least_length: int = 5, max_words: int = 50_000) -> DataFrame:
    """Every word with the partitions it takes part in; ``short`` is the length of a pair's shorter word."""
    size = F.char_length("word")
    shorts = F.explode(F.array_compact(F.array(size, F.when(size > least_length, size - 1))))
    rows = words.select("word", "n", shorts.alias("short")).select(
        "*", F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    rows = written(_keyed(_halves(rows)), "spelling-parts")
    done = None
    while True:
        large = (rows.where("short - lo - hi > 1").groupBy(*_KEY).agg(F.count("*").alias("words"))
                 .where(F.col("words") > max_words).select(*_KEY))
        large = written(large, "spelling-large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = written(rows.join(large, _KEY, "left_anti").select(*rows.columns), "spelling-parts")
        done = small if done is None else done.unionByName(small)
        rows = written(_keyed(_halves(rows.join(large, _KEY, "left_semi"))), "spelling-parts")


def near_pairs(words: DataFrame, least_length: int = 5, max_words: int = 50_000, rows_per_task: int = 100_000) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of words one edit apart."""
    ship(words.sparkSession)
    parts = partitions(words, least_length, max_words)
    tasks = max(1, -(-parts.count() // rows_per_task))

    def pairs_of(key: tuple, middles: list[str], ns: list[int]) -> Iterator[tuple]:
        from vantage.llm.word_automata import Acceptor

        short, lo, hi, prefix, suffix = key
        held = dict(zip(middles, ns))
        for x, y in Acceptor(middles).one_edit_pairs(at_end=hi == 0):
            if len(x) == short - lo - hi:  # others meet in the partition of their own length
                yield prefix + x + suffix, held[x], prefix + y + suffix, held[y]

    def compose(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: list[tuple] = []

        def flush():
            columns = list(zip(*(found + [(v, m, u, n) for u, n, v, m in found])))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())],
                                              ["word", "n", "near", "near_n"])
        key, middles, ns = None, [], []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for own, middle, n in zip(zip(*columns[:5]), columns[5], columns[6]):
                if own != key:
                    if len(middles) > 1:
                        for pair in pairs_of(key, middles, ns):
                            found.append(pair)
                            if len(found) >= _PAIRS:
                                yield flush()
                                found = []
                    key, middles, ns = own, [], []
                middles.append(middle)
                ns.append(n)
        if len(middles) > 1:
            for pair in pairs_of(key, middles, ns):
                found.append(pair)
                if len(found) >= _PAIRS:
                    yield flush()
                    found = []
        if found:
            yield flush()
        del found, middles, ns
        release()

    dealt = parts.select(*_KEY, "open", "n").repartition(tasks, *_KEY).sortWithinPartitions(*_KEY, "open")
    return dealt.mapInArrow(compose, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): pointers are doubled until none moves."""
    up = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = written(up.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        moved = up.where("moved").isEmpty()
        up = up.drop("moved")
        if moved:
            return up


def variant_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, max_words: int = 50_000,
                   rows_per_task: int = 100_000) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of ``docs`` and the word it is a variant of.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; where crc32 of ``<doc_id>:<run>``
    is divisible by 97, the letter at that number modulo the run's length is deleted. They have at least
    ``least_length`` letters and ``least_count`` occurrences. Two words are near if one inserted, deleted or
    replaced letter makes them equal. A word's ``form`` is its near word with most occurrences (ties: the
    smallest) if that has at least twice as many as the word, else null; ``root`` is the end of the chain of
    forms, the word itself without a form.

    A null or empty text has no words. A null ``doc_id`` counts as empty in the crc32. Repeated rows and rows
    sharing an id count as often as they stand. A text of any length is counted run by run. Other columns are
    left out. An empty table gives an empty result.
    """
    words = written(vocabulary(docs, least_length, least_count), "spelling-words")
    near = near_pairs(words, least_length, max_words, rows_per_task)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    full = words.join(best, "word", "left")
    formed = F.col("best.less") <= -2 * F.col("n")
    full = written(full.select("word", F.when(formed, F.col("best.near")).alias("form"), "n",
                               F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(formed, -F.col("best.less")).alias("form_n")), "spelling-forms")
    roots = _roots(full.where("form IS NOT NULL"))
    return full.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
