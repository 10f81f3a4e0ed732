"""I-Match document fingerprints over randomised lexicons.

The lexicon holds the terms whose document frequency lies in a band (an inverse-document-frequency
band). Each of several random subsets of the lexicon gives one signature: the document's distinct
terms in the subset, hashed as a set (the XOR of the terms' hashes, so no order has to be made); none if there are none. The first signature takes the whole
lexicon, or all terms of the text if none is in the lexicon. Two fingerprints are as alike as the
share of equal signatures among those that either of them has. Dense subsets tell exact from edited
copies, sparse ones agree about as often as the term sets overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import blank, number_rows, with_classes, written

#: (one term in so many, number of subsets of that density); 48 subsets, one bit of a mask each.
SUBSETS = ((8, 8), (32, 12), (128, 14), (512, 14))
_BROADCAST_TERMS = 2_000_000


def distinct_terms(text: Column) -> Column:
    """Hashes of the distinct lower-cased runs of letters and digits."""
    words = F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = 0.001, high: float = 0.1) -> DataFrame:
    """(term, mask): terms in ``low`` to ``high`` of all documents; bit k of mask: in subset k.

    At most (mean number of distinct terms of a document) / ``low`` terms lie in the band.
    """
    n = docs.count()
    counts = docs.select(F.explode(distinct_terms(blank(F.col("text")))).alias("term")).groupBy("term").count()
    mask, bit = F.lit(0).cast("long"), 0
    for one_in, times in SUBSETS:
        for _ in range(times):
            mask = mask.bitwiseOR(F.when(F.pmod(F.xxhash64("term", F.lit(bit)), F.lit(one_in)) == 0,
                                         F.lit(1 << bit)).otherwise(F.lit(0)))
            bit += 1
    return written(counts.where((F.col("count") >= low * n) & (F.col("count") <= high * n)).select("term", mask.alias("mask")),
                   "lexicon")


def fingerprints(texts: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """``keys`` and ``marks``, the signatures of each row's ``text`` (32-bit, null where a subset is empty).

    Rows of ``texts`` must differ in ``keys``. No shuffle if they are already partitioned by some of them.
    Two subsets share one 64-bit sum (XOR): one takes the upper half of the term hashes, one the lower.
    """
    # the term list is bounded by the band, and its size is checked; a longer one is joined by shuffle
    if words.count() <= _BROADCAST_TERMS:
        words = F.broadcast(words)
    rows = texts.select(*keys, F.explode_outer(distinct_terms(blank(F.col("text")))).alias("term"))
    mask, term = F.coalesce("mask", F.lit(0).cast("long")), F.col("term")
    count = sum(times for _, times in SUBSETS)

    def half(bit: int, part: int) -> Column:
        return F.when(mask.bitwiseAND(F.lit(1 << bit)) != 0, term.bitwiseAND(F.lit(part))).otherwise(F.lit(0).cast("long"))

    sums = [F.bit_xor(half(k, -(1 << 32)).bitwiseOR(half(k + 1, 0xFFFFFFFF))).alias(f"sum{k}") for k in range(0, count, 2)]
    held = rows.join(words, "term", "left").groupBy(*keys).agg(
        F.bit_xor("term").alias("whole"), F.bit_xor(F.when(F.col("mask").isNotNull(), term)).alias("known"),
        F.bit_or(mask).alias("any"), *sums)

    def sign(k: int) -> Column:
        own = F.col(f"sum{k - k % 2}")
        return F.when(F.col("any").bitwiseAND(F.lit(1 << k)) != 0,
                      F.hash(own.bitwiseAND(F.lit(0xFFFFFFFF)) if k % 2 else F.shiftrightunsigned(own, 32)))

    return held.select(*keys, F.array(F.hash(F.coalesce("known", "whole")), *[sign(k) for k in range(count)]).alias("marks"))


def likeness(a: str, b: str) -> Column:
    """Share of equal signatures among those that one of the two has."""
    both = F.zip_with(F.col(a), F.col(b), lambda x, y: F.struct(
        (x.isNotNull() | y.isNotNull()).alias("any"), F.coalesce(x == y, F.lit(False)).alias("same")))
    return F.size(F.filter(both, lambda z: z["same"])) / F.size(F.filter(both, lambda z: z["any"]))


def fingerprint_text(marks: str) -> Column:
    return F.array_join(F.transform(marks, lambda m: F.coalesce(F.lower(F.hex(m.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))),
                                                                F.lit("-"))), ".")


def fingerprint_with_edits(docs: DataFrame, low: float = 0.001, high: float = 0.1, with_text: bool = True) -> DataFrame:
    """Fingerprints of every text and of its edited copy.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document in ascending ``doc_id`` (after the last: the first). Returns ``doc_id``,
    ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next`` and, ``with_text``, ``edited`` (the text, at the price of one more shuffle of all
    texts); other columns are left out. A null text is empty. Null ids (and the smallest 64-bit
    number, which counts as one) come first; rows that share an id are ordered by a hash of their
    text. Rows equal in id and text are one document with one next document, and each of them is returned. A single document is its own next one. An empty table
    gives an empty result.
    """
    words = lexicon(docs, low, high)
    none = F.lit(-(1 << 63))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), none).alias("k1"),
                        F.xxhash64(blank(F.col("text"))).alias("k2"), blank(F.col("text")).alias("text"))
    order = written(number_rows(keyed.select("k1", "k2", F.length("text").alias("n")), ["k1", "k2"], "document-order"),
                    "document-order")
    n = order.count()
    back = order.select(F.pmod(F.col("rank") + 1, F.lit(max(n, 1))).alias("rank"), F.col("k1").alias("prev1"),
                        F.col("k2").alias("prev2"), F.col("n").alias("prev_n"))
    links = written(order.select("k1", "k2", "rank").join(back, "rank").drop("rank"), "document-links")
    # every text is shuffled once by its key (both joins below use the same exchange); only the part
    # that the document before takes moves on
    repeated = n != docs.count()
    placed = keyed.dropDuplicates(["k1", "k2"]) if repeated else keyed
    tails = placed.join(links, ["k1", "k2"]).select(
        F.col("prev1").alias("k1"), F.col("prev2").alias("k2"),
        F.substring("text", F.lit(1), F.floor(F.col("prev_n") / 2).cast("int")).alias("tail"))
    n_chars = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), (n_chars - F.floor(n_chars / 2)).cast("int")), F.col("tail"))
    pairs = placed.join(tails, ["k1", "k2"]).select("k1", "k2", "text", edited.alias("edited"))
    each = pairs.select("k1", "k2", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("x"))
    each = each.select("k1", "k2", "x.kind", "x.text")
    each = each.select("k1", "k2", "kind", "text", F.length("text").cast("long").alias("size"),
                       F.unhex(F.sha2("text", 256)).alias("digest"))
    marks = written(fingerprints(each, ["k1", "k2", "kind", "size", "digest"], words), "document-marks")
    plain = marks.where("kind = 0").select("k1", "k2", F.col("size").alias("n_chars"), "marks")
    changed = marks.where("kind = 1").select("k1", "k2", F.lower(F.hex("digest")).alias("edited_sha256"),
                                             F.col("marks").alias("edited_marks"))
    after = plain.join(links, ["k1", "k2"]).select(F.col("prev1").alias("k1"), F.col("prev2").alias("k2"),
                                                   F.col("marks").alias("next_marks"))
    found = plain.join(changed, ["k1", "k2"]).join(after, ["k1", "k2"])
    columns = [F.nullif(F.col("k1"), none).alias("doc_id"), "n_chars", "edited_sha256", fingerprint_text("marks").alias("fingerprint"),
               fingerprint_text("edited_marks").alias("edited_fingerprint"),
               likeness("marks", "edited_marks").alias("near_edited"), likeness("marks", "next_marks").alias("near_next")]
    if with_text:
        found, columns = found.join(pairs.select("k1", "k2", "edited"), ["k1", "k2"]), columns + ["edited"]
    found = found.select("k1", "k2", *columns)
    if repeated:  # equal rows were one document so far; each gets the answer
        copies = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n"))
        classes = written(found.join(copies, ["k1", "k2"]).withColumn("key", F.struct("k1", "k2")).drop("k1", "k2"), "document-answers")
        found = with_classes(keyed.select(F.struct("k1", "k2").alias("key")), classes, "key")
    return found.drop("k1", "k2", "key")
