"""Line deduplication over levelled sorted runs of line hashes.

Documents arrive in batches of ascending ``doc_id``. A run holds, sorted by hash, every line key a
batch saw first, with the smallest document that has it. A new batch groups its own line keys,
merge-anti-joins them against all runs, and adds what is left as its own run. When a level has
``fanout`` runs they are merged into one run of the next level. As batches ascend, the owner in a
run is the smallest document of the whole table, so a line goes exactly if (key, document) is in
no run.

Hot lines: the group by key combines before its shuffle, and the final anti-join is on (key,
document), which spreads a line that stands in every document over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.base import BLANKS, blank, delete_path, row_struct, scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "key1 long, key2 long, doc_id long"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """The levelled runs: ``levels[i]`` lists the paths of the runs of level i."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        if fanout < 2:
            raise ValueError("fanout must be 2 or more")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def rows(self) -> DataFrame | None:
        """All runs together; a (key1, key2) stands in one run only."""
        paths = [p for level in self.levels for p in level]
        return self.spark.read.schema(_RUN).parquet(*paths) if paths else None

    def add(self, keys: DataFrame) -> None:
        """Add the keys (key1, key2, doc_id) of a batch whose ids are above those of all batches before."""
        first = keys.groupBy("key1", "key2").agg(F.min("doc_id").alias("doc_id"))
        known = self.rows()
        if known is not None:
            first = first.join(known.select("key1", "key2").hint("merge"), ["key1", "key2"], "left_anti")
        self._write(first, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        path = scratch(self.spark, f"line-run-{level}")
        rows.select("key1", "key2", "doc_id").sortWithinPartitions("key1", "key2").write.parquet(path)
        self.levels[level].append(path)

    def _compact(self, level: int) -> None:
        merged, self.levels[level] = self.levels[level], []
        self._write(self.spark.read.schema(_RUN).parquet(*merged).repartition("key1", "key2"), level + 1)
        for path in merged:
            delete_path(self.spark, path)


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 8, fanout: int = 4) -> DataFrame:
    """Drop repeated lines; keep them in the smallest ``doc_id`` that has them.

    Returns the columns of ``docs`` with ``text`` replaced by the kept lines, and ``n_lines``,
    ``n_dropped`` (these two replace input columns of the same name). Keys are lines stripped of
    blanks at both ends with A-Z lower-cased; keys under ``min_chars`` code points always stay.
    Two 64-bit hashes stand for a key.

    A null text is one empty line. Rows with a null ``doc_id`` keep all lines and own none. Rows
    sharing a ``doc_id`` count as one document: all of them keep the lines it owns. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    lines = F.split(blank(F.col("text")), "\n")
    bounds = sorted({int(x) for x in docs.select("doc_id").stat.approxQuantile(
        "doc_id", [i / batches for i in range(1, batches)], 0.01)}) if batches > 1 else []
    batch = F.lit(0)
    for bound in bounds:
        batch = batch + (F.col("doc_id") >= F.lit(bound)).cast("int")
    found = (docs.where(F.col("doc_id").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), batch.alias("batch"),
                     F.xxhash64(blank(F.col("text"))).alias("body"), F.posexplode(lines).alias("pos", "line"))
             .select("doc_id", "batch", "body", "pos", line_key(F.col("line")).alias("key"))
             .where(F.length("key") >= min_chars)
             .select("doc_id", "batch", "body", "pos", F.xxhash64("key").alias("key1"),
                     F.xxhash64(F.lit(1), F.col("key")).alias("key2")))
    path = scratch(spark, "lines")
    found.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)

    runs = LineRuns(spark, fanout)
    for number in range(len(bounds) + 1):
        runs.add(found.where(F.col("batch") == number).select("key1", "key2", "doc_id"))
    dropped = (found.join(runs.rows().hint("merge"), ["key1", "key2", "doc_id"], "left_anti")
               .groupBy("doc_id", "body").agg(F.sort_array(F.collect_set("pos")).alias("gone")))

    left = docs.select(F.col("doc_id").cast("long").alias("id"), blank(F.col("text")).alias("all"),
                       row_struct(docs, ("text", "n_lines", "n_dropped")).alias("row"))
    joined = left.join(
        dropped, (F.col("id") == F.col("doc_id")) & (F.xxhash64("all") == F.col("body")), "left").select(
        "row", "all", F.split("all", "\n").alias("parts"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    # the kept lines are the stretches between dropped positions
    stretches = F.transform(F.sequence(F.lit(0), F.size("gone")), lambda i: F.slice(
        "parts", F.coalesce(F.get("gone", i - 1) + 2, F.lit(1)),
        F.coalesce(F.get("gone", i), F.size("parts")) - F.coalesce(F.get("gone", i - 1) + 1, F.lit(0))))
    text = F.when(F.size("gone") == 0, F.col("all")).otherwise(F.array_join(F.flatten(stretches), "\n"))
    out = joined.select("row", text.alias("text"), F.size("parts").cast("long").alias("n_lines"),
                        F.size("gone").cast("long").alias("n_dropped"))
    kept = [c for c in docs.columns if c.lower() not in ("text", "n_lines", "n_dropped")]
    return out.select(*[F.col(f"row.`{c}`") for c in kept], "text", "n_lines", "n_dropped")
