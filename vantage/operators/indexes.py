"""Stored indexes over a listing: ordered pages of any depth (C2), and substring search by trigrams (C4).

Both are Parquet folders on shared storage, written once per state of the listing, so that a page or a
search reads the few files it needs instead of sorting or scanning the listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions.expressions import search_match
from vantage.operators.listing import _order
from vantage.sources.versions import read_folder, replace_folder

_PART, _POS = "_part", "_pos"
_LOCAL = (1 << 33) - 1


class PageIndex:
    """An ordered listing, stored part by part; a page reads only the parts it touches.

    ``build`` sorts the listing once (a range-partitioned sort: no task sees all of it) and writes each row with its
    part and its position in the part, one folder per part, and a table of the parts' row counts. That table has
    one row per part and is read by the driver; everything else stays on the executors. A page then filters
    on folders and on a range of positions, which Parquet statistics prune, since files are in that order.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        sizes = read_folder(spark, f"{self.path}/parts").orderBy("part").collect()  # one row per part
        self.first: dict[int, int] = {}
        total = 0
        for row in sizes:
            self.first[row.part] = total
            total += row.n
        self.total = total
        self.sizes = {row.part: row.n for row in sizes}

    @classmethod
    def build(cls, listing: DataFrame, path: str, order_by: list, parts: int | None = None) -> "PageIndex":
        """``order_by`` as for ``page``: names (NULLs last) or columns. Rows that tie are ordered by ``id`` if there is one;
        make the order unique if pages of two builds have to agree."""
        spark = listing.sparkSession
        keys = list(order_by)
        if "id" in listing.columns and "id" not in [c for c in keys if isinstance(c, str)]:
            keys.append("id")
        order = _order(keys)
        ranged = listing.repartitionByRange(parts, *order) if parts else listing.repartitionByRange(*order)
        placed = ranged.sortWithinPartitions(*order).select(
            "*", F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL)).alias(_POS))
        path = path.rstrip("/")
        replace_folder(placed.limit(0), f"{path}/layout")
        placed.write.mode("overwrite").partitionBy(_PART).parquet(f"{path}/rows")
        stored = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        replace_folder(stored.groupBy(F.col(_PART).alias("part")).agg((F.max(_POS) + 1).alias("n")), f"{path}/parts")
        return cls(spark, path)

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(read_folder(self.spark, f"{self.path}/layout").schema).parquet(f"{self.path}/rows")

    def rows(self, first: int, count: int) -> DataFrame:
        """Rows ``first`` to ``first + count - 1`` (from 0) of the listing, in order."""
        stored = self._rows()
        columns = [c for c in stored.columns if c not in (_PART, _POS)]
        wanted = F.lit(False)
        for part, start in self.first.items():
            low, high = max(first - start, 0), min(first + count - start, self.sizes[part])
            if low < high:
                wanted = wanted | ((F.col(_PART) == part) & (F.col(_POS) >= low) & (F.col(_POS) < high))
        return stored.where(wanted).orderBy(_PART, _POS).select(*columns)

    def page(self, page_nr: int = 1, size: int = 100) -> DataFrame:
        """One 1-based page, at the same cost whatever its number; beyond the end it is empty."""
        if page_nr < 1 or size < 1:
            raise ValueError("page and size are 1-based and positive")
        return self.rows((page_nr - 1) * size, size)


def _grams(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters of a lower-cased text."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(low) - (size - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(low, i, F.lit(size))))


class SearchIndex:
    """C4: substring search over a stored listing by posting lists of its names' trigrams.

    A name that contains a text contains all of its trigrams. The postings (gram, id) are stored in the order of the grams,
    so a search reads the row groups of its grams only, by Parquet statistics. Ids that have every gram are
    candidates; their names are then compared, so the result is that of ``search``. Texts shorter than a gram
    scan the listing.
    """

    def __init__(self, spark: SparkSession, path: str, column: str = "name", size: int = 3):
        self.spark, self.path, self.column, self.size = spark, path.rstrip("/"), column, size

    @classmethod
    def build(cls, listing: DataFrame, path: str, column: str = "name", size: int = 3) -> "SearchIndex":
        """``listing`` needs an ``id``, unique and not NULL."""
        path = path.rstrip("/")
        replace_folder(listing, f"{path}/listing")
        held = read_folder(listing.sparkSession, f"{path}/listing")
        postings = held.select(F.explode(_grams(F.col(column), size)).alias("gram"), "id")
        replace_folder(postings.repartitionByRange("gram", "id").sortWithinPartitions("gram", "id"), f"{path}/postings")
        return cls(listing.sparkSession, path, column, size)

    def listing(self) -> DataFrame:
        return read_folder(self.spark, f"{self.path}/listing")

    def candidates(self, text: str) -> DataFrame:
        """The ids of names that hold every gram of the text."""
        low = text.lower()
        grams = sorted({low[i:i + self.size] for i in range(len(low) - self.size + 1)})
        found = read_folder(self.spark, f"{self.path}/postings").where(F.col("gram").isin(*grams))
        return found.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(grams)).select("id")

    def search(self, text: str | None) -> DataFrame:
        matches = self.listing().where(search_match(F.col(self.column), text))
        if not text or len(text.lower()) < self.size:
            return matches
        return matches.join(self.candidates(text), "id", "left_semi")
