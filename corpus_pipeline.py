"""Corpus pipeline: the stages in order, each over all its predecessor kept.

Quality classifier (rejected documents go), line dedup, n-gram Jaccard join (the smallest document
of each group stays), mixing to target weights (documents repeat by their rates, none below one; the
budget is as large as that needs), SentencePiece encoding (the last stage's rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.llm import jaccard_join, line_dedup, mixing, quality_fm, sentencepiece_bpe
from vantage.llm.base import blank, read_documents, row_struct, written
from vantage.llm.queries import MIX_TARGETS, mixing_labels


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, learned from labels.quality, does not reject."""
    model = quality_fm.quality_model(docs, read_documents(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).where("predicted = 1").drop("score", "predicted")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in an earlier one; n_chars counts what is left."""
    kept = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the smallest doc_id (a null one last), ties by a hash of the text.

    Documents that link with nothing stay, null and empty texts among them. Of rows that are equal in id
    and text a group keeps one; rows that share an id only are documents of their own.
    """
    links = written(jaccard_join.link_components(docs, with_rows=True).select("doc_id", "body", "group_id"), "pipeline-links")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "body")).alias("first")
    kept = links.where("group_id IS NOT NULL").groupBy("group_id").agg(first).select(
        F.col("first.doc_id").alias("id"), F.col("first.body").alias("body"), F.lit(True).alias("one"))
    kept = kept.distinct().unionByName(links.where("group_id IS NULL").select(F.col("doc_id").alias("id"), "body", F.lit(False).alias("one")).distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.xxhash64(blank(F.col("text"))).alias("own"), row_struct(docs).alias("row"))
    rows = rows.join(kept, F.col("key").eqNullSafe(F.col("id")) & (F.col("own") == F.col("body")))
    again = F.row_number().over(Window.partitionBy("key", "own").orderBy("key")) > 1
    return rows.withColumn("again", again).where(~(F.col("one") & F.col("again"))).select("row.*")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by rates that bring the domains' tokens to their target shares."""
    return mixing.resample(docs, mixing.mix(docs, mixing_labels(spark, sf_dir), MIX_TARGETS, budget="cover"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    import public_tokenizers

    encoded = sentencepiece_bpe.encode_documents(docs.select("doc_id", "lang", "source", "text"),
                                                 public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "ids_crc32", "parity", "ids")


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("mixing", mixture), ("sentencepiece", encode)]

#: The classifier, the fitted rates and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
