"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm import (collocations, fingerprints, jaccard_join, line_dedup, mixing, quality_fm, sentencepiece_bpe,
                         simhash_dedup, spelling_variants, suffix_dedup, token_files, vector_search, window_dedup)
from vantage.llm.base import read_documents, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: Token shares of the mixture's domains.
MIX_TARGETS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}


def mixing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of the domain classifier: the labelled documents' languages."""
    labelled = read_documents(spark, sf_dir, "labels").select("doc_id").distinct()
    return read_documents(spark, sf_dir).select("doc_id", F.col("lang").alias("domain")).join(labelled, "doc_id")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir), mixing_labels(spark, sf_dir), MIX_TARGETS).drop("body")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = """
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM parts),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line),
owner AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT k.doc_id, k.pos, k.line, coalesce(o.owner < k.doc_id, false) AS gone
           FROM keyed k LEFT JOIN owner o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_edits(read_documents(spark, sf_dir), with_text=False)


@query
def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    model = quality_fm.quality_model(docs, read_documents(spark, sf_dir, "labels"))
    return quality_fm.score(docs, model).select("doc_id", quality_fm.held_out().alias("held_out"), "score", "predicted")


@query
def op5_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = window_dedup.dedup_windows(read_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query
def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(read_documents(spark, sf_dir, "embeddings"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.dedup_substrings(read_documents(spark, sf_dir))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2(F.col("kept"), 256).alias("kept_sha256"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(read_documents(spark, sf_dir), with_links=True)


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return sentencepiece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = scratch(spark, "token-files")
    token_files.write_token_files(read_documents(spark, sf_dir), out,
                                  public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_token_files(spark, out)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_phrases(read_documents(spark, sf_dir))


@query
def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.link_components(read_documents(spark, sf_dir))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variant_groups(read_documents(spark, sf_dir))
