"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm import alignment, ann, chat, divergence, fingerprints, jaccard, langid, linededup, mixing, packing, quality, sharding, sql, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol and repetition counts of every document, and whether it is kept."""
    return quality.score(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judge(_table(spark, sf_dir, "pages"))


def _held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    documents = _table(spark, sf_dir, "documents")
    model = langid.fit(documents, ~_held_out())
    found = langid.predict(documents, model, ["doc_id"])
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mixture holds each document."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op8_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("sequence_tokens")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the side of every participant."""
    return chat.render(_table(spark, sf_dir, "conversations"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped lines of every document, and a checksum of the text that is left."""
    found = linededup.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("dropped").cast("long").alias("n_dropped"),
                        F.array_join(F.transform("dropped", lambda k: k.cast("string")), ",").alias("dropped_lines"),
                        F.length("clean_text").cast("long").alias("clean_chars"), F.md5("clean_text").alias("clean_md5"))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they and the next document are."""
    found = fingerprints.compared(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", fingerprints.fingerprint(F.col("own")).alias("fingerprint"),
                        fingerprints.fingerprint(F.col("edited")).alias("edited_fingerprint"),
                        "near_edited", "near_next", "kept_share", "distinct_shingles")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens that two tokenizers give every document, scored over the corpus."""
    return alignment.link_statistics(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source lies from the others of its language, and by which terms from its language."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_rules, op2_ngram_jaccard_join, op3_nearest_neighbours, op4_url_filters, op5_language_id,
        op6_source_mixing, op7_sharding, op8_sequence_packing, op9_chat_formatting, op10_line_dedup,
        op11_document_fingerprints, op12_tokenizer_alignment, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": sql.quality(),
        "op2_ngram_jaccard_join": sql.near_duplicates(),
        "op4_url_filters": sql.url_filters(),
        "op6_source_mixing": sql.source_mixing(),
        "op9_chat_formatting": sql.chat_formatting(),
        "op10_line_dedup": sql.line_dedup(),
        "op11_document_fingerprints": sql.document_fingerprints(),
        "op13_source_divergence": sql.source_divergence(),
    }
