"""The corpus pipeline: quality rules, line de-duplication, near-duplicate removal, mixing, packing.

Each stage works on all rows its predecessor kept, is written as Parquet into the shared
folder and read again; all but the last return the columns of ``documents``.  The last
returns the pieces of the packed sequences; a document that the mixture holds twice is packed
twice.

Every stage takes tables with nulls in any column, repeated rows and texts of any length; its module's
docstring states the results.  A document with a null or empty text fails the quality rules; a
text that loses its last word to line dedup goes; rows with a null doc_id are judged by their
texts; an empty table passes through every stage.  Further columns of documents are carried up to
the packing, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanlens.llm import jaccard, linededup, mixing, packing, quality
from loanlens.llm.state import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality.rejected_removed(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line equals or nearly equals."""
    return linededup.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document as often as its source's budget selects it."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

#: Which sequence a piece lands in follows from a sequential heuristic that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
