"""The training-data pipeline: five stages over ``documents``, each reading what the one before it wrote.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the columns of ``documents``. Every stage works
on all rows it gets, and its decisions take effect on what it returns. Rows are told apart by id and a hash of the text, so
repeated ids and rows without an id are handled like any other.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corpus_engine.llm.common import mark, settled, table  # noqa: E402
from corpus_engine.llm.curve_packing import pack  # noqa: E402
from corpus_engine.llm.near_duplicates import near_duplicates  # noqa: E402
from corpus_engine.llm.quality_rules import quality_rules  # noqa: E402
from corpus_engine.llm.repeated_passages import remove_repeats  # noqa: E402
from corpus_engine.llm.template_leaks import template_leaks  # noqa: E402
from corpus_engine.llm.word_tokens import default_tokenizer  # noqa: E402

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality_rules(docs, table(spark, sf_dir, "labels"), carry=("text", "lang", "source", "n_chars"))
    return judged.where("kept").select(*COLUMNS)


NAME = ["_id", "_mark"]


def _named(docs: DataFrame) -> DataFrame:
    """Documents with the columns that name them, neither null: the id (a null one as the largest) and the text's hash."""
    at = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    text_hash = F.col("mark") if "mark" in docs.columns else mark(F.col("text"))
    return docs.select("*", at.alias("_id"), text_hash.alias("_mark"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of five words, similarity of 0.8 or more)."""
    staying = _named(near_duplicates(docs).where("stays").select("doc_id", "mark")).select(*NAME)
    kept = _named(docs.select(*COLUMNS)).join(staying, NAME, "left_semi")
    # Rows equal in id and text are one document; the join has already brought them together.
    return kept.groupBy(*NAME).agg(*(F.first(c).alias(c) for c in COLUMNS)).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those with nothing left go."""
    cut = remove_repeats(docs, carry=("lang", "source", "n_chars"), with_text=True).where("n_removed = 0 OR n_removed < n_words")
    chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("kept_text").cast("bigint"))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", chars.alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, also not with other numbers or names."""
    leaked = _named(template_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "mark").distinct()).select(*NAME)
    return _named(docs.select(*COLUMNS)).join(leaked, NAME, "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2,048 tokens."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# A calibrated classifier, similarity components and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1], 1):
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
