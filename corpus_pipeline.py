"""From raw documents to packed training sequences.

Each stage takes what the one before kept, written as Parquet and read again, and returns the
columns of ``documents``; others are left out. Nulls, empty tables and repeated rows are treated
as the operators do; no stage drops a row for them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityviews.llm.common import saved, table
from cityviews.llm.mixing import copies, plan
from cityviews.llm.ngram_join import jaccard_components
from cityviews.llm.packing import pack
from cityviews.llm.toxicity import THRESHOLD, fit, held_out, score


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier calls toxic."""
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model, *[F.col(c) for c in COLUMNS]).where(
        F.col("score") < THRESHOLD).drop("score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that of the least id, of each group linked by five-word shingles.

    Rows without an id, words or links are kept; of rows that share the least id, all.
    """
    found = jaccard_components(docs, words=5, per_cent=80)
    gone = saved(found.where("doc_id != component_id").select("doc_id").distinct(), "gone")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources, as far as the repetition limit lets it."""
    return copies(docs.select(*COLUMNS), plan(docs)).drop("pass")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all that is left into sequences of 4096 ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: A classifier and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
