"""A text corpus from raw documents to packed sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm import exact, jaccard, packing, suffixes, toxicity
from demandspark.llm.common import held_out, stage_tidily, table

TOXIC = 0.5
# SQL has no classifier; tests compare the stages to brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC``; the classifier learns as in the query of its own."""
    columns = docs.columns
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id"), 5, 0))
    return toxicity.score_column(docs, model, out="_score").where(F.col("_score") < TOXIC).select(*columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts are equal but for white space."""
    return exact.one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each component of five-word-shingle similarity 0.8 or more."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that start in an earlier document; documents that lose all of their text go."""
    return suffixes.cut_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage_tidily(stage(spark, docs, sf_dir))
    return docs
