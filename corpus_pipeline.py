"""A training-data pipeline over documents: quality rules, quality classifier, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with exactly
their columns; the last one returns the packed pieces. Every stage's rows are written as
Parquet in the shared folder and read again as the next one's documents, so a lost
executor costs no more than one stage's tasks.

An empty table passes through every stage; NULL and repeated rows are treated as each
operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hedonic.llm import jaccard, neighbours, packing, rules
from hedonic.llm.common import table
from hedonic.session import remove, scratch, scratch_path

# Part of a stage cannot be written in SQL (a fitted model, linked groups, a search).
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule cascade keeps."""
    return rules.keep_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents vote for."""
    return neighbours.keep_documents(docs, neighbours.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a similarity of 0.8 at least."""
    return jaccard.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("five-word near-duplicates", near_duplicates),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. What a stage leaves behind goes once the next one's rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
