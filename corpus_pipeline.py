"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns
of ``documents``; the last one returns the packed pieces.  Nulls, empty texts and repeated
rows are handled as the operators say; extra columns are left out, missing rows give
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, jaccard_join, packing, pii, quality
from quayside.llm.common import stored, table
from quayside.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates: five-word shingles, similarity of 0.8 or more.
NEAR = jaccard_join.Rule(words=5, least=80, over=100)
#: Documents stay when P(grade >= 1) reaches this.
LEAST_TAIL = 0.5


def rated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    It learns from rated rows of the documents at hand.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.rate(docs, model, keep=COLUMNS) \
        .filter(F.col("tail_1") >= LEAST_TAIL).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least doc_id.

    Repeated rows are one document; a document without words is a group of its own.
    """
    return jaccard_join.one_per_component(docs.select(*COLUMNS), NEAR)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.filter(F.size("hits") == 0).select(*COLUMNS)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` of the new text."""
    out = pii.redact(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                          .otherwise(F.length("text").cast("long")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", rated),
    ("near_duplicates", one_of_each),
    ("benchmarks", clean_of_benchmarks),
    ("pii", redacted),
    ("packing", packed),
]

#: No stage but the personal data can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
