"""Bounded samples of labelled texts, and the held-out fold."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import text_column

#: Different texts of one id in a sample, at most.
TEXTS_PER_ID = 4


def held_out(key: Column) -> Column:
    """crc32 of the key as text is 0 modulo 5; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def texts_of(docs: DataFrame, picked: DataFrame, texts: int = TEXTS_PER_ID) -> DataFrame:
    """``picked`` (few distinct rows with a ``doc_id``) with each text of the id once.

    Of an id with more than ``texts`` different texts, those of least hash.  Every task
    cuts its rows of an id before they are shuffled (Spark's window group limit).
    """
    by_id = Window.partitionBy(*picked.columns).orderBy(F.xxhash64("text"), "text")
    # Copies go first: combined in each task, then dealt by id and text.
    rows = docs.select(docs["doc_id"], text_column(docs).alias("text")) \
        .join(F.broadcast(picked), "doc_id").select(*picked.columns, "text").distinct()
    return rows.withColumn("_n", F.row_number().over(by_id)).filter(F.col("_n") <= texts) \
        .drop("_n")


def training_sample(docs: DataFrame, labels: DataFrame, label: Column,
                    bounds: dict[int, int]) -> pd.DataFrame:
    """``label`` and ``text`` of at most ``bounds[l]`` labelled ids for each label l.

    Ids are taken in the order of a hash, outside the held-out fold; so the
    sample does not depend on partitions.  Repeated label rows count once, and an id has at
    most ``TEXTS_PER_ID`` texts.  Rows with a null key or label are no samples.
    """
    rated = labels.select(F.col("doc_id"), label.cast("int").alias("label")) \
        .filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id"))) \
        .distinct()
    picked = None
    for value, bound in bounds.items():
        part = rated.filter(F.col("label") == value) \
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        picked = part if picked is None else picked.unionByName(part)
    # Bounded: at most TEXTS_PER_ID * sum(bounds) rows.
    rows = texts_of(docs, picked).select("doc_id", "label", "text").toPandas()
    return rows.drop_duplicates().sort_values(["doc_id", "label", "text"], ignore_index=True)
