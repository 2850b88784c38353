"""Query keys of the operators and of the pipeline, and their SQL.

Each query applies its operator with production parameters to a whole table and derives
the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    decontaminate, hard_negatives, jaccard_join, language_id, licenses, packing, piece_encoding, pii,
    quality, ranked_search, repeats, spotsigs, toxicity,
)
from quayside.llm.common import table
from quayside.llm.labelled import held_out

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    from public_tokenizers import path

    return path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["stop"] - h["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(table(spark, sf_dir, "documents"))
    return language_id.identify(table(spark, sf_dir, "pages"), model)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.rate(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_1",
        "tail_2", (F.col("tail_1") >= 0.5).alias("selected"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spotsigs.edited_and_next(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        spotsigs.written(F.col("spots")).alias("fingerprint"),
        spotsigs.written(F.col("edited_spots")).alias("edited_fingerprint"),
        "near_edited", "near_next")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *pii.digests(found))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path(PIECES)
    return piece_encoding.digests(
        piece_encoding.encode(table(spark, sf_dir, "documents"), model), model)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_decontamination, op3_license_scan, op4_language_id, op5_jaccard_join,
        op6_quality, op7_toxicity, op8_suffix_dedup, op9_fingerprints, op10_pii,
        op11_ranked_search, op12_hard_negatives, op13_pieces, pipeline)
}

ORACLES: dict[str, str] = {
    "op3_license_scan": licenses.scan_sql(),
    "op11_ranked_search": ranked_search.ranked_sql(),
    "op12_hard_negatives": hard_negatives.negatives_sql(),
}
