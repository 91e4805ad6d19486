"""The registered queries: each operator over its whole table, with the
contract's parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardwalk.llm import bpe, byte_bpe, decontaminate, divergence, langid, line_dedup, lm, quality, rabitq, simhash, toxicity, variants, warc
from boardwalk.llm.common import table


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_rabitq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.learn_and_identify(table(spark, sf_dir, "documents"), parts=4, held=2)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenized(table(spark, sf_dir, "documents"), _vocabulary())


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_lines(docs, line_dedup.line_bitmaps(docs, min_docs=10, min_chars=1))
    return out.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), parts=5, held=0)
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.held_out_scores(table(spark, sf_dir, "documents"), parts=7, held=2)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), parts=3, held=1)
    return found.select("doc_id", "held_out", "score", "predicted")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark), min_bytes=1000)
    return warc.read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, drop_every=199)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [
        op1_rabitq_search,
        op2_language_id,
        op3_bpe,
        op4_simhash_groups,
        op5_line_dedup,
        op6_toxicity,
        op7_decontamination,
        op8_lm_score,
        op9_quality,
        op10_warc,
        op11_byte_bpe,
        op12_source_divergence,
        op13_spelling_variants,
    ]
    return {f.__name__: f for f in every}
