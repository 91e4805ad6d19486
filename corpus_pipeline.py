"""A corpus from raw documents to tokens, as five stages.

Each stage takes ``(spark, docs, sf_dir)``; ``docs`` holds what its predecessor
kept. All but the last return the columns of ``documents``. A stage never
looks at other stages' inputs, and copes with null, empty, repeated and no
rows as its operator's docstring says.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from boardwalk.llm import bpe, decontaminate, langid, line_dedup, simhash
from boardwalk.llm.common import fold, table
from boardwalk.session import shared_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows outside fold 2 of 4 and names the language
    of every row: from here on ``lang`` is the language that the network found,
    whatever the row came with. Rows that get ``und``, which are those without
    letters, go, however unsure the others' language."""
    net = langid.fit(docs.where(fold(docs["doc_id"], 4) != 2).select("doc_id", "text", "lang"))
    return langid.keep_identified(docs, net, into="lang")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more leave every text."""
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the smallest doc_id stays."""
    return simhash.keep_one(docs, simhash.simhash_groups(docs, shingle=4, max_bits=4))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), window=10))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, the digests of a decoded round trip, and the
    language that was found, by which a corpus is mixed."""
    return bpe.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True, also=("lang",))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

#: SQL can express neither the trained network nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage keeps is a table in the
    shared folder before the next one reads it, so no stage is computed twice
    and none depends on executors that have gone."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/boardwalk-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
