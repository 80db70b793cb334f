"""The corpus pipeline: operators one after another, each reading what its predecessor wrote.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the
last return the columns of ``docs``.  Stages with Python code ship the package
to the workers.  NULL texts, empty tables and repeated
rows are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import bpe, exact_dedup, jaccard, mixing, repetition
from rowloom.llm.common import free_names
from rowloom.session import materialize, ship_package

#: The tokenizer file of the last stage.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    ship_package(spark)
    return repetition.drop_repetitive(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    ship_package(spark)
    return jaccard.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document is repeated for each epoch that takes from it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids; the decoded text is kept as its digest."""
    ship_package(spark)
    (name,) = free_names(docs, "tokens_")
    rows = docs.withColumn(name, bpe.tokens("text", VOCABULARY))
    return rows.select(
        "doc_id",
        "source",
        (F.octet_length(f"{name}.ids") / 4).cast("long").alias("n_tokens"),
        F.col(f"{name}.ids").alias("token_ids"),
        F.sha2(F.col(f"{name}.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("jaccard_join", near), ("mixing", mix), ("bpe_encoding", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
