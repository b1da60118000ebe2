"""Stages of a training-data pipeline over ``documents``, each one operator of ``quire.llm``.

Each stage gets the documents that its predecessor kept and returns documents
with the same columns; the last returns tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, jaccard, pii, toxicity
from quire.llm.common import table
from quire.llm.queries import vocabulary_path
from quire.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents graded clean by the ordinal model, which is fitted on the labelled ones."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group tied by copies or by five-word similarity of 0.8 or more."""
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; n_chars counts the new text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else masked


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text they decode to."""
    return bpe.encode(docs, vocabulary_path(), ("n_tokens", "ids", "decoded"))


STAGES = [("toxicity", drop_toxic), ("jaccard", drop_near_copies), ("decontamination", drop_leaks), ("pii", mask_personal_data), ("bpe", encode_bpe)]

#: The stages fit models, search by latent vectors and merge byte pairs; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written as Parquet in the shared
    folder and read again, so no stage is computed twice and a lost executor
    costs at most the stage at hand."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
