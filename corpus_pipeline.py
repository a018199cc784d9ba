"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared checkpoint folder and reads it again for
the next stage.

All stages count whole texts, however long, take a null text as the empty one,
give repeated rows one fate each, keep an empty table empty, and leave other
columns, whatever their names, as they are; the docstrings say what else holds.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import exact_dedup, jaccard, language, packing, toxicity
from shelfwise.llm.common import ensure_checkpoint_dir, table


#: Spark sends Python workers batches of at most so many bytes: a stage holds two or three at once in each of an executor's tasks.
BATCH_BYTES = "4m"


def modest(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the classifier chain calls toxic; trained on the labelled documents among them.

    Null and empty texts are judged like any other: they have no feature.
    """
    modest(spark)
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without a letter, or that resemble no learned language, go: null and empty ones, too."""
    modest(spark)
    return language.keep_identified(docs, language.train(docs), least=0.35)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id; of rows that repeat both, or of a text without ids, one."""
    modest(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: shingles of five words, similarity 0.8 or more.

    Texts without a word, and rows without id, stay.
    """
    modest(spark)
    return jaccard.drop_near_copies(docs, words=5, num=80, den=100)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents' ids in sequences of 2048; an empty text has its end id alone."""
    import public_tokenizers

    modest(spark)
    return packing.digests(packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY)))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("exact_dedup", drop_exact),
    ("ngram_jaccard", drop_near),
    ("packing", pack),
]

#: The trained stages and the packing have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the rows of the last one."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
