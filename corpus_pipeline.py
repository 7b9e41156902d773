"""Training-data pipeline over ``documents``: quality classifier, MinHash
near-dedup, secret scan, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its
predecessor kept; all but the last return the columns of ``documents``.
``run`` writes every stage's result as Parquet into the shared scratch
folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import classifier, common, minhash, mixing, packing, secrets

KEEP_SCORE = 0.3

# The stages train, hash and pack; SQL cannot express them.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of documents
    whose crc32 of the id is not a multiple of 5, does not reject."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    learnt = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = classifier.fit(docs, learnt)
    score = common.free_column(docs, "score")
    return classifier.score(docs, model, out=score).filter(F.col(score) >= KEEP_SCORE).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.one_per_group(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live credentials in their texts are replaced."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                            .otherwise(F.length("text").cast("long"))).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (weights 1 to 3
    by source, at most 3 copies)."""
    size, copies = common.free_column(docs, "words"), "copies"
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    light = common.written(sized.select("source", size), "mix-sizes")
    weights = mixing.cyclic_weights(mixing.source_sizes(light, "source", size))
    mixed = mixing.mix(sized, weights, size_col=size)
    return (mixed.filter(F.col(copies) > 0)
            .select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias("_copy"))
            .drop("_copy"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, one row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
