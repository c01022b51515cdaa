"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import jaccard_join, packing, pii_bootstrap, sentence_spans, toxic_crf
from tidewell.llm.storage import dropped_after, stored

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field does not reject; it is fitted on labelled ones of this input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_crf.without_toxic(docs, toxic_crf.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.one_per_class(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences of passages that stand in an earlier place.

    A document of which nothing is left stays, with an empty text.
    """
    out = sentence_spans.remove_repeated_spans(docs)
    return out.select(
        *(
            F.col("kept_text").alias("text") if c == "text"
            else F.length("kept_text").cast("long").alias("n_chars") if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        )
    )


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    out = pii_bootstrap.masked(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text_key")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL can express the field, nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*_COLUMNS)
    for name, stage in STAGES:
        with dropped_after(spark):
            docs = stored(stage(spark, docs, sf_dir), name)
    return docs
