"""A training corpus out of `documents`: toxicity, line dedup, near-dedup, mixing and BPE, stage by stage.

Each stage reads what the one before it has written, so an executor lost in a later stage costs no
earlier one. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revaudit.llm import bpe, linedup, mixing, neardup, toxicity
from revaudit.llm.common import table
from revaudit.operators.scratch import settle


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The model learns from the labels of the stage's own documents."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of fifty words and more are cut out of the texts; n_chars follows the new text."""
    cut = linedup.remove_repeats(docs)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("n_chars"))).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lowest doc_id of each class of near-duplicates stays."""
    return neardup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    return mixing.taken(mixing.mix(docs)).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and the decoded text's digest."""
    encoded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), decoded=True, kept=["doc_id", "source"])
    return encoded.select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", remove_repeats),
    ("near dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The toxicity stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
