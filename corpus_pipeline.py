"""The corpus pipeline: each stage works on all that its predecessor kept.

Toxic documents go, one document of each group of near-duplicates stays, documents with benchmark passages go, personal
data is replaced in the texts, and what is left is packed into sequences. Every stage but the last returns the columns of
its input; each is written as Parquet and read again by the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waferscope.llm import decontamination, packing, pii, simhash, toxicity
from waferscope.llm.registry import crc_fold, table
from waferscope.llm.shipping import ship
from waferscope.llm.storage import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from the labels of four folds of five, scores below a half."""
    ship(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.without_toxic(docs, toxicity.train(docs, labels.where(crc_fold(5) != 0)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group: 4-word shingles, at most 4 differing bits."""
    ship(spark)
    return simhash.one_of_each(docs, shingle_words=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    ship(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars set to the new length."""
    ship(spark)
    return pii.redacted(docs, pii.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of power-of-two lengths."""
    ship(spark)
    return packing.pack(docs, tokenizer="word_bpe_49k.json", end_id=2, longest=4096)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", replace_personal_data),
    ("packing", pack),
]

# SQL cannot express the learned stages, the alignment or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
