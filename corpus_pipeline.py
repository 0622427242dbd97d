"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportarium.llm import packing, secret_scan, super_minhash, toxicity
from reportarium.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for clean; a fifth of the labels stays unseen."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels), "__toxicity")
    return scored.filter(F.col("__toxicity") < 0.5).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, on shingles of five words."""
    return super_minhash.deduplicated_rows(docs, size=5)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, sequences and offsets."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", secret_scans),
    ("packing", pack_sequences),
]

#: Label models, signatures and token ids are beyond SQL; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
