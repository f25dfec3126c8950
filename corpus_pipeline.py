"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``; the last returns
the pieces of the mixed corpus and their places in training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import exactdup, mixing, packing, simjoin, toxicity
from shelfwise.llm.common import stage, table
from shelfwise.llm.queries import pieces_of


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below one half; the model learns from all labelled ones."""
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.keep_clean(docs, toxicity.fit(rows))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, case aside: the one with the largest id."""
    return exactdup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simjoin.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's draw towards the square roots of the sources' sizes, in shuffled order."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences of 2048; copies of a document give their own pieces."""
    return packing.pack(pieces_of(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned first stage has no SQL form; the tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
