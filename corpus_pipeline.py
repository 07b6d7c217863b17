"""The corpus pipeline: five stages over `documents`, each written and read again before the next.

    STAGES                 (name, function); a function takes (spark, docs, sf_dir)
    run(spark, sf_dir)     all stages, applied to documents

All stages but the last return the columns of their input; the last returns the packed pieces.
Between stages a Parquet table is written in the folder that spark.checkpoint.dir names, so a
lost executor repeats work of one stage at most."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import langid, packing, simhash, templates, winnow
from shelfmark.llm.frames import shared_folder, table
from shelfmark.llm.queries import vocabulary

# No stage after the first has an SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no text, no letter, or no label that most positions share."""
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of recurring lines go, and documents that have no other line."""
    return templates.drop_lines(docs, long_recurs=templates.LONG_RECURS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.representatives(docs, shingle=4, distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
