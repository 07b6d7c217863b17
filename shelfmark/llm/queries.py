"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import chat, htmltext, langid, lexical, packing, quality, secrets, simhash, suffixes, templates, vectors, whitening, winnow
from shelfmark.llm.frames import shared_folder, table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    LLM_QUERIES[f.__name__] = f
    return f


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnow.digest(winnow.decontaminate(documents, table(spark, sf_dir, "benchmark").select("item_id", "text")))


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("host"))
    return quality.judge(documents, copies=True).drop("host")


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(table(spark, sf_dir, "documents"), long_recurs=templates.LONG_RECURS)


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    # a ledger of its own, so that every blob is scanned
    ledger = secrets.Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    history = ledger.update(texts)
    return ledger.report(history).withColumnRenamed("path", "doc_id")


@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], conversations.schema)
    return chat.digest(chat.format_conversations(conversations.unionByName(extra)))


@query
def op11_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)
