"""The registered queries of the corpus operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import (
    conversations, dedup, langid, licenses, mixing, ngram_join, packing, pii, sharding, spelling, token_files, topk, toxicity,
)
from meterflow.llm.common import crc_of, table
from meterflow.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of("doc_id"), F.lit(3)) == 1
    languages, lattice = langid.learn(documents, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return langid.predict(documents, languages, lattice).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@registered
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of("doc_id"), F.lit(5)) == 0
    stems, weights = toxicity.learn(documents, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(documents, stems, weights).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@registered
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@registered
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@registered
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.joined("base").cast("binary"), 256).alias("base_sha256"),
        pii.joined(F.concat("base", "learned")).alias("spans"),
        (F.size("base") + F.size("learned")).cast("long").alias("n_spans"),
    )


@registered
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@registered
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@registered
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    plans = mixing.plan(documents, F.array("source"))
    sources = mixing.source_table(plans)
    return plans.withColumn("source", F.element_at("members", 1)).join(
        F.broadcast(sources), F.col("source").eqNullSafe(F.col("of_source"))
    ).select("doc_id", "size", "source_size", "target", "taken")


@registered
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.decisions(table(spark, sf_dir, "documents"))


@registered
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@registered
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    files = token_files.write(
        documents, scratch_path(spark, "token-files"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return token_files.read(files).select("doc_id", "start", "n_tokens", "ids_crc32")


@registered
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged).withColumnRenamed("sha256", "repaired_sha256").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
