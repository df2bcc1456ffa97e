"""The corpus pipeline: each stage reads what the one before it has written and hands on the columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import dedup, langid, mixing, ngram_join, packing
from meterflow.llm.common import crc_of, stored, table

#: Documents whose likeliest language is less sure than this are rejected.
SURE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in one of the learned languages; texts that are null or without a letter go.

    Learned from the rows that are not held out, null languages left out; where no language was learned, all rows go.
    Repeated rows are judged each; an empty table stays empty.
    """
    held_out = F.pmod(crc_of("doc_id"), F.lit(3)) == 1
    languages, lattice = langid.learn(docs, public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return langid.in_a_language(docs, languages, lattice, SURE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id (null last), then one by a digest of its columns.

    A null text is an empty one, so of all rows without a text one stays. An empty table stays empty.
    """
    return dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id (null last).

    Rows are told by a number of their own: repeated and null ids do not matter. Rows without words are near nothing and
    stay. An empty table stays empty.
    """
    return ngram_join.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for them; those that are not taken go.

    A null source is a source. Texts without words are never taken. Reruns agree. An empty table stays empty.
    """
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 ids.

    A null text is its end id alone; a document that was taken twice is packed twice. An empty table gives no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language), ("exact dedup", exact), ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixture), ("packing", packed),
]

#: Languages, signatures and token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again. Nulls, ties and empty tables are each stage's matter."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
