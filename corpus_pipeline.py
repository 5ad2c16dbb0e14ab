"""The corpus pipeline: quality rules, exact and SimHash near deduplication, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next stage's ``docs``. In every stage a null or empty
text is a text without words, a null ``lang`` or ``source`` is a value of its own, an empty table gives an empty result, texts of any length are
taken whole, and columns of any name ride along (the last stage returns its own). Documents are told apart by ``doc_id``: rows that repeat one (null
included) share its decision.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.llm import bpe
from verdigrid.llm.common import stored, table
from verdigrid.llm.exact_dedup import exact_dedup
from verdigrid.llm.mixing import mix
from verdigrid.llm.quality import judge
from verdigrid.llm.simhash import near_dedup

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside the perplexity band of their language go; copies count once.

    A null or empty text has too few words and goes. A ``doc_id`` stays if one of its rows passes.
    """
    judged = judge(docs.select("doc_id", "text", "lang"), each_text_once=True)
    stay = judged.where("kept").select(F.col("id").alias("doc_id")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["doc_id"]), "left_semi")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays, one with a null id only if there is no other.

    Null and empty texts are equal. A row that repeats both id and text stays as often as it stands there.
    """
    return exact_dedup(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by SimHash fingerprints (three words, two bits) the one with the smallest id stays.

    Wordless texts link with each other. A null id stays only in a group that has no other.
    """
    stay = near_dedup(docs.select("doc_id", "text")).where("doc_id <=> component_id").select("doc_id").distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["doc_id"]), "left_semi")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their targets.

    Rows with one id get one draw. Documents of a source without words have rate zero and go.
    """
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, each encoded and decoded again; a null text has no tokens."""
    return bpe.digests(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("mixing", mixture),
    ("bpe", encoding),
]

#: SQL cannot express the language model, the fingerprints and the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
