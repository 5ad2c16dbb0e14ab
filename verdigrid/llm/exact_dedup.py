"""Exact deduplication by salted, content-checked combining (DataFrame operations only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdigrid.llm.common import stored

#: White space that the normal form turns into one space; single spaces need no work.
_RUNS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
SALTS = 16


def normal_form(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per different text: ``digest, content, keep_id, group_size``.

    Three combining stages, each grouping by digest **and** full text: within a task (map-side), within a salt
    (the number of the reading task modulo ``salts``), and over the salts' winners. A text that makes up a third
    of the rows reaches the last stage as at most ``salts`` rows. ``content`` is null unless the digest belongs to
    several texts.
    """
    rows = docs.select(F.col(key).alias("id"), normal_form(F.col(text)).alias("content"))
    rows = rows.select("id", "content", digest(F.col("content")).alias("digest"), (F.spark_partition_id() % salts).alias("salt"))
    merged = rows.groupBy("salt", "digest", "content").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    winners = (
        merged.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
        .withColumn("texts", F.count("*").over(W.partitionBy("digest")))
    )
    return stored(
        winners.select("digest", F.when(F.col("texts") > 1, F.col("content")).alias("content"), "keep_id", "group_size"),
        "text-groups",
    )


def exact_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """All columns of ``docs`` plus ``keep_id, group_size, kept, text_digest`` (its own columns of these names go).

    Texts are equal when their normal forms are; the row with the smallest ``key`` stays. A null text is empty. A row
    with a null key stays only if its group has no other key. ``key`` names a document: rows that repeat one key and
    text share its fate. An empty table gives an empty result.

    The way back is a join on the digest. Contents were compared while grouping, so a digest with one text decides
    by itself; for digests with several texts (if there are any at all) the join compares the texts again.
    """
    groups = text_groups(docs, text, key, salts, digest)
    own = [c for c in docs.columns if c.lower() not in ("keep_id", "group_size", "kept", "text_digest")]
    form = normal_form(F.col(text))
    left = docs.select(F.struct(*own).alias("row"), digest(form).alias("digest"), form.alias("own_text"))
    single = groups.where("content IS NULL").drop("content")
    out = left.drop("own_text").join(single, "digest")
    shared = groups.where("content IS NOT NULL")
    if not shared.isEmpty():
        shared = shared.withColumnRenamed("content", "own_text")
        out = out.unionByName(left.join(shared, ["digest", "own_text"]).drop("own_text"))
    return out.select(
        "row.*", "keep_id", "group_size", F.col(f"row.{key}").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_digest"),
    )
