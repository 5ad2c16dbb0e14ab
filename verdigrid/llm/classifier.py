"""Quality classifier: perplexity under a model of trusted text, against quantiles of each language."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdigrid.llm.common import solid_key, stored, uniform
from verdigrid.llm.ngrams import SHARD, perplexities, train

#: A document is kept up to this quantile of the held-out trusted documents of its language.
QUANTILE = 0.995
#: Share of the trusted documents, by a hash of the key, that set the thresholds and not the counts: a text has a lower loss
#: under a model that has counted it, so thresholds from counted texts would reject good ones that are new.
HELD_OUT = 0.2
GRID = 1024
#: Ids of trusted documents are broadcast up to this number (16 bytes each), beyond it they are joined by shuffle.
BROADCAST_IDS = 2_000_000


def thresholds(losses: DataFrame, quantile: float) -> DataFrame:
    """``lang_key, threshold, rows``: the least grid step that covers the quantile of a language's ``loss`` rows, exact on the grid."""
    steps = losses.groupBy("lang_key", F.ceil(F.col("loss") * GRID).alias("step")).agg(F.count("*").alias("n"))
    by = W.partitionBy("lang_key")
    spread = steps.withColumn("upto", F.sum("n").over(by.orderBy("step"))).withColumn("total", F.sum("n").over(by))
    return spread.where(F.col("upto") >= quantile * F.col("total")).groupBy("lang_key").agg(
        (F.min("step") / GRID).alias("threshold"), F.first("total").alias("rows")
    )


def classify(
    docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    quantile: float = QUANTILE, rows: int = SHARD,
) -> DataFrame:
    """``id, lang, mean_loss, threshold, kept`` for each row of ``docs``; ``trusted`` has the keys of the trusted ones.

    The model is counted over the whole trusted texts but the held-out ones; count tables are joined by n-gram, and its shards meet the
    documents one after another. The threshold of a language is a quantile over all its held-out trusted documents; a language with too few
    for that quantile takes that of all held-out documents together. If no document is held out, or all are, the same trusted documents serve
    both ends. A null or empty text has no loss and is not kept; a null language is one of its own; repeated rows
    get equal verdicts. Without any trusted text nothing is kept. Other columns play no part.
    """
    plain = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("text_hash"))
    ids = trusted.select(F.col(key).alias("id")).where("id IS NOT NULL").distinct()
    ids = stored(ids.withColumn("held", uniform(F.lit("held-out"), F.col("id").cast("string")) < HELD_OUT), "trusted")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    fitted = plain.join(ids.where("NOT held"), "id", "left_semi")
    model = train(plain.join(ids, "id", "left_semi") if fitted.isEmpty() else fitted)
    losses = perplexities(plain, model, "id", "text", rows).select(
        F.col("id").alias("of"), F.col("text_hash").alias("of_hash"), F.col("mean_loss").alias("loss")
    )
    keys = plain.select("id", "text_hash", "lang", solid_key(F.col("lang")).alias("lang_key"))
    scored = stored(
        keys.join(losses, keys["id"].eqNullSafe(losses["of"]) & (keys["text_hash"] == losses["of_hash"])).drop("of", "of_hash", "text_hash"), "scored"
    )
    known = scored.where("loss IS NOT NULL")
    good = known.join(ids.where("held"), "id", "left_semi")
    if good.isEmpty():
        good = known.join(ids, "id", "left_semi")
    limits = thresholds(good, quantile).where(F.col("rows") * (1 - quantile) >= 1).drop("rows")
    overall = thresholds(good.withColumn("lang_key", F.lit("")), quantile).first()
    limit = F.coalesce("threshold", F.lit(overall["threshold"] if overall else None).cast("double"))
    return scored.join(limits, "lang_key", "left").select(
        "id", "lang", F.col("loss").alias("mean_loss"), limit.alias("threshold"), F.coalesce(F.col("loss") <= limit, F.lit(False)).alias("kept")
    )
