"""Mixing sources to target weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigrid.llm.common import WORD, fresh, stored, uniform

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``source, source_size, target`` from ``(source, size)`` rows.

    Sizes combine map-side, so a hot source is no hot spot. The order of the sources comes from a distributed sort.
    A target is ``least(most * size, level * weight)``; the level rises while sources reach their cap and the rest
    shares the excess. A round is one aggregate of whole numbers, so reruns agree to the last bit.
    """
    if share > most:
        raise ValueError("no mix takes more than all documents the allowed number of times")
    spark = sized.sparkSession
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = sums.orderBy(F.col("source").asc_nulls_last())
    numbered = ordered.rdd.zipWithIndex().map(lambda r: (r[0][0], r[0][1], weights[r[1] % len(weights)]))
    schema = sized.select("source").schema.add("source_size", "long").add("weight", "long")
    sources = stored(spark.createDataFrame(numbered, schema), "sources")
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = share * (total or 0) / (weight or 1), -1
    while True:
        above = F.lit(level) * F.col("weight") >= most * F.col("source_size")
        count, fixed, free = sources.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if count == capped or not free:
            break
        level, capped = (share * total - most * (fixed or 0)) / free, count
    return sources.select(
        "source", "source_size", F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight")).alias("target")
    )


def mix_plan(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST,
) -> DataFrame:
    """Each row of ``docs`` as struct ``row``, with ``size, source_size, target, rate, copies``.

    A document is taken ``floor(rate)`` times plus once more with probability ``rate - floor(rate)``, decided by a hash
    of the seed and the key. A null text or one without words has size 0; a null source is a source of its own, last in order.
    Rows with equal keys get equal draws. A source without words has rate 0. An empty table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    targets = source_targets(docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size")), weights, share, most)
    targets = targets.withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    draw = uniform(F.lit(seed), F.coalesce(F.col(f"row.{key}").cast("string"), F.lit("")))
    return (
        rows.join(targets, rows["source"].eqNullSafe(targets["of"]))
        .withColumn("rate", rate)
        .withColumn("copies", (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
        .select("row", "size", "source_size", "target", "rate", "copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as the plan takes it."""
    (copy,) = fresh(docs, "copy")
    plan = mix_plan(docs, **options).where("copies > 0")
    return plan.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy)).select("row.*")
