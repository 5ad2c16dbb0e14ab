"""Groups of copies must not change what the quality stage keeps."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from verdigrid.llm import quality
from verdigrid.llm.common import table


def test_copy_groups_change_no_verdict(spark):
    docs = table(spark, SF_DIR, "documents")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF_DIR).collect()}
    clean = docs.where(F.col("doc_id").isin(*kept) & (F.col("n_chars") > 1000)).orderBy("lang", "doc_id").collect()
    first = {r["lang"]: r["doc_id"] for r in reversed(clean)}
    assert len(first) > 1
    for share, (lang, doc) in zip((20, 400), sorted(first.items())):  # a tenth, two thirds of the rows
        of = docs.where(F.col("doc_id") == doc)
        copies = of.crossJoin(spark.range(share)).withColumn("doc_id", F.col("id") + 1_000_000).drop("id")
        got = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs.unionByName(copies), SF_DIR).collect()}
        assert {d for d in got if d < 1_000_000} == kept
        assert sum(d >= 1_000_000 for d in got) == share


def test_spread_has_a_floor(spark):
    losses = spark.createDataFrame([("1en", 1.5)] * 60 + [("1en", 1.51)] * 40, "lang_key string, loss double")
    assert quality.bands(losses).first()["spread"] >= quality.LEAST_SPREAD
