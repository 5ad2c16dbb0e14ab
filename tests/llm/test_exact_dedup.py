"""Exact deduplication and mixing against DuckDB and small brute force."""

import re

import pytest
from pyspark.sql import functions as F

from tests.check_queries import compare, connect
from tests.conftest import SF_DIR, plan_of
from verdigrid.llm.exact_dedup import exact_dedup
from verdigrid.llm.mixing import mix, mix_plan
from verdigrid.llm.queries import CHECKS, QUERIES


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees(spark, name):
    assert compare(spark, connect(SF_DIR), name, QUERIES[name], CHECKS[name], SF_DIR) == ""


ROWS = [
    (4, "a  b", "x"), (2, "a\t\nb", "y"), (9, "a b", None), (9, "a b", None), (7, None, "n"), (3, "", "e"), (8, " ", "s"),
    (None, "a b", "q"), (None, "lone", "q"), (11, "x" * 300_000, "long"), (12, "x" * 300_000, "long"), (13, "a b", "nbsp"),
]


def plain(rows):
    texts = {}
    for key, text, _ in rows:
        texts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(key)
    out = []
    for key, text, _ in rows:
        group = texts[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")]
        keep = min((k for k in group if k is not None), default=None)
        out.append((str(key), str(keep), len(group), key == keep))
    return sorted(out)


@pytest.mark.parametrize("weak", [False, True])
def test_small_cases_also_when_digests_collide(spark, weak):
    digest = (lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 2)) if False else F.lit(b"\x01")) if weak else None
    df = spark.createDataFrame(ROWS, "doc_id long, text string, Kept string").repartition(4)
    done = exact_dedup(df, digest=digest) if weak else exact_dedup(df)
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in done.collect())
    assert got == plain(ROWS)


def test_no_python_in_the_plan_and_empty_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = plan_of(exact_dedup(df.select("doc_id", "text")))
    assert "Python" not in plan and "Cartesian" not in plan
    assert exact_dedup(df.limit(0)).count() == 0


def test_mix_takes_what_it_plans(spark):
    rows = [(i, "w " * (i % 40 + 1), ["hot", "b", None, "tiny", ""][0 if i % 3 else i % 5]) for i in range(3000)]
    rows += [(5000, None, "void"), (5001, " ", "void"), (None, "one two", "b"), (7, "w", "hot"), (7, "w", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit(1))
    plan = mix_plan(df)
    total = plan.agg(F.sum("size")).first()[0]
    per = {r["source"]: r for r in plan.groupBy("row.source").agg(
        F.first("target").alias("target"), F.first("source_size").alias("all"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()}
    assert abs(sum(r["target"] for r in per.values()) - 1.5 * total) < 1e-6 * total
    # plain water filling
    names = sorted(k for k in per if k is not None) + [None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    capped, level = set(), 0
    while True:
        level = (1.5 * total - sum(2 * per[n]["all"] for n in capped)) / sum(weight[n] for n in names if n not in capped)
        more = {n for n in names if level * weight[n] >= 2 * per[n]["all"]}
        if more == capped:
            break
        capped = more
    for n in names:
        assert per[n]["target"] == pytest.approx(min(2 * per[n]["all"], level * weight[n]))
        if (per[n]["all"] or 0) > 1000:
            assert per[n]["taken"] == pytest.approx(per[n]["target"], rel=0.15)
    assert plan.where("copies > 2").count() == 0
    mixed = mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert mix(df.limit(0)).count() == 0
    again = mix_plan(df.repartition(7)).groupBy().agg(F.sum(F.xxhash64("row.doc_id", "copies").cast("decimal(38,0)"))).first()
    assert again == plan.groupBy().agg(F.sum(F.xxhash64("row.doc_id", "copies").cast("decimal(38,0)"))).first()
