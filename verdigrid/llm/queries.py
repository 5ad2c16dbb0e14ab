"""Registered queries of the text operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigrid.llm import bpe
from verdigrid.llm.classifier import classify
from verdigrid.llm.common import table
from verdigrid.llm.exact_dedup import exact_dedup
from verdigrid.llm.hard_negatives import hard_negatives
from verdigrid.llm.licenses import scan_licenses
from verdigrid.llm.line_dedup import ascii_lower, dedup_lines
from verdigrid.llm.mixing import mix_plan
from verdigrid.llm.pii import replace_pii
from verdigrid.llm.quality import judge
from verdigrid.llm.repeats import remove_repeats
from verdigrid.llm.simhash import near_dedup
from verdigrid.llm.spelling import variant_groups
from verdigrid.llm.url_lists import filter_urls, host_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            CHECKS[name] = sql
        return function

    return add


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(
    "op5_exact_dedup",
    r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
           sha256(t) AS text_sha256
    FROM n WINDOW g AS (PARTITION BY t)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("text_digest")).alias("text_sha256"))


@query(
    "op6_mixing",
    r"""
    WITH sized AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
    c AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS all_weights,
                 CAST(sum(2 * source_size) OVER o AS BIGINT) AS caps, CAST(sum(weight) OVER o AS BIGINT) AS gone
          FROM w WINDOW o AS (ORDER BY 2E0 * source_size / weight, source NULLS LAST)),
    l AS (SELECT max(level) AS level FROM (
            SELECT 15E-1 * total / all_weights AS level FROM c
            UNION ALL
            SELECT (15E-1 * total - caps) / (all_weights - gone) FROM c
            WHERE all_weights > gone AND (15E-1 * total - (caps - 2 * source_size)) / (all_weights - (gone - weight)) * weight >= 2 * source_size)),
    t AS (SELECT source, source_size, least(2E0 * source_size, level * weight) AS target FROM w, l),
    r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0E0 END AS rate,
                 CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496E0 AS draw
          FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, round(target, 3) AS target,
           CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM r
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return plan.select(
        "row.doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op9_quality_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("mean_loss", 6).alias("mean_loss"),
    )


@query("op10_suffix_array_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # a cut may fall inside a character: the text marks what is left of it, the hash is that of the bytes
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), text)


def _hex_number(column, start: int) -> F.Column:
    return F.conv(F.substring(F.md5(column), start, 6), 16, 10).cast("long")


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries derived from the hosts of ``pages``: two in five registered domains are listed, half of these leave, some come back."""
    domain = F.regexp_extract(host_of(F.col("url")), r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("domain")
    hosts = pages.select(domain).where("domain <> ''").distinct()
    hosts = hosts.withColumn("u", _hex_number(F.col("domain"), 1)).withColumn("d", _hex_number(F.col("domain"), 7) % 180).where("u % 5 < 2")
    day = lambda n: F.timestamp_add("DAY", n.cast("int"), F.lit("2024-01-01").cast("timestamp"))
    category = F.when(F.col("u") % 3 == 0, "adult").when(F.col("u") % 3 == 1, "malware").otherwise("spam")
    steps = F.array(
        F.struct(day(F.col("d")).alias("at"), F.lit("add").alias("action")),
        F.when(F.col("u") % 2 == 0, F.struct(day(F.col("d") + 60).alias("at"), F.lit("remove").alias("action"))),
        F.when(F.col("u") % 4 == 0, F.struct(day(F.col("d") + 120).alias("at"), F.lit("add").alias("action"))),
    )
    return hosts.select("domain", category.alias("category"), F.explode(steps).alias("e")).where("e IS NOT NULL").select("domain", "e.at", "e.action", "category")


@query(
    "op3_url_lists",
    r"""
    WITH h AS (SELECT page_id, rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
                      TIMESTAMP '2024-01-01' + to_days(CAST(page_id * 7 % 365 AS INT)) AS fetched FROM pages),
    d AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS domain FROM h),
    n AS (SELECT domain, CAST('0x' || substr(md5(domain), 1, 6) AS BIGINT) AS u, CAST('0x' || substr(md5(domain), 7, 6) AS BIGINT) % 180 AS d
          FROM d WHERE domain <> ''),
    l AS (SELECT *, CASE u % 3 WHEN 0 THEN 'adult' WHEN 1 THEN 'malware' ELSE 'spam' END AS category FROM n WHERE u % 5 < 2),
    v AS (SELECT domain, category, d AS since, CASE WHEN u % 2 = 0 THEN d + 60 ELSE 100000 END AS until FROM l
          UNION ALL SELECT domain, category, d + 120, 100000 FROM l WHERE u % 4 = 0),
    b AS (SELECT page_id, host, v.domain, category, since, row_number() OVER (PARTITION BY page_id ORDER BY length(v.domain) DESC) AS k
          FROM h JOIN v ON (host = v.domain OR host LIKE '%.' || v.domain)
            AND fetched >= TIMESTAMP '2024-01-01' + to_days(CAST(since AS INT)) AND fetched < TIMESTAMP '2024-01-01' + to_days(CAST(until AS INT)))
    SELECT h.page_id, nullif(h.host, '') AS host, b.domain AS matched, CAST(date_diff('day', DATE '2024-01-01', CAST(TIMESTAMP '2024-01-01' + to_days(CAST(since AS INT)) AS DATE)) AS INT) AS listed_day,
           category, b.domain IS NULL AS kept
    FROM h LEFT JOIN b ON h.page_id = b.page_id AND k = 1
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    at = F.timestamp_add("DAY", (F.col("page_id") * 7 % 365).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    done = filter_urls(pages.withColumn("fetched_at", at), list_entries(pages))
    day = F.datediff(F.col("listed_since").cast("date"), F.lit("2024-01-01").cast("date"))
    return done.select("row.page_id", "host", "matched", day.alias("listed_day"), "category", "kept")


def placed(docs: DataFrame) -> DataFrame:
    """Documents as files: a folder per source with up to three levels below it; every 40th document is a licence file."""
    level = lambda n: F.concat(F.lit("/"), F.lit("abc"[n]), (F.col("doc_id") % (n + 3)).cast("string"))
    folder = F.concat(F.coalesce("source", F.lit("none")), F.when(F.col("doc_id") % 40 == 0, "").otherwise(level(0)), F.when(F.col("doc_id") % 3 > 0, level(1)).otherwise(""), F.when(F.col("doc_id") % 7 > 3, level(2)).otherwise(""))
    name = F.when(F.col("doc_id") % 40 == 0, F.lit("LICENSE")).otherwise(F.concat(F.lit("text"), F.col("doc_id").cast("string")))
    return docs.withColumn("path", F.concat(folder, F.lit("/"), name))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = scan_licenses(placed(table(spark, sf_dir, "documents").select("doc_id", "source", "text")))
    return done.select("row.doc_id", "row.path", "own_license", F.round("similarity", 6).alias("similarity"), "license", "inherited_from")


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    done = classify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), trusted)
    return done.select(F.col("id").alias("doc_id"), "lang", F.round("mean_loss", 6).alias("mean_loss"), F.exp("mean_loss").alias("perplexity"), "threshold", "kept")


#: Key of the surrogates; give your own in production.
SURROGATE_KEY = "verdigrid-example-key"


@query("op8_pii_surrogates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


@query(
    "op11_line_dedup",
    r"""
    WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    j AS (SELECT doc_id, line, pos, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def misspelt_words(docs: DataFrame, every: int = 97) -> DataFrame:
    """``word, n``: lower-cased runs of letters of all whole texts, one in about ``every`` with a letter deleted, by the checksum of document and run.

    A null text has no words; a null ``doc_id`` counts as empty text in the checksum.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z\u00C0-\u00FF]+"), 0)).alias("run"))
    runs = runs.select(ascii_lower(F.col("run")).alias("run"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"), F.char_length("run").alias("length"))
    at = (F.col("h") % F.col("length")).cast("int")
    short = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("length")))
    return runs.select(F.when(F.col("h") % every == 0, short).otherwise(F.col("run")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = misspelt_words(table(spark, sf_dir, "documents").select("doc_id", "text")).where("char_length(word) >= 5 AND n >= 3")
    return variant_groups(words).select("word", "form", "root", "n", "n_near", "form_n")


@query(
    "op13_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                 CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
    QUALIFY row_number() OVER w <= 10
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives(rows, F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))
