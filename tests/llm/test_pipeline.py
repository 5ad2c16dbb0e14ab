"""The stages of the pipeline on odd rows, and the whole of it stage by stage."""

import hashlib
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.test_simhash import plain_components, plain_fingerprint
from verdigrid.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, of string, component_id long"
ROWS = [
    (1, "one two three four five", "en", "a", 1, "k", "o", 9), (1, "one two three four five", "en", "a", 1, "k", "o", 9), (2, "one  two\nthree four five", None, None, 2, "", None, 0),
    (3, None, "en", "b", 3, None, None, None), (4, "", "de", "b", 4, None, None, None), (None, "one two three four five", "en", "a", 5, None, None, None),
    (None, "alone", "fr", None, 6, None, None, None), (6, "word " * 60_000, "en", "c", 7, None, None, None), (7, "ONE TWO THREE FOUR FIVE", "en", "a", 8, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda i: (i is None, i or 0))


def test_every_stage_keeps_the_columns_and_takes_an_empty_table(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd.limit(0), SF_DIR)
        assert out.count() == 0
        if name != "bpe":
            assert out.schema.names == odd.schema.names


def test_quality_drops_what_has_no_words(spark, odd):
    assert ids(corpus_pipeline.quality(spark, odd, SF_DIR)) == []
    docs = table(spark, SF_DIR, "documents")
    both = docs.union(docs.limit(20)).union(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(-5).cast("long")))
    kept = ids(corpus_pipeline.quality(spark, both, SF_DIR))
    assert set(kept) == set(ids(corpus_pipeline.quality(spark, docs, SF_DIR))) and len(kept) > len(set(kept)) > 0


def test_exact_duplicates(spark, odd):
    assert ids(corpus_pipeline.exact_duplicates(spark, odd, SF_DIR)) == [1, 1, 3, 6, 7, None]


def test_near_duplicates(spark, odd):
    assert ids(corpus_pipeline.near_duplicates(spark, odd, SF_DIR)) == [1, 1, 3, 6, None, None]


def test_near_duplicates_against_all_pairs(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = docs.collect()
    want = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    assert ids(corpus_pipeline.near_duplicates(spark, docs, SF_DIR)) == sorted(d for d, c in want.items() if d == c)


def test_mixture_takes_rows_of_one_id_alike(spark, odd):
    out = corpus_pipeline.mixture(spark, odd, SF_DIR)
    got = [tuple(r) for r in out.collect()]
    assert set(got) <= set(ROWS)
    times = {r: got.count(r) for r in ROWS}
    assert times[ROWS[0]] % 2 == 0 and all(n <= 2 * ROWS.count(r) for r, n in times.items())


def encoded(library, key, text):
    numbers = library.encode(text or "", add_special_tokens=False).ids
    packed, plain = struct.pack(f"<{len(numbers)}I", *numbers), library.decode(numbers, skip_special_tokens=False)
    return (str(key), len(numbers), hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain.encode()).hexdigest())


def test_encoding_and_the_whole_run(spark, odd):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    tuples = lambda df: sorted((str(r[0]), *r[1:]) for r in df.collect())
    assert tuples(corpus_pipeline.encoding(spark, odd, SF_DIR)) == sorted(encoded(library, r[0], r[1]) for r in ROWS)
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
    want = sorted(encoded(library, r["doc_id"], r["text"]) for r in docs.collect())
    assert want and tuples(corpus_pipeline.run(spark, SF_DIR)) == want
