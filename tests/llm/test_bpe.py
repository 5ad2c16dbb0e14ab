"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from verdigrid.llm import bpe
from verdigrid.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " \t\n", "Hello, World!! it's 2024 I'LL we've", "ÉÀÈ ça ñandú ß İstanbul ΟΔΟΣ σΣ", "é å ﬁ ½ ² Ⅷ x y z\x1cq\x85r",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "日本語 テスト 한국어 🙂🙃 👩‍👩‍👧", "a" * 500, "ab" * 300 + "%" * 200, "don't 'S 'RE x'm", "_under_score_ 1234567",
    "́ combining", "ǅ ŉ ΐ K Å", "the the  the\n\nthe", "힣가", "x" * 97, "q" * 96,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)


def test_texts_agree_with_the_library(spark, library):
    rng = random.Random(1)
    alphabet = "abcEÉß '’.,!?0123\n\t ñ日́Σσς<|>%-"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 200))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, N_Tokens string")
    rows = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids, text = expected(library, texts[row["doc_id"]])
        assert bytes(row["ids"]) == ids and row["decoded"] == text and row["n_tokens"] == len(ids) // 4


def test_long_words_merge_alike_on_both_ways():
    with open(PATH, "rb") as f:
        model = bpe.WordBpe(f.read())
    rng = random.Random(2)
    for _ in range(200):
        parts = [model.inner[rng.choice(b"ethanrs")] for _ in range(rng.randint(1, 60))]
        assert model._scan(list(parts)) == model._heap(list(parts))


def test_texts_longer_than_a_piece(spark, library, monkeypatch):
    with open(PATH, "rb") as f:
        data = f.read()
    model, tokens = bpe.WordBpe(data), bpe.WordTokens(data)
    monkeypatch.setattr(bpe, "PIECE", 7)
    for text in ("one two  three\nfour five", "nospacesatallinhere", "a\nb c\nd e f g h i j k l"):
        assert model.encode(text) == expected(library, text)[0]
        assert tokens.decode(model.encode(text)) == expected(library, text)[1]


def test_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op1_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids, text = expected(library, docs[row["doc_id"]])
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, PATH).count() == 0
    assert bpe.decode(spark.sql("SELECT CAST(NULL AS BINARY) AS ids"), PATH).select(F.col("decoded")).first()[0] == ""


def test_every_code_point_within_a_word(library):
    with open(PATH, "rb") as f:
        model = bpe.WordBpe(f.read())
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert [i for i, text in enumerate(texts) if model.encode(text) != expected(library, text)[0]] == []
