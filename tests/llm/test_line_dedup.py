"""Line dedup against a plain version, on odd tables, and its plan."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of
from verdigrid.llm import line_dedup
from verdigrid.llm.line_dedup import dedup_lines, dropped_lines, flat_bitmap

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, row string, pos int, of string"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def plain(rows, least=10):
    """``(doc_id, n_lines, n_dropped, text)``; a null id is one document that comes last."""
    rank = lambda i: (i is None, i or 0)
    holder = {}
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            holder[key_of(line)] = min(holder.get(key_of(line), rank(doc)), rank(doc))
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(key_of(x)) < least or holder[key_of(x)] == rank(doc)]
        out.append((str(doc), len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def ours(frame, **options):
    done = dedup_lines(frame, **options).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    return sorted((str(r[0]), *r[1:]) for r in done)


LONG = "\n".join(f"line number {i} of a long text" if i % 3 else "a common line here" for i in range(1000))
ROWS = [
    (5, "A common line here\nshort\n\tA COMMON line here \nown line of five", "r", 1, None),
    (2, " a common line here\r\nshort", "r", 2, "x"),
    (9, LONG, "r", 3, None), (12, LONG, None, None, None), (12, LONG, None, None, None), (12, "a common line here\nother text of twelve", None, 0, None),
    (None, "a common line here\nnull key has this line", "n", 0, ""), (None, "null key has this line", "n", 0, ""),
    (7, None, "", 0, ""), (8, "", "", 0, ""), (3, "\n\n\n", "", 0, ""), (4, "ÄÖÜ ÄÖÜ ÄÖÜ\näöü äöü äöü", "", 0, ""), (6, "äöü äöü äöü\nÄÖÜ ÄÖÜ ÄÖÜ", "", 0, ""),
    (10, "nine char", "", 0, ""), (11, "nine char", "", 0, ""), (13, "ten chars!", "", 0, ""), (14, "ten chars!", "", 0, ""),
    (15, " ten chars!", "", 0, ""), (16, "no trailing newline\n", "", 0, ""), (17, "no trailing newline\n", "", 0, ""),
]


@pytest.mark.parametrize("ranges", [1, 5, 64])
def test_odd_rows(spark, ranges):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert ours(frame, ranges=ranges) == plain(ROWS)


def test_a_line_in_most_documents_is_spread_and_right(spark):
    rng = random.Random(5)
    lines = ["the line that everyone has"] * 6 + [f"rare line {i} of few" for i in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9))), "", 0, "") for i in rng.sample(range(3000), 1500)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    often = line_dedup.frequent_keys(frame, "text", "doc_id", 10, 16)
    assert often.count() > 0
    assert ours(frame, ranges=16) == plain(rows)


def test_empty_table_and_columns_of_clashing_names(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, gone int, n_lines int")
    assert dedup_lines(empty).count() == 0
    frame = spark.createDataFrame([(1, "a line of text here", 4, "k"), (2, "a line of text here", 5, "l")], "doc_id int, text string, n_dropped int, id string")
    got = {r["row"]["doc_id"]: (r["row"]["n_dropped"], r["row"]["id"], r["kept_text"]) for r in dedup_lines(frame).collect()}
    assert got == {1: (4, "k", "a line of text here"), 2: (5, "l", "")}


def test_flat_bitmap_fills_gaps(spark):
    words = F.expr("array(named_struct('word', 1, 'bits', 5L), named_struct('word', 4, 'bits', -1L))")
    frame = spark.range(1).select(words.alias("words")).select(flat_bitmap(F.col("words")).alias("flat"))
    assert frame.first()["flat"] == [0, 5, 0, 0, -1]


def test_lines_move_once_and_without_text(spark, monkeypatch):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    plans = []
    real = line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, label: (plans.append((label, plan_of(df))), real(df, label))[1])
    dropped_lines(frame, ranges=8)
    plan = dict(plans)["line-verdicts"]
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len(moved) == 1 and "Python" not in plan and "Arrow" not in plan


def test_hash_of_result(spark):
    from verdigrid.llm.queries import QUERIES
    from tests.conftest import SF_DIR

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in plain(docs))
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in QUERIES["op11_line_dedup"](spark, SF_DIR).collect())
    assert got == want
