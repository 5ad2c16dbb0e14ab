"""Repeat removal against a table of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from tests.conftest import SF_DIR
from verdigrid.llm import repeats
from verdigrid.llm.queries import QUERIES


def plain(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter()
    for data in raw:
        seen.update(data[i : i + 400] for i in range(len(data) - 399))
    out = []
    for data in raw:
        gone = bytearray(len(data))
        for i in range(len(data) - 399):
            if seen[data[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(data), sum(gone), runs, kept))
    return out


def made(rng):
    def noise(n):
        return "".join(rng.choice("abcdé fgh\n") for _ in range(n))

    passage, other = noise(900), noise(420)
    base = noise(3000)
    texts = [None, "", "short", noise(399), noise(400), "x" * 3000, "ab" * 900, ("line of sixty characters or so, again and again and again.\n") * 40]
    texts += [noise(rng.randint(0, 300)) + passage[rng.randint(0, 200) : 900 - rng.randint(0, 200)] + noise(rng.randint(0, 300)) for _ in range(12)]
    texts += [noise(200) + other[i:] + noise(100) for i in range(0, 12)]
    for _ in range(25):  # near copies
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = "Z"
        texts.append("".join(copy))
    texts += [base, base, noise(5000), noise(700) + passage + noise(50) + passage]
    return texts


@pytest.mark.parametrize(("collection", "piece"), [(8192, 1 << 22), (3, 1 << 22), (8192, 1500)])
def test_against_all_windows(spark, monkeypatch, collection, piece):
    texts = made(random.Random(5))
    monkeypatch.setattr(repeats, "PIECE", piece)
    found = {}
    if piece < 1 << 22:  # cut texts: compare in this process, where the smaller piece holds
        for numbers, offsets, held in repeats.blocks((t or "").encode() for t in texts):
            rows = repeats.segments(held)
            for i, first, n, times in zip(rows["text"], rows["first"], rows["n_windows"], rows["times"]):
                if times:
                    at = offsets[i] + first
                    found.setdefault(numbers[i], Counter()).update(range(at, at + n))
        for i, t in enumerate(texts[8:], 8):
            data = (t or "").encode()
            windows = {data[j : j + 400] for j in range(len(data) - 399)}
            assert {data[j : j + 400] for j in found.get(i, ())} == windows
        return
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, Kept int").repartition(5)
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in repeats.remove_repeats(df, collection=collection).collect()}
    want = plain(texts)
    assert len(got) == len(texts)
    for i, row in enumerate(want):
        assert got[i] == row, i


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    want = dict(zip(docs, plain(docs.values())))
    rows = QUERIES["op10_suffix_array_dedup"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, removed, spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_rows_without_or_with_equal_keys(spark):
    text = "".join(chr(97 + i * i % 23) + chr(97 + i % 17) for i in range(300))
    rows = [(None, text), (None, "y" + "".join(reversed(text))), (7, "q" * 399), (7, text[:450] + "tail"), (8, "lone " + "".join(map(str, range(300))))] * 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["id"]), r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    want = sorted((str(k), n, removed) for (k, _), (n, removed, _, _) in zip(rows, plain([t for _, t in rows])))
    assert got == want
    twice = repeats.remove_repeats(df.union(df)).collect()
    assert all(r["n_removed"] == (r["n_bytes"] if r["n_bytes"] >= 400 else 0) for r in twice)
    assert repeats.remove_repeats(df.limit(0)).count() == 0
