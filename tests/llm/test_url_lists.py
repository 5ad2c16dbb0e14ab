"""URL lists, licences, personal data and the quality classifier on small tables."""

import math
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, plan_of
from verdigrid.llm import licenses, pii
from verdigrid.llm.classifier import classify
from verdigrid.llm.queries import QUERIES, placed
from verdigrid.llm.url_lists import filter_urls, intervals


def day(n):
    return datetime(2024, 1, n)


ENTRIES = [
    ("bad.com", day(2), "add", "spam"), ("bad.com", day(10), "remove", None), ("bad.com", day(20), "add", "adult"),
    ("deep.bad.com", day(5), "add", "malware"), ("early.org", None, "add", "spam"), (None, day(1), "add", "spam"),
    ("same.net", day(3), "remove", None), ("same.net", day(3), "add", "spam"), ("Upper.Org", day(1), "add", "spam"), ("odd.com", day(1), "drop", "x"),
]
CAPTURES = [
    (1, "http://bad.com/x", day(1), None), (2, "http://www.bad.com/", day(2), None), (3, "https://u:p@bad.com:80/a?b", day(10), None), (4, "http://a.deep.bad.com", day(6), None),
    (5, "http://BAD.com./", day(25), None), (6, "http://early.org", day(1), None), (7, None, day(5), None), (8, "http://bad.com", None, None), (9, "no url", day(5), None),
    (10, "http://same.net", day(4), None), (11, "http://notbad.com", day(5), None), (12, "http://upper.org", day(9), None), (2, "http://www.bad.com/", day(2), None),
    (None, "http://odd.com", day(5), None), (13, "", day(3), None),
]
WANT = {1: None, 2: "bad.com", 3: None, 4: "deep.bad.com", 5: "bad.com", 6: "early.org", 7: None, 8: None, 9: None, 10: "same.net", 11: None, 12: "upper.org", None: None, 13: None}


def test_captures_meet_the_entries_of_their_time(spark):
    entries = spark.createDataFrame(ENTRIES, "domain string, at timestamp, action string, category string")
    captures = spark.createDataFrame(CAPTURES, "page_id long, url string, fetched_at timestamp, host string")
    rows = filter_urls(captures, entries).collect()
    assert len(rows) == len(CAPTURES)
    for r in rows:
        assert r["matched"] == WANT[r["row"]["page_id"]] and r["kept"] == (r["matched"] is None)
    assert filter_urls(captures.limit(0), entries).count() == 0
    assert filter_urls(captures, entries.limit(0)).where("NOT kept").count() == 0
    overlap = intervals(entries).alias("a").join(intervals(entries).alias("b"), F.expr("a.domain = b.domain AND a.valid_from < b.valid_from AND b.valid_from < a.valid_to"))
    assert overlap.count() == 0


def plain_scan(docs):
    templates = {k: licenses.plain_terms(v) for k, v in licenses.TEMPLATES.items()}
    vocabulary = set().union(*templates.values())
    lines = [(i, licenses.plain_terms(line)) for i, d in enumerate(docs) for line in (d["text"] or "").split("\n")]
    seen = {w: sum(w in t for _, t in lines) for w in vocabulary}
    idf = {w: 1 + math.log((1 + len(lines)) / (1 + n)) for w, n in seen.items()}
    rare = 1 + math.log((1 + len(lines)) / 2)
    best = {}
    for i, terms in lines:
        known = terms & vocabulary
        if len(known) < 2:
            continue
        norm = math.sqrt(sum(idf[w] ** 2 for w in known) + (len(terms) - len(known)) * rare**2)
        for order, (name, own) in enumerate(templates.items()):
            cosine = sum(idf[w] ** 2 for w in known & own) / (norm * math.sqrt(sum(idf[w] ** 2 for w in own)))
            if cosine >= 0.8 and (round(cosine, 9), -order) > best.get(i, (0, 0))[:2]:
                best[i] = (round(cosine, 9), -order, name)
    files = {}
    for i, d in enumerate(docs):
        folder, _, base = (d["path"] or "").rpartition("/")
        if d["path"] is not None and base == "LICENSE" and i in best:
            files.setdefault(folder, []).append((-best[i][0], best[i][2]))
    out = []
    for i, d in enumerate(docs):
        own, up = best.get(i, (None, None, None))[2], None
        if own is None and d["path"] is not None:
            folder = d["path"].rpartition("/")[0]
            while folder not in files and folder:
                folder = folder.rpartition("/")[0]
            up = folder if folder in files else None
        out.append((d["doc_id"], own, own or (min(files[up])[1] if up is not None else None), up))
    return sorted(out, key=repr)


def test_licences_against_the_plain_scan(spark):
    docs = placed(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "text")).collect()
    rows = QUERIES["op4_license_scan"](spark, SF_DIR).collect()
    assert sorted(((r["doc_id"], r["own_license"], r["license"], r["inherited_from"]) for r in rows), key=repr) == plain_scan(docs)
    assert any(r["own_license"] for r in rows)


def test_licence_edges(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x", "nothing here"), (3, "a/b/LICENSE", "hello\nLicensed under CC BY-NC 4.0.\nbye"), (4, "a/b/c/y", None),
        (5, None, "words"), (6, "top", ""), (7, "z/w", "x " * 50_000), (3, "a/b/LICENSE", "hello\nLicensed under CC BY-NC 4.0.\nbye"), (8, "q/r", "All rights reserved."), (None, "a/n", "released UNDER the mit license"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit(1))
    found = licenses.scan_licenses(df).collect()
    got = sorted(((r["row"]["doc_id"], r["own_license"], r["license"], r["inherited_from"]) for r in found), key=repr)
    assert got == plain_scan([dict(zip(("doc_id", "path", "text"), r)) for r in rows])
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    assert "Python" not in plan_of(licenses.scan_licenses(df))


TEXTS = [
    (1, "Mail the.99@mail9.example.com or THE.99@MAIL9.EXAMPLE.COM now."), (2, "call +1 (017) 555-7713, pay 4539 1488 0343 6467 or 4539148803436467."),
    (3, "from 83.229.25.121 to 10.0.0.1! token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" end"), (4, None), (5, ""), (6, "no data here 1234 and 12.5"),
    (7, "Mrs Smith met Mr. John Brown; Mrs. Smith left. Госпожа Иванова, Señora Marta Lopez"), (8, "the.99@mail9.example.com"), (8, "the.99@mail9.example.com"),
    (None, "7536784127813050 4845168114407329"), (9, "x" * 100_000 + " a.1@b.cd " + "y" * 1000), (10, "a.1@b.cd a.2@b.cd a.3@b.cd b.1@b.cd b.2@c.cd"),
]


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10


def test_surrogates(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "'old' AS N_Replaced", "7 AS found").repartition(3)
    rows = pii.replace_pii(df, "k").collect()
    assert len(rows) == len(TEXTS)
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["text"], r["n_replaced"]))
    assert got[4] == [(None, 0)] and got[5] == [("", 0)] and got[6] == [(TEXTS[5][1], 0)]
    mail, loud = re.findall(r"\S+@\S+", got[1][0][0])
    assert loud == mail.upper() and re.fullmatch(r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", mail) and mail != "the.99@mail9.example.com"
    assert got[8] == [(mail, 1), (mail, 1)]
    phone, spaced, card = re.fullmatch(r"call (\+1 \(\d{3}\) \d{3}-\d{4}), pay (\d{4} \d{4} \d{4} \d{4}) or (\d{16})\.", got[2][0][0]).groups()
    assert spaced.replace(" ", "") == card and luhn(card) == luhn("4539148803436467") == 0 and "5557713" not in re.sub(r"\D", "", phone)
    ips = re.findall(r"\d+\.\d+\.\d+\.\d+", got[3][0][0])
    assert len(set(ips)) == 2 and all(0 < int(p) < 255 for ip in ips for p in ip.split("."))
    assert re.search(r'token = "[0-9a-f]{40}" end', got[3][0][0]) and "04dbebab" not in got[3][0][0]
    people = got[7][0][0]
    assert re.fullmatch(r"Mrs (\w+) met Mr\. (\w+) (\w+); Mrs\. \1 left\. Госпожа [А-Я][а-я]+, Señora (\w+) (\w+)", people), people
    john, marta = re.search(r"Mr\. (\w+)", people)[1], re.search(r"Señora (\w+)", people)[1]
    assert john in pii.GIVEN["latin"]["m"] and marta in pii.GIVEN["latin"]["f"]
    a, b = got[None][0][0].split()
    assert a != b and (luhn(a) == 0) == (luhn("7536784127813050") == 0)
    assert len(set(got[10][0][0].split())) == 5 and got[10][0][1] == 5
    assert not set(got[10][0][0].split()) & set(TEXTS[11][1].split())
    assert pii.replace_pii(df.limit(0), "k").count() == 0
    again = {(r["doc_id"], r["text"]) for r in pii.replace_pii(df.repartition(1), "k").collect()}
    assert again == {(r["doc_id"], r["text"]) for r in rows}
    assert "Python" not in plan_of(pii.replace_pii(df, "k"))


def test_surrogates_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in QUERIES["op8_pii_surrogates"](spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    pattern = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+\d \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d+\.\d+\.\d+\.\d+(?!\d)|(?<!\w)[0-9a-fA-F]{40}(?!\w)")
    pairs = {}
    for d in docs:
        old, new = d["text"], rows[d["doc_id"]]["text"]
        assert pattern.sub("#", old) == pattern.sub("#", new)
        for a, b in zip(pattern.findall(old), pattern.findall(new)):
            assert a.lower() != b.lower()
            assert pairs.setdefault(a.lower(), b.lower()) == b.lower()
    assert pairs and len(set(pairs.values())) == len(pairs) and not set(pairs) & set(pairs.values())


def test_classifier_tells_held_out_junk(spark):
    docs = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/labels.parquet")
    rows = {r["id"]: r for r in classify(docs, labels.where("quality = 1 AND doc_id % 2 = 0")).collect()}
    assert len(rows) == docs.count()
    held = labels.where("doc_id % 2 = 1").collect()
    good = [rows[r["doc_id"]] for r in held if r["quality"] == 1]
    assert sum(r["kept"] for r in good) / len(good) > 0.95
    odd = [r["doc_id"] for r in docs.where("text RLIKE '[a-z]### |[a-z]%%% |!! [A-Z]+!!'").collect()]
    assert odd and sum(not rows[i]["kept"] for i in odd) / len(odd) > 0.6


def test_classifier_edges(spark):
    rows = [(1, "good words here and there", "en"), (2, None, "en"), (3, "", None), (None, "good words", "xx"), (1, "good words here and there", "en"), (4, "§§§§ ¶¶¶ ~~~~", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kept", F.lit(1))
    trusted = spark.createDataFrame([(1,), (None,), (99,)], "doc_id long")
    got = [(r["id"], r["kept"]) for r in classify(df, trusted).collect()]
    assert sorted(got, key=repr) == sorted([(1, True), (2, False), (3, False), (None, got[[i for i, _ in got].index(None)][1]), (1, True), (4, False)], key=repr)
    assert all(not r["kept"] for r in classify(df, trusted.limit(0)).collect())
    assert classify(df.limit(0), trusted).count() == 0


@pytest.mark.parametrize("name", ["op3_url_lists"])
def test_query_has_drops(spark, name):
    assert 0 < QUERIES[name](spark, SF_DIR).where("NOT kept").count()
