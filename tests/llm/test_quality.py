"""Quality rules and the n-gram model against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_DIR
from verdigrid.llm import ngrams, quality
from verdigrid.llm.queries import QUERIES


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_counts():
    for text in (None, "", " \n ", "a\nb\na\n\n\na ", "x " * 9, "x " * 8, "a b c d e f g h i a b c d e f g h", "é#*$ %&\x0b|<> b\x85c",
                 ("one two three four five six seven eight " * 3 + "nine ") * 4, "w%d " * 50 % tuple(range(50)), "z" * 200_000):
        assert quality.text_counts(text) == plain_counts(text), text and text[:40]


def symbol(c):
    p = ord(c)
    if p >= 128:
        return 3 + p % 30
    return 2 if c == "\n" else p + 1 if 32 <= p < 127 else 1


class PlainModel:
    """Modified Kneser-Ney by dictionaries."""

    def __init__(self, texts, order=5):
        self.order = order
        level = Counter()
        for text in texts:
            s = (0,) * (order - 1) + tuple(map(symbol, text or ""))
            level.update(s[i : i + order] for i in range(len(s) - order + 1))
        counts = {order: level}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        self.own, self.weight = {}, {}
        for k, c in counts.items():
            n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
            cut = (0.5, 1.0, 1.5)
            if min(n1, n2, n3, n4):
                y = n1 / (n1 + 2 * n2)
                d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
                if all(0 < x <= i + 1 for i, x in enumerate(d)):
                    cut = d
            total, spare = defaultdict(int), defaultdict(float)
            for g, v in c.items():
                total[g[:-1]] += v
                spare[g[:-1]] += cut[min(v, 3) - 1]
            for g, v in c.items():
                self.own[g] = (v - cut[min(v, 3) - 1]) / total[g[:-1]]
            for h in total:
                self.weight[k, h] = spare[h] / total[h]

    def p(self, g):
        if not g:
            return 1 / 128
        lower = self.p(g[1:])
        if (len(g), g[:-1]) not in self.weight:
            return lower
        return self.own.get(g, 0.0) + self.weight[len(g), g[:-1]] * lower

    def loss(self, text):
        s = (0,) * (self.order - 1) + tuple(map(symbol, text))
        return -sum(math.log(self.p(s[i : i + self.order])) for i in range(len(s) - self.order + 1)) / len(text)


TRAIN = ["the cat sat on the mat.", "the dog sat on the log\nthe end", None, "", "évé naïf 日本", "aaaa aaaa aaab", "The cat, the dog; 12 34"] * 2 + ["once only zebra"]
UNSEEN = ["the zqx cat", "日x", "@@@@", "sat the on dog the"]


@pytest.mark.parametrize("rows", [2_000_000, 150])
def test_model_agrees_with_the_plain_one_in_one_or_many_shards(spark, rows):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(TRAIN)], "doc_id long, text string")
    model = ngrams.train(train)
    plain = PlainModel(TRAIN)
    texts = TRAIN + UNSEEN
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    got = {r["id"]: r["mean_loss"] for r in ngrams.perplexities(docs, model, rows=rows).collect()}
    for i, text in enumerate(texts):
        if not text:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(plain.loss(text), rel=1e-5)


def test_probabilities_sum_to_one(spark):
    plain = PlainModel(TRAIN)
    for context in ((0, 0, 0, 0), tuple(map(symbol, "the ")), tuple(map(symbol, "zzzz"))):
        assert sum(plain.p((*context, s)) for s in range(128)) == pytest.approx(1)


def test_query_against_the_plain_version(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op9_quality_rules"](spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    model = PlainModel([d["text"] for d in docs.values()])
    losses, failed = {}, {}
    for row in rows:
        text = docs[row["doc_id"]]["text"]
        want = plain_counts(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == want
        failed[row["doc_id"]] = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert row["base_failed"] == failed[row["doc_id"]]
        assert row["mean_loss"] == pytest.approx(model.loss(text), rel=1e-4)
        losses[row["doc_id"]] = row["mean_loss"]
    for lang in {d["lang"] for d in docs.values()}:
        own = [i for i, d in docs.items() if d["lang"] == lang]
        steps = sorted(math.floor(losses[i] * 1024) for i in own if not failed[i])
        centre = steps[(len(steps) - 1) // 2]
        away = sorted(abs(s - centre) for s in steps)
        spread = away[(len(away) - 1) // 2]
        for row in rows:
            if row["doc_id"] in set(own):
                room = 4 * spread / 1024 + 2 / math.sqrt(len(docs[row["doc_id"]]["text"]))
                distance = abs(row["mean_loss"] - (centre + 0.5) / 1024)
                if abs(distance - room) > 3e-3:
                    assert row["kept"] == (not failed[row["doc_id"]] and distance <= room)


def test_edge_rows(spark):
    long = "word%d " * 40 % tuple(range(40))
    rows = [(1, None, None), (1, None, None), (2, "", "en"), (None, long, None), (3, long, "en"), (4, "x" * 100_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS kept", "2 AS n_words")
    got = quality.judge(df).collect()
    assert len(got) == len(rows)
    assert {r["id"]: r["base_failed"] for r in got} == {1: True, 2: True, None: False, 3: False, 4: True}
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert quality.judge(df.limit(0)).count() == 0


def test_grams_of_neighbouring_texts_do_not_mix():
    both, lengths = ngrams.grams(["ab", "", "cd"])
    assert list(lengths) == [2, 0, 2]
    assert list(both) == [*ngrams.grams(["ab"])[0], *ngrams.grams(["cd"])[0]]
    assert len(ngrams.grams([""])[0]) == 0
    assert np.all(ngrams.grams(["é"])[0] == 3 + ord("é") % 30)
