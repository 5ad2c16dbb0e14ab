"""SimHash against all pairs on small tables."""

import random

import numpy as np
import xxhash

from tests.conftest import SF_DIR
from verdigrid.llm import simhash
from verdigrid.llm.common import components
from verdigrid.llm.queries import QUERIES


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + ([word] if word else []), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: least[find(i)] for i, (doc, _) in enumerate(prints)}


def test_fingerprints():
    for text in (None, "", " \n", "One", "one two", "ÉA éa B\tb\x0bC", "a a a a a a", "x y z", "w " * 70_000, "a b c d e f g h " * 30):
        assert simhash.fingerprint(text) == plain_fingerprint(text), text and text[:30]


def test_query_against_all_pairs(spark):
    docs = [(r["doc_id"], plain_fingerprint(r["text"])) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op2_simhash"](spark, SF_DIR).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {d: f"{f:016x}" for d, f in docs}
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_components(docs)
    assert len(rows) == len(docs)


def _clustered(rng, n):
    base = [rng.getrandbits(64) for _ in range(3)] + [0, 2**64 - 1]
    out = set()
    while len(out) < n:
        value = rng.choice(base)
        for _ in range(rng.randint(0, 9)):
            value ^= 1 << rng.randrange(64)
        out.add(value)
    return sorted(out)


def _signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_links_in_crowded_buckets(spark):
    prints = _clustered(random.Random(3), 700)
    nodes = spark.createDataFrame([(_signed(v),) for v in prints], "fp long")
    want = plain_components([(v, v) for v in prints])
    for bucket in (2, 40, 4096):  # dealt twice, in part, never
        for radius in (2, 1, 0):
            got = simhash.links(nodes, radius, radius + 2, bucket).collect()
            assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 64 for a, b in got)
            if radius == 2:
                merged = {}
                for a, b in got:
                    merged.setdefault(a, set()).add(b)
                    merged.setdefault(b, set()).add(a)
                seen = {}
                for v in sorted(prints):
                    todo = [_signed(v)]
                    while todo:
                        x = todo.pop()
                        if x not in seen:
                            seen[x] = v
                            todo += merged.get(x, ())
                groups = {}
                for v in prints:
                    groups.setdefault(want[v], set()).add(seen[_signed(v)])
                assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(seen.values()))


def test_near_pairs_are_all_pairs():
    rng = random.Random(4)
    prints = np.array(_clustered(rng, 300), np.uint64)
    keys = np.sort(np.array([rng.randrange(5) for _ in prints]))
    got = {(int(a), int(b)) for x, y in simhash.near_pairs(keys, prints, 2) for a, b in zip(x, y)}
    want = {
        (i, j) for j in range(300) for i in range(j)
        if keys[i] == keys[j] and bin(int(prints[i]) ^ int(prints[j])).count("1") <= 2
    }
    assert got == want


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame(chain + hub + [(5000, 5001), (5001, 5000), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    want = {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}, 5000: 5000, 5001: 5000}
    assert got == want
    assert components(edges.limit(0)).count() == 0


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "y"), (5, "A b C", "z"), (5, "A b C", "z"), (None, "a B c", None), (9, "solo", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Component_Id string")
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in simhash.near_dedup(df).collect())
    assert got == [(-1, 5), (1, 1), (2, 1), (5, 5), (5, 5), (9, 9)]
    assert simhash.near_dedup(df.limit(0)).count() == 0
