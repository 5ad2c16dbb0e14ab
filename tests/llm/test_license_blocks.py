"""Licence files, headers and SPDX lines against licence texts; the vectors against a plain computation."""

import math
import re
import textwrap
from pathlib import Path

import pytest

from tests.conftest import plan_of
from verdigrid.llm import license_blocks as lb
from verdigrid.llm import licenses

TEXTS = lb.license_texts()
FULL = {n: t for n, t in TEXTS if len(t) > 1000 or n in ("ISC",)}
HEADERS = {n: t for n, t in TEXTS if len(t) <= 1000 and n != "ISC"}
PROSE = "\n".join("The quick report of the year shows that all of the numbers are as good as they were in the last one, and no more." for _ in range(40))


def wrapped(text, mark, first="Copyright 2024 Some Person and others"):
    return "\n".join(f"{mark} {line}".rstrip() for line in [first, ""] + [x for p in text.split("\n\n") for x in [*textwrap.wrap(p, 70), ""]]) + "\nimport os\n\nprint(1)\n"


FILES = (
    [(f"full/{n}/LICENSE", f"{n}\n\nCopyright (c) 2024 Some Person\n\n{t}", n) for n, t in FULL.items()]
    + [(f"full/{n}/a/b.py", "print(1)", n) for n in FULL]
    + [(f"head/{n}.py", wrapped(t, "#"), n) for n, t in HEADERS.items()]
    + [(f"head/{n}.c", "/*\n" + wrapped(t, " ").replace("\nimport", "\n */\nimport"), n) for n, t in HEADERS.items()]
    + [
        ("spdx/a.c", "// SPDX-License-Identifier: MIT\nint x;", "MIT"), ("spdx/b.c", "int y;\n/* SPDX-License-Identifier: MIT OR Apache-2.0 */", "MIT OR Apache-2.0"),
        ("wrap/a.py", "# This work is licensed under the GNU General\n# Public License, version 3.\nx = 1\n", "GPL-3.0"),
        ("none/a.txt", PROSE, None), ("none/b.txt", None, None), ("none/c.txt", "", None), ("none/LICENSE", "\n \n", None), ("none/d.txt", "SPDX-License-Identifier: ", None),
        (None, FULL["MIT"], None), ("none/e.txt", "word " * 200_000, None), ("none/f.txt", "# x\n" * 50_000, None),
    ]
)


def test_files_headers_and_inheritance(spark):
    df = spark.createDataFrame([(p, t, w, 1) for p, t, w in FILES + FILES[:3]], "path string, text string, want string, block_id int")
    found = licenses.scan_licenses(df)
    assert "Python" not in plan_of(found)
    rows = found.collect()
    assert len(rows) == len(FILES) + 3
    wrong = [(r["row"]["path"], r["license"], r["similarity"]) for r in rows if r["license"] != r["row"]["want"]]
    assert not wrong
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def plain_block(path, text):
    start = re.sub(r"^\s+", "", text or "")
    if re.search(lb.LICENCE_FILE, (path or "").rpartition("/")[2]):
        return start
    for mark, end in lb._BLOCK_MARKS.items():
        if start.startswith(mark):
            return start[len(mark):].split(end, 1)[0]
    if re.match(rf"(?:{lb._LINE_MARKS})", start):
        return re.split(rf"\n(?![ \t]*(?:{lb._LINE_MARKS}))", start, maxsplit=1)[0]
    return re.split(r"\n[ \t\r]*\n", start, maxsplit=1)[0]


@pytest.mark.parametrize("least", [0.8, 0.3])
def test_cosines_against_a_plain_computation(spark, least):
    blocks = {b for b in (plain_block(p, t) for p, t, _ in FILES) if b}
    every = [lb.counts_of(b) for b in (plain_block(p, t) for p, t, _ in FILES) if b]
    templates = [(n, lb.counts_of(t)) for n, t in TEXTS]
    vocabulary = set().union(*(c for _, c in templates))
    idf = {w: 1 + math.log((1 + len(every)) / (1 + sum(w in c for c in every))) for w in vocabulary}
    rare = 1 + math.log((1 + len(every)) / 2)

    def vector(c):
        return {w: (1 + math.log(n)) * idf.get(w, rare) for w, n in c.items()}

    def length(v):
        return math.sqrt(sum(x * x for x in v.values()))

    want = {}
    for b in blocks:
        v = vector(lb.counts_of(b))
        scores = [(sum(v[w] * t[w] for w in v.keys() & t.keys()) / (length(v) * length(t)), -i) for i, t in enumerate(vector(c) for _, c in templates)] if v else []
        top = max(((round(s, 9), i) for s, i in scores), default=(0, 0))
        if top[0] >= least:
            want[b] = (TEXTS[-top[1]][0], round(top[0], 6))
    df = spark.createDataFrame([(p, t) for p, t, _ in FILES], "path string, text string")
    found = lb.matching_blocks(df, "path", "text", TEXTS, least)
    ids = df.select(lb.block_of(df.path, df.text).alias("block")).selectExpr("block", "sha2(block, 256) AS block_id").distinct()
    got = {r["block"]: (r["block_license"], round(r["block_similarity"], 6)) for r in ids.join(found, "block_id").collect()}
    assert got == want and len(got) > 20


def test_salted_way_back(spark, monkeypatch):
    df = spark.createDataFrame([(p, t) for p, t, _ in FILES], "path string, text string")
    first = sorted(map(repr, licenses.scan_licenses(df).collect()))
    monkeypatch.setattr(lb, "BROADCAST_BLOCKS", 0)
    assert sorted(map(repr, licenses.scan_licenses(df).collect())) == first


def test_texts_are_plain_files():
    assert all(p.suffix == ".txt" for p in Path(lb.__file__).parent.joinpath("license_texts").iterdir())
