"""Lines that are cut into terms in the licence scan: the bound is exact, and terms need no pattern of their own."""

import math
import random

import pytest

from tests.conftest import plan_of
from verdigrid.llm import licenses


@pytest.mark.parametrize("least", [0.3, 0.8, 1.0])
def test_every_near_line_has_a_mark(least):
    rng = random.Random(5)
    words = sorted(set().union(*map(licenses.plain_terms, licenses.TEMPLATES.values())))
    weights = {w: rng.uniform(1, 9) for w in words}
    marks = set(licenses.marks_of(licenses.TEMPLATES, weights, least))
    near = 0
    for template in licenses.TEMPLATES.values():
        own = sorted(licenses.plain_terms(template))
        for _ in range(300):
            line = set(rng.sample(own, rng.randint(1, len(own))))
            cosine = math.sqrt(sum(weights[w] ** 2 for w in line) / sum(weights[w] ** 2 for w in own))
            if cosine >= least:
                near += 1
                assert line & marks
    assert near
    assert len(marks) < len(words) or least < 0.5


def test_terms_and_lines(spark):
    rows = [
        (1, "x\nReleased under the MIT License.\n..."), (2, "...Licensed... (under) CC-BY... 4.0.. !"), (3, "committed to the reserve, submitted under reservation"),
        (4, None), (5, ""), (6, "ALL RIGHTS RESERVED"), (7, "licence 4.0 of cc by the mit"),
    ]
    found = licenses.notices(spark.createDataFrame(rows, "doc_id int, text string"))
    assert {r["row"]["doc_id"]: r["own_license"] for r in found.collect()} == {
        1: "MIT", 2: "CC-BY-4.0", 3: None, 4: None, 5: None, 6: "proprietary", 7: None
    }
    # a pattern replaced in every single term took half of the time
    assert "regexp_replace" not in plan_of(found)
