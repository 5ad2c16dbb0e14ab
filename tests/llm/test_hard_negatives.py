"""Hard negatives against a plain version; scores against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigrid.llm import hard_negatives as hn
from verdigrid.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score int, cell string"


def plain(rows, positives=5, negatives=10):
    seen, use = set(), []
    for key, vector, label, *_ in rows:
        if key is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        vector = [float(np.float32(x)) for x in vector]
        if (key, label, tuple(vector)) not in seen:
            seen.add((key, label, tuple(vector)))
            use.append((key, [math.floor(256 * x) for x in vector], label))
    out = []
    for key, q, label in use:
        if key % 100:
            continue
        score = lambda o: sum(x * y for x, y in zip(q, o[1]))
        order = sorted((o for o in use if o[0] != key), key=lambda o: (-score(o), o[0]))
        for p in [o for o in order if o[2] == label][:positives]:
            inside = [o for o in order if o[2] != label and 30 * score(p) <= 100 * score(o) <= 90 * score(p)]
            out += [(key, p[0], i + 1, o[0], score(p), score(o)) for i, o in enumerate(inside[:negatives])]
    return sorted(out)


def ours(frame, **options):
    return sorted(tuple(r) for r in hard_negatives(frame, F.col("vec_id") % 100 == 0, **options).collect())


@pytest.mark.parametrize("groups", [(8192, 131072, 2048), (2, 7, 3)])
@pytest.mark.parametrize("grain", [0.02, 1.0])
def test_against_plain_version(spark, monkeypatch, groups, grain):
    """``grain`` 1 gives few different scores, so that ties decide; small groups give many cells."""
    for name, value in zip(("MOST_ANCHORS", "MOST_CANDIDATES", "FEW"), groups):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(11)
    vectors = np.round(rng.normal(0.3, 0.5, (260, 12)) / grain) * grain
    rows = [(int(i) * 4, [float(x) for x in v], int(rng.choice([0, 0, 0, 1, 2])), 1, "c") for i, v in enumerate(vectors)]
    assert ours(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1, 0, ""), (0, [1.0, 1.0], 1, 0, ""), (100, [1.0, 0.5], 1, 0, ""), (1, [1.0, 1.0], 1, 0, ""), (2, [0.5, 0.5], 2, 0, ""), (2, [0.5, 0.5], 2, 0, ""),
        (3, [0.5], 2, 0, ""), (4, [], 2, 0, ""), (5, [0.5, 0.5, 9.0], 3, 0, ""), (6, [nan, 1.0], 2, 0, ""), (7, [inf, 1.0], 2, 0, ""), (8, [None, 1.0], 2, 0, ""),
        (9, None, 2, 0, ""), (10, [0.6, 0.6], None, 0, ""), (None, [0.6, 0.6], 2, 0, ""), (200, [-1.0, -1.0], 4, 0, ""), (201, [-0.001, 0.001], 4, 0, ""),
        (300, [0.0, 0.0], 5, 0, ""), (301, [0.0, 0.0], 5, 0, ""),
    ]
    got = ours(spark.createDataFrame(rows, SCHEMA))
    assert got == plain(rows)
    assert (0, 1, 1, 2, 131072, 65536) in got


def test_empty_tables(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []
    assert ours(spark.createDataFrame([(1, [1.0], 1, 0, "")], SCHEMA)) == []


def test_scores_too_large_are_refused(spark):
    rows = [(0, [1e15], 1, 0, ""), (1, [1e15], 1, 0, "")]
    with pytest.raises(Exception, match="64 bits"):
        ours(spark.createDataFrame(rows, SCHEMA))


def test_lookups_equal_inner_products():
    rng = np.random.default_rng(2)
    for low, high, kind in ((-3, 3, np.int32), (-2000, 2000, np.int64), (0, 1, np.int32), (-(2**27), 2**27, np.int64)):
        a, c = rng.integers(low, high, (5, 24)).astype(kind), rng.integers(low, high, (40, 24))
        assert (hn.scores(hn.subset_sums(a), hn.bit_planes(c)) == c @ a.T.astype(np.int64)).all()


def test_first_of_keeps_order_on_ties():
    assert list(hn.first_of(np.array([3, 5, 5, 1, 5, 3]), 4)) == [1, 2, 4, 0]
    assert list(hn.first_of(np.array([], np.int64), 4)) == []
