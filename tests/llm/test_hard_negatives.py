"""Hard negatives against a brute-force version in whole numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from reelgauge.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives, negatives, scale=256):
    ok = [
        (i, [math.floor(scale * x) for x in v], y)
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, v, y) in enumerate(ok):
        if not is_anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, z) for k, (j, w, z) in enumerate(ok) if k != at)
        for s, j, _ in [x for x in scored if x[2] == y][:positives]:
            fits = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, j, r, x[1], -s, -x[0]) for r, x in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(frame):
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.collect())


def vectors(seed, n, width, spread):
    """Clusters of directions, so that bounds rule something out; repeated vectors and ties."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, spread) for x in c], rng.randrange(4)))
    common = rows[5][1]
    return [(i, common if i % 3 == 0 and i > n // 2 else v, y) for i, v, y in rows]


@pytest.mark.parametrize("spread,group,block", [(0.05, 1024, 4096), (0.3, 7, 64), (2.0, 3, 64)])
def test_lists_are_exact(spark, spread, group, block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PER_CLUSTER", 5)
    monkeypatch.setattr(hard_negatives, "SLICE", 2)
    rows = vectors(int(10 * spread), 700, 8, spread)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("q", F.lit("mine")).withColumn("anchor", F.lit(1))
    got = found(hard_negatives.mine(frame, F.col("vec_id") % 20 == 0, 5, 5, group=group, block=block))
    assert got == brute(rows, lambda i: i % 20 == 0, 5, 5)
    assert len(got) > 100


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.1], 2), (2, [0.9, 0.1], 2), (3, [0.95, 0.0], 2), (10, [0.5], 2), (11, [], 3),
        (12, [0.8, 0.1, 9.0], 3), (4, None, 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 2),
        (20, [-1.0, 0.0], 5), (30, [0.0, 0.0], 5), (40, [-1e-20, 0.0], 6), (50, [1.0, 0.0], 9),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(hard_negatives.mine(frame, F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0, 5, 5)
    assert found(hard_negatives.mine(frame.limit(0), F.lit(True))) == []
    assert found(hard_negatives.mine(frame, F.lit(False))) == []


@pytest.mark.parametrize("size", [300.0, 3e6])
def test_large_components(spark, size):
    """Packed in two, four and eight bytes; products beyond 53 bits stay exact."""
    rng = random.Random(int(size))
    rows = [(i, [rng.uniform(-size, size) for _ in range(5)], rng.randrange(3)) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(hard_negatives.mine(frame, F.col("vec_id") % 7 == 0)) == brute(rows, lambda i: i % 7 == 0, 5, 5)


def test_walks_end_early(monkeypatch):
    """On separate clusters, most of the list is not looked at."""
    import numpy as np

    rng = np.random.default_rng(1)
    far = np.rint(256 * np.eye(16)[rng.integers(4, 16, 5000)] + rng.normal(0, 5, (5000, 16)))
    close = np.rint(256 * np.eye(16)[np.zeros(200, int)] + rng.normal(0, 5, (200, 16)))
    v = np.concatenate([far, close])
    shape = hard_negatives.Shape(16, "<f8", True)
    one = np.full((3, 1), hard_negatives._LEAST)
    walk = hard_negatives.Walk(close[:3], np.zeros(3, int), np.arange(5000, 5003), True, one, -1 - one, one, shape)
    looked = []
    scores = hard_negatives.Walk.scores
    monkeypatch.setattr(hard_negatives.Walk, "scores", lambda self, m, x: looked.append(len(x)) or scores(self, m, x))
    member, _, score, ids = walk.down(np.eye(16)[0], v, np.zeros(len(v), int), np.arange(len(v)), np.arange(len(v)), 5)
    assert sum(looked) < 1000
    for m in range(3):
        s = v @ close[m]
        want = [i for i in np.lexsort((np.arange(len(v)), -s)) if i != 5000 + m][:5]
        assert ids[member == m].tolist() == want
