import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import hardneg as H

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    good = {(i, x, tuple(math.floor(256 * c) for c in v)) for i, v, x in rows
            if None not in (i, v, x) and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for i, x, v in good:
        if i % 100:
            continue
        score = lambda w, v=v: sum(a * b for a, b in zip(v, w, strict=True))
        others = sorted((-score(w), j, y == x) for j, y, w in good if j != i and len(w) == len(v))
        for p, j, same in [o for o in others if o[2]][:positives]:
            hits = [(s, k) for s, k, own in others if not own and low * -p <= 100 * -s <= high * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(hits)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("slice", F.lit("x")).withColumn("content", F.lit(1))
    got = H.mine(df, F.col("vec_id") % 100 == 0, **more).collect()
    return sorted((r.anchor, r.positive, r["rank"], r.negative, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_random_vectors_in_many_blocks_as_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(H, "SLICE_BYTES", 0)
    monkeypatch.setattr(H, "BLOCK_BYTES", 0)
    monkeypatch.setattr(H, "FEW", 40)  # several slices of rows and, below, blocks of anchors
    r = random.Random(3)
    rows = [(100 * k if k < 60 else k, [r.gauss(0, spread) + 0.05 for _ in range(6)], r.randrange(3)) for k in range(300)]
    want = plain(rows)
    assert len(want) > 300 and mined(spark, rows) == want
    assert mined(spark, rows, positives=2, negatives=3, low=10, high=95) == plain(rows, 2, 3, 10, 95)


def test_ties_zero_and_negative_scores(spark):
    rows = [(k, [0.0, 1.0], k % 2) for k in range(0, 40)] + [(200, [0.0, 0.0], 0), (300, [0.0, -1.0], 1), (-100, [1.0, 0.0], 0)]
    want = plain(rows)
    assert any(w[4] == 0 for w in want) and mined(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (200, [1.0], 1), (300, [], 2), (400, None, 1), (500, [nan, 1.0], 1),
            (600, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (1, [2.0, None], 1), (2, [inf, 1.0], 1), (3, [1.0, 1.0], 1),
            (4, [0.5, 0.5], 2), (4, [0.5, 0.5], 2), (4, [0.4, 0.5], 2), (5, [0.5], 1), (6, [0.3], 3), (7, [], 2), (8, [], 1),
            (700, [1.0, 0.9], 1), (700, [0.9, 0.9], 1), (700, [0.9, 0.9], 2)]
    want = plain(rows)
    assert {w[0] for w in want} >= {100, 200, 300, 700} and mined(spark, rows) == want
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []


def test_scores_beyond_doubles_are_exact():
    big = np.array([[1 << 29, 3], [-(1 << 29), 5]], np.int64)
    assert H.products(big, big + 1).tolist() == (big.astype(object) @ (big + 1).T.astype(object)).tolist()
    huge = big << 28
    assert H.products(huge, huge).tolist() == (huge.astype(object) @ huge.T.astype(object)).tolist()


def test_a_hot_label_of_equal_vectors(spark):
    rows = [(k, [0.5, 0.25], 1) for k in range(1, 3000)] + [(100 * k, [0.5, 0.25 + k / 100], k % 2) for k in range(5000, 5004)]
    rows += [(10_000 + k, [0.3, 0.2], 2) for k in range(50)]
    assert mined(spark, rows) == plain(rows)
