"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from areapulse.llm import negatives


def brute(rows, divisor=100, k=5, m=10):
    ids: dict[int, tuple] = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * np.float64(x))) for x in v])
        ids[i] = min(ids.get(i, row), row)
    out = []
    for a, (label, q) in ids.items():
        if a % divisor:
            continue
        scores = sorted(((sum(x * y for x, y in zip(q, c, strict=False)), j, lb) for j, (lb, c) in ids.items() if j != a), key=lambda x: (-x[0], x[1]))
        for p, pid, lb in [s for s in scores if s[2] == label][:k]:
            inside = [s for s in scores if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:m]
            out += [(a, pid, n, j, p, s) for n, (s, j, _) in enumerate(inside, 1)]
    return sorted(out)


def made(frame, **options):
    return sorted(tuple(r) for r in negatives.mined(frame, F.col("label"), **options).collect())


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 1, (4, 9))
    rows = [(i, int(i % 4 if i % 11 else rng.integers(4)), (middles[i % 3] * rng.uniform(0.5, 1.5) + rng.normal(0, 0.6, 9)).tolist()) for i in range(700)]
    rows += [(1000 + i, i % 2, rows[7][2]) for i in range(60)]  # one vector in many copies, of two labels
    rows += [(2000, None, rows[1][2]), (2100, 1, None), (2200, 1, [None] * 9), (2300, 1, [float("inf")] * 9), (None, 1, rows[1][2])]
    rows += [(2400, 1, [0.0] * 9), (2500, 1, [1.0, 2.0]), (2600, 1, []), rows[100], (200, 0, [0.5] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"q": F.lit("clash"), "block": F.lit(1)})
    rows = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    want = brute(rows)
    assert want and made(frame) == want
    assert made(frame, candidate_block=64, anchor_block=3) == want


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, rng.normal(0, 1, 3).tolist()) for i in range(120)] + [(200, 1, [2.0**21, 1.0, 3.0]), (201, 1, [2.0**20, 5.0, -1.0]), (202, 0, [2.0**19, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    rows = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    assert made(frame) == brute(rows)


def test_few_or_no_rows(spark):
    frame = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.5])], "vec_id long, label int, embedding array<float>")
    assert made(frame) == [(0, 1, 1, 2, 65536, 32768)]
    assert made(frame.where("vec_id < 0")) == []
    assert made(frame.where("vec_id < 2")) == []
    assert made(frame.where("vec_id <> 1")) == []


def test_bounds_hold_and_leave_much_out():
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 100, (6, 16))
    vectors = (middles[rng.integers(0, 6, 800)] + rng.normal(0, 15, (800, 16))).astype(np.int64)
    references = negatives.fit_references(vectors.tolist(), 6)
    norms = negatives.norms_of(vectors)
    angles = np.arccos(negatives.cosines(vectors, norms, references))
    block = negatives.Block(np.arange(800), np.zeros(800, np.int64), vectors, norms, angles)
    low, high = block.bounds(norms[:50], angles[:50])
    scores = vectors[:50] @ vectors.T
    assert (low <= scores).all() and (scores <= high).all()
    least = np.sort(low, axis=1)[:, -5]
    assert (high >= least[:, None]).mean() < 0.5


@pytest.mark.parametrize("vectors", [[[0, 0], [0, 0]], [[5, 0]], []])
def test_references_of_odd_samples(vectors):
    assert np.isfinite(negatives.fit_references(vectors)).all()
