import math
import random

import numpy as np
import pytest

from candlewick.llm import topk


def brute(rows, every, k):
    whole = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in dict(reversed(whole)).items():
        if q % every == 0:
            scores = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in whole if i != q
            )
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    if small:  # many ranges, blocks and groups
        monkeypatch.setattr(topk, "RANGE", 24)
        monkeypatch.setattr(topk, "BLOCK", 4)
        monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 6] + 0.2 * rng.normal(size=8)]) for i in range(700)]
    rows += [(1000 + i, rows[5][1]) for i in range(40)]  # ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(frame, 50, 10).collect()))
    assert got == brute(rows, 50, 10)


def test_blocks_are_skipped():
    rng = np.random.default_rng(1)
    data = np.sort(rng.integers(-900, 900, size=(4096, 1)), axis=0)
    ids, cut = np.arange(4096), np.arange(0, 4096, topk.BLOCK)
    bound = topk.bounds(np.array([[7]]), np.minimum.reduceat(data, cut), np.maximum.reduceat(data, cut))[0]
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, part):
            seen.append(part)
            return super().__getitem__(part)

    found, score = topk.best(np.array([7]), -1, topk.NONE, bound, ids, data.view(Watched), 10, topk.BLOCK)
    want = sorted(((-7 * int(x), i) for i, x in enumerate(data[:, 0])))[:10]
    assert [(-s, i) for s, i in zip(score.tolist(), found.tolist(), strict=True)] == want
    assert len(seen) < 6


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(1, 8)]
    rows += [(0, [0.5, -0.1, 0.3]), (0, [0.5, -0.1, 0.3]), (100, []), (200, [1.0]), (300, None), (None, [1.0] * 3),
             (400, [None, 1.0, 1.0]), (500, [float("nan")] * 3), (600, [float("inf"), 0.0, 0.0]),
             (7, [0.1, 0.2, 0.3]), (7, [0.1, 0.2, 0.3]), (-100, [-1.0, -1.0, -1.0, 0.25])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(map(tuple, topk.top_k(frame, 100, 10).collect()))
    assert got == brute(rows, 100, 10)
    assert topk.top_k(frame.limit(0)).count() == 0
    assert topk.top_k(frame.filter("vec_id = 200")).count() == 0


def test_only_hopeful_ranges_are_written(spark, monkeypatch):
    """In clustered vectors few pairs of a query and a range outlive the query's own range."""
    monkeypatch.setattr(topk, "RANGE", 32)
    monkeypatch.setattr(topk, "BLOCK", 8)
    written, hopeful = [], topk._hopeful
    monkeypatch.setattr(topk, "_hopeful", lambda *a: written.append(hopeful(*a)) or written[-1])
    rng = np.random.default_rng(6)
    centres = np.where(rng.random((16, 12)) < 0.5, -1.0, 1.0)
    rows = [(i, [float(x) for x in centres[i % 16] + 0.05 * rng.normal(size=12)]) for i in range(1600)]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == brute(rows, 100, 10)
    queries, ranges = 16, 1600 // 32
    assert written[0].count() < 0.2 * queries * ranges
