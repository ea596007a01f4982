import math
import random

import numpy as np
from pyspark.sql import functions as F

from docvec.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank int"


def brute(rows, k=5, every=50):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in usable]
    result = []
    for a, (q, x) in enumerate(whole):
        if q % every == 0:
            scored = sorted((-sum(s * t for s, t in zip(x, y)), i) for b, (i, y) in enumerate(whole) if a != b and len(y) == len(x))
            result += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(result)


def found(spark, rows):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("id") % 50 == 0).collect())


def test_equals_brute_force(spark, monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(topk, "BLOCK", 8)  # many blocks, also of a few rows
    monkeypatch.setattr(topk, "CHUNK_BLOCKS", 3)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 2)
    rows = [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(60)]  # ties
    rows += [(2000 + i, [r.uniform(-1, 1) for _ in range(3)]) for i in range(60)]  # of another length
    rows += [(50, [0.5] * 6), (100, [0.5] * 6), (100, [0.5] * 6)]  # repeated keys
    assert found(spark, rows) == brute(rows)


def test_blocks_are_pruned():
    r = np.random.default_rng(0)
    centers = r.integers(-200, 200, (30, 16))
    blocks = [c + r.integers(-5, 5, (64, 16)) for c in centers]
    ids = [np.arange(64) + 64 * i for i in range(30)]
    queries = centers[:4] * 2
    scores, names, _, visits = topk.best(queries, np.full(4, -1), blocks, ids, 5)
    every = np.concatenate(blocks)
    for q, s, n in zip(queries, scores, names):
        full = every @ q
        order = np.lexsort((np.arange(len(full)), -full))[:5]
        assert s.tolist() == full[order].tolist() and n.tolist() == order.tolist()
    assert visits < 4 * 30 / 2


def test_large_values_stay_exact():
    q, d = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, 1], [2**20 + 1, 2]])
    scores, names, _, _ = topk.best(q, np.array([-1]), [d], [np.array([7, 8])], 2)
    assert scores.tolist() == [[(2**40 + 1) * (2**20 + 1) + 6, (2**40 + 1) * (2**20 + 1) + 3]] and names.tolist() == [[8, 7]]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (50, [nan, 1.0]), (100, [inf, 1.0]), (150, [None, 1.0]), (None, [1.0, 1.0]), (200, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [-1.0, 0.0])]
    assert found(spark, rows) == brute(rows) == [(200, 1, 3, 128 * 256), (200, 2, 4, -(256 * 256))]
    assert found(spark, rows[:4]) == [] and found(spark, []) == []
