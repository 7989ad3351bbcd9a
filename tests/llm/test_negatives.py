"""Hard negatives against all inner products, trees and bounds against direct distances."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, x string, ordinal long, place int, id long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3) for i, v, label in rows], SCHEMA)


def brute(rows, anchor, positives=5, negatives_=3, low=50, high=95):
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    good = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not abs(c) < 1 << 18 for c in v):
            continue
        good.append((i, [math.floor(float(np.float32(c)) * 256) for c in v] + [0] * (width - len(v)), label))
    out = []
    for i, v, label in good:
        if i % anchor:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, w, other in good if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:negatives_]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(fit, 1)]
    return sorted(out)


def got(frame):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in frame.collect())


def test_tree():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(-300, 300, (60, 8)), np.zeros((2, 8))]).astype(np.int32)
    order, parent, edge = negatives.spanning_tree(x)
    seen = {int(order[0])}
    for node in order[1:]:
        assert parent[node] in seen
        assert edge[node] >= np.sqrt(((x[node].astype(float) - x[parent[node]]) ** 2).sum()) - 1e-9
        seen.add(int(node))
    assert sorted(order) == list(range(62)) and parent[order[0]] == -1
    far = np.sqrt(((x[:, None].astype(float) - x[None]) ** 2).sum(-1))
    joined, total = {0}, 0.0  # Prim over the whole matrix
    while len(joined) < 62:
        a, b = min(((a, b) for a in joined for b in range(62) if b not in joined), key=lambda p: far[p])
        joined.add(b)
        total += far[a, b]
    assert edge.sum() == pytest.approx(total)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, rows = rng.integers(-400, 400, (30, 16)).astype(np.int32), rng.integers(-400, 400, (200, 16)).astype(np.int32)
    order, parent, edge = negatives.spanning_tree(x)
    place = np.argsort(order)
    tree = negatives.Tree({"ordinal": range(30), "vec_id": range(30), "label": [0] * 30, "parent": [-1 if parent[o] < 0 else place[parent[o]] for o in order], "edge": edge[order], "vectors": x[order].tobytes()})
    true, taken = x[order].astype(np.int64) @ rows.T.astype(np.int64), {}

    def meets(c, low, high):
        assert (low <= true[c]).all() and (true[c] <= high).all()
        return high >= 500_000

    tree.walk(rows, meets, lambda c, at, score: taken.__setitem__(c, (at, score)))
    for c in range(30):
        assert (taken[c][1] == true[c][taken[c][0]]).all() if c in taken else (true[c] < 500_000).all()
        assert set(np.flatnonzero(true[c] >= 500_000)) <= set(taken.get(c, [[]])[0])


@pytest.mark.parametrize("wave", [1, 8 << 20])
def test_against_brute_force(spark, monkeypatch, wave):
    monkeypatch.setattr(negatives, "WAVE_BYTES", wave)
    monkeypatch.setattr(negatives, "ROWS", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = [(k, [float(c) for c in np.round(centres[k % 4] + rng.normal(size=6) * 0.4, 1 if k % 3 else 3)], int(rng.integers(0, 3))) for k in range(240)]
    rows += [(300 + k, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0], k % 2) for k in range(12)]  # ties
    rows += [(400, [0.5, 0.25], 1), (401, [0.0] * 6, 1), (10, None, 1), (20, [1.0] * 6, None), (30, [1.0, None], 1), (40, [float("nan")] * 6, 0),
             (50, [float("inf"), 0.0], 0), (60, [1e9], 2), (None, [1.0] * 6, 1), (70, [], 1), (33, rows[33][1], rows[33][2]), (7, [2.0] * 6, 2)]
    out = got(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0, block=7))
    assert out == brute(rows, 5)


def test_large_components(spark):
    """Products that floating point would round."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(c) for c in rng.integers(-200_000, 200_000, 3)], k % 2) for k in range(60)]
    assert got(negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0)) == brute(rows, 5)


def test_empty(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0], 1)], [(0, [1.0], 1)]):
        out = negatives.hard_negatives(table(spark, rows), F.col("vec_id") % 5 == 0)
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and out.count() == 0
