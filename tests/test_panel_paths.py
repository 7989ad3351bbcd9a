"""Trajectories, padded sequences, ragged chain products and sensitivities against plain Python."""

import math
import random
import statistics

import numpy as np
import pytest

from hazardloom.operators import classify, compete, panel


@pytest.fixture(scope="module")
def rows():
    random.seed(4)
    return [(i, 2000 + i % 2, a, random.choice([None, random.random()]), random.random()) for i in range(60) for a in range(random.randint(1, 9))]


SCHEMA = "loan_id int, vintage_year int, loan_age int, a double, b double"


@pytest.mark.parametrize("small", [0, 12, 100_000])
def test_trajectories(spark, rows, small):
    want = {}
    for v in (2000, 2001):
        for age in range(9):
            group = [r for r in rows if r[1] == v and r[2] == age]
            medians = [statistics.median(x) if x else None for x in ([r[k] for r in group if r[k] is not None] for k in (3, 4))]
            if any(m is not None for m in medians):
                want[v, age] = medians
    got = {(r.vintage_year, r.loan_age): [r.a, r.b] for r in panel.trajectories(spark.createDataFrame(rows, SCHEMA), ["a", "b"], small=small).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == [x if x is None else pytest.approx(x) for x in w]


def test_padded_sequences(spark, rows):
    got = {r.loan_id: r for r in panel.padded_sequences(spark.createDataFrame(rows, SCHEMA), ["a", "b"], 6, fill=-1.0).collect()}
    for i in range(60):
        mine = [r for r in rows if r[0] == i][:6]
        pad = 6 - len(mine)
        assert got[i].length == len(mine) and got[i].mask == [True] * len(mine) + [False] * pad
        assert got[i].a == [-1.0 if r[3] is None else r[3] for r in mine] + [-1.0] * pad
        assert got[i].b == [r[4] for r in mine] + [-1.0] * pad


def test_chain_products_over_ragged_paths(spark, monkeypatch):
    random.seed(1)
    paths = [[random.random() * 0.2 for _ in range(n)] for n in (0, 3, 1, 0, 700, 5, 0)]
    data = [(i, p, [x / 2 for x in p]) for i, p in enumerate(paths)] + [(98, None, [0.1]), (99, [0.1, None, 1.0], [0.0, 0.2, 0.5])]
    df = spark.createDataFrame(data, "id int, h1 array<double>, h2 array<double>").coalesce(1)
    for piece in (4, 1 << 17):
        monkeypatch.setattr(compete, "PIECE", piece)
        got = {r.id: r.path for r in compete.incidence_arrays(df, "h1", "h2").collect()}
        assert got[98] is None
        for i, p, q in data[:-2] + [(99, [0.1, 0.0, 1.0], [0.0, 0.2, 0.5])]:
            s, f1, f2 = 1.0, 0.0, 0.0
            assert len(got[i]) == len(p)
            for x, a, b in zip(got[i], p, q):
                a, b = (min(max(v, compete.EPS), 1 - compete.EPS) for v in (a, b))
                f1, f2, s = f1 + a * s, f2 + b * s, s * (1 - a) * (1 - b)
                assert math.isclose(x.s, s, rel_tol=1e-9) and math.isclose(x.f1, f1, rel_tol=1e-9) and math.isclose(x.f2, f2, rel_tol=1e-9)
    with pytest.raises(Exception, match="equal length"):
        compete.incidence_arrays(spark.createDataFrame([([0.1], [0.1, 0.2])], "h1 array<double>, h2 array<double>"), "h1", "h2").collect()


def test_sensitivity_against_bumped_features(spark):
    rng = np.random.default_rng(8)
    model = classify.DiscreteHazards.__new__(classify.DiscreteHazards)
    model.features, model.stds = ["u", "w"], {"u": 2.0, "w": 0.5}
    model.coef = {1: {"u": 0.4, "w": -0.3}, 2: {"u": -0.2, "w": 0.6}}
    model.intercept = {1: -3.0, 2: -4.0}
    x = {(i, a): rng.normal(size=2) for i in range(12) for a in range(rng.integers(1, 8))}
    df = spark.createDataFrame([(i, a, float(v[0]), float(v[1])) for (i, a), v in x.items()], "loan_id int, loan_age int, u double, w double")
    got = {(r.loan_age, r.feature): (r.n, r.importance) for r in model.incidence_sensitivity(model.hazards(df).select("loan_id", "loan_age", "h1", "h2"), 60, 1).collect()}

    def cif(i, bump=None):
        s, f = 1.0, 0.0
        for a in range(len([k for k in x if k[0] == i])):
            v = x[i, a].copy()
            if bump and bump[0] == a:
                v[bump[1]] += bump[2] * (2.0, 0.5)[bump[1]]
            e = [math.exp(model.intercept[k] + model.coef[k]["u"] * v[0] + model.coef[k]["w"] * v[1]) for k in (1, 2)]
            h = [y / (1 + sum(e)) for y in e]
            f += h[0] * s
            s *= (1 - h[0]) * (1 - h[1])
        return f

    for j, name in enumerate(model.features):
        change = {(i, a): abs(cif(i, (a, j, 1e-5)) - cif(i, (a, j, -1e-5))) / 2e-5 for i, a in x}
        for age in {a for _, a in x}:
            own = [c for (_, a), c in change.items() if a == age]
            assert got[age, name] == (len(own), pytest.approx(sum(own) / len(own), rel=1e-6))
        assert got[None, name] == (len(x), pytest.approx(sum(change.values()) / len(x), rel=1e-6))


def test_total_loss_is_its_parts(spark):
    random.seed(8)
    rows = []
    for loan in range(40):
        x, k, f1, f2 = random.randint(0, 7), random.randint(0, 2), 0.0, 0.0
        for m in range(x + 1):
            f1, f2 = f1 + random.random() / 20, f2 + random.random() / 20
            rows.append((loan, m, random.random() / 5, random.random() / 5, f1, f2, x, k))
    df = spark.createDataFrame(rows, "loan int, m int, h1 double, h2 double, cif1 double, cif2 double, x int, k int")
    got = compete.total_loss(df, "loan", "m", "x", "k").collect()[0]
    for k in (1, 2):
        assert got[f"nll{k}"] == pytest.approx(compete.cause_nll(df, "loan", "m", f"h{k}", "x", "k", k).collect()[0][0])
        assert got[f"rank{k}"] == pytest.approx(compete.ranking_loss(df, "loan", "m", f"cif{k}", "x", "k", k).collect()[0][0])
    assert got.total_loss == pytest.approx(got.nll1 + got.nll2 + 0.2 * (got.rank1 + got.rank2))
