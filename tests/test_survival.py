"""Curves, Cox fits and competing risks against brute force on small random loans."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardloom.operators import compete, cox, curves
from hazardloom.operators.partial_likelihood import Model, evaluate, month_sums, tie_sums

RNG = np.random.default_rng(3)
N = 400
T = RNG.integers(1, 25, N)
CAUSE = RNG.choice([0, 1, 2], N, p=[0.3, 0.5, 0.2])
X = np.column_stack([RNG.normal(size=N), RNG.integers(0, 2, N), RNG.normal(size=N), RNG.normal(size=N)])
W = RNG.uniform(0.5, 2, N)


@pytest.fixture(scope="module")
def loans(spark):
    rows = [(i, int(t), int(c), int(c == 1), int(c == 2), *map(float, x), float(w))
            for i, (t, c, x, w) in enumerate(zip(T, CAUSE, X, W))]
    return spark.createDataFrame(rows, "id int, t int, event_type int, e int, defaulted int, x1 double, x2 double, x3 double, x4 double, w double").repartition(5)


def efron(beta, x, t, e, w=None, start=None):
    w = np.ones(len(t)) if w is None else w
    start = np.zeros(len(t)) if start is None else start
    r = w * np.exp(x @ beta)
    ll = 0.0
    for s in np.unique(t[e == 1]):
        risk = r[(t >= s) & (start < s)].sum()
        dead = (t == s) & (e == 1)
        d = dead.sum()
        ll += (w[dead] * (x[dead] @ beta)).sum()
        for k in range(d):
            ll -= w[dead].mean() * math.log(risk - k / d * r[dead].sum())
    return ll


def numeric_score(f, beta, h=1e-5):
    out = []
    for i in range(len(beta)):
        up, dn = beta.copy(), beta.copy()
        up[i] += h
        dn[i] -= h
        out.append((f(up) - f(dn)) / (2 * h))
    return np.array(out)


def test_kaplan_meier_brute_force(loans):
    km = {r.t: (r.S, r.S_lower, r.S_upper) for r in curves.kaplan_meier(
        curves.overall_event_table(loans, "t", "e")).collect()}
    s = 1.0
    for m in sorted(set(T)):
        s *= 1 - ((T == m) & (CAUSE == 1)).sum() / (T >= m).sum()
        assert abs(km[m][0] - s) < 1e-12
        if 0 < s < 1:
            assert km[m][1] <= s <= km[m][2]


def test_all_exit_at_once_and_no_events(spark):
    one = spark.createDataFrame([(5, 1)] * 20, "t int, e int")
    r = curves.kaplan_meier(curves.overall_event_table(one, "t", "e")).collect()[0]
    assert r.S == 0.0 and r.S_lower is None
    none = spark.createDataFrame([(5, 0), (7, 0)], "t int, e int")
    km = curves.kaplan_meier(curves.overall_event_table(none, "t", "e"))
    assert {x.S for x in km.collect()} == {1.0}
    assert curves.median_survival(km).collect()[0].median_survival_time is None


def test_small_strata_are_skipped(spark):
    df = spark.range(299).select((F.col("id") % 9 + 1).cast("int").alias("Duration"), F.lit(1).alias("Event_Prepay"),
                                 F.when(F.col("id") < 200, "a").otherwise("b").alias("s"))
    got = curves.stratified_km(df, {"v": "s"}).select("stratum").distinct().collect()
    assert [r.stratum for r in got] == ["a"]


def test_aalen_johansen_partition(loans):
    aj = compete.aalen_johansen(compete.cause_table(loans, "t"))
    assert compete.partition_check(aj).collect()[0].max_gap < 1e-12
    bias = compete.km_bias(compete.cause_table(loans, "t")).collect()
    assert all(r.bias >= -1e-12 for r in bias)


@pytest.mark.parametrize("native", [True, False])
@pytest.mark.parametrize("ties", ["efron", "breslow"])
def test_month_sums_give_the_likelihood(loans, native, ties):
    beta = np.array([0.3, -0.4])
    (s,) = month_sums(loans, ["x1", "x2"], [Model("e", beta)], time="t", weight="w", native=native)
    ev = evaluate(s, beta, ties)

    def breslow(b):
        eta, event = X[:, :2] @ b, CAUSE == 1
        at_risk = np.array([(W * np.exp(eta))[t <= T].sum() for t in T])
        return (W * (eta - np.log(at_risk)))[event].sum()

    f = breslow if ties == "breslow" else lambda b: efron(b, X[:, :2], T, CAUSE == 1, W)
    assert abs(ev.loglik - f(beta)) < 1e-8
    assert np.allclose(ev.score, numeric_score(f, beta), atol=1e-5)


@pytest.mark.parametrize("native", [True, False])
def test_entry_times(spark, native):
    start = np.minimum(RNG.integers(0, 10, N), T - 1)
    rows = [(int(a), int(t), int(c == 1), *map(float, x[:2])) for a, t, c, x in zip(start, T, CAUSE, X)]
    df = spark.createDataFrame(rows, "a int, t int, e int, x1 double, x2 double")
    beta = np.array([0.2, 0.5])
    (s,) = month_sums(df, ["x1", "x2"], [Model("e", beta)], time="t", start="a", native=native)
    assert abs(evaluate(s, beta).loglik - efron(beta, X[:, :2], T, CAUSE == 1, start=start)) < 1e-8


def test_fit_reaches_a_zero_score(loans):
    model = cox.fit(loans, ["x1", "x2", "x3", "x4"], time="t", event="e")
    f = lambda b: efron(b, X, T, CAUSE == 1)
    assert np.abs(numeric_score(f, model.coef)).max() < 1e-4
    assert abs(model.loglik - f(model.coef)) < 1e-8
    again = cox.fit(loans.repartition(11), ["x1", "x2", "x3", "x4"], time="t", event="e")
    assert np.allclose(model.coef, again.coef, atol=1e-10)


def test_baseline_and_predictions(loans):
    model = cox.fit(loans, ["x1"], time="t", event="e")
    h, want = 0.0, {}
    r = np.exp(X[:, 0] * model.coef[0])
    for m in sorted(set(T[CAUSE == 1])):
        h += ((T == m) & (CAUSE == 1)).sum() / r[T >= m].sum()
        want[m] = h
    for t, _, got in model.baseline():
        assert abs(got - want[t]) < 1e-9
    p = cox.horizon_probabilities(loans, model, [0, 12]).select("pred_Cox_T0", "pred_Cox_T12").collect()
    assert all(x[0] == 0.0 and 0 < x[1] < 1 for x in p)


@pytest.mark.parametrize("d", [2, 16, 17, 40, 1000, 19_999, 20_001, 300_000])
def test_tie_sums(d):
    """One formula for any number of ties: against extended precision at every share of events at risk."""
    for share in (1e-9, 1e-5, 1e-3, 0.1, 0.5, 1.0):
        a = 987654.321
        e = a * share
        left = np.arange(d, 0, -1, dtype=np.longdouble) / d
        f, phi = 1 - left, (np.longdouble(a) - np.longdouble(e)) + np.longdouble(e) * left
        want = np.log(phi).sum(), (1 / phi).sum(), (f / phi).sum(), (1 / phi ** 2).sum(), (f / phi ** 2).sum(), (f * f / phi ** 2).sum()
        assert all(abs(g - w) <= 3e-13 * abs(w) for g, w in zip(tie_sums(a, e, d, "efron"), want))


def test_subdistribution_brute_force(loans):
    g = cox.censoring_lookup(curves.censoring_survival(loans, "t", (F.col("event_type") > 0).cast("int")))
    beta = {"x1": 0.3, "x2": -0.2}
    ev = cox.at_fixed(loans, beta, time="t", event="e", ties="breslow", competing="defaulted", censoring=g)
    b = np.array([0.3, -0.2])
    r, ll = np.exp(X[:, :2] @ b), 0.0
    for s in np.unique(T[CAUSE == 1]):
        wt = np.where(T >= s, 1.0, 0.0)
        late = (T < s) & (CAUSE == 2)
        wt[late] = [g(s) / g(t) if g(t) > 0 else 0.0 for t in T[late]]
        dead = (T == s) & (CAUSE == 1)
        ll += (X[dead, :2] @ b).sum() - dead.sum() * math.log((wt * r).sum())
    assert abs(ev.loglik - ll) < 1e-8


def test_ridge_shrinks_and_history_is_recorded(loans, spark):
    free = cox.fit(loans, ["x1", "x3"], time="t", event="e")
    ridge = cox.fit(loans, ["x1", "x3"], time="t", event="e", penalizer=1.0)
    assert np.abs(ridge.coef).sum() < np.abs(free.coef).sum()
    assert free.history_table(spark).count() == len(free.history) > 1


def test_ranking_loss_brute_force(spark):
    rows, times, cif = [], RNG.integers(1, 8, 40), RNG.uniform(0, 0.2, (40, 8)).cumsum(axis=1) / 2
    for i in range(40):
        rows += [(i, m, float(cif[i, m]), int(times[i]), 1 + i % 2) for m in range(times[i] + 1)]
    df = spark.createDataFrame(rows, "loan int, m int, cif double, x int, k int")
    per = []
    ids = [i for i in range(40) if i % 2 == 0]
    for i in ids:
        partners = [j for j in ids if times[j] > times[i]]
        if partners:
            per.append(np.mean([math.exp((cif[j, times[i]] - cif[i, times[i]]) / 0.1) for j in partners]))
    got = compete.ranking_loss(df, "loan", "m", "cif", "x", "k", 1).collect()[0][0]
    assert abs(got - np.mean(per)) < 1e-9


def test_long_paths_and_unfinished_fits(spark):
    path = [0.01] * 400
    df = spark.createDataFrame([(path, path)], "a array<double>, b array<double>")
    assert len(compete.incidence_arrays(df, "a", "b").first().path) == 400
    rows = spark.createDataFrame([(1 + k % 7, k % 3 == 0, float(k % 5)) for k in range(60)], "t int, e boolean, x double").selectExpr("t", "int(e) e", "x")
    assert cox.fit(rows, ["x"], time="t", event="e").converged
    assert not cox.fit(rows, ["x"], time="t", event="e", max_iter=0).converged
