"""Queries of full models use every vintage and covariate."""

import os

import pytest

from hazardloom.functions import constants as K
from hazardloom.operators import cox
from hazardloom.plans.catalog import CATALOG
from hazardloom.plans.views import Views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_fit_history_and_fine_gray_are_whole(spark, monkeypatch):
    asked = {}
    fit = cox.fit

    def record(df, covariates, **kw):
        asked[kw.get("label", "history")] = (df, list(covariates), kw)
        return fit(df, covariates, **kw)

    monkeypatch.setattr(cox, "fit", record)
    assert CATALOG["cox_fit_history"].run(spark, FOLDER).count() > 1
    assert {r.covariate for r in CATALOG["fine_gray_model"].run(spark, FOLDER).select("covariate").collect()} == set(K.COX_COVARIATES)
    train, covariates, kw = asked["history"]
    assert covariates == [*K.COX_COVARIATES, "worst_status"]
    assert train.count() + kw["validation"].count() == Views(spark, FOLDER).cox_rows.count()


def test_best_step_is_returned(spark):
    """Overfitted training rows: the kept step is the one with the best validation likelihood, and its state is returned."""
    import numpy as np

    from hazardloom.operators.partial_likelihood import Model, evaluate, month_sums

    rng = np.random.default_rng(5)
    x = rng.normal(size=(460, 4))
    t = np.ceil(rng.exponential(np.exp(-0.4 * x[:, 0])) * 10).clip(1, 60).astype(int)
    df = spark.createDataFrame([(i, int(m), int(rng.random() < 0.8), *map(float, r)) for i, (m, r) in enumerate(zip(t, x))], "i int, t int, e int, x0 double, x1 double, x2 double, x3 double")
    train, val = df.where("i < 60"), df.where("i >= 60")
    names = ["x0", "x1", "x2", "x3"]
    whole = cox.fit(train, names, time="t", event="e", validation=val)
    assert whole.best is None and whole.converged
    for patience in (1, 2, 50):
        got = cox.fit(train, names, time="t", event="e", validation=val, patience=patience)
        values = [h["val_loglik"] for h in got.history]
        assert got.best == int(np.argmax(values)) or values[got.best] >= max(values) - 1e-9 * abs(max(values))
        assert len(values) <= got.best + patience + 1
        (s,) = month_sums(val, names, [Model("e", got.coef)], time="t")
        assert abs(evaluate(s, got.coef).loglik - values[got.best]) < 1e-6
        assert abs(got.loglik - got.history[got.best]["loglik"]) < 1e-9
        assert got.history_table(spark).where("best").first().iteration == got.best


def test_factors_equal_indicator_columns(spark):
    """Factors give the fit of dense indicator columns; intervals, weights, competing exits and two causes too."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 5)), int(rng.integers(6, 30)), int(rng.integers(0, 2)), int(rng.integers(0, 2)), float(rng.normal()), float(rng.normal()),
             float(rng.uniform(0.5, 2)), int(rng.integers(0, 3)), int(rng.integers(0, 4))) for _ in range(500)]
    df = spark.createDataFrame(rows, "t0 int, t int, e int, c int, x0 double, x1 double, w double, a int, b int").repartition(3)
    factors = [cox.Factor("a", ["a1", "a2"]), cox.Factor("b", ["b1", "b2", "b3"])]
    dense = cox.with_indicators(df, factors)
    names = ["x0", "x1", "a1", "a2", "b1", "b2", "b3"]
    for kw in ({}, {"start": "t0"}, {"weight": "w"}, {"competing": "c", "censoring": lambda t: 1 - t / 40}):
        one = cox.fit_many(df, ["x0", "x1"], time="t", events={"m": "e", "n": "c"}, penalizer=0.02, factors=factors, **kw)
        two = cox.fit_many(dense, names, time="t", events={"m": "e", "n": "c"}, penalizer=0.02, **kw)
        for m in ("m", "n"):
            assert one[m].names == names and np.allclose(one[m].coef, two[m].coef, atol=1e-8)
            assert np.allclose(one[m].variance, two[m].variance, atol=1e-8) and abs(one[m].loglik - two[m].loglik) < 1e-7
            assert np.allclose([h for _, _, h in one[m].baseline()], [h for _, _, h in two[m].baseline()], rtol=1e-7)
    binned, found = cox.bin_factors(df.withColumn("x2", F.when(F.col("x0") > 0, F.col("x0"))), ["x0", "x2"], 4)
    assert [len(f.names) for f in found] == [3, 3] and binned.where("x2 is null and x2__bin is not null").isEmpty()
    assert {r[0] for r in binned.select("x0__bin").distinct().collect()} == {0, 1, 2, 3}
