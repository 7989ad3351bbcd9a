"""Ranks, running totals and quantiles, with one group holding most rows."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardloom.operators import encode, lookup, ordered, split


def skewed(spark, n=3000):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 10 < 8, "hot").otherwise("cold").alias("g"),
        ((F.col("id") * 7919) % 1000 / F.lit(8.0)).alias("x"))


def test_ranks_are_exact_and_do_not_depend_on_partitions(spark):
    df = skewed(spark)
    for parts in (1, 16):
        got = ordered.ranked(df.repartition(parts), ["g"], "x", ["id"]).toPandas()
        for _, g in got.groupby("g"):
            g = g.sort_values(["x", "id"])
            assert list(g["rank"]) == list(range(1, len(g) + 1))


def test_quantiles_match_numpy(spark):
    df = skewed(spark)
    probs = [0.0, 0.1, 0.37, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in ordered.quantiles(df, ["x"], probs, ["g"]).collect()}
    pdf = df.toPandas()
    for g, sub in pdf.groupby("g"):
        assert np.allclose(got[g], np.quantile(sub["x"], probs))


def test_constant_column_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0), (1.0, 4.0)], "a double, b double")
    got = {r["column"]: r["median"] for r in ordered.medians(df, ["a", "b"]).collect()}
    assert got == {"a": 1.0, "b": 3.0}


def test_lookups(spark):
    curve = spark.createDataFrame([(2, 0.9), (5, 0.4)], "t int, S double")
    grid = lookup.month_grid(curve, [], 7)
    step = {r.t: r.S for r in lookup.step(curve, grid, {"S": 1.0}).collect()}
    assert step == {1: 1.0, 2: 0.9, 3: 0.9, 4: 0.9, 5: 0.4, 6: 0.4, 7: 0.4}
    lin = {r.t: round(r.S, 6) for r in lookup.linear(curve, grid, "S").collect()}
    assert lin[1] == 0.0 and lin[3] == round(0.9 - 0.5 / 3, 6) and lin[7] == 0.4
    near = {r.at: r.t_used for r in lookup.nearest(curve, [1, 4, 9], "S").collect()}
    assert near == {1: 2, 4: 5, 9: 5}


def test_splits_have_exact_sizes(spark):
    df = skewed(spark).select("id", "g")
    val = split.carve_validation(df, 0.1, key="id")
    assert val.where("is_val").count() == 300 and val.count() == 3000
    strat = split.stratified_split(df, ["g"], 0.2, key="id")
    got = {r["g"]: r["n"] for r in strat.where("is_test").groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert got == {"hot": 480, "cold": 120}
    quota = split.quota_sample(df, "g", {"hot": 10, "cold": 99999}, key="id")
    assert {r["g"]: r["n"] for r in quota.groupBy("g").agg(F.count("*").alias("n")).collect()} == {"hot": 10, "cold": 600}
    prop = split.proportional_sample(df, ["g"], 100, key="id")
    assert prop.count() == 100


def test_selected_is_the_exact_median(spark, monkeypatch):
    random.seed(6)
    monkeypatch.setattr(ordered, "DISTINCT", 5)
    monkeypatch.setattr(ordered, "BINS", 8)
    rows = [(random.random() ** 9 * 10 ** random.randint(-9, 9), float(random.randint(0, 4)) if i % 3 else None, -0.0, None) for i in range(401)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = {k: statistics.median([r[i] for r in rows if r[i] is not None] or [math.nan]) for i, k in enumerate("abc")}
    assert ordered.selected(df, list("abcd")) == {**want, "d": None}
    assert ordered.selected(df.limit(400), ["a"]) == {"a": pytest.approx(statistics.median(r.a for r in df.limit(400).collect()), rel=1e-15)}
    assert ordered.selected(spark.createDataFrame([(1.0,), (math.nan,)], "a double"), ["a"]) is None


def test_medians_of_fitting_rows_move_no_rows(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (None,), (2.0,)], "a double")
    assert sorted(r.a for r in encode.fill_medians(df, ["a"]).collect()) == [1.0, 2.0, 2.0, 4.0]
