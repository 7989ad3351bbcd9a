"""Edge values of the column functions."""

from pyspark.sql import functions as F

from hazardloom.functions import columns as C
from hazardloom.functions import constants as K
from hazardloom.functions import loans as L


def values(df):
    return [r[0] for r in df.collect()]


def test_buckets_at_cut_values(spark):
    df = spark.createDataFrame([(619,), (620,), (779,), (780,), (None,)], "x int").coalesce(1)
    got = values(df.select(C.bucket("x", K.FICO_CUTS, K.FICO_LABELS, right_closed=False, missing="Missing")))
    assert got == ["<620", "620-659", "740-779", "780+", "Missing"]
    df = spark.createDataFrame([(60,), (61,), (95,), (96,)], "x int").coalesce(1)
    got = values(df.select(C.bucket("x", K.LTV_CUTS, K.LTV_LABELS, right_closed=True)))
    assert got == ["<=60", "61-70", "91-95", "96+"]


def test_interval_outside_edges_is_null(spark):
    df = spark.createDataFrame([(0,), (680,), (681,), (850,), (851,)], "x int").coalesce(1)
    assert values(df.select(C.interval("x", *K.FICO_GROUPS))) == [None, "FICO < 680", "FICO 680–740", "FICO > 740", None]


def test_duration_floor_and_flags(spark):
    df = spark.createDataFrame([(None, 1), (0, 3), (-2, 15), (7, None)], "Duration int, ZeroBalanceCode int").coalesce(1)
    assert values(L.floor_duration(df).select("Duration")) == [1, 1, 1, 7]
    rows = L.add_event_flags(df).collect()
    assert [r.Prepaid for r in rows] == [True, False, False, False]
    assert [r.CreditTerminated for r in rows] == [False, True, False, False]
    assert [r.Terminated for r in rows] == [True, True, True, False]


def test_sentinels_are_idempotent(spark):
    df = spark.createDataFrame([(9999, "9"), (700, "P"), (None, None)], "CreditScore int, LoanPurpose string").coalesce(1)
    once = L.clean_string_sentinels(L.clean_numeric_sentinels(df))
    twice = L.clean_string_sentinels(L.clean_numeric_sentinels(once))
    assert once.collect() == twice.collect() == [(None, None), (700, "P"), (None, None)]


def test_century_pivot(spark):
    df = spark.createDataFrame([("F99Q1000001",), ("F00Q4000001",), ("F90Q2000001",), ("F89Q3000001",)], "LoanSequenceNumber string").coalesce(1)
    got = [(r.VintageYear, r.VintageQuarter) for r in L.add_vintage(df).collect()]
    assert got == [(1999, 1), (2000, 4), (1990, 2), (2089, 3)]


def test_harmonic_increment(spark):
    cases = [(10, 3), (40, 40), (1000, 1), (100000, 2500), (17, 1), (16, 16)]
    df = spark.createDataFrame(cases, "n int, d int").coalesce(1)
    for (n, d), got in zip(cases, values(df.select(C.harmonic_increment("n", "d")))):
        want = sum(1.0 / (n - k) for k in range(d))
        assert abs(got - want) < 1e-9 * max(1.0, want)


def test_clip_keeps_null_and_month_arithmetic(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (99.0,)], "x double").coalesce(1)
    assert values(df.select(C.clip("x", 0.0, 12.0))) == [None, 0.0, 12.0]
    ym = spark.createDataFrame([(199912,), (200001,)], "m int").coalesce(1)
    assert values(ym.select(C.yyyymm(C.month_number("m") + F.lit(1)))) == [200001, 200002]


def test_sample_complement_is_exact(spark):
    ids = spark.range(2000)
    a = ids.where(C.sampled("id", 0.3, 7)).count()
    b = ids.where(~C.sampled("id", 0.3, 7)).count()
    assert a + b == 2000 and 500 < a < 700
