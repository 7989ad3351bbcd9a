"""The discrete hazard model at scale: how often rows are read, and how its columns compile."""

import contextlib
import io
import re

import numpy as np
from pyspark.sql import functions as F

from hazardloom.operators import classify, encode, logit, panel


def _counted(df):
    """df with an accumulator of the rows that were read."""
    n = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), n


def _months(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 2))
    e = np.exp(np.column_stack([np.zeros(900), x[:, 0] - 2, 0.5 * x[:, 1] - 3]))
    y = [int(rng.choice(3, p=p)) for p in e / e.sum(1, keepdims=True)]
    return spark.createDataFrame([(*map(float, r), c) for r, c in zip(x, y)], "a double, b double, cause_month int").repartition(3)


def test_the_hazard_fit_reads_its_rows_once(spark):
    df = _months(spark)
    x, n = _counted(df)
    model = classify.DiscreteHazards.fit(x, ["a", "b"])
    assert n.value == 900
    stds = df.agg(F.stddev_pop("a").alias("a"), F.stddev_pop("b").alias("b")).first().asDict()
    assert all(abs(model.stds[f] - s) < 1e-12 for f, s in stds.items())
    # at the optimum the mean hazards are the observed shares
    got = model.hazards(df).agg(F.avg("h1"), F.avg("h2"), F.avg((F.col("cause_month") == 1).cast("int")), F.avg((F.col("cause_month") == 2).cast("int"))).first()
    assert abs(got[0] - got[2]) < 1e-8 and abs(got[1] - got[3]) < 1e-8


def test_a_block_holds_many_rows(spark):
    df = _months(spark).selectExpr("a as x0", "b as x1", "nullif(cause_month, 1) as y0").coalesce(1)
    staged = logit.packed(df, 2, 1)
    assert staged.count() == 1
    ((x, y),) = logit._slices(iter(staged.toArrow().to_batches()), 2, 1)
    want = df.toArrow()
    assert (x == np.column_stack([want["x0"], want["x1"]]).T).all() and (y[0] == want["y0"].fill_null(-1).to_numpy()).all()


def test_median_imputation_reads_its_rows_in_few_passes(spark):
    df = spark.range(4000).selectExpr("id / 7 as a", "if(id % 3 = 0, null, (id * 37) % 1000 / 3) as b", "if(id % 5 = 0, null, id % 4) as c")
    x, n = _counted(df)
    filled = encode.fill_medians(x, ["a", "b", "c"])
    assert n.value <= 3 * 4000  # gaps and bounds, bins, values near the median
    want = df.agg(F.median("b"), F.median("c")).first()
    got = filled.where("b is null or c is null").count()
    read = filled.join(df.select(F.col("a"), F.col("b").alias("b0"), F.col("c").alias("c0")), "a")
    assert got == 0 and read.where(F.col("b0").isNull() & (F.col("b") != want[0]) | F.col("c0").isNull() & (F.col("c") != want[1])).isEmpty()


def test_current_ltv_compiles(spark):
    """Methods of 8,000 bytes and more are interpreted by the JVM, row by row."""
    x = spark.range(10).selectExpr("id as loan_id", "cast(id as int) as loan_age", "if(id = 3, null, 80) as LTV", "if(id = 5, null, 4e0 + id) as orig_rate",
                                   "1e0 + id / 100 as hpi_cumul", "999 as DTI", "'P' as loan_purpose", "'I' as occupancy")
    y = panel.panel_features(x)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            y.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue()))) < 8000
    for r in y.collect():
        rate = None if r.orig_rate is None else max(r.orig_rate / 1200, 1e-6)
        left = None if rate is None else min(max(((1 + rate) ** 360 - (1 + rate) ** r.loan_age) / ((1 + rate) ** 360 - 1), 0), 1)
        want = None if left is None or r.LTV is None else min(max(r.LTV * left / r.hpi_cumul, 0), 200)
        assert (r.ELTV is None) == (want is None) and (want is None or abs(r.ELTV - want) < 1e-9)
