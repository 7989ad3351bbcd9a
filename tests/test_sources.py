"""Readers, writers and guards."""

import pytest
from pyspark.sql import functions as F

from hazardloom.operators import encode, panel, split, targets
from hazardloom.sources import staging, tables


def test_years_skip_missing_and_fail_on_none(spark, tmp_path):
    for y in (2001, 2003):
        spark.range(3).withColumn("y", F.lit(y)).write.parquet(f"{tmp_path}/d_{y}.parquet")
    df = tables.scan_years(spark, f"{tmp_path}/d_{{year}}.parquet", range(2000, 2005))
    assert df.count() == 6
    with pytest.raises(FileNotFoundError):
        tables.scan_years(spark, f"{tmp_path}/x_{{year}}.parquet", [1])


def test_series_csv(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("DATE,V\n2000-01-01,1.5\n2000-02-01,.\n2000-03-01,2\n")
    df = tables.read_series_csv(spark, str(p), "v")
    assert [r.v for r in df.orderBy("date").collect()] == [1.5, 2.0]
    assert tables.read_series_csv(spark, str(tmp_path / "none.csv"), "v") is None
    q = tmp_path / "b.csv"
    q.write_text("when,V\n2000-01-01,1\n")
    assert tables.read_series_csv(spark, str(q), "v") is None


def test_macro_panel_fills_inside_the_range_only(spark):
    a = spark.createDataFrame([("2000-01-10", 1.0), ("2000-01-20", 3.0), ("2000-04-01", 5.0)], "d string, A double").select(F.to_date("d").alias("date"), "A")
    b = spark.createDataFrame([("2000-02-01", 7.0)], "d string, B double").select(F.to_date("d").alias("date"), "B")
    got = [(r.YYYYMM, r.A, r.B) for r in panel.macro_panel({"A": a, "B": b}).orderBy("YYYYMM").collect()]
    assert got == [(200001, 2.0, None), (200002, 2.0, 7.0), (200003, 2.0, None), (200004, 5.0, None)]


def test_config_metadata_and_encoder_round_trip(spark, tmp_path):
    tables.write_run_config(spark, f"{tmp_path}/c", target_mode="binary")
    assert tables.read_run_option(spark, f"{tmp_path}/c", "target_mode", "cause_specific") == "binary"
    assert tables.read_run_option(spark, f"{tmp_path}/no", "target_mode", "cause_specific") == "cause_specific"
    tables.write_metadata(spark, f"{tmp_path}/m", {"features": ["a", "b"], "n": 3})
    assert tables.read_metadata(spark, f"{tmp_path}/m")["features"] == ["a", "b"]
    enc = encode.Encoder({"CreditScore": 700.0}, {"Channel": ["R", "T"]})
    enc.save(spark, f"{tmp_path}/e")
    assert encode.Encoder.load(spark, f"{tmp_path}/e") == enc
    assert tables.scan_optional(spark, f"{tmp_path}/missing") is None


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.col("id") % 2)
    tables.write_table(df, f"{tmp_path}/t", partition_by=["v"])
    assert tables.scan_partitioned(spark, f"{tmp_path}/t", [1], "v").count() == 5
    tables.write_summary(df, f"{tmp_path}/s")
    assert tables.scan(spark, f"{tmp_path}/s", ["id"], "v = 0").count() == 5


def test_split_guards(spark, tmp_path):
    df = spark.createDataFrame([("a", 2000), ("b", 2001)], "LoanSequenceNumber string, VintageYear int")
    with pytest.raises(ValueError):
        tables.split_table({"other": df})
    with pytest.raises(KeyError):
        tables.split_table({"train": df.drop("VintageYear")})
    tables.write_split({"train": df}, f"{tmp_path}/split")
    s = tables.read_split(spark, f"{tmp_path}/split")
    with pytest.raises(ValueError):
        split.restrict_to_split(df, s, "nope")
    with pytest.raises(ValueError):
        split.restrict_to_split(df, s, "test")
    assert split.restrict_to_split(df, s, "train").count() == 2
    with pytest.raises(RuntimeError):
        split.assert_aligned(s, s.limit(1))
    with pytest.raises(FileNotFoundError):
        tables.read_split(spark, f"{tmp_path}/none")
    with pytest.raises(ValueError):
        split.carve_validation(df, 1.5)


def test_encoder_guards_and_null_levels(spark):
    df = spark.createDataFrame([(700, "P"), (None, None), (650, "Z")], "CreditScore int, LoanPurpose string").coalesce(1)
    with pytest.raises(KeyError):
        encode.feature_columns(df, encode.Encoder())
    enc = encode.Encoder({"CreditScore": 690.0}, {"LoanPurpose": ["P"]})
    x = encode.feature_matrix(df, enc).collect()
    assert [r["CreditScore"] for r in x] == [700.0, 690.0, 650.0]
    assert [r["LoanPurpose__OTHER"] for r in x] == [0, 1, 1] and {r["LoanPurpose__MISSING"] for r in x} == {0}
    y = encode.feature_matrix(df, enc, null_level="MISSING").collect()
    assert [r["LoanPurpose__MISSING"] for r in y] == [0, 1, 0]


def test_target_boundary(spark):
    rows = [(12, 1, True), (12, 0, True), (12, 0, False), (11, 0, False), (13, 1, True)]
    df = spark.createDataFrame(rows, "Duration int, Event_Prepay int, Terminated boolean").coalesce(1)
    assert [r[0] for r in df.select(targets.horizon_target(12)).collect()] == [1.0, None, 0.0, None, 0.0]
    assert [r[0] for r in df.select(targets.horizon_target(12, "binary")).collect()] == [1.0, 0.0, 0.0, None, 0.0]
    with pytest.raises(ValueError):
        targets.horizon_target(12, "x")


def test_small_table_falls_back(spark):
    df = spark.range(50)
    assert "LocalTableScan" in staging.small_table(df)._jdf.queryExecution().executedPlan().toString()
    assert staging.small_table(df, 10) is df
    assert staging.small_table(df).count() == 50


def test_panel_hpi_shortcut_equals_row_product(spark):
    macro = spark.createDataFrame([(200000 + m, 5.0, 4.0, float(m) if m != 3 else None) for m in range(1, 7)],
                                  "yyyymm int, mortgage_rate double, unemployment double, hpi_yoy double")
    surv = spark.createDataFrame(
        [(1, 2000, 700, 80, 30, 1e5, 6.0, "P", "P", 199912, 9, True, False), (2, 2000, 700, 80, 30, 1e5, 6.0, "P", "P", 200003, 2, False, False)],
        "loan_key int, VintageYear int, CreditScore int, OriginalLoantoValueLTV int, OriginalDebttoIncomeRatio int, OriginalUPB double, OriginalInterestRate double, LoanPurpose string, OccupancyStatus string, FirstPaymentDate int, Duration int, Prepaid boolean, CreditTerminated boolean")
    x = panel.expand_panel(surv, macro, "loan_key")
    a = {(r.loan_id, r.loan_age): r.hpi_cumul for r in x.collect()}
    b = {(r.loan_id, r.loan_age): r.hpi_cumul for r in panel.cumulative_hpi(x.drop("hpi_cumul")).collect()}
    assert len(a) == 11 and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_panel_is_spread_by_its_months(spark, monkeypatch):
    macro = spark.createDataFrame([(200001, 5.0, 4.0, 1.0)], "yyyymm int, mortgage_rate double, unemployment double, hpi_yoy double")
    surv = spark.createDataFrame(
        [(i, 2000, 700, 80, 30, 1e5, 6.0, "P", "P", 200001, 40, False, False) for i in range(100)],
        "loan_key int, VintageYear int, CreditScore int, OriginalLoantoValueLTV int, OriginalDebttoIncomeRatio int, OriginalUPB double, OriginalInterestRate double, LoanPurpose string, OccupancyStatus string, FirstPaymentDate int, Duration int, Prepaid boolean, CreditTerminated boolean").coalesce(1)
    monkeypatch.setattr(panel, "PANEL_ROWS", 100)
    x = panel.expand_panel(surv, macro, "loan_key")
    assert x.rdd.getNumPartitions() >= 40 and x.count() == 4000
    plan = panel.cumulative_hpi(x.drop("hpi_cumul"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("REPARTITION_BY_NUM") <= 2  # the loans are moved, their months are not


def test_split_table_of_tagged_rows(spark):
    df = spark.createDataFrame([("a", 1998, "train"), ("b", 2001, "test"), ("b", 2001, "test"), (None, 1999, "val"), ("c", 2009, None)],
                               "LoanSequenceNumber string, VintageYear int, split string")
    apart = tables.split_table({s: df.where(F.col("split") == s) for s in tables.SPLITS})
    once = tables.split_table(df)
    assert once.columns == apart.columns and sorted(map(str, once.collect())) == sorted(map(str, apart.collect()))
    with pytest.raises(KeyError):
        tables.split_table(df.drop("split"))
