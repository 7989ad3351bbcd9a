"""The stages run end to end on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from hazardloom.plans import stages
from hazardloom.plans.views import Views

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_curves_models_and_scenarios(spark, tmp_path):
    v = Views(spark, FOLDER)
    out = str(tmp_path)
    v.surv.write.parquet(f"{out}/surv")
    surv = spark.read.parquet(f"{out}/surv")
    stages.curve_tables(surv, out)
    assert spark.read.parquet(f"{out}/km_overall").count() == 360
    stages.horizon_tables(surv, out, horizons=[24], models=["LogReg"], cutoff=200112, train_end=1998, test_start=1999, test_end=2001)
    assert {r.model for r in spark.read.parquet(f"{out}/C_metrics").select("model").distinct().collect()} <= {"LogReg", "Cox"}
    stages.nonlinear_tables(surv, out, horizons=[24], cutoff=200112, train_end=1998, test_start=1999, test_end=2001)
    assert spark.read.parquet(f"{out}/D_linear_vs_nonlinear").count() == 1
    stages.time_varying_tables(surv, v.macro, out, key="loan_key")
    assert spark.read.parquet(f"{out}/landmark_concordance").count() == 12
    stages.scenario_tables(spark.read.parquet(f"{out}/panel_monthly").where(F.col("vintage_year") <= 2016), out)
    price = {r.shock_bp: r.price_mean for r in spark.read.parquet(f"{out}/scenario_summary").collect()}
    assert price[-300] > price[0] > price[300]


def test_files_to_survival_table_cox_and_competing_risks(spark, tmp_path):
    from hazardloom.operators import terminal

    v, out = Views(spark, FOLDER), str(tmp_path)
    for y in (1995, 1996, 1997):
        x = v.loans.where(F.floor(F.col("FirstPaymentDate") / 100) == y)
        x.write.parquet(f"{out}/o_{y}.parquet")
        v.perf.join(x.select("loan_key", "LoanSequenceNumber"), "loan_key").write.parquet(f"{out}/p_{y}.parquet")
    surv = stages.build_survival_table(spark, out + "/o_{year}.parquet", out + "/p_{year}.parquet", range(1994, 1999), out + "/surv")
    assert surv.count() == v.surv.where("VintageYear <= 1997").count()
    macro = v.macro.select(F.col("yyyymm").alias("YYYYMM"), F.col("mortgage_rate").alias("MortgageRate"),
                           F.col("unemployment").alias("Unemployment"), F.col("hpi_yoy").alias("HPI_YoY"))
    stages.cox_tables(surv, macro, out + "/b")
    assert spark.read.parquet(out + "/b/cox_macro_summary").count() == 18
    stages.competing_risk_tables(terminal.survival_loans(surv), v.macro, surv, out + "/e")
    assert spark.read.parquet(out + "/e/coefficients").count() == 14
