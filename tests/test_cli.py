"""The command line of the stages."""

import os

import pytest

from hazardloom.plans import cli
from hazardloom.plans.views import Views
from hazardloom.sources import tables

FOLDER = "/root/testdata/sf0.001"


def test_options():
    a = cli.parser().parse_args(["horizon", "--survival", "s", "--out", "o"])
    assert (a.target_mode, a.drop_vintage_year, a.models) == ("cause_specific", False, ["LogReg", "RF", "LGBM"])
    for wrong in (["horizon", "--survival", "s", "--out", "o", "--target-mode", "other"], ["curves", "--survival", "s"], []):
        with pytest.raises(SystemExit):
            cli.parser().parse_args(wrong)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_horizon_stage(spark, tmp_path):
    Views(spark, FOLDER).surv.write.parquet(f"{tmp_path}/surv")
    years = "--cutoff 200112 --train-end 1998 --test-start 1999 --test-end 2001 --horizons 24 --models LogReg".split()
    names = {}
    for out, more in (("with", []), ("without", ["--drop-vintage-year", "--target-mode", "binary"])):
        cli.main(["horizon", "--survival", f"{tmp_path}/surv", "--out", f"{tmp_path}/{out}", *years, *more])
        found = spark.read.parquet(f"{tmp_path}/{out}/C_feature_importance").select("feature").distinct()
        names[out] = {r.feature for r in found.collect()}
    assert names["with"] - names["without"] == {"VintageYear"}
    mode = {out: tables.read_run_option(spark, f"{tmp_path}/{out}/run_config", "target_mode", "") for out in names}
    assert mode == {"with": "cause_specific", "without": "binary"}
    total = {out: spark.read.parquet(f"{tmp_path}/{out}/C_predictions").where("Target_T24 is not null").count() for out in names}
    assert total["without"] > total["with"]  # another exit before the horizon is a known label only in binary mode
