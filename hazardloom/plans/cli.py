"""Command line of the stages: python -m hazardloom.plans.cli STAGE --survival PATH --out PATH [options]."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from ..functions import constants as K
from ..operators import targets
from . import stages
from .session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hazardloom", description="Run one stage on a survival table and write its result tables.")
    sub = top.add_subparsers(dest="stage", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--survival", required=True, help="survival table, Parquet")
    common.add_argument("--out", required=True, help="folder of the result tables")
    common.add_argument("--master", default=None, help="Spark master; without it the one of spark-submit")

    years = argparse.ArgumentParser(add_help=False)
    years.add_argument("--horizons", type=int, nargs="+", default=list(K.HORIZONS), metavar="MONTHS")
    years.add_argument("--cutoff", type=int, default=K.DATA_CUTOFF, metavar="YYYYMM", help="last observed month")
    years.add_argument("--train-end", type=int, default=K.TRAIN_END, metavar="YEAR")
    years.add_argument("--test-start", type=int, default=K.TEST_START, metavar="YEAR")
    years.add_argument("--test-end", type=int, default=K.TEST_END, metavar="YEAR")

    sub.add_parser("curves", parents=[common], help="survival and hazard curves")
    fit = sub.add_parser("cox", parents=[common], help="Cox models and diagnostics")
    fit.add_argument("--macro", help="macro table, Parquet")
    horizon = sub.add_parser("horizon", parents=[common, years], help="classifiers by horizon beside the Cox model")
    horizon.add_argument("--target-mode", choices=targets.MODES, default=targets.MODES[0],
                         help="what a competing exit before the horizon means for a label")
    horizon.add_argument("--drop-vintage-year", action="store_true", help="leave the origination year out of the features")
    horizon.add_argument("--models", nargs="+", choices=["LogReg", "RF", "LGBM"], default=["LogReg", "RF", "LGBM"])
    sub.add_parser("nonlinear", parents=[common, years], help="linear against nonlinear Cox; reads the split and target mode that `horizon` wrote to --out")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = session("hazardloom", a.master)
    surv = spark.read.parquet(a.survival)
    if a.stage == "curves":
        stages.curve_tables(surv, a.out)
    elif a.stage == "cox":
        stages.cox_tables(surv, spark.read.parquet(a.macro) if a.macro else None, a.out)
    else:
        years = {"horizons": a.horizons, "cutoff": a.cutoff, "train_end": a.train_end, "test_start": a.test_start, "test_end": a.test_end}
        if a.stage == "horizon":
            stages.horizon_tables(surv, a.out, target_mode=a.target_mode, vintage_year=not a.drop_vintage_year, models=a.models, **years)
        else:
            stages.nonlinear_tables(surv, a.out, **years)


if __name__ == "__main__":
    main()
