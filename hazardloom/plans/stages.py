"""The analysis stages end to end: each reads named tables and writes named tables.

Order: `build_survival_table`, then any of the others. Every path is a folder; the tables of a
stage are sub-folders of it. Long inputs are staged once where several outputs need them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import loans as L
from ..operators import (classify, compete, cox, curves, encode, metrics, panel, reports, scenario,
                         split, targets, terminal)
from ..sources import tables
from ..sources.staging import small_table, stage

KEY = "LoanSequenceNumber"


def build_survival_table(spark: SparkSession, origination: str, performance: str, years: Iterable[int],
                         out: str) -> DataFrame:
    """Yearly origination and performance files to the survival table (zstd parquet)."""
    years = list(years)
    orig = L.prepare_origination(tables.scan_years(spark, origination, years, K.ORIGINATION_COLUMNS))
    perf = tables.scan_years(spark, performance, years, K.PERFORMANCE_COLUMNS)
    tables.write_table(terminal.survival_table(orig, terminal.terminal_records(perf)), out)
    return spark.read.parquet(out)


def curve_tables(surv: DataFrame, out: str) -> None:
    """Summaries, overall and stratified Kaplan-Meier, hazards, medians."""
    et = small_table(curves.overall_event_table(surv))
    km = small_table(curves.kaplan_meier(et))
    by = ["variable", "stratum"]
    skm = small_table(curves.stratified_km(surv))
    results = {
        "summary": terminal.population_summary(surv), "vintage_summary": terminal.vintage_summary(surv),
        "km_overall": curves.on_grid(km), "km_median": curves.median_survival(km),
        "hazard_overall": curves.hazard_table(et), "km_by_stratum": curves.on_grid(skm, by),
        "stratum_medians": curves.median_survival(skm, by), "loglog_curves": curves.loglog_curves(surv)}
    for name, df in results.items():
        tables.write_summary(df, f"{out}/{name}")


def _cox_rows(surv: DataFrame, fit_on=None) -> DataFrame:
    x = L.clean_numeric_sentinels(surv).where(F.col("Duration") > 0)
    return encode.cox_features(x, encode.fit_cox_encoder(
        x.dropna(subset=["CreditScore", "OriginalLoantoValueLTV", "OriginalInterestRate"]), fit_on=fit_on))


def _write_fit(model: cox.CoxFit, spark: SparkSession, out: str, name: str) -> None:
    coef = model.coefficients(spark)
    tables.write_summary(coef, f"{out}/cox_{name}_summary")
    tables.write_summary(model.metadata(spark), f"{out}/cox_{name}_metadata")
    tables.write_summary(reports.forest_rows(coef), f"{out}/hazard_ratios_{name}")


def cox_tables(surv: DataFrame, macro: DataFrame | None, out: str, penalizer: float = 0.001) -> None:
    """Base model, proportional-hazards diagnostics and the vintage-macro model, on all rows."""
    spark = surv.sparkSession
    rows = stage(_cox_rows(surv).select("Duration", "Event_Prepay", "FirstPaymentDate", *K.COX_COVARIATES))
    base = cox.fit(rows, K.COX_COVARIATES, penalizer=penalizer, label="base", with_concordance=True)
    _write_fit(base, spark, out, "base")
    tables.write_summary(cox.ph_test(base, spark), f"{out}/ph_test")
    tables.write_table(cox.schoenfeld(rows, base), f"{out}/schoenfeld_residuals")
    if macro is None:
        return
    tables.write_summary(macro, f"{out}/macro_panel")
    x = encode.macro_z(panel.join_macro_at(rows, macro, "FirstPaymentDate", "YYYYMM"), K.MACRO_COVARIATES)
    extra = [f"{c}_z" for c in K.MACRO_COVARIATES if c in macro.columns]
    _write_fit(cox.fit(x, [*K.COX_COVARIATES, *extra], penalizer=penalizer, label="macro", with_concordance=True),
               spark, out, "macro")


def horizon_tables(surv: DataFrame, out: str, *, horizons: Sequence[int] = tuple(K.HORIZONS),
                   target_mode: str = "cause_specific", vintage_year: bool = True, cutoff: int = K.DATA_CUTOFF,
                   models: Sequence[str] = ("LogReg", "RF", "LGBM"), settings: dict | None = None,
                   train_end: int = K.TRAIN_END, test_start: int = K.TEST_START, test_end: int = K.TEST_END) -> None:
    """Targets, split, encoders, classifiers, Cox baseline, predictions, metrics, calibration."""
    spark = surv.sparkSession
    x = targets.horizon_targets(L.clean_numeric_sentinels(surv).where("Duration > 0"), horizons, target_mode, cutoff)
    x = stage(split.vintage_split(x, train_end, test_start, test_end))
    train, test = x.where("split = 'train'"), x.where("split = 'test'")
    tables.write_run_config(spark, f"{out}/run_config", target_mode=target_mode, vintage_year=vintage_year)
    tables.write_split({"train": train, "test": test}, f"{out}/canonical_split")
    enc = encode.Encoder.fit(train)
    enc.save(spark, f"{out}/encoders")
    labels = [f"Target_T{h}" for h in horizons]
    info = ["VintageYear", "VintageBucket", "FICO_bucket", "LTV_bucket", "LoanPurpose", "Duration", "Event_Prepay", "MaxObsMonths"]
    feats = list(encode.feature_columns(x, enc, vintage_year=vintage_year))
    # feature columns carry a prefix so that VintageYear can be both a feature and a key
    design = {f"f{i}": e for i, e in enumerate(encode.feature_columns(x, enc, vintage_year=vintage_year).values())}
    wide_train, wide_test = (f.select(KEY, *labels, *info, *[e.alias(n) for n, e in design.items()]) for f in (train, test))
    fitted, rows = classify.fit_horizons(wide_train, list(design), horizons, KEY, models, settings)
    rows = [(m, h, feats[int(f[1:])], i, r) for m, h, f, i, r in rows]
    preds = classify.score_horizons(wide_test, list(design), fitted, [KEY, *info, *labels])
    cenc = encode.fit_cox_encoder(train)
    model = cox.fit(encode.cox_features(train, cenc), K.COX_COVARIATES, penalizer=0.001, label="Cox")
    cox_preds = cox.horizon_probabilities(encode.cox_features(test, cenc), model, horizons)
    preds = stage(reports.merge_predictions(preds, cox_preds))
    tables.write_table(preds, f"{out}/C_predictions")
    evaluate(preds, [*models, "Cox"], horizons, out, "C")
    tables.write_summary(classify.importance_table(spark, rows, fitted), f"{out}/C_feature_importance")
    tables.write_metadata(spark, f"{out}/C_metadata", {
        "feature_names": feats, "horizons": list(horizons), "target_mode": target_mode, "cox": model.beta})


def evaluate(preds: DataFrame, models: Sequence[str], horizons: Sequence[int], out: str, prefix: str) -> DataFrame:
    """Metrics overall and by vintage and score bucket, and calibration, for a prediction table."""
    long = metrics.predictions_long(preds, models, horizons, [KEY, "VintageYear", "FICO_bucket"])
    m = metrics.stratified_metrics(long, {"vintage": "VintageYear", "FICO": "FICO_bucket"}, allowed={"FICO": K.FICO_LABELS})
    tables.write_summary(m, f"{out}/{prefix}_metrics")
    tables.write_summary(metrics.calibration(long), f"{out}/{prefix}_calibration")
    tables.write_summary(metrics.top_share_lift(long), f"{out}/{prefix}_lift")
    return preds.sparkSession.read.parquet(f"{out}/{prefix}_metrics")


def nonlinear_tables(surv: DataFrame, out: str, *, horizons: Sequence[int] = tuple(K.HORIZONS),
                     cutoff: int = K.DATA_CUTOFF, penalizer: float = 0.01, bins: int = 4,
                     train_end: int = K.TRAIN_END, test_start: int = K.TEST_START, test_end: int = K.TEST_END) -> None:
    """Linear and nonlinear Cox on the split of the horizon stage, with their ablation table."""
    spark = surv.sparkSession
    mode = tables.read_run_option(spark, f"{out}/run_config", "target_mode", "cause_specific")
    x = split.vintage_split(targets.horizon_targets(surv, horizons, mode, cutoff), train_end, test_start, test_end)
    canonical = tables.read_split(spark, f"{out}/canonical_split")
    x = stage(_cox_rows(x, "split = 'train'"))
    train = split.restrict_to_split(x.drop("split"), canonical, "train")
    test = split.restrict_to_split(x.drop("split"), canonical, "test")
    split.assert_aligned(test, canonical.where("split = 'test'"))
    inner = split.carve_validation(train)
    scaled = ["FICO_z", "LTV_z", "Rate_z", "UPB_z", "DTI_z"]
    wide, names = cox.expand_basis(inner, scaled, bins, fit_on="not is_val")
    wide_test, _ = cox.expand_basis(test, scaled, 1)
    edges = {n: e for n, e in _bin_columns(inner.where("not is_val"), scaled, bins).items()}
    wide_test = wide_test.withColumns(edges)
    preds = wide_test
    history = []
    for label, covs in (("LinearCox", K.COX_COVARIATES), ("DeepCox", [*names, *K.COX_COVARIATES[5:]])):
        model = cox.fit(wide.where("not is_val"), covs, penalizer=penalizer, label=label, validation=wide.where("is_val"))
        preds = cox.horizon_probabilities(preds, model, horizons, f"pred_{label}")
        history.append(model.history_table(spark).withColumn("model", F.lit(label)))
    keep = [KEY, "VintageYear", "FICO_bucket", *[f"Target_T{h}" for h in horizons],
            *[f"pred_{m}_T{h}" for m in ("LinearCox", "DeepCox") for h in horizons]]
    preds = stage(preds.select(*keep))
    tables.write_table(preds, f"{out}/D_predictions")
    m = evaluate(preds, ["LinearCox", "DeepCox"], horizons, out, "D")
    tables.write_summary(reports.ablation(m, "DeepCox", "LinearCox"), f"{out}/D_linear_vs_nonlinear")
    tables.write_summary(tables.union_all(history), f"{out}/D_training_history")


def _bin_columns(rows: DataFrame, columns: Sequence[str], bins: int) -> dict:
    """Quantile-bin indicators with the edges of the fitting rows."""
    from ..operators.ordered import quantiles

    out = {}
    for r in quantiles(rows, columns, [i / bins for i in range(1, bins)]).collect():
        for i, e in enumerate(sorted(set(r["q"]))):
            out[f"{r['column']}__q{i + 1}"] = (F.col(r["column"]) > F.lit(e)).cast("double")
    return out


def competing_risk_tables(labels: DataFrame, macro: DataFrame, history: DataFrame, out: str,
                          penalizer: float = 0.1) -> None:
    """Incidence curves, bias table, cause-specific fits and Fine-Gray, on all loans."""
    spark = labels.sparkSession
    x = labels.withColumn("event_type", L.event_code())
    et = small_table(compete.cause_table(x))
    tables.write_summary(terminal.event_profile(labels), f"{out}/event_profile")
    tables.write_summary(terminal.cohort_mix(labels), f"{out}/cohort_mix")
    tables.write_summary(compete.aalen_johansen(et), f"{out}/aalen_johansen")
    tables.write_summary(compete.bias_at(compete.km_bias(et)), f"{out}/km_aj_bias")
    tables.write_summary(compete.stratified_incidence(L.add_risk_groups(x), {
        "FICO": "fico_grp", "LTV": "ltv_grp", "Vintage": "vintage_grp"}), f"{out}/stratified_incidence")
    rows = terminal.add_delinquency_history(x, history)
    annual = panel.annual_means(macro, ["mortgage_rate", "unemployment", "hpi_yoy"])
    rows = panel.join_macro_at(rows, annual, "VintageYear", "year")
    rows = L.panel_dummies(rows, "LoanPurpose", "OccupancyStatus").withColumns({
        "rate_incentive": F.col("OriginalInterestRate") - F.col("mortgage_rate"), "any_event": L.any_event()})
    covs = ["CreditScore", "OriginalLoantoValueLTV", "OriginalDebttoIncomeRatio", "OriginalUPB", "mortgage_rate",
            "unemployment", "hpi_yoy", "rate_incentive", "MaxDelinquency", "EverDelinquent90",
            "LP_Purchase", "LP_NoCashRefi", "Occ_Investment", "Occ_SecondHome"]
    rows = stage(rows.select("duration", "prepaid", "defaulted", "any_event", *covs)).dropna()
    fits = cox.fit_many(rows, covs, time="duration", events={"naive": "any_event", "prepay": "prepaid", "default": "defaulted"},
                        penalizer=penalizer, staged=False)
    fits["fine_gray"] = cox.fit_fine_gray(rows, covs, penalizer=penalizer)
    coef = {n: f.coefficients(spark) for n, f in fits.items()}
    tables.write_summary(cox.divergence(cox.compare_coefficients(coef), "prepay", "default"), f"{out}/coefficients")


def time_varying_tables(surv: DataFrame, macro: DataFrame, out: str, penalizer: float = 0.01, key: str = KEY) -> None:
    """Loan-month panel, Andersen-Gill against static Cox, landmark concordance of both."""
    spark = surv.sparkSession
    tables.write_table(panel.expand_panel(surv, macro, key), f"{out}/panel_monthly", partition_by=["vintage_year"])
    feats = K.PANEL_STATIC + K.PANEL_DYNAMIC
    rows = panel.counting_process(panel.panel_features(spark.read.parquet(f"{out}/panel_monthly")))
    rows = stage(rows.select("loan_id", "vintage_year", "loan_age", "tstart", "tstop", "event", "prepaid_month", *feats))
    tables.write_summary(panel.trajectories(rows), f"{out}/trajectories")
    rows = encode.fill_medians(rows, feats)
    rows = encode.scale(rows, encode.fit_scaler(rows, feats, ddof=0))
    dynamic = cox.fit(rows, feats, time="tstop", event="event", start="tstart", penalizer=penalizer, label="time_varying")
    static_feats = [*K.PANEL_STATIC, "unemployment", "hpi_yoy"]
    static_rows = panel.origination_snapshot(rows).select("loan_id", *static_feats).join(panel.loan_exits(rows), "loan_id")
    static = cox.fit(static_rows, static_feats, time="duration", event="event_prepay", penalizer=penalizer, label="static")
    for model in (dynamic, static):
        _write_fit(model, spark, out, model.label)
    a = metrics.dynamic_concordance(rows.withColumn("risk", cox.log_hazard(dynamic.beta)), K.LANDMARKS, "risk")
    b = metrics.landmark_concordance(static_rows.withColumn("risk", cox.log_hazard(static.beta)), K.LANDMARKS,
                                     "duration", "event_prepay", "risk")
    both = a.withColumn("model", F.lit("time_varying")).unionByName(b.withColumn("model", F.lit("static")))
    tables.write_summary(both, f"{out}/landmark_concordance")


def scenario_tables(panel_rows: DataFrame, out: str, penalizer: float = 0.1, last_vintage: int = 2016) -> None:
    """Time-varying fit on (age-1, age] intervals, then shocks, paths, speeds and prices."""
    spark = panel_rows.sparkSession
    feats = ["rate_incentive", *K.REPRESENTATIVE_LOAN]
    rows = panel.counting_process(panel_rows.where(F.col("vintage_year") <= last_vintage), "end")
    model = cox.fit(rows, feats, time="tstop", event="event", start="tstart", penalizer=penalizer, label="scenario")
    inc = small_table(scenario.monthly_increments(model.baseline_table(spark)))
    shocks, beta = scenario.shock_table(spark), model.beta
    eta = scenario.representative_eta(beta)
    paths = scenario.survival_paths(shocks, inc, eta)
    h0 = scenario.hazard_array(inc)
    flows = scenario.perturbed_scenarios(shocks, scenario.rate_paths(spark)).withColumn("smm", scenario.smm_array(h0, eta))
    flows = scenario.cash_flows(flows, h0, eta, F.lit(K.COUPON_PCT), F.col("market"), F.lit(K.FACE_AMOUNT))
    summary = small_table(scenario.scenario_summary(flows))
    results = {
        "shock_response": scenario.shock_response(shocks, beta), "survival_paths": paths,
        "path_summary": scenario.path_summary(paths), "cpr_sweep": scenario.cpr_sweep(spark, inc, beta),
        "cpr_fico": scenario.cpr_surface(spark, inc, beta, "FICO", 580.0, 820.0),
        "cpr_ltv": scenario.cpr_surface(spark, inc, beta, "LTV", 40.0, 100.0),
        "cpr_profile": scenario.cpr_profile(flows), "scenario_summary": summary,
        "rate_risk": scenario.rate_risk(summary)}
    for name, df in results.items():
        tables.write_summary(df, f"{out}/{name}")
