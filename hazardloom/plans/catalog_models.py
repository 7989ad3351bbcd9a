"""Queries over the Cox family and the discrete competing-risk evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..operators import compete, cox, curves, encode, metrics, reports
from ..operators import panel as P
from . import views as V
from .newton_sql import _sums, _total, coef_rows, list_coef_rows, newton, newton_lists, prefixed
from .registry import query

ID = "loan_key"
_KEEP = "where CreditScore is not null and OriginalLoantoValueLTV is not null"
ROWS = {"r0": f"select Duration as t, Event_Prepay as e, 1e0 as w, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2 from surv {_KEEP}"}
COEF = "coef hazard_ratio se coef_lower coef_upper hr_lower hr_upper z"
NAMES = ("x1", "x2")


def _rows(v):
    """Two raw-unit covariates of the complete rows."""
    x = v.labels.where("CreditScore is not null and OriginalLoantoValueLTV is not null")
    return x.select(
        ID, F.col("duration").cast("int").alias("t"), F.col("prepaid").alias("e"), "defaulted", "event_type",
        ((F.col("CreditScore") - 700) / 100.0).alias("x1"), (F.col("OriginalInterestRate") - 5).alias("x2"))


def _coef(model, v):
    return model.coefficients(v.spark).drop("p", "label")


# --- fixed coefficients ----------------------------------------------------------------
def _fixed(ties, rows="r0", cumulative=True, beta=(0.3, -0.2)):
    out = {"zz": f"select t, e, w, x1 as z1, x2 as z2 from {rows}", "be0": f"select {beta[0]!r} as p1, {beta[1]!r} as p2"}
    out.update(_sums(0, "zz", cumulative))
    out.update(_total(0, ties))
    return out


FIXED_SQL = "select loglik, u1 as score1, u2 as score2, -i11 as h11, -i12 as h12, -i22 as h22, cast(n_events as bigint) as n_events from l0"
FIXED = "loglik score1 score2 h11 h12 h22"


def _evaluation(v, ev):
    row = (float(ev.loglik), *map(float, ev.score), float(ev.hessian[0, 0]), float(ev.hessian[0, 1]),
           float(ev.hessian[1, 1]), int(ev.d.sum()))
    return v.spark.createDataFrame([row], "loglik double, score1 double, score2 double, h11 double, h12 double, h22 double, n_events bigint")


@query("cox_likelihood_efron", FIXED_SQL, ("surv",), FIXED, digits=4, extra={**ROWS, **_fixed("efron")})
def _(v):
    return _evaluation(v, cox.at_fixed(_rows(v), {"x1": 0.3, "x2": -0.2}, time="t", event="e"))


@query("cox_likelihood_breslow", FIXED_SQL, ("surv",), FIXED, digits=4, extra={**ROWS, **_fixed("breslow")})
def _(v):
    return _evaluation(v, cox.at_fixed(_rows(v), {"x1": 0.3, "x2": -0.2}, time="t", event="e", ties="breslow", native=False))


AG_ROWS = {"r0": """select loan_age + 1 as t, prepaid_month as e, 1e0 as w, rate_incentive as x1, (FICO - 700) / 100e0 as x2 from panel
    where rate_incentive is not null and FICO is not null"""}


def _ag_rows(v):
    x = P.counting_process(v.panel).where("rate_incentive is not null and FICO is not null")
    return x.select("tstart", "tstop", "event", F.col("rate_incentive").alias("x1"), ((F.col("FICO") - 700) / 100.0).alias("x2"))


@query("andersen_gill_likelihood", FIXED_SQL, ("panel",), FIXED, digits=4, extra={**AG_ROWS, **_fixed("efron", cumulative=False)})
def _(v):
    return _evaluation(v, cox.at_fixed(_ag_rows(v), {"x1": 0.3, "x2": -0.2}, time="tstop", event="event", start="tstart"))


# --- fits ----------------------------------------------------------------------------------
@query("cox_fit", coef_rows(NAMES), ("surv",), COEF, extra={**ROWS, **newton("r0")})
def _(v):
    return _coef(cox.fit(_rows(v), NAMES, time="t", event="e"), v)


@query("cox_fit_ridge", coef_rows(NAMES), ("surv",), COEF, extra={**ROWS, **newton("r0", penalizer=0.1)})
def _(v):
    return _coef(cox.fit(_rows(v), NAMES, time="t", event="e", penalizer=0.1), v)


@query("cox_fit_breslow", coef_rows(NAMES), ("surv",), COEF, extra={**ROWS, **newton("r0", ties="breslow")})
def _(v):
    return _coef(cox.fit(_rows(v), NAMES, time="t", event="e", ties="breslow"), v)


PAIRS = """select sum(case when i.s > j.s then i.c * j.c when i.s = j.s then 0.5e0 * i.c * j.c else 0 end)::double as concordant, sum(i.c * j.c)::double as pairs
    from cg i join cg j on i.e = 1 and (i.t < j.t or (i.t = j.t and j.e = 0))"""


@query("cox_metadata", """select 'cox' as label, n, cast(n_events as bigint) as n_events, 2 as n_covariates, (select concordant / pairs from pairs) as concordance,
    -2 * loglik + 4 as "partial_AIC", loglik as log_likelihood, loglik - 0.5e0 * 0.001e0 * n * (p1 * p1 + p2 * p2) as penalised_log_likelihood, 0.001e0 as penalizer, true as converged from fin""",
       ("surv",), "concordance partial_AIC log_likelihood penalised_log_likelihood penalizer", digits=4,
       extra={**ROWS, **newton("r0", penalizer=0.001),
              "cg": "select t, e, round(b1 * x1 + b2 * x2, 9) as s, count(*) as c from r0, fin group by 1, 2, 3", "pairs": PAIRS})
def _(v):
    return cox.fit(_rows(v), NAMES, time="t", event="e", penalizer=0.001, with_concordance=True).metadata(v.spark)


@query("andersen_gill_fit", coef_rows(NAMES), ("panel",), COEF, extra={**AG_ROWS, **newton("r0", penalizer=0.01, cumulative=False, steps=6)})
def _(v):
    return _coef(cox.fit(_ag_rows(v), NAMES, time="tstop", event="event", start="tstart", penalizer=0.01), v)


CAUSES = {
    "ra": f"select duration as t, prepaid as e, 1e0 as w, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2 from sl {_KEEP}",
    "rb": f"select duration as t, defaulted as e, 1e0 as w, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2 from sl {_KEEP}",
    "rc": f"select duration as t, greatest(prepaid, defaulted) as e, 1e0 as w, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2 from sl {_KEEP}",
    **newton("ra", 6, 0.1, prefix="fa_"), **newton("rb", 6, 0.1, prefix="fb_"), **newton("rc", 6, 0.1, prefix="fc_"),
}


@query("cause_specific_fits", """select *, case when prepay * "default" < 0 and abs(prepay) > 0.05 and abs("default") > 0.05 then 'opposite' when abs(prepay - "default") > 0.3 then 'diverge' else '' end as flag from (
    select 'x1' as covariate, c.b1 as naive, a.b1 as prepay, b.b1 as "default" from fa_fin a, fb_fin b, fc_fin c union all select 'x2', c.b2, a.b2, b.b2 from fa_fin a, fb_fin b, fc_fin c)""",
       ("sl",), 'naive prepay "default"', extra=CAUSES)
def _(v):
    x = _rows(v).withColumn("any", ((F.col("e") == 1) | (F.col("defaulted") == 1)).cast("int"))
    fits = cox.fit_many(x, NAMES, time="t", events={"naive": "any", "prepay": "e", "default": "defaulted"}, penalizer=0.1)
    tables = {n: f.coefficients(v.spark) for n, f in fits.items()}
    return cox.divergence(cox.compare_coefficients(tables), "prepay", "default")


@query("coefficient_shifts", """select covariate, prepay, "default", prepay - "default" as difference, case when abs(prepay - "default") > 0.2 then '>0.2' when abs(prepay - "default") > 0.1 then '>0.1' else '' end as flag from (
    select 'x1' as covariate, a.b1 as prepay, b.b1 as "default" from fa_fin a, fb_fin b union all select 'x2', a.b2, b.b2 from fa_fin a, fb_fin b)""",
       ("sl",), 'prepay "default" difference', extra=CAUSES)
def _(v):
    # the second model names its covariates differently; the alias map brings them together
    x = _rows(v).withColumns({"score": F.col("x1"), "rate": F.col("x2")})
    a = cox.fit(x, NAMES, time="t", event="e", penalizer=0.1).coefficients(v.spark)
    b = cox.fit(x, ("score", "rate"), time="t", event="defaulted", penalizer=0.1).coefficients(v.spark)
    return cox.shifts(cox.compare_coefficients({"prepay": a, "default": b}, {"score": "x1", "rate": "x2"}), "prepay", "default")


# --- baseline and predictions -------------------------------------------------------------------
_BH = {"bm": f"""select t, sum(d)::bigint as d, sum(r) as r from (select Duration as t, Event_Prepay as d, exp(0.3e0 * (CreditScore - 700) / 100e0 - 0.2e0 * (OriginalInterestRate - 5)) as r from surv {_KEEP}) group by 1""",
       "bk": "select t, d, sum(r) over (order by t rows between current row and unbounded following) as risk from bm",
       "bh": "select t, d, risk, d / risk as increment, sum(d / risk) over (order by t rows between unbounded preceding and current row) as H0 from bk"}


@query("breslow_baseline", "select * from bh", ("surv",), "risk increment H0", digits=5, extra=_BH)
def _(v):
    return cox.breslow(_rows(v), {"x1": 0.3, "x2": -0.2}, "t", "e")


@query("breslow_from_fit", """select t, wd / a * exp(-(b1 * m1 + b2 * m2)) as increment, sum(wd / a * exp(-(b1 * m1 + b2 * m2))) over (order by t) as H0 from m7, fin""",
       ("surv",), "increment H0", extra={**ROWS, **newton("r0")})
def _(v):
    return cox.fit(_rows(v), NAMES, time="t", event="e").baseline_table(v.spark)


@query("cox_horizon_probabilities", "select loan_key, " + ", ".join(
    f"1 - exp(-(select max(H) from (select sum(wd / a * exp(-(b1 * m1 + b2 * m2))) over (order by t) as H, t from m7, fin) where t <= {h}) * exp(b1 * x1 + b2 * x2)) as pred_Cox_T{h}" for h in V.HORIZONS)
    + " from (select loan_key, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2 from surv) s, fin", ("surv",), " ".join(f"pred_Cox_T{h}" for h in V.HORIZONS), extra={**ROWS, **newton("r0")})
def _(v):
    model = cox.fit(_rows(v), NAMES, time="t", event="e")
    x = v.surv.select(ID, ((F.col("CreditScore") - 700) / 100.0).alias("x1"), (F.col("OriginalInterestRate") - 5).alias("x2"))
    return cox.horizon_probabilities(x, model, V.HORIZONS).drop("x1", "x2")


# --- diagnostics ------------------------------------------------------------------------------------
@query("schoenfeld_residuals", """select r.t, covariate, count(*) as n, avg(residual) as mean_residual, stddev_pop(residual) as std_residual from (
    select r0.t, unnest(['x1', 'x2']) as covariate, unnest([x1 - (n1 / d * s1 + m1), x2 - (n2 / d * s2 + m2)]) as residual from r0 join m7 on r0.t = m7.t, fin where e = 1) r group by 1, 2""",
       ("surv",), "mean_residual std_residual", extra={**ROWS, **newton("r0")})
def _(v):
    r = cox.schoenfeld(_rows(v), cox.fit(_rows(v), NAMES, time="t", event="e"))
    return r.groupBy("t", "covariate").agg(
        F.count("*").alias("n"), F.avg("residual").alias("mean_residual"), F.stddev_pop("residual").alias("std_residual"))


@query("ph_test", """select unnest(['x1', 'x2']) as covariate, unnest([deaths * pow(sv1 * g1 + cov * g2, 2) / (sv1 * q), deaths * pow(cov * g1 + sv2 * g2, 2) / (sv2 * q)]) as test_statistic from (
    select sum(d) as deaths, sum((rank - mr) * (g1 - wd * n1 / d)) as g1, sum((rank - mr) * (g2 - wd * n2 / d)) as g2, sum((rank - mr) * (rank - mr) * d) as q
    from rk, (select sum(rank * d) / sum(d) as mr from rk)), fin""", ("surv",), "test_statistic", digits=5, extra={
        **ROWS, **newton("r0"), "rk": "select *, sum(d) over (order by t) - d + (d + 1) / 2e0 as rank from m7"})
def _(v):
    return cox.ph_test(cox.fit(_rows(v), NAMES, time="t", event="e"), v.spark).select("covariate", "test_statistic")


@query("residual_trend", """select covariate, bin, sum(t)::double / count(*) as mean_t, avg(residual) as mean_residual, count(*) as n from (
    select covariate, t, residual, greatest(cast(ceil((t - lo) * bins::double / (hi - lo)) as int), 1) as bin from res,
    (select min(t) as lo, max(t) as hi, least(40, greatest(5, count(distinct t))) as bins from res)) group by 1, 2""", ("surv",), "mean_t mean_residual", extra={
        **ROWS, **newton("r0"), "res": """select r0.t, unnest(['x1', 'x2']) as covariate, unnest([x1 - (n1 / d * s1 + m1), x2 - (n2 / d * s2 + m2)]) as residual from r0 join m7 on r0.t = m7.t, fin where e = 1"""})
def _(v):
    return cox.residual_trend(cox.schoenfeld(_rows(v), cox.fit(_rows(v), NAMES, time="t", event="e")))


@query("forest_rows", f"""select cast(row_number() over (order by coef) as int) as position, * exclude (z, se), case when hazard_ratio > 1 then '↑ faster prepayment' else '↓ slower prepayment' end as direction
    from ({coef_rows(NAMES)})""", ("surv",), "coef hazard_ratio coef_lower coef_upper hr_lower hr_upper", extra={**ROWS, **newton("r0")})
def _(v):
    model = cox.fit(_rows(v), NAMES, time="t", event="e")
    return reports.forest_rows(model.coefficients(v.spark)).drop("p", "sig", "label")


# --- Fine-Gray --------------------------------------------------------------------------------------
_G = {"gc": f"select duration as t, count(*) as n_exit, count(*) filter (event_type = 0) as d from sl {_KEEP} group by 1",
      "gk": "select t, 1 - d::double / sum(n_exit) over (order by t rows between current row and unbounded following) as f from gc",
      "gg": "select t, case when min(f) over w <= 0 then 0e0 else exp(sum(case when f > 0 then ln(f) else 0 end) over w) end as G from gk window w as (order by t rows between unbounded preceding and current row)"}


@query("fine_gray_weighted", coef_rows(NAMES), ("sl",), COEF, extra={
    **_G, "r0": f"""select duration as t, prepaid as e, greatest(case when defaulted = 1 then G else 1 end, 1e-6) as w, (CreditScore - 700) / 100e0 as x1, OriginalInterestRate - 5 as x2
        from sl join gg on sl.duration = gg.t {_KEEP}""", **newton("r0", penalizer=0.1)})
def _(v):
    return _coef(cox.fit_fine_gray(_rows(v), NAMES, time="t", event="e", competing="defaulted", mode="reference", penalizer=0.1), v)


_SUB = {**_G, "rr": f"""select duration as t, prepaid as e, defaulted as c, (CreditScore - 700) / 100e0 as z1, OriginalInterestRate - 5 as z2,
        exp(0.3e0 * (CreditScore - 700) / 100e0 - 0.2e0 * (OriginalInterestRate - 5)) as r from sl {_KEEP}""",
        "mm": "select distinct t from rr where e = 1",
        # every row against every event month: weight 1 while at risk, G(t)/G(T) after a competing exit
        "kx": """select mm.t, sum(wt * r) as a, sum(wt * r * z1) as b1, sum(wt * r * z2) as b2 from mm, lateral (
            select r, z1, z2, case when rr.t >= mm.t then 1e0 when c = 1 and gs.G > 0 then gt.G / gs.G else 0 end as wt
            from rr join gg gs on gs.t = rr.t join gg gt on gt.t = mm.t) group by 1""",
        "ev": "select t, count(*) as d, sum(0.3e0 * z1 - 0.2e0 * z2) as eta, sum(z1) as g1, sum(z2) as g2 from rr where e = 1 group by 1"}


@query("fine_gray_subdistribution", """select sum(eta - d * ln(a)) as loglik, sum(g1 - d * b1 / a) as score1, sum(g2 - d * b2 / a) as score2, cast(sum(d) as bigint) as n_events from kx join ev using (t)""",
       ("sl",), "loglik score1 score2", digits=4, extra=_SUB)
def _(v):
    x = _rows(v)
    g = curves.censoring_survival(x, "t", (F.col("event_type") > 0).cast("int"))
    ev = cox.at_fixed(x, {"x1": 0.3, "x2": -0.2}, time="t", event="e", ties="breslow", competing="defaulted",
                      censoring=cox.censoring_lookup(g))
    return _evaluation(v, ev).select("loglik", "score1", "score2", "n_events")


# --- full models -----------------------------------------------------------------------
def _list(*expressions):
    return "[" + ", ".join(f"cast({e} as double)" for e in expressions) + "]"


_COX_RAW = {"FICO_z": "CreditScore", "LTV_z": "OriginalLoantoValueLTV", "Rate_z": "OriginalInterestRate", "UPB_z": "OriginalUPB", "DTI_z": "dti"}
COX_VIEW = {
    "c0": f"""select *, coalesce(OriginalDebttoIncomeRatio, (select median(OriginalDebttoIncomeRatio) from surv {_KEEP})) as dti, cast(OriginalDebttoIncomeRatio is null as int) as DTI_missing, coalesce(MaxDelinquency, 0) as worst_status,
        cast(coalesce(LoanPurpose = 'P', false) as int) as is_Purchase, cast(coalesce(LoanPurpose = 'C', false) as int) as is_CashOutRefi,
        cast(coalesce(OccupancyStatus = 'I', false) as int) as is_Investment, cast(coalesce(OccupancyStatus = 'S', false) as int) as is_SecondHome,
        cast(coalesce(FirstTimeHomebuyerFlag = 'Y', false) as int) as is_FirstTimeBuyer, cast(coalesce(PropertyType = 'CO', false) as int) as is_Condo,
        cast(coalesce(PropertyType = 'PU', false) as int) as is_PUD, cast(coalesce(MortgageInsurancePercentage > 0, false) as int) as has_MI,
        cast(coalesce(NumberofBorrowers > 1, false) as int) as "is_MultiBorrower" from surv {_KEEP}""",
    "c1": "select " + ", ".join(f"avg({c}) as m_{z}, stddev_samp({c}) as s_{z}" for z, c in _COX_RAW.items()) + " from c0",
    "cz": "select c0.*, " + ", ".join(f"({c} - m_{z}) / s_{z} as {z}" for z, c in _COX_RAW.items()) + " from c0, c1",
}


def _cox_x(rows="cz", names=K.COX_COVARIATES, event="Event_Prepay", where=""):
    return f"select Duration as t, {event} as e, 1e0 as w, {_list(*names)} as x from {rows} {where}"


@query("cox_base_model", list_coef_rows(K.COX_COVARIATES), ("surv",), COEF, extra={**COX_VIEW, "r0": _cox_x(), **newton_lists("r0", 7, 0.001)})
def _(v):
    return _coef(cox.fit(v.cox_rows, K.COX_COVARIATES, penalizer=0.001, label="base"), v)


_MACRO = {"MortgageRate": "mortgage_rate", "Unemployment": "unemployment", "HPI_YoY": "hpi_yoy"}
MACRO_VIEW = {
    **COX_VIEW, "k0": "select cz.*, mortgage_rate, unemployment, hpi_yoy from cz left join macro on FirstPaymentDate = yyyymm",
    "k1": "select " + ", ".join(f"avg({c}) as m{n}, stddev_samp({c}) as s{n}" for n, c in _MACRO.items()) + " from k0",
    "kz": "select k0.*, " + ", ".join(f"coalesce(({c} - m{n}) / nullif(s{n}, 0), 0) as {n}_z" for n, c in _MACRO.items()) + " from k0, k1"}
MACRO_NAMES = [*K.COX_COVARIATES, *[f"{c}_z" for c in _MACRO]]


@query("cox_macro_model", f"select * from ({list_coef_rows(MACRO_NAMES)}) where covariate in ('MortgageRate_z', 'Unemployment_z', 'HPI_YoY_z')", ("surv", "macro"), COEF,
       extra={**MACRO_VIEW, "r0": _cox_x("kz", MACRO_NAMES), **newton_lists("r0", 7, 0.001)})
def _(v):
    m = v.macro.select("yyyymm", F.col("mortgage_rate").alias("MortgageRate"), F.col("unemployment").alias("Unemployment"), F.col("hpi_yoy").alias("HPI_YoY"))
    x = encode.macro_z(P.join_macro_at(v.cox_rows, m, "FirstPaymentDate", "yyyymm"), K.MACRO_COVARIATES)
    covs = [*K.COX_COVARIATES, *[f"{c}_z" for c in K.MACRO_COVARIATES if f"{c}_z" in x.columns]]
    return reports.macro_rows(_coef(cox.fit(x, covs, penalizer=0.001, label="macro"), v))


# Newton steps from zero, judged on a fifth of the loans of every vintage; it ends with the first step that brings nothing
TRACKED = [*K.COX_COVARIATES, "worst_status"]
HISTORY = {**COX_VIEW, "r0": _cox_x(names=TRACKED, where="where loan_key % 5 <> 0"), "rv": _cox_x(names=TRACKED, where="where loan_key % 5 = 0"), **newton_lists("r0", 7, 0.001, validation="rv"),
           "steps": " union all ".join(f"select {k} as iteration, a.loglik as train_loglik, c.loglik as val_loglik, b from ll_{k} a, ll_v{k} c, be{k}" for k in range(8)),
           "worse": """select coalesce(min(iteration), 99) as k from (select iteration, val_loglik, lag(val_loglik) over (order by iteration) as before from steps)
               where not val_loglik > before + 1e-9 * abs(before)""",
           "kept": "select steps.*, iteration = k - 1 as best from steps, worse where iteration <= k"}


def _history(v):
    x = v.cox_rows.withColumn("worst_status", F.coalesce("MaxDelinquency", F.lit(0)))
    train, val = x.where("loan_key % 5 <> 0"), x.where("loan_key % 5 = 0")
    return cox.fit(train, TRACKED, penalizer=0.001, validation=val, patience=1)


@query("cox_fit_history", "select iteration, train_loglik, val_loglik, best from kept", ("surv",), "train_loglik val_loglik", digits=4, extra=HISTORY)
def _(v):
    return _history(v).history_table(v.spark).drop("max_step")


@query("cox_best_step", f"""select {"[" + ", ".join(f"'{n}'" for n in TRACKED) + "]"}[i] as covariate, b[i] / s[i] as coef, iteration as best
    from (select unnest(range(1, p + 1)) as i from st), st, kept where best""", ("surv",), "coef", extra=HISTORY)
def _(v):
    model = _history(v)
    return model.coefficients(v.spark).select("covariate", "coef", F.lit(model.best).alias("best"))


@query("best_iteration", "select arg_max(iteration, val_loglik) as best, -max(val_loglik) as best_loss from kept where best", ("surv",), "best_loss", digits=4, extra=HISTORY)
def _(v):
    history = _history(v).history_table(v.spark).where("best").withColumn("val_loss", -F.col("val_loglik"))
    return reports.best_iteration(history)


_BINNED = list(_COX_RAW)
_SMOOTH = [*_BINNED, *[f"{c}__sq" for c in _BINNED], *[f"{a}__x__{b}" for i, a in enumerate(_BINNED) for b in _BINNED[i + 1:]], *K.COX_COVARIATES[5:]]
_SMOOTH_SQL = [*_BINNED, *[f"{c} * {c}" for c in _BINNED], *[f"{a} * {b}" for i, a in enumerate(_BINNED) for b in _BINNED[i + 1:]], *K.COX_COVARIATES[5:]]
BINS = [f"{c}__b{i}" for c in _BINNED for i in (1, 2, 3)]
BIN_VIEW = {**COX_VIEW, "eg": "select " + ", ".join(f"list_sort(list_distinct(quantile_cont({c}, [0.25, 0.5, 0.75]))) as g_{c}" for c in _BINNED) + " from cz",
            "cb": "select cz.*, " + ", ".join(f"len(list_filter(g_{c}, lambda g: g < {c})) as {c}__bin" for c in _BINNED) + " from cz, eg"}
_BIN_SQL = [f"{c}__bin = {i}" for c in _BINNED for i in (1, 2, 3)]


def _nonlinear(v):
    x, _ = cox.expand_basis(v.cox_rows, _BINNED, bins=1)
    return cox.bin_factors(x, _BINNED, 4)


@query("nonlinear_cox_model", list_coef_rows([*_SMOOTH, *BINS]), ("surv",), COEF, digits=5,
       extra={**BIN_VIEW, "r0": _cox_x("cb", [*_SMOOTH_SQL, *_BIN_SQL]), **newton_lists("r0", 7, 0.01)})
def _(v):
    x, factors = _nonlinear(v)
    return _coef(cox.fit(x, _SMOOTH, penalizer=0.01, label="nonlinear", factors=factors), v)


# score and information of every bin at fixed coefficients, with only two covariates beside the bins
_FIXED_BINS = {**BIN_VIEW, "bb": """select t, e, i, k, r from (select Duration as t, Event_Prepay as e, exp(0.2e0 * Rate_z - 0.1e0 * is_Purchase + """
               + " + ".join(f"0.05e0 * {c}__bin" for c in _BINNED) + ") as r, " + "[" + ", ".join(f"{c}__bin" for c in _BINNED) + "] as codes from cb), lateral (select unnest(codes) as k, generate_subscripts(codes, 1) as i)",
               "b1": "select t, i, k, sum(r) as r, count(*) filter (e = 1) as d from bb where k > 0 group by 1, 2, 3",
               "b2": "select t, sum(r) as r, count(*) filter (e = 1) as d from bb where i = 1 group by 1",
               "b3": "select t, d, sum(r) over (order by t desc) as risk from b2",
               "b4": """select m.t, c.i, c.k, coalesce(d, 0) as d, sum(coalesce(r, 0)) over (partition by c.i, c.k order by m.t desc) as r
                   from (select t from b2) m cross join (select distinct i, k from b1) c left join b1 on b1.t = m.t and b1.i = c.i and b1.k = c.k"""}


@query("nonlinear_cox_effects", f"""select {"[" + ", ".join(f"'{c}'" for c in _BINNED) + "]"}[i] || '__b' || k as covariate, cast(sum(b4.d) as bigint) as n_events,
    sum(b4.d - b3.d * r / risk) as score, sum(b3.d * (r / risk) * (1 - r / risk)) as information,
    sum(b4.d - b3.d * r / risk) / sum(b3.d * (r / risk) * (1 - r / risk)) as step from b4 join b3 using (t) where b3.d > 0 group by i, k""", ("surv",), "score information step", digits=4, extra=_FIXED_BINS)
def _(v):
    x, factors = _nonlinear(v)
    beta = {"Rate_z": 0.2, "is_Purchase": -0.1} | {n: 0.05 * k for f in factors for k, n in enumerate(f.names, 1)}
    ev = cox.at_fixed(x, beta, time="Duration", event="Event_Prepay", ties="breslow", factors=factors)
    rows = [(n, int(ev.event_x[:, j].sum()), float(ev.score[j]), float(-ev.hessian[j, j]), float(-ev.score[j] / ev.hessian[j, j])) for j, n in enumerate(beta) if j > 1]
    return v.spark.createDataFrame(rows, "covariate string, n_events bigint, score double, information double, step double")


_TV = [*K.PANEL_STATIC, *K.PANEL_DYNAMIC]
TV_VIEW = {"f0": "select " + ", ".join(f"median({c}) as d_{c}" for c in _TV) + " from feat",
           "f1": "select loan_age + 1 as t, prepaid_month as e, " + ", ".join(f"coalesce(cast({c} as double), d_{c}) as {c}" for c in _TV) + " from feat, f0",
           "f2": "select " + ", ".join(f"avg({c}) as m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) as s_{c}" for c in _TV) + " from f1",
           "r0": "select t, e, 1e0 as w, " + _list(*[f"({c} - m_{c}) / s_{c}" for c in _TV]) + " as x from f1, f2"}


def _tv_rows(v):
    """Counting-process rows, imputed and scaled, built from the loans where they are read."""
    x = P.counting_process(v.panel_features).select("loan_id", "tstart", "tstop", "event", *[F.col(c).cast("double").alias(c) for c in _TV])
    x = encode.fill_medians(x, _TV)
    return encode.scale(x, encode.fit_scaler(x, _TV, ddof=0))


@query("time_varying_model", list_coef_rows(_TV), ("feat",), COEF, digits=5, extra={**TV_VIEW, **newton_lists("r0", 6, 0.01, cumulative=False)})
def _(v):
    return _coef(cox.fit(_tv_rows(v), _TV, time="tstop", event="event", start="tstart", penalizer=0.01, label="time_varying"), v)


# --- static against time-varying covariates on the same landmark rows ------------------------------------
_PAIR = "[rate_incentive, (FICO - 700) / 100e0]"
_EVAL = " union all ".join(
    f"""select '{m}' as model, {h} as horizon, least(d, {h}) as t, case when ev = 1 and d <= {h} then 1 else 0 end as e, {c} as s from ls join (
        select loan_id, arg_max(score, loan_age) as rd from ld where loan_age + 1 <= {h} group by 1) using (loan_id) where rs is not null"""
    for h in V.HORIZONS for m, c in (("static", "rs"), ("time_varying", "rd")))
LANDMARK = {
    **prefixed({"r0": f"select loan_age + 1 as t, prepaid_month as e, 1e0 as w, {_PAIR} as x from panel where rate_incentive is not null and FICO is not null",
                **newton_lists("r0", 6, 0.01, cumulative=False)}, "dy_"),
    "lo": "select loan_id, max(loan_age) + 1 as d, max(prepaid_month) as ev from panel group by 1",
    **prefixed({"r0": f"select d as t, ev as e, 1e0 as w, {_PAIR} as x from panel join lo using (loan_id) where loan_age = 0 and rate_incentive is not null and FICO is not null",
                **newton_lists("r0", 7, 0.01)}, "st_"),
    "ls": f"select lo.*, round(list_inner_product({_PAIR}, b), 6) as rs from lo join panel using (loan_id), (select list(b order by i) as b from st_coefs) where loan_age = 0 and rate_incentive is not null and FICO is not null",
    "ld": f"select loan_id, loan_age, round(list_inner_product({_PAIR}, b), 6) as score from panel, (select list(b order by i) as b from dy_coefs) where rate_incentive is not null and FICO is not null",
    "le": _EVAL, "cg": "select model, horizon, t, e, s, count(*) as c from le group by all",
    "pr": """select i.model, i.horizon, sum(case when i.s > j.s then i.c * j.c when i.s = j.s then 0.5e0 * i.c * j.c else 0 end)::double as concordant, sum(i.c * j.c)::double as pairs
        from cg i join cg j on i.model = j.model and i.horizon = j.horizon and i.e = 1 and (i.t < j.t or (i.t = j.t and j.e = 0)) group by 1, 2""",
    "lm": "select model, horizon, t, count(*) as n, sum(e) as d, sum(exp(s)) as r, sum(e * s) as eta from le group by all",
    "lk": "select *, sum(r) over (partition by model, horizon order by t desc) as risk from lm",
}


@query("static_against_dynamic", """select model, horizon, n, n_events, concordant / pairs as c_index, loglik from (select model, horizon, cast(sum(n) as bigint) as n, cast(sum(d) as bigint) as n_events,
    sum(case when d > 0 then eta - d * ln(risk) else 0 end) as loglik from lk group by 1, 2) join pr using (model, horizon)""", ("panel",), "c_index loglik", digits=4, extra=LANDMARK)
def _(v):
    names = ["rate_incentive", "fico"]
    x = P.counting_process(v.panel).select("loan_id", "loan_age", "tstart", "tstop", "event", "prepaid_month", "rate_incentive", ((F.col("FICO") - 700) / 100.0).alias("fico"))
    dynamic = cox.fit(x, names, time="tstop", event="event", start="tstart", penalizer=0.01)
    static = cox.fit(P.origination_snapshot(x).join(P.loan_exits(x), "loan_id"), names, time="duration", event="event_prepay", penalizer=0.01)
    scored = x.withColumns({"s": F.round(cox.log_hazard(static.beta), 6), "d": F.round(cox.log_hazard(dynamic.beta), 6)})
    return metrics.landmark_comparison(scored, V.HORIZONS, "s", "d")


FG_VIEW = {**_G, **COX_VIEW, "r0": f"select Duration as t, cast(Prepaid as int) as e, cast(CreditTerminated as int) as c, 1e0 as w, {_list(*K.COX_COVARIATES)} as x from cz"}


@query("fine_gray_model", list_coef_rows(K.COX_COVARIATES), ("surv", "sl"), COEF, extra={**FG_VIEW, **newton_lists("r0", 7, 0.1, competing=True)})
def _(v):
    x = v.cox_rows.withColumns({"prepaid": F.col("Prepaid").cast("int"), "defaulted": F.col("CreditTerminated").cast("int")})
    return _coef(cox.fit_fine_gray(x, K.COX_COVARIATES, time="Duration", penalizer=0.1), v)


# --- discrete competing-risk evaluation ----------------------------------------------------------------
_HZ = {"hz": """select loan_id, loan_age, least(greatest(0.008e0 + 0.004e0 * coalesce(rate_incentive, 0), 1e-7), 1 - 1e-7) as l1,
        least(greatest(0.002e0 + 0.00005e0 * coalesce(LTV, 70), 1e-7), 1 - 1e-7) as l2 from panel""",
       "hs": "select *, exp(coalesce(sum(ln(1 - l1) + ln(1 - l2)) over (partition by loan_id order by loan_age rows between unbounded preceding and 1 preceding), 0)) as sp from hz",
       "ci": """select *, sp * (1 - l1) * (1 - l2) as S, sum(l1 * sp) over w as cif1, sum(l2 * sp) over w as cif2 from hs window w as (partition by loan_id order by loan_age rows between unbounded preceding and current row)""",
       "cl": "select ci.*, duration - 1 as x, event_type from ci join sl on loan_id = loan_key"}


def _hazards(v):
    return v.panel.select("loan_id", "loan_age", "prepaid_month", "default_month", (F.lit(0.008) + F.lit(0.004) * F.coalesce("rate_incentive", F.lit(0.0))).alias("h1"),
                          (F.lit(0.002) + F.lit(0.00005) * F.coalesce("LTV", F.lit(70))).alias("h2"))


def _chain(v):
    lab = v.labels.select(F.col(ID).alias("loan_id"), (F.col("duration") - 1).alias("x"), "event_type")
    return compete.incidence_rows(_hazards(v), "loan_id", "loan_age", "h1", "h2").join(lab, "loan_id")


@query("incidence_chain", "select loan_age, count(*) as n, avg(S) as S, avg(cif1) as cif1, avg(cif2) as cif2, max(cif1) as top from ci group by 1", ("panel",), "S cif1 cif2 top", extra={k: _HZ[k] for k in ("hz", "hs", "ci")})
def _(v):
    x = compete.incidence_rows(_hazards(v), "loan_id", "loan_age", "h1", "h2")
    return x.groupBy("loan_age").agg(F.count("*").alias("n"), F.avg("S").alias("S"), F.avg("cif1").alias("cif1"), F.avg("cif2").alias("cif2"), F.max("cif1").alias("top"))


@query("incidence_arrays", "select loan_id, arg_max(S, loan_age) as S, arg_max(cif1, loan_age) as cif1, arg_max(cif2, loan_age) as cif2 from ci group by 1", ("panel",), "S cif1 cif2", extra={k: _HZ[k] for k in ("hz", "hs", "ci")})
def _(v):
    seq = P.sequences(_hazards(v), ["h1", "h2"])
    x = seq.select("loan_id", F.transform("steps", lambda s: s["h1"]).alias("a"), F.transform("steps", lambda s: s["h2"]).alias("b"))
    last = F.element_at("path", -1)
    return compete.incidence_arrays(x, "a", "b").select("loan_id", last["s"].alias("S"), last["f1"].alias("cif1"), last["f2"].alias("cif2"))


def _nll_sql(k):
    return f"""select avg(s / m) + avg(p) as nll from (select loan_id, sum(case when loan_age < x then -ln(1 - l{k}) else 0 end) as s, greatest(count(*) filter (loan_age < x), 1) as m,
        max(case when loan_age = x then case when event_type = {k} then -ln(l{k}) else -ln(1 - l{k}) end end) as p from cl group by 1)"""


def _rank_sql(k):
    return f"""select sum(per) / count(*) as ranking_loss from (select a.loan_id, avg(exp((b.cif{k} - a.cif{k}) / 0.1e0)) as per
        from (select * from cl where event_type = {k} and loan_age = x) a join (select * from cl where event_type = {k}) b on b.loan_age = a.x and b.x > a.x group by 1)"""


@query("discrete_nll", f"select * from ({_nll_sql(1)})", ("panel", "sl"), "nll", extra=_HZ)
def _(v):
    return compete.cause_nll(_chain(v), "loan_id", "loan_age", "h1", "x", "event_type", 1)


@query("ranking_loss", f"select * from ({_rank_sql(2)})", ("panel", "sl"), "ranking_loss", extra=_HZ)
def _(v):
    return compete.ranking_loss(_chain(v), "loan_id", "loan_age", "cif2", "x", "event_type", 2)


@query("total_loss", f"""select *, nll1 + nll2 + 0.2e0 * (rank1 + rank2) as total_loss from (select (select nll from ({_nll_sql(1)})) as nll1, (select ranking_loss from ({_rank_sql(1)})) as rank1,
    (select nll from ({_nll_sql(2)})) as nll2, (select ranking_loss from ({_rank_sql(2)})) as rank2)""", ("panel", "sl"), "nll1 nll2 rank1 rank2 total_loss", digits=5, extra=_HZ)
def _(v):
    return compete.total_loss(_chain(v), "loan_id", "loan_age", "x", "event_type")


@query("base_log_odds", """select ln(p1 / (1 - p1)) as prepay, ln(p2 / (1 - p2)) as "default" from (select sum(prepaid_month)::double / count(*) as p1, sum(default_month)::double / count(*) as p2 from panel)""", ("panel",), 'prepay "default"')
def _(v):
    r = v.panel.agg(F.avg("prepaid_month").alias("p1"), F.avg("default_month").alias("p2"))
    return r.select(C.logit("p1").alias("prepay"), C.logit("p2").alias("default"))
