"""Queries over rate-shock scenarios; the baseline hazard comes from the loan tables."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import cox
from ..operators import scenario as S
from ..sources.staging import small_table
from .registry import query

BETA = {"rate_incentive": 0.35, "FICO": 0.001, "LTV": -0.004, "DTI": -0.002, "unemployment": 0.02, "hpi_yoy": 0.01}
LOAN = K.REPRESENTATIVE_LOAN
FIXED = sum(BETA[n] * x for n, x in LOAN.items())
RAW = "0.001e0 * CreditScore - 0.004e0 * OriginalLoantoValueLTV"
_OK = "CreditScore is not null and OriginalLoantoValueLTV is not null"

BASE = {
    "bm": f"select Duration as t, cast(sum(Event_Prepay) as bigint) as d, sum(exp({RAW})) as r from surv where {_OK} group by 1",
    "bh": """select t, sum(d / risk) over (order by t) as H0 from (select t, d, sum(r) over (order by t rows between current row and unbounded following) as risk from bm)""",
    "b0": "select 0 as t, 0e0 as H0 union all select t, H0 from bh",
    "inc": """select g.t, coalesce(H, 0) - coalesce(lag(H) over (order by g.t), 0) as h0 from (select cast(t as int) as t from range(1, 121) r(t)) g left join (
        select g.t, case when a.t is null or a.t < (select min(t) from bh) then 0e0 when b.t is null or b.t = a.t then a.H0 else a.H0 + (b.H0 - a.H0) * (g.t - a.t) / (b.t - a.t) end as H
        from range(1, 121) g(t) left join b0 a on a.t = (select max(t) from b0 where b0.t <= g.t) left join b0 b on b.t = (select min(t) from b0 where b0.t >= g.t)) h on h.t = g.t""",
    "sh": "select shock_bp, 5.3e0 + shock_bp / 100e0 as market, 5e0 - (5.3e0 + shock_bp / 100e0) as rate_incentive from (select unnest([-300, -200, -100, 0, 100, 200, 300]) as shock_bp)",
    "pt": f"""select shock_bp, t, h0 * exp({FIXED!r}::double + 0.35e0 * rate_incentive) as hazard, exp(-sum(h0 * exp({FIXED!r}::double + 0.35e0 * rate_incentive)) over (partition by shock_bp order by t)) as S from sh cross join inc""",
}


def _increments(v):
    """Monthly baseline increments of the survival table at fixed coefficients."""
    x = v.surv.where(_OK).select(
        "Duration", "Event_Prepay", F.col("CreditScore").alias("FICO"), F.col("OriginalLoantoValueLTV").alias("LTV"))
    base = cox.breslow(x, {"FICO": 0.001, "LTV": -0.004}, "Duration", "Event_Prepay")
    return small_table(S.monthly_increments(base))


def _eta():
    return S.representative_eta(BETA)


@query("baseline_increments", "select * from inc", ("surv",), "h0", digits=9, extra=BASE)
def _(v):
    return _increments(v)


@query("rate_shock_response", f"""select shock_bp, rate_incentive, {FIXED!r}::double + b * rate_incentive as log_hazard, b * rate_incentive - b * -0.3e0 as delta, -b * shock_bp / 100e0 as analytic
    from sh, (select sum(Event_Prepay)::double / count(*) as b from surv)""", ("surv",), "rate_incentive log_hazard delta analytic", extra={"sh": BASE["sh"]})
def _(v):
    # the slope is the observed event rate, so that the table follows the data
    rate = v.surv.agg(F.avg(F.col("Event_Prepay").cast("double"))).collect()[0][0]
    return S.shock_response(S.shock_table(v.spark), {**BETA, "rate_incentive": rate})


@query("covariate_shock", """select shock_bp, n, m + move as mean_score, move as delta from (select shock_bp, n, m, 0.35e0 * shock_bp / 100e0 / s as move from sh,
    (select count(*) as n, avg(0.35e0 * OriginalInterestRate) as m, 1.4e0 as s from surv))""", ("surv",), "mean_score delta", extra={"sh": BASE["sh"]})
def _(v):
    return S.covariate_shock(v.surv, S.shock_table(v.spark), {"OriginalInterestRate": 0.35}, "OriginalInterestRate", 1.4)


@query("survival_paths", "select * from pt", ("surv",), "hazard S", extra=BASE)
def _(v):
    return S.survival_paths(S.shock_table(v.spark), _increments(v), _eta())


@query("path_summary", "select shock_bp, arg_max(S, t) as S_end, min(case when S < 0.5 then t end) as median_month from pt group by 1", ("surv",), "S_end", extra=BASE)
def _(v):
    return S.path_summary(S.survival_paths(S.shock_table(v.spark), _increments(v), _eta()))


_SWEEP = {**BASE, "sw": f"""select i as rate_incentive_i, ri as rate_incentive, h0 * exp({FIXED!r}::double + 0.35e0 * ri) as smm, 100e0 * (1 - pow(1 - h0 * exp({FIXED!r}::double + 0.35e0 * ri), 12)) as cpr
    from (select cast(i as int) as i, -3e0 + i * (7e0 / 79) as ri from range(0, 80) r(i)), (select h0 from inc where t = 36)""",
          "sl_": """select *, (coalesce(lead(cpr) over w, cpr) - coalesce(lag(cpr) over w, cpr)) / ((coalesce(lead(rate_incentive) over w, rate_incentive) - coalesce(lag(rate_incentive) over w, rate_incentive)) * 100e0) as slope
    from sw window w as (order by rate_incentive_i)"""}


@query("cpr_sweep", "select * from sl_", ("surv",), "rate_incentive smm cpr slope", extra=_SWEEP)
def _(v):
    return S.cpr_sweep(v.spark, _increments(v), BETA)


@query("cpr_sweep_summary", "select arg_min(cpr, rate_incentive_i) as cpr_low, arg_min(cpr, abs(rate_incentive)) as cpr_zero, arg_max(cpr, rate_incentive_i) as cpr_high, arg_min(slope, abs(rate_incentive)) as slope_zero from sl_",
       ("surv",), "cpr_low cpr_zero cpr_high slope_zero", extra=_SWEEP)
def _(v):
    return S.sweep_summary(S.cpr_sweep(v.spark, _increments(v), BETA))


def _surface(axis, low, high):
    fixed = sum(BETA[n] * x for n, x in LOAN.items() if n != axis)
    return f"""select cast(a.i as int) as rate_incentive_i, cast(b.j as int) as {axis}_i, -3e0 + a.i * (7e0 / 44) as rate_incentive, {low}e0 + b.j * ({high - low}e0 / 44) as {axis},
        100e0 * (1 - pow(1 - h0 * exp({fixed!r}::double + 0.35e0 * (-3e0 + a.i * (7e0 / 44)) + {BETA[axis]!r}::double * ({low}e0 + b.j * ({high - low}e0 / 44))), 12)) as cpr
        from range(0, 45) a(i), range(0, 45) b(j), (select h0 from inc where t = 36)"""


@query("cpr_surface_fico", _surface("FICO", 580, 820), ("surv",), "rate_incentive FICO cpr", extra=BASE)
def _(v):
    return S.cpr_surface(v.spark, _increments(v), BETA, "FICO", 580.0, 820.0)


@query("cpr_surface_ltv", _surface("LTV", 40, 100), ("surv",), "rate_incentive LTV cpr", extra=BASE)
def _(v):
    return S.cpr_surface(v.spark, _increments(v), BETA, "LTV", 40.0, 100.0)


# --- cash flows ------------------------------------------------------------------------------------
def flow_sql(rows: str, keys: str, months: int = 120) -> dict[str, str]:
    """Month recursion over `rows` (keys, coupon, disc, face, eta) with the increments `inc`."""
    return {
        "fi": f"select {keys}, coupon / 1200e0 as mc, disc / 1200e0 as md, face, eta, face * (coupon / 1200e0) / (1 - pow(1 + coupon / 1200e0, -360)) as pay from {rows}",
        "rc": f"""with recursive go as (
            select {keys}, mc, md, face, eta, pay, 0 as t, face as bal, 0e0 as wal, 0e0 as pv from fi union all
            select {keys}, mc, md, face, eta, pay, go.t + 1, case when bal >= 1 then bal - tp else bal end, case when bal >= 1 then wal + (go.t + 1) / 12e0 * tp else wal end,
              case when bal >= 1 then pv + (bal * mc + tp) / pow(1 + md, go.t + 1) else pv end from (
              select go.*, least(pay - bal * mc, bal) + least(greatest(h0 * exp(eta), 0), 1) * greatest(bal - least(pay - bal * mc, bal), 0) as tp
              from go join inc on inc.t = go.t + 1 where go.t < {months}) go) select * from go where t = {months}""",
        "fl": f"select {keys}, (wal + case when bal >= 1 then {months} / 12e0 * bal else 0 end) / face as wal, (pv + case when bal >= 1 then bal / pow(1 + md, {months}) else 0 end) / face * 100 as price from rc",
    }


_ND = NormalDist()
PATHS = ", ".join(f"({i}, {25.0 * _ND.inv_cdf((i - 0.5) / 200)!r}::double)" for i in range(1, 201))
MC = {**BASE, "pa": f"select * from (values {PATHS}) as p(path, noise_bp)",
      "mc": f"""select shock_bp, path, 5e0 as coupon, market as disc, 300000e0 as face, {FIXED!r}::double + 0.35e0 * (5e0 - (market + noise_bp / 100e0)) as eta from sh cross join pa""",
      **flow_sql("mc", "shock_bp, path"),
      "su": "select shock_bp, count(*) as n, avg(wal) as wal_mean, stddev_pop(wal) as wal_std, avg(price) as price_mean, stddev_pop(price) as price_std from fl group by 1"}


def _paths(v):
    x = S.perturbed_scenarios(S.shock_table(v.spark), S.rate_paths(v.spark))
    h0 = S.hazard_array(_increments(v))
    x = x.withColumn("smm", S.smm_array(h0, _eta()))
    return S.cash_flows(x, h0, _eta(), F.lit(K.COUPON_PCT), F.col("market"), F.lit(K.FACE_AMOUNT))


@query("perturbed_paths", "select shock_bp, path, wal, price from fl", ("surv",), "wal price", extra=MC)
def _(v):
    return _paths(v).select("shock_bp", "path", "wal", "price")


@query("scenario_summary", "select * from su", ("surv",), "wal_mean wal_std price_mean price_std", extra=MC)
def _(v):
    return S.scenario_summary(_paths(v))


@query("cpr_profile", "select shock_bp, t, avg(smm) as smm_mean, 100e0 * (1 - pow(1 - avg(smm), 12)) as cpr from (select shock_bp, inc.t, least(greatest(h0 * exp(eta), 0), 1) as smm from mc cross join inc) group by 1, 2",
       ("surv",), "smm_mean cpr", extra={k: MC[k] for k in (*BASE, "pa", "mc")})
def _(v):
    return S.cpr_profile(_paths(v))


@query("duration_convexity", """select -(p1 - m1) / (2 * p0 * 0.01e0) as duration_100, (p1 + m1 - 2 * p0) / (p0 * 0.0001e0) as convexity_100, -(p2 - m2) / (2 * p0 * 0.02e0) as duration_200,
    (p2 + m2 - 2 * p0) / (p0 * 0.0004e0) as convexity_200 from (select max(price_mean) filter (shock_bp = -200) as m2, max(price_mean) filter (shock_bp = -100) as m1, max(price_mean) filter (shock_bp = 0) as p0,
    max(price_mean) filter (shock_bp = 100) as p1, max(price_mean) filter (shock_bp = 200) as p2 from su)""", ("surv",), "duration_100 convexity_100 duration_200 convexity_200", digits=4, extra=MC)
def _(v):
    return S.rate_risk(S.scenario_summary(_paths(v)))


_LF = {**BASE, "lf": f"""select loan_key, shock_bp, OriginalInterestRate as coupon, market as disc, OriginalUPB as face,
    {RAW} + 0.35e0 * (OriginalInterestRate - market) - 0.5e0 as eta from surv cross join sh where {_OK}""", **flow_sql("lf", "loan_key, shock_bp")}


def _loan_flows(v):
    """Every loan under every scenario: a map over loans × seven rows."""
    x = v.surv.where(_OK).select("loan_key", "OriginalInterestRate", "OriginalUPB", "CreditScore", "OriginalLoantoValueLTV")
    x = x.withColumn("shock_bp", F.explode(F.array(*[F.lit(s) for s in K.SHOCKS_BP]))).withColumn(
        "market", F.lit(K.MARKET_PCT) + F.col("shock_bp") / F.lit(100.0))
    eta = (F.lit(0.001) * F.col("CreditScore") + F.lit(-0.004) * F.col("OriginalLoantoValueLTV")
           + F.lit(0.35) * (F.col("OriginalInterestRate") - F.col("market")) - F.lit(0.5))
    return S.cash_flows(x, S.hazard_array(_increments(v)), eta, F.col("OriginalInterestRate"), F.col("market"), F.col("OriginalUPB"))


@query("loan_cash_flows", "select loan_key, shock_bp, wal, price from fl", ("surv",), "wal price", digits=5, extra=_LF)
def _(v):
    return _loan_flows(v).select("loan_key", "shock_bp", "wal", "price")


@query("portfolio_scenarios", "select shock_bp, count(*) as n, avg(wal) as wal_mean, stddev_pop(wal) as wal_std, avg(price) as price_mean, stddev_pop(price) as price_std from fl group by 1",
       ("surv",), "wal_mean wal_std price_mean price_std", extra=_LF)
def _(v):
    return S.scenario_summary(_loan_flows(v))
