"""Rate scenarios driven by a Cox fit on the loans: response, shocks, paths, speeds and prices.

The fit has the rate incentive and the held-fixed covariates of the representative loan that the
survival table carries; its own baseline gives the monthly hazard increments.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import cox
from ..operators import scenario as S
from ..sources.staging import small_table
from .catalog_scenario import BASE, PATHS, flow_sql
from .newton_sql import newton_lists
from .registry import query

_OK = "CreditScore is not null and OriginalLoantoValueLTV is not null"
COVARIATES = ("rate_incentive", "FICO", "LTV")
_X = {"rate_incentive": f"(OriginalInterestRate - {K.MARKET_PCT!r}::double)", "FICO": "CreditScore::double", "LTV": "OriginalLoantoValueLTV::double"}
_SCORE = " + ".join(f"c{i} * {x}" for i, x in enumerate(_X.values(), 1))
_HELD = " + ".join(f"c{i} * {K.REPRESENTATIVE_LOAN[n]!r}::double" for i, n in enumerate(COVARIATES, 1) if n != "rate_incentive")

FIT = {"r0": f"select Duration as t, Event_Prepay as e, 1e0 as w, [{', '.join(_X.values())}] as x from surv where {_OK}",
       **newton_lists("r0", 7, 0.001),
       "bt": "select " + ", ".join(f"max(case when i = {i} then b end) as c{i}" for i in range(1, len(COVARIATES) + 1)) + " from coefs",
       "sh": BASE["sh"]}
GRID = {**FIT, "bm": f"select Duration as t, cast(sum(Event_Prepay) as bigint) as d, sum(exp({_SCORE})) as r from surv, bt where {_OK} group by 1",
        # a fit's baseline has the months with events only
        "bh": "select t, sum(d / risk) over (order by t) as H0 from (select t, d, sum(r) over (order by t rows between current row and unbounded following) as risk from bm) where d > 0",
        **{n: BASE[n] for n in ("b0", "inc")}}
PATH = {**GRID, "pt": f"""select shock_bp, t, h0 * exp(eta) as hazard, exp(-sum(h0 * exp(eta)) over (partition by shock_bp order by t)) as S
    from (select shock_bp, {_HELD} + c1 * rate_incentive as eta from sh, bt) cross join inc"""}
PRICE = {**GRID, "pa": f"select * from (values {PATHS}) as p(path, noise_bp)",
         "mc": f"""select shock_bp, path, {K.COUPON_PCT!r}::double as coupon, market as disc, {K.FACE_AMOUNT!r}::double as face,
             {_HELD} + c1 * ({K.COUPON_PCT!r}::double - (market + noise_bp / 100e0)) as eta from sh cross join pa cross join bt""",
         **flow_sql("mc", "shock_bp, path")}


def _rows(v):
    return v.surv.where(_OK).select(
        "Duration", "Event_Prepay", (F.col("OriginalInterestRate") - F.lit(K.MARKET_PCT)).alias("rate_incentive"),
        F.col("CreditScore").cast("double").alias("FICO"), F.col("OriginalLoantoValueLTV").cast("double").alias("LTV"))


def _fit(v):
    return cox.fit(_rows(v), COVARIATES, penalizer=0.001, label="scenario")


def _increments(v, model):
    return small_table(S.monthly_increments(model.baseline_table(v.spark)))


@query("fitted_rate_response", f"""select shock_bp, rate_incentive, {_HELD} + c1 * rate_incentive as log_hazard, c1 * rate_incentive - c1 * -0.3e0 as delta, -c1 * shock_bp / 100e0 as analytic from sh, bt""",
       ("surv",), "rate_incentive log_hazard delta analytic", extra=FIT)
def _(v):
    return S.shock_response(S.shock_table(v.spark), _fit(v).beta)


@query("fitted_covariate_shock", f"""select shock_bp, n, m + move as mean_score, move as delta from (select shock_bp, n, m, b * shock_bp / 100e0 / s as move from sh,
    (select count(*) as n, avg({_SCORE}) as m, max(c3) as b, stddev_samp(OriginalLoantoValueLTV) as s from surv, bt where {_OK}))""", ("surv",), "mean_score delta", extra=FIT)
def _(v):
    x = _rows(v)
    spread = x.agg(F.stddev_samp("LTV")).first()[0]
    return S.covariate_shock(x, S.shock_table(v.spark), _fit(v).beta, "LTV", spread)


@query("fitted_survival_paths", "select * from pt", ("surv",), "hazard S", extra=PATH)
def _(v):
    model = _fit(v)
    return S.survival_paths(S.shock_table(v.spark), _increments(v, model), S.representative_eta(model.beta))


@query("fitted_cpr_sweep", f"""select i as rate_incentive_i, ri as rate_incentive, smm, 100e0 * (1 - pow(1 - smm, 12)) as cpr
    from (select i, ri, h0 * exp({_HELD} + c1 * ri) as smm from (select cast(i as int) as i, -3e0 + i * (7e0 / 79) as ri from range(0, 80) r(i)), bt, (select h0 from inc where t = {K.PEAK_AGE}))""",
       ("surv",), "rate_incentive smm cpr", extra=GRID)
def _(v):
    model = _fit(v)
    return S.cpr_sweep(v.spark, _increments(v, model), model.beta).drop("slope")


@query("fitted_scenario_summary", "select shock_bp, count(*) as n, avg(wal) as wal_mean, stddev_pop(wal) as wal_std, avg(price) as price_mean, stddev_pop(price) as price_std from fl group by 1",
       ("surv",), "wal_mean wal_std price_mean price_std", digits=5, extra=PRICE)
def _(v):
    model = _fit(v)
    h0, eta = S.hazard_array(_increments(v, model)), S.representative_eta(model.beta)
    x = S.perturbed_scenarios(S.shock_table(v.spark), S.rate_paths(v.spark)).withColumn("smm", S.smm_array(h0, eta))
    return S.scenario_summary(S.cash_flows(x, h0, eta, F.lit(K.COUPON_PCT), F.col("market"), F.lit(K.FACE_AMOUNT)))
