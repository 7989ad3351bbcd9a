"""Queries over ranking, calibration and concordance metrics and the report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import metrics as M
from ..operators import panel as P
from ..operators import reports
from . import views as V
from .registry import query

MODELS = ["Rate", "Score"]
KEEP = ["loan_key", "VintageYear", "FICO_bucket"]


def _long(v):
    return M.predictions_long(v.scores, MODELS, V.HORIZONS, KEEP)


def metrics_sql(rows: str, by: str) -> str:
    """Metrics per group with the rank-sum form of AUC."""
    return f"""select {by}, case when p > 0 and n > p then (r - p * (p + 1) / 2e0) / (p * (n - p)) end as auc,
        case when p > 0 and n > p then brier end as brier, case when p > 0 and n > p then ll end as log_loss, case when p > 0 and n > p then acc end as accuracy, n, p as n_events from (
        select {by}, count(*) as n, cast(sum(y) as bigint) as p, sum(case when y = 1 then mid else 0 end) as r, avg(pow(pc - y, 2)) as brier,
        avg(case when y = 1 then -ln(pc) else -ln(1 - pc) end) as ll, avg(case when (pc >= 0.5) = (y = 1) then 1e0 else 0e0 end) as acc from (
        select *, least(greatest(p, 1e-7), 1 - 1e-7) as pc, rank() over (partition by {by} order by p) + (count(*) over (partition by {by}, p) - 1) / 2e0 as mid from {rows}) group by {by})"""


FL = "auc brier log_loss accuracy"
SCORED = {"lp": "select * from long where p is not null"}


@query("model_metrics", metrics_sql("lp", "model, horizon"), ("long",), FL, extra=SCORED)
def _(v):
    return M.binary_metrics(_long(v), ["model", "horizon"])


STRAT = {**SCORED, "lall": """select model, horizon, 'all' as stratum_type, 'all' as stratum_value, y, p from long union all
    select model, horizon, 'vintage', cast(VintageYear as varchar), y, p from long union all select model, horizon, 'FICO', FICO_bucket, y, p from long where FICO_bucket <> 'Missing'""",
         "lkeep": "select model, horizon, stratum_type, stratum_value from lall group by 1, 2, 3, 4 having count(*) >= 100 or stratum_type = 'all'",
         "ls": "select lall.* from lall semi join lkeep using (model, horizon, stratum_type, stratum_value) where p is not null",
         "ms": metrics_sql("ls", "model, horizon, stratum_type, stratum_value")}


def _strat(v):
    return M.stratified_metrics(_long(v), {"vintage": "VintageYear", "FICO": "FICO_bucket"}, allowed={"FICO": K.FICO_LABELS})


@query("stratified_metrics", "select * from ms", ("long",), FL, extra=STRAT)
def _(v):
    return _strat(v)


@query("grouping_set_errors", """select model, horizon, VintageYear, cast(grouping(model, horizon, VintageYear) as int) as level, count(*) as n, avg(pow(least(greatest(p, 1e-7), 1 - 1e-7) - y, 2)) as brier,
    avg(case when (p >= 0.5) = (y = 1) then 1e0 else 0e0 end) as accuracy from lp group by grouping sets ((model, horizon), (model, horizon, VintageYear), (model))""", ("long",), "brier accuracy", extra=SCORED)
def _(v):
    return M.pooled_errors(_long(v))


@query("metric_pivot", "select model, " + ", ".join(f"max(case when horizon = {h} then auc end) as auc_T{h}" for h in V.HORIZONS) + " from ms where stratum_type = 'all' group by 1", ("long",),
       " ".join(f"auc_T{h}" for h in V.HORIZONS), extra=STRAT)
def _(v):
    return reports.metric_pivot(_strat(v), "auc", V.HORIZONS)


@query("metrics_pivot", "select model, " + ", ".join(f"max(case when horizon = {h} then {n} end) as {n}_T{h}" for n in ("brier", "log_loss") for h in V.HORIZONS) + " from ms where stratum_type = 'all' group by 1", ("long",),
       " ".join(f"{n}_T{h}" for n in ("brier", "log_loss") for h in V.HORIZONS), extra=STRAT)
def _(v):
    return reports.metrics_pivot(_strat(v), ["brier", "log_loss"], V.HORIZONS)


@query("ablation", """select a.horizon, a.auc as auc_deep, b.auc as auc_linear, a.auc - b.auc as auc_delta, a.brier as brier_deep, b.brier as brier_linear, a.brier - b.brier as brier_delta,
    a.log_loss as logloss_deep, b.log_loss as logloss_linear, a.log_loss - b.log_loss as logloss_delta, a.n, a.n_events from ms a join ms b using (horizon)
    where a.stratum_type = 'all' and b.stratum_type = 'all' and a.model = 'Score' and b.model = 'Rate'""", ("long",),
       "auc_deep auc_linear auc_delta brier_deep brier_linear brier_delta logloss_deep logloss_linear logloss_delta", extra=STRAT)
def _(v):
    return reports.ablation(_strat(v), "Score", "Rate")


@query("metric_by_vintage", "select 0 as model_rank, model, horizon, stratum_value, auc as value, n from ms where stratum_type = 'vintage'", ("long",), "value", extra=STRAT)
def _(v):
    return reports.metric_slice(_strat(v), "vintage", "auc")


@query("metric_by_fico", "select 0 as model_rank, model, horizon, stratum_value, brier as value, n from ms where stratum_type = 'FICO'", ("long",), "value", extra=STRAT)
def _(v):
    return reports.metric_slice(_strat(v), "FICO", "brier")


@query("auc_order", "select horizon, model, auc, cast(row_number() over (partition by horizon order by auc desc, model) as int) as position from ms where stratum_type = 'all'", ("long",), "auc", extra=STRAT)
def _(v):
    return reports.auc_order(_strat(v))


@query("roc_points", """select model, horizon, p as threshold, sum(neg) over w / sum(neg) over (partition by model, horizon) as fpr, sum(pos) over w / sum(pos) over (partition by model, horizon) as tpr
    from (select model, horizon, p, count(*) filter (y = 1) as pos, count(*) filter (y = 0) as neg from lp group by 1, 2, 3) window w as (partition by model, horizon order by p desc rows between unbounded preceding and current row)""",
       ("long",), "threshold fpr tpr", extra=SCORED)
def _(v):
    return M.roc_points(_long(v), ["model", "horizon"])


@query("calibration", """select model, horizon, greatest(len(list_filter(edges, lambda e: e < p)) - 1, 0)::int as bin, avg(p) as pred_mean, avg(y) as observed_rate, min(p) as pred_lower, max(p) as pred_upper, count(*) as n_in_bin
    from lp join (select model, horizon, list_distinct([quantile_cont(p, 0), quantile_cont(p, 0.1), quantile_cont(p, 0.2), quantile_cont(p, 0.3), quantile_cont(p, 0.4), quantile_cont(p, 0.5), quantile_cont(p, 0.6), quantile_cont(p, 0.7), quantile_cont(p, 0.8), quantile_cont(p, 0.9), quantile_cont(p, 1)]) as edges
    from lp group by 1, 2) using (model, horizon) group by 1, 2, 3""", ("long",), "pred_mean observed_rate pred_lower pred_upper", extra=SCORED)
def _(v):
    return M.calibration(_long(v))


@query("top_decile_lift", """select model, horizon, baseline, rate as top_decile_rate, rate / baseline as lift, n_top from (
    select model, horizon, max(b) as baseline, avg(y) as rate, count(*) as n_top from lp join (select model, horizon, quantile_cont(p, 0.9) as cut from lp group by 1, 2) using (model, horizon)
    join (select model, horizon, avg(y) as b from long group by 1, 2) using (model, horizon) where p >= cut group by 1, 2)""", ("long",), "baseline top_decile_rate lift", extra=SCORED)
def _(v):
    return M.top_share_lift(_long(v))


@query("score_histogram", """select model, horizon, y, least(1 + floor((p - lo) * 40 / (hi - lo)), 40)::int as bin, count(*) as n, count(*) / (max(c) * max(hi - lo) / 40e0) as density from lp
    join (select model, horizon, y, min(p) as lo, max(p) as hi, count(*) as c from lp group by 1, 2, 3) using (model, horizon, y) group by 1, 2, 3, 4""", ("long",), "density", digits=4, extra=SCORED)
def _(v):
    return M.score_histogram(_long(v))


@query("subset_metrics", metrics_sql("(select * from lp where VintageYear >= 2000)", "model, horizon"), ("long",), FL, extra=SCORED)
def _(v):
    ids = v.surv.where("VintageYear >= 2000")
    return M.subset_metrics(_long(v), ids, "loan_key", 50)


# --- concordance ------------------------------------------------------------------------------
def pairs_sql(groups: str, by: str = "") -> str:
    cond = " and ".join(f"i.{c} = j.{c}" for c in by.split(", ")) + " and " if by else ""
    sel = f"i.{by}, " if by else ""
    tail = f"group by i.{by}" if by else ""
    return f"""select {sel}sum(case when i.s > j.s then i.c * j.c when i.s = j.s then 0.5e0 * i.c * j.c else 0 end)::double as concordant, sum(i.c * j.c)::double as pairs
        from {groups} i join {groups} j on {cond}i.e = 1 and (i.t < j.t or (i.t = j.t and j.e = 0)) {tail}"""


@query("concordance", "select *, concordant / pairs as c_index from pr", ("surv",), "concordant pairs c_index", digits=5, extra={
    "cg": "select Duration as t, Event_Prepay as e, OriginalInterestRate as s, count(*) as c from surv group by 1, 2, 3", "pr": pairs_sql("cg")})
def _(v):
    return M.concordance(v.surv, "Duration", "Event_Prepay", "OriginalInterestRate")


@query("concordance_flipped", "select *, concordant / pairs as c_index from pr", ("surv",), "concordant pairs c_index", digits=5, extra={
    "cg": "select Duration as t, Event_Prepay as e, -CreditScore as s, count(*) as c from surv where CreditScore is not null group by 1, 2, 3", "pr": pairs_sql("cg")})
def _(v):
    return M.concordance(v.surv, "Duration", "Event_Prepay", "CreditScore", higher_is_riskier=False)


_LM = "select horizon, n, n_events, case when n >= {a} and n_events >= 2 then concordant / pairs end as c_index from (select horizon, sum(c)::bigint as n, (sum(c) filter (e = 1))::bigint as n_events from cg group by 1) left join pr using (horizon)"


@query("landmark_static", _LM.format(a=0), ("surv",), "c_index", extra={
    "cg": " union all ".join(f"select {h} as horizon, least(Duration, {h}) as t, case when Prepaid and Duration <= {h} then 1 else 0 end as e, OriginalInterestRate as s, count(*) as c from surv group by 1, 2, 3, 4" for h in V.HORIZONS),
    "pr": pairs_sql("cg", "horizon")})
def _(v):
    return M.landmark_concordance(v.surv, V.HORIZONS, "Duration", "Event_Prepay", "OriginalInterestRate")


@query("landmark_dynamic", _LM.format(a=10), ("panel",), "c_index", extra={
    "dur": "select loan_id, max(loan_age) + 1 as d, max(prepaid_month) as ev from panel group by 1",
    "cg": " union all ".join(f"""select {h} as horizon, least(d, {h}) as t, case when ev = 1 and d <= {h} then 1 else 0 end as e, s, count(*) as c from (
        select loan_id, arg_max(r, loan_age) as s from (select loan_id, loan_age, round(rate_incentive, 1) as r from panel where loan_age + 1 <= {h} and rate_incentive is not null) group by 1)
        join dur using (loan_id) group by 1, 2, 3, 4""" for h in V.HORIZONS), "pr": pairs_sql("cg", "horizon")})
def _(v):
    x = P.counting_process(v.panel).withColumn("risk", F.round("rate_incentive", 1))
    return M.dynamic_concordance(x, V.HORIZONS, "risk")


@query("horizon_incidence_metrics", "select horizon, n, n_events, case when n_events >= 2 and n - n_events >= 2 then auc end as auc, brier from ("
       + metrics_sql("hi", "horizon") + ")", ("sl",), "auc brier", extra={
           "hi": " union all ".join(f"select {h} as horizon, case when event_type = 1 and duration <= {h} then 1 else 0 end as y, round(0.1e0 * (OriginalInterestRate - 2.5e0) + {h / 200!r}::double, 4) as p from sl" for h in V.HORIZONS)})
def _(v):
    x = v.labels.withColumns({f"cif_{h}": F.round(F.lit(0.1) * (F.col("OriginalInterestRate") - F.lit(2.5)) + F.lit(h / 200), 4) for h in V.HORIZONS})
    return M.horizon_incidence_metrics(x, V.HORIZONS, "duration", "event_type", 1)
