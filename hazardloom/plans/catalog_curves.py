"""Queries over survival curves and competing-risk incidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import loans as L
from ..operators import compete, curves, lookup
from .registry import query

Z = "1.959963984540054e0"

# --- event tables and Kaplan-Meier in SQL -------------------------------------------------
ET = """select t, n_exit, d, n_exit - d as censored, cast(sum(n_exit) over (order by t rows between current row and unbounded following) as bigint) as at_risk
    from (select Duration as t, count(*) as n_exit, cast(sum(Event_Prepay) as bigint) as d from surv group by 1)"""


def km_sql(et: str, by: str = "", event: str = "d") -> str:
    part = f"partition by {by} " if by else ""
    cols = f"{by}, " if by else ""
    w = f"over ({part}order by t rows between unbounded preceding and current row)"
    whole = f"over ({part})" if by else "over ()"
    return f"""select *, case when S = 1 then 1e0 when S > 0 and S < 1 then exp(-exp(ln(-ln(S)) - {Z} * sqrt(v) / ln(S))) end as S_lower,
      case when S = 1 then 1e0 when S > 0 and S < 1 then exp(-exp(ln(-ln(S)) + {Z} * sqrt(v) / ln(S))) end as S_upper from (
      select {cols}t, n_exit, {event} as d, at_risk, case when min(at_risk - {event}) {w} <= 0 then 0e0
        else exp(sum(case when at_risk > {event} then ln(1 - {event}::double / at_risk) else 0 end) {w}) end as S,
        sum(case when at_risk > {event} then {event}::double / (at_risk::double * (at_risk - {event})) else 0 end) {w} as v,
        cast(sum(n_exit) {whole} as bigint) as n_in_stratum, cast(sum({event}) {whole} as bigint) as n_events from {et})"""


STRATA_ET = """select variable, stratum, t, count(*) as n_exit, cast(sum(e) as bigint) as d,
    cast(sum(count(*)) over (partition by variable, stratum order by t rows between current row and unbounded following) as bigint) as at_risk from (
    select 'FICO' as variable, FICO_bucket as stratum, Duration as t, Event_Prepay as e from surv where FICO_bucket <> 'Missing' union all
    select 'LTV', LTV_bucket, Duration, Event_Prepay from surv where LTV_bucket <> 'Missing' union all
    select 'Vintage', VintageBucket, Duration, Event_Prepay from surv union all
    select 'LoanPurpose', LoanPurpose, Duration, Event_Prepay from surv where LoanPurpose is not null) group by 1, 2, 3"""
KM = {"et": ET, "km": km_sql("et")}
SKM = {"set0": STRATA_ET, "skm": f"select * from ({km_sql('set0', 'variable, stratum')}) where n_in_stratum >= 100"}
GRID = """select g.t, coalesce(k.S, 1e0) as S, case when k.t is null then 1e0 else k.S_lower end as S_lower, case when k.t is null then 1e0 else k.S_upper end as S_upper
    from grid360 g left join km k on k.t = (select max(t) from km where km.t <= g.t)"""


def _et(v):
    return curves.overall_event_table(v.surv)


@query("event_table", "select * from et", ("surv",), extra={"et": ET})
def _(v):
    return _et(v)


@query("km_at_events", "select t, n_exit, d, at_risk, S, S_lower, S_upper, n_in_stratum, n_events from km", ("surv",), "S S_lower S_upper", extra=KM)
def _(v):
    return curves.kaplan_meier(_et(v)).drop("censored")


@query("km_overall", "select * from kg", ("surv", "grid360"), "S S_lower S_upper", extra={**KM, "kg": GRID})
def _(v):
    return curves.on_grid(curves.kaplan_meier(_et(v)))


@query("km_median", "select max(n_in_stratum) as n, max(n_events) as n_events, min(case when S <= 0.5 then t end) as median_survival_time, max(n_events) / max(n_in_stratum)::double as prepay_rate from km",
       ("surv",), "prepay_rate", extra=KM)
def _(v):
    return curves.median_survival(curves.kaplan_meier(_et(v)))


@query("km_key_months", "select t, S, 100e0 * (1 - S) as pct_prepaid from kg where t in (12, 24, 36, 60, 84, 120, 180, 240)", ("surv", "grid360"), "S pct_prepaid", extra={**KM, "kg": GRID})
def _(v):
    return curves.key_months(curves.on_grid(curves.kaplan_meier(_et(v))))


HAZ = """select t, 1 - S / greatest(coalesce(lag(S) over (order by t), 1), 1e-10) as h_discrete, -ln(greatest(S, 1e-10)) as cum_hazard_km, cum_hazard_na from (
    select g.t, g.S, coalesce(n.H, 0) as cum_hazard_na from kg g left join na n on n.t = (select max(t) from na where na.t <= g.t))"""
NA = "select t, sum(d::double / at_risk) over (order by t rows between unbounded preceding and current row) as H from et"
NAS = """select t, sum(inc) over (order by t rows between unbounded preceding and current row) as H from (
    select e.t, list_sum(list_transform(range(0, e.d), lambda k: 1e0 / (e.at_risk - k))) as inc0, coalesce(inc0, 0) as inc from et e)"""
HALL = {**KM, "kg": GRID, "na": NA, "hz": HAZ}
HSQL = "select t, h_discrete, avg(h_discrete) over (order by t rows between 3 preceding and 2 following) as h_smoothed, cum_hazard_km, cum_hazard_na from hz"


@query("hazard_overall", HSQL, ("surv", "grid360"), "h_discrete h_smoothed cum_hazard_km cum_hazard_na", extra=HALL)
def _(v):
    return curves.hazard_table(_et(v))


@query("hazard_annualised", "select t, h_discrete, 100e0 * (1 - pow(1 - h_discrete, 12)) as annual_pct from hz where t in (6, 12, 24, 36, 60, 84, 120)", ("surv", "grid360"), "h_discrete annual_pct", extra=HALL)
def _(v):
    return curves.annualised_hazard(curves.hazard_table(_et(v)), [6, 12, 24, 36, 60, 84, 120])


@query("hazard_gap", "select max(abs(cum_hazard_km - cum_hazard_na)) as max_gap, avg(abs(cum_hazard_km - cum_hazard_na)) as mean_gap from hz", ("surv", "grid360"), "max_gap mean_gap", extra=HALL)
def _(v):
    return curves.hazard_gap(curves.hazard_table(_et(v)))


@query("nelson_aalen_split", "select t, H as cum_hazard from nas", ("surv",), "cum_hazard", extra={"et": ET, "nas": NAS})
def _(v):
    return curves.nelson_aalen(_et(v), ties="split").select("t", "cum_hazard")


@query("nelson_aalen_linear", """select g.t, case when a.t is null then 0e0 when b.t is null then a.H when b.t = a.t then a.H else a.H + (b.H - a.H) * (g.t - a.t) / (b.t - a.t) end as cum_hazard
    from grid360 g left join n0 a on a.t = (select max(t) from n0 where n0.t <= g.t) left join n0 b on b.t = (select min(t) from n0 where n0.t >= g.t)""",
       ("surv", "grid360"), "cum_hazard", extra={"et": ET, "na": NA, "n0": "select 0 as t, 0e0 as H union all select t, H from na"})
def _(v):
    na = curves.nelson_aalen(_et(v)).select("t", "cum_hazard")
    origin = v.spark.range(1).select(F.lit(0).alias("t"), F.lit(0.0).alias("cum_hazard"))
    return lookup.linear(na.unionByName(origin), lookup.month_grid(na, [], K.MONTH_GRID), "cum_hazard")


@query("nearest_month", "select w.h as at, k.t as t_used, k.S from (select unnest([1, 13, 14, 37, 120]) as h) w join k3 k on k.t = (select arg_min(t, abs(t - w.h) * 100000 + t) from k3)",
       ("surv",), "S", extra={**KM, "k3": "select t, S from km"})
def _(v):
    return lookup.nearest(curves.kaplan_meier(_et(v)), [1, 13, 14, 37, 120], "S")


def _skm(v):
    return curves.stratified_km(v.surv)


@query("km_by_stratum", """select s.variable, s.stratum, n_in_stratum, n_events, g.t, coalesce(k.S, 1e0) as S, case when k.t is null then 1e0 else k.S_lower end as S_lower,
    case when k.t is null then 1e0 else k.S_upper end as S_upper from (select distinct variable, stratum, n_in_stratum, n_events from skm) s cross join grid360 g
    left join (select variable, stratum, t, S, S_lower, S_upper from skm) k on k.variable = s.variable and k.stratum = s.stratum and k.t = (select max(t) from skm x where x.variable = s.variable and x.stratum = s.stratum and x.t <= g.t)""",
       ("surv", "grid360"), "S S_lower S_upper", extra=SKM)
def _(v):
    return curves.on_grid(_skm(v), ["variable", "stratum"])


@query("stratum_medians", """select variable, stratum, max(n_in_stratum) as n, max(n_events) as n_events, min(case when S <= 0.5 then t end) as median_survival_time,
    max(n_events) / max(n_in_stratum)::double as prepay_rate from skm group by 1, 2""", ("surv",), "prepay_rate", extra=SKM)
def _(v):
    return curves.median_survival(_skm(v), ["variable", "stratum"])


@query("loglog_curves", """select case variable when 'FICO' then 'FICO_bucket' when 'LTV' then 'LTV_bucket' else variable end as stratum_var,
    case variable when 'FICO' then 'FICO Score' when 'LTV' then 'Original LTV' else 'Loan Purpose' end as stratum_label, stratum, n_in_stratum, t, ln(t + 1) as log_t, S, ln(-ln(S)) as log_log_S
    from skm where S > 0 and S < 1 and ((variable = 'FICO' and stratum in ('<620', '660-699', '740-779', '780+')) or (variable = 'LTV' and stratum in ('<=60', '71-80', '81-90', '96+'))
    or (variable = 'LoanPurpose' and stratum in ('P', 'N', 'C')))""", ("surv",), "log_t S log_log_S", extra=SKM)
def _(v):
    return curves.loglog_curves(v.surv)


# --- competing risks --------------------------------------------------------------------------
CET = """select duration as t, count(*) as n_exit, count(*) filter (event_type = 1) as d1, count(*) filter (event_type = 2) as d2,
    cast(sum(count(*)) over (order by duration rows between current row and unbounded following) as bigint) as at_risk from sl group by 1"""


def aj_sql(et: str, by: str = "") -> str:
    part, cols = (f"partition by {by} ", f"{by}, ") if by else ("", "")
    w = f"over ({part}order by t rows between unbounded preceding and current row)"
    return f"""select *, sum(prev * d1 / at_risk) {w} as cif1, sum(prev * d2 / at_risk) {w} as cif2 from (
      select *, coalesce(lag(S) over ({part}order by t), 1e0) as prev from (
      select {cols}t, n_exit, d1, d2, at_risk, case when min(at_risk - d1 - d2) {w} <= 0 then 0e0 else
        exp(sum(case when at_risk > d1 + d2 then ln(1 - (d1 + d2)::double / at_risk) else 0 end) {w}) end as S from {et}))"""


AJ = {"cet": CET, "aj": aj_sql("cet")}


def _cet(v):
    return compete.cause_table(v.labels)


@query("cause_table", "select * from cet", ("sl",), extra={"cet": CET})
def _(v):
    return _cet(v)


@query("aalen_johansen", "select t, n_exit, d1, d2, at_risk, S, cif1, cif2 from aj", ("sl",), "S cif1 cif2", extra=AJ)
def _(v):
    return compete.aalen_johansen(_cet(v))


@query("partition_identity", "select max(abs(cif1 + cif2 + S - 1)) as max_gap, count(*) as n_months from aj", ("sl",), "max_gap", extra=AJ)
def _(v):
    return compete.partition_check(compete.aalen_johansen(_cet(v)))


BIAS = {**AJ, "k1": km_sql("cet", event="d1"), "bias": "select k1.t, 1 - k1.S as km, cif1 as aj, 1 - k1.S - cif1 as bias from k1 join aj on k1.t = aj.t"}


@query("km_aj_bias", "select * from bias", ("sl",), "km aj bias", extra=BIAS)
def _(v):
    return compete.km_bias(_cet(v))


@query("km_aj_bias_horizons", "select h as horizon, km, aj, bias, 100e0 * bias as bias_pp from (select unnest([12, 24, 60, 120, 240]) as h) join bias on t = (select max(t) from bias where t <= h)",
       ("sl",), "km aj bias bias_pp", extra=BIAS)
def _(v):
    return compete.bias_at(compete.km_bias(_cet(v)), [12, 24, 60, 120, 240])


SCIF = {"cs": """select variable, stratum, t, count(*) as n_exit, count(*) filter (event_type = 1) as d1, count(*) filter (event_type = 2) as d2,
    cast(sum(count(*)) over (partition by variable, stratum order by t rows between current row and unbounded following) as bigint) as at_risk from (
    select 'fico' as variable, case when CreditScore <= 680 then 'FICO < 680' when CreditScore <= 740 then 'FICO 680–740' when CreditScore <= 850 then 'FICO > 740' end as stratum, duration as t, event_type from sl union all
    select 'ltv', case when OriginalLoantoValueLTV <= 80 then 'LTV ≤ 80' when OriginalLoantoValueLTV <= 100 then 'LTV > 80' end, duration, event_type from sl union all
    select 'vintage', case when VintageYear > 1998 and VintageYear <= 2007 then '1999–2007' end, duration, event_type from sl) where stratum is not null group by 1, 2, 3""",
        "saj": aj_sql("cs", "variable, stratum")}


@query("stratified_incidence", """select variable, stratum, cause, cif, n_events, t, at_risk, n from (
    select variable, stratum, t, at_risk, sum(n_exit) over w::bigint as n, max(case when at_risk >= 500 then t end) over w as last_t,
      unnest([1, 2]) as cause, unnest([cif1, cif2]) as cif, unnest([sum(d1) over w, sum(d2) over w])::bigint as n_events from saj window w as (partition by variable, stratum))
    where n >= 50 and n_events >= 10 and (last_t is null or t <= last_t)""", ("sl",), "cif", extra=SCIF)
def _(v):
    x = L.add_risk_groups(v.labels)
    return compete.stratified_incidence(x, {"fico": "fico_grp", "ltv": "ltv_grp", "vintage": "vintage_grp"})


@query("censoring_survival", "select t, S as G from g", ("sl",), "G", extra={
    "gt": """select duration as t, count(*) as n_exit, count(*) filter (event_type = 0) as d, cast(sum(count(*)) over (order by duration rows between current row and unbounded following) as bigint) as at_risk from sl group by 1""",
    "g": km_sql("gt")})
def _(v):
    return curves.censoring_survival(v.labels, "duration", (F.col("event_type") > 0).cast("int"))
