"""Queries over the macro panel and the loan-month panel."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import panel as P
from .registry import query

# --- macro ------------------------------------------------------------------------------
_MACRO = {
    "days": "select cast(l_shipdate as date) as day, l_discount, l_tax, l_extendedprice, year(l_shipdate) * 12 + month(l_shipdate) - 1 as m from lineitem",
    "s1": "select m, avg(l_discount) as v from days group by 1",
    "s2": "select m, avg(l_tax) as v from (select l_tax, m + 3 as m from days) group by 1",
    "s3": "select m, avg(l_extendedprice) as v from (select l_extendedprice, m - 7 as m from days) group by 1",
    "s4": "select m, avg(l_quantity) as v from (select l_quantity, year(l_shipdate) * 12 as m from lineitem) group by 1",
    "spine": "select unnest(range(lo, hi + 1)) as m from (select min(m) as lo, max(m) as hi from (select m from s1 union all select m from s2 union all select m from s3 union all select m from s4))",
    "wide": "select spine.m, s1.v as MortgageRate, s2.v as u0, s3.v as h0, s4.v as c0 from spine left join s1 using (m) left join s2 using (m) left join s3 using (m) left join s4 using (m)",
    "filled": """select m, case when m <= (select max(m) from s1) then last_value(MortgageRate ignore nulls) over w end as MortgageRate, case when m <= (select max(m) from s2) then last_value(u0 ignore nulls) over w end as Unemployment,
        case when m <= (select max(m) from s3) then last_value(h0 ignore nulls) over w end as HPI, last_value(h0 ignore nulls) over w as held, last_value(c0 ignore nulls) over w as CPI_YoY
        from wide window w as (order by m rows between unbounded preceding and current row)""",
}


@query("macro_panel", """select cast(m // 12 * 100 + m % 12 + 1 as int) as YYYYMM, MortgageRate, Unemployment, HPI, CPI_YoY,
    100e0 * (held / lag(held, 12) over (order by m) - 1) as HPI_YoY from filled""", (), "MortgageRate Unemployment HPI CPI_YoY HPI_YoY", extra=_MACRO)
def _(v):
    x = v.table("lineitem").withColumn("date", F.to_date("l_shipdate"))
    series = {
        "MortgageRate": x.select("date", F.col("l_discount").alias("MortgageRate")),
        "Unemployment": x.select(F.add_months("date", 3).alias("date"), F.col("l_tax").alias("Unemployment")),
        "HPI": x.select(F.add_months("date", -7).alias("date"), F.col("l_extendedprice").alias("HPI")),
        "CPI_YoY": x.select(F.trunc("date", "year").alias("date"), F.col("l_quantity").alias("CPI_YoY")),  # an annual series
    }
    return P.macro_panel(series)


@query("annual_macro", "select cast(yyyymm // 100 as int) as year, avg(mortgage_rate) as mortgage_rate, avg(unemployment) as unemployment, avg(hpi_yoy) as hpi_yoy from macro group by 1",
       ("macro",), "mortgage_rate unemployment hpi_yoy")
def _(v):
    return P.annual_means(v.macro, ["mortgage_rate", "unemployment", "hpi_yoy"])


@query("year_on_year", "select yyyymm, hpi, hpi_yoy from macro", ("macro",), "hpi hpi_yoy", digits=4)
def _(v):
    return v.macro.select("yyyymm", "hpi", "hpi_yoy")


# --- loan months ----------------------------------------------------------------------------
@query("panel_profile", """select vintage_year, loan_age, count(*) as n, cast(sum(prepaid_month) as bigint) as prepaid, cast(sum(default_month) as bigint) as defaulted,
    count(mortgage_rate) as with_macro, avg(mortgage_rate) as mortgage_rate, avg(unemployment) as unemployment, avg(hpi_yoy) as hpi_yoy, avg(rate_incentive) as rate_incentive from panel group by 1, 2""",
       ("panel",), "mortgage_rate unemployment hpi_yoy rate_incentive")
def _(v):
    return v.panel.groupBy("vintage_year", "loan_age").agg(
        F.count("*").alias("n"), F.sum("prepaid_month").alias("prepaid"), F.sum("default_month").alias("defaulted"),
        F.count("mortgage_rate").alias("with_macro"), *[F.avg(c).alias(c) for c in ("mortgage_rate", "unemployment", "hpi_yoy", "rate_incentive")])


@query("panel_by_loan", """select loan_id, count(*) as n, min(yyyymm) as first_month, max(yyyymm) as last_month, sum(rate_incentive) as incentive, max(FICO) as FICO,
    max(LTV) as LTV, max(DTI) as DTI, max(loan_purpose) as loan_purpose, max(occupancy) as occupancy from panel group by 1""", ("panel",), "incentive")
def _(v):
    return v.panel.groupBy("loan_id").agg(
        F.count("*").alias("n"), F.min("yyyymm").alias("first_month"), F.max("yyyymm").alias("last_month"),
        F.sum("rate_incentive").alias("incentive"), *[F.max(c).alias(c) for c in ("FICO", "LTV", "DTI", "loan_purpose", "occupancy")])


@query("current_ltv", """select loan_id, max(loan_age) as age, arg_max(hpi_cumul, loan_age) as hpi_cumul, arg_max(ELTV, loan_age) as last_eltv, avg(ELTV) as mean_eltv from feat group by 1""",
       ("feat",), "hpi_cumul last_eltv mean_eltv")
def _(v):
    return v.panel_features.groupBy("loan_id").agg(
        F.max("loan_age").alias("age"), F.max_by("hpi_cumul", "loan_age").alias("hpi_cumul"),
        F.max_by("ELTV", "loan_age").alias("last_eltv"), F.avg("ELTV").alias("mean_eltv"))


@query("cumulative_hpi", "select loan_id, max(hpi_cumul) as high, min(hpi_cumul) as low, arg_max(hpi_cumul, loan_age) as last from hpi group by 1", ("hpi",), "high low last")
def _(v):
    x = P.cumulative_hpi(v.panel.drop("hpi_cumul"))
    return x.groupBy("loan_id").agg(F.max("hpi_cumul").alias("high"), F.min("hpi_cumul").alias("low"),
                                    F.max_by("hpi_cumul", "loan_age").alias("last"))


@query("remaining_balance", """select orig_rate, loan_age, count(*) as n, avg(least(greatest((pow(1 + rm, 360) - pow(1 + rm, loan_age)) / (pow(1 + rm, 360) - 1), 0), 1)) as fraction
    from (select *, greatest(orig_rate / 1200e0, 1e-6) as rm from panel) group by 1, 2""", ("panel",), "orig_rate fraction")
def _(v):
    from ..functions.columns import remaining_fraction

    return v.panel.groupBy("orig_rate", "loan_age").agg(
        F.count("*").alias("n"), F.avg(remaining_fraction("orig_rate", "loan_age")).alias("fraction"))


@query("panel_dummies", """select sum(LP_Purchase) as LP_Purchase, sum(LP_NoCashRefi) as LP_NoCashRefi, sum(Occ_Investment) as Occ_Investment, sum(Occ_SecondHome) as Occ_SecondHome, count(DTI) as dti from feat""", ("feat",))
def _(v):
    return v.panel_features.agg(*[F.sum(c).alias(c) for c in ("LP_Purchase", "LP_NoCashRefi", "Occ_Investment", "Occ_SecondHome")], F.count("DTI").alias("dti"))


@query("counting_process_start", "select loan_age as tstart, loan_age + 1 as tstop, prepaid_month as event, count(*) as n from panel group by 1, 2, 3", ("panel",))
def _(v):
    return P.counting_process(v.panel).groupBy("tstart", "tstop", "event").agg(F.count("*").alias("n"))


@query("counting_process_end", "select loan_age - 1 as tstart, loan_age as tstop, prepaid_month as event, count(*) as n from panel where loan_age > 0 group by 1, 2, 3", ("panel",))
def _(v):
    return P.counting_process(v.panel, "end").groupBy("tstart", "tstop", "event").agg(F.count("*").alias("n"))


@query("origination_snapshot", "select loan_id, FICO, LTV, unemployment, rate_incentive from panel where loan_age = 0", ("panel",), "unemployment rate_incentive")
def _(v):
    return P.origination_snapshot(v.panel).select("loan_id", "FICO", "LTV", "unemployment", "rate_incentive")


@query("loan_exits", "select loan_id, max(loan_age) + 1 as duration, max(prepaid_month) as event_prepay from panel group by 1", ("panel",))
def _(v):
    return P.loan_exits(v.panel)


@query("first_values", "select loan_id, arg_min(mortgage_rate, loan_age) as mortgage_rate, arg_min(yyyymm, loan_age) as yyyymm from panel where mortgage_rate is not null group by 1", ("panel",), "mortgage_rate")
def _(v):
    return P.first_values(v.panel.where("mortgage_rate is not null"), ["mortgage_rate", "yyyymm"])


@query("landmark_snapshot", """select loan_id, max(loan_age + 1) as tstop, arg_max(yyyymm, loan_age) as yyyymm, arg_max(LTV, loan_age) as LTV from panel where loan_age + 1 <= 24 group by 1""", ("panel",))
def _(v):
    return P.last_rows(P.counting_process(v.panel), ["yyyymm", "LTV"], upto=24)


@query("labels_on_panel", """select event_type, count(*) as n, cast(sum(duration) as bigint) as months from panel left join sl on loan_id = loan_key group by 1""", ("panel", "sl"))
def _(v):
    lab = v.labels.select(F.col("loan_key").alias("loan_id"), "duration", "event_type")
    return v.panel.join(lab, "loan_id", "left").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("duration").alias("months"))


@query("feature_trajectories", "select vintage_year, loan_age, median(rate_incentive) as rate_incentive, median(ELTV) as ELTV from feat group by 1, 2 having count(rate_incentive) + count(ELTV) > 0", ("feat",), "rate_incentive ELTV")
def _(v):
    return P.trajectories(v.panel_features)


@query("sequences", f"""select loan_id, {K.SEQUENCE_MONTHS} as places, count(*)::int as length, sum(rate_incentive * (loan_age + 1)) as weighted, max(case when loan_age = 0 then unemployment end) as first_u,
    coalesce(max(case when loan_age = least(mx, {K.SEQUENCE_MONTHS} - 1) then ELTV end), 0) as last_eltv, sum(coalesce(ELTV, 0)) as eltv
    from (select *, max(loan_age) over (partition by loan_id) as mx from feat) where loan_age < {K.SEQUENCE_MONTHS} group by 1""", ("feat",), "weighted first_u last_eltv eltv", digits=5)
def _(v):
    s = P.padded_sequences(v.panel_features, ["ELTV", "unemployment", "rate_incentive"])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    return s.select(
        "loan_id", F.size("mask").alias("places"), F.size(F.filter("mask", lambda m: m)).alias("length"),
        total(F.transform("rate_incentive", lambda x, i: x * (i + 1))).alias("weighted"), F.element_at("unemployment", 1).alias("first_u"),
        F.element_at("ELTV", F.col("length")).alias("last_eltv"), total("ELTV").alias("eltv"))


@query("longest_sequences", """select event_type, loan_id, length, rank from (select event_type, loan_key as loan_id, duration as length,
    row_number() over (partition by event_type order by duration desc, loan_key) as rank from sl) where rank <= 2""", ("sl",))
def _(v):
    x = v.labels.select("event_type", F.col("loan_key").alias("loan_id"), F.col("duration").alias("length"))
    return P.longest_sequences(x, "event_type", 2)


_ARC = """select 'Prime FRM' as loan_id, 760e0 as FICO, 65e0 as LTV, 4e0 as orig_rate union all select 'Median FRM', 700, 80, 5.5e0 union all select 'Subprime FRM', 640, 95, 6.5e0"""


@query("archetype_paths", """select loan_id, loan_age, yyyymm, mortgage_rate, orig_rate - mortgage_rate as rate_incentive,
    least(greatest(LTV * least(greatest((pow(1 + rm, 360) - pow(1 + rm, loan_age)) / (pow(1 + rm, 360) - 1), 0), 1) / exp(sum(ln(1 + coalesce(hpi_yoy, 0) / 1200e0)) over (partition by loan_id order by loan_age)), 0), 200) as ELTV
    from (select *, orig_rate / 1200e0 as rm from arc cross join (select *, cast(row_number() over (order by yyyymm) - 1 as int) as loan_age from macro where yyyymm between 199601 and 200012))""",
       ("macro",), "mortgage_rate rate_incentive ELTV", extra={"arc": _ARC})
def _(v):
    return P.archetype_paths(v.macro, 199601, 200012).select("loan_id", "loan_age", "yyyymm", "mortgage_rate", "rate_incentive", "ELTV")


@query("forward_fill", """select yyyymm, last_value(u ignore nulls) over (order by yyyymm rows between unbounded preceding and current row) as u
    from (select yyyymm, case when yyyymm % 3 = 0 then unemployment end as u from macro)""", ("macro",), "u")
def _(v):
    x = v.macro.select("yyyymm", F.when(F.col("yyyymm") % 3 == 0, F.col("unemployment")).alias("u"))
    return P.forward_fill(x, "u", "yyyymm")
