"""Queries over cleaning, derived columns, joins, summaries, sampling and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..functions import loans as L
from ..operators import encode, ordered, reports, split, targets, terminal
from ..sources import tables
from . import views as V
from .registry import query

ID = "loan_key"


# --- cleaning and derived columns -----------------------------------------------------
@query("clean_numeric_sentinels", """select loan_key,
    case when CreditScore >= 9999 then null else CreditScore end as CreditScore,
    case when OriginalLoantoValueLTV >= 999 then null else OriginalLoantoValueLTV end as OriginalLoantoValueLTV,
    case when OriginalDebttoIncomeRatio >= 999 then null else OriginalDebttoIncomeRatio end as OriginalDebttoIncomeRatio,
    case when MortgageInsurancePercentage >= 999 then null else MortgageInsurancePercentage end as MortgageInsurancePercentage,
    case when NumberofBorrowers >= 99 then null else NumberofBorrowers end as NumberofBorrowers from loans""", ("loans",))
def _(v):
    cols = [c for c in K.NUMERIC_SENTINELS if c in v.loans.columns]
    return L.clean_numeric_sentinels(v.loans).select(ID, *cols)


@query("clean_string_sentinels", """select loan_key, nullif(Channel, '9') as Channel,
    nullif(FirstTimeHomebuyerFlag, '9') as FirstTimeHomebuyerFlag, nullif(OccupancyStatus, '9') as OccupancyStatus,
    nullif(LoanPurpose, '9') as LoanPurpose, nullif(PropertyType, '99') as PropertyType from loans""", ("loans",))
def _(v):
    return L.clean_string_sentinels(v.loans).select(ID, *K.STRING_SENTINELS)


@query("term_filter", "select loan_key, OriginalLoanTerm from loans where OriginalLoanTerm = 360", ("loans",))
def _(v):
    return L.term_filter(v.loans).select(ID, "OriginalLoanTerm")


@query("vintage_from_key", "select loan_key, VintageYear, VintageQuarter from clean", ("clean",))
def _(v):
    return v.origination.select(ID, "VintageYear", "VintageQuarter")


@query("fico_bucket", "select FICO_bucket, count(*) as n, min(CreditScore) as low, max(CreditScore) as high from orig group by 1", ("orig",))
def _(v):
    return v.origination.groupBy("FICO_bucket").agg(
        F.count("*").alias("n"), F.min("CreditScore").alias("low"), F.max("CreditScore").alias("high"))


@query("ltv_bucket", "select loan_key, LTV_bucket from orig", ("orig",))
def _(v):
    return v.origination.select(ID, "LTV_bucket")


@query("vintage_bucket", "select loan_key, VintageBucket from orig", ("orig",))
def _(v):
    return v.origination.select(ID, "VintageBucket")


@query("interval_groups", """select loan_key,
    case when CreditScore > 0 and CreditScore <= 680 then 'FICO < 680' when CreditScore > 680 and CreditScore <= 740 then 'FICO 680–740'
         when CreditScore > 740 and CreditScore <= 850 then 'FICO > 740' end as fico_grp,
    case when OriginalLoantoValueLTV > 0 and OriginalLoantoValueLTV <= 80 then 'LTV ≤ 80'
         when OriginalLoantoValueLTV > 80 and OriginalLoantoValueLTV <= 100 then 'LTV > 80' end as ltv_grp,
    case when VintageYear > 1998 and VintageYear <= 2007 then '1999–2007' when VintageYear > 2007 and VintageYear <= 2015 then '2008–2015'
         when VintageYear > 2015 and VintageYear <= 2025 then '2016–2025' end as vintage_grp from orig""", ("orig",))
def _(v):
    return L.add_risk_groups(v.origination).select(ID, "fico_grp", "ltv_grp", "vintage_grp")


@query("equal_width_trend", """select bin, count(*) as n, avg(x) as mean_x, avg(y) as mean_y from (
    select Duration as x, RateChange as y, greatest(cast(ceil((Duration - lo) * 40e0 / (hi - lo)) as int), 1) as bin
    from surv, (select min(Duration) as lo, max(Duration) as hi from surv)) group by bin""", ("surv",), "mean_x mean_y")
def _(v):
    s = v.surv.groupBy("Duration").agg(F.count("*").alias("c"), F.sum("RateChange").alias("s"))
    span = s.agg(F.min("Duration").alias("lo"), F.max("Duration").alias("hi"))  # one row
    x = s.crossJoin(span).withColumn("bin", C.equal_width_right("Duration", "lo", "hi", 40))
    return x.groupBy("bin").agg(
        F.sum("c").alias("n"), (F.sum(F.col("Duration") * F.col("c")) / F.sum("c")).alias("mean_x"),
        (F.sum("s") / F.sum("c")).alias("mean_y"))


@query("event_flags", """select loan_key, Prepaid, CreditTerminated, Terminated, Event_Prepay from surv""", ("surv",))
def _(v):
    return v.surv.select(ID, "Prepaid", "CreditTerminated", "Terminated", "Event_Prepay")


@query("duration_floor", """select loan_key, greatest(LoanAge - 5, 1) as d from perf""", ("perf",))
def _(v):
    # shifted by five so that zero and negative ages occur
    return L.floor_duration(v.perf.select(ID, (F.col("LoanAge") - 5).alias("d")), "d")


@query("rate_change", "select loan_key, RateChange from surv", ("surv",), "RateChange")
def _(v):
    return v.surv.select(ID, "RateChange")


@query("event_label", """select loan_key, event_type, case event_type when 1 then 'Prepaid' when 2 then 'Defaulted' else 'Censored' end as event,
    case when prepaid = 1 or defaulted = 1 then 1 else 0 end as any_event from sl""", ("sl",))
def _(v):
    return v.labels.select(ID, "event_type", L.event_name().alias("event"), L.any_event().alias("any_event"))


@query("complete_cases", """select loan_key, CreditScore, OriginalLoantoValueLTV, OriginalDebttoIncomeRatio from surv
    where CreditScore is not null and OriginalLoantoValueLTV is not null and OriginalDebttoIncomeRatio is not null and Duration > 0""", ("surv",))
def _(v):
    cols = ["CreditScore", "OriginalLoantoValueLTV", "OriginalDebttoIncomeRatio"]
    return L.complete_cases(v.surv.where("Duration > 0"), cols).select(ID, *cols)


@query("tolerant_cast", """select loan_key, tie_breaker, MonthlyReportingPeriod, try_cast(CurrentLoanDelinquencyStatus as smallint) as dq,
    try_cast(ZeroBalanceCode as smallint) as zbc from perf""", ("perf",))
def _(v):
    return v.perf.select(ID, "tie_breaker", "MonthlyReportingPeriod",
                         C.small_int("CurrentLoanDelinquencyStatus").alias("dq"), C.small_int("ZeroBalanceCode").alias("zbc"))


@query("clip_and_replace", """select loan_key, least(greatest(dq0, 0), 12) as dq, nullif(OriginalDebttoIncomeRatio, 999) as dti,
    least(greatest(OriginalInterestRate / 1200e0, 3e-3), 5e-3) as r from
    (select loan_key, OriginalDebttoIncomeRatio, OriginalInterestRate, OriginalLoantoValueLTV - 50 as dq0 from loans)""", ("loans",), "r")
def _(v):
    x = L.replace_value(v.loans, "OriginalDebttoIncomeRatio", 999)
    return x.select(ID, C.clip(F.col("OriginalLoantoValueLTV") - 50, 0, 12).alias("dq"),
                    F.col("OriginalDebttoIncomeRatio").alias("dti"),
                    C.clip(F.col("OriginalInterestRate") / 1200.0, 3e-3, 5e-3).alias("r"))


_DUMMY = """case when LoanPurpose = 'P' then 1 else 0 end as is_Purchase, case when LoanPurpose = 'C' then 1 else 0 end as is_CashOutRefi,
    case when OccupancyStatus = 'I' then 1 else 0 end as is_Investment, case when OccupancyStatus = 'S' then 1 else 0 end as is_SecondHome,
    case when FirstTimeHomebuyerFlag = 'Y' then 1 else 0 end as is_FirstTimeBuyer, case when PropertyType = 'CO' then 1 else 0 end as is_Condo,
    case when PropertyType = 'PU' then 1 else 0 end as is_PUD, case when coalesce(MortgageInsurancePercentage, 0) > 0 then 1 else 0 end as has_MI,
    case when coalesce(NumberofBorrowers, 1) > 1 then 1 else 0 end as is_MultiBorrower"""


@query("cox_dummies", f"select loan_key, {_DUMMY} from orig", ("orig",))
def _(v):
    return L.cox_dummies(v.origination).select(ID, *K.COX_COVARIATES[6:])


@query("friendly_labels", """select coalesce(case LoanPurpose when 'P' then 'Purchase' when 'N' then 'Refi (No Cash-Out)' when 'C' then 'Refi (Cash-Out)' end, LoanPurpose) as purpose,
    concat('Vintage ', cast(VintageYear as varchar)) as cohort, count(*) as n from orig group by 1, 2""", ("orig",))
def _(v):
    return v.origination.groupBy(C.lookup("LoanPurpose", K.PURPOSE_LABELS).alias("purpose"),
                                 F.format_string("Vintage %d", F.col("VintageYear")).alias("cohort")).agg(F.count("*").alias("n"))


@query("calendar_functions", """select FirstPaymentDate, make_date(FirstPaymentDate // 100, FirstPaymentDate % 100, 1) as first_day,
    cast((2001 * 12 + 12) - ((FirstPaymentDate // 100) * 12 + FirstPaymentDate % 100) as int) as months_left, count(*) as n from orig group by 1, 2, 3""", ("orig",))
def _(v):
    left = C.month_number(F.lit(V.CUTOFF)) - C.month_number("FirstPaymentDate")
    return v.origination.groupBy("FirstPaymentDate", C.yyyymm_date("FirstPaymentDate").alias("first_day"),
                                 left.cast("int").alias("months_left")).agg(F.count("*").alias("n"))


@query("math_functions", """select loan_key, ln(p / (1 - p)) as logit, 1 / (1 + exp(-p)) as sigmoid, 1 - pow(1 - p / 10, 12) as annual,
    sin(p) as s, cos(p) as c, abs(p - 0.5e0) as a, round(p, 2) as r2 from (select loan_key, OriginalInterestRate / 10e0 as p from orig)""", ("orig",), "logit sigmoid annual s c a r2")
def _(v):
    x = v.origination.select(ID, (F.col("OriginalInterestRate") / 10.0).alias("p"))
    return x.select(ID, C.logit("p").alias("logit"), C.sigmoid("p").alias("sigmoid"), C.annualised(F.col("p") / 10).alias("annual"),
                    F.sin("p").alias("s"), F.cos("p").alias("c"), F.abs(F.col("p") - 0.5).alias("a"), F.round("p", 2).alias("r2"))


@query("significance_markers", """select loan_key, case when p < 0.001 then '***' when p < 0.01 then '**' when p < 0.05 then '*' else '' end as sig,
    case when hr > 1 then '↑ faster prepayment' else '↓ slower prepayment' end as direction from
    (select loan_key, pow((OriginalInterestRate - 2.9e0) / 4.5e0, 6) as p, OriginalInterestRate / 5e0 as hr from orig)""", ("orig",))
def _(v):
    x = v.origination.select(ID, F.pow((F.col("OriginalInterestRate") - 2.9) / 4.5, F.lit(6)).alias("p"),
                             (F.col("OriginalInterestRate") / 5.0).alias("hr"))
    return x.select(ID, C.significance("p").alias("sig"), C.direction("hr").alias("direction"))


# --- terminal records, survival table, joins ---------------------------------------------
@query("terminal_record", """select loan_key, Duration0 as Duration, LastReportingPeriod, ZeroBalanceCode, LastInterestRate, MaxDelinquency,
    EverDelinquent90Plus from term""", ("term",), "LastInterestRate")
def _(v):
    return v.terminal


@query("survival_table", "select * from surv", ("surv",), "OriginalUPB OriginalInterestRate LastInterestRate RateChange")
def _(v):
    return v.surv


@query("survival_loans", "select * from sl", ("sl",), "OriginalUPB OriginalInterestRate")
def _(v):
    return v.labels


@query("macro_at_origination", """select loan_key, FirstPaymentDate, mortgage_rate, unemployment, hpi_yoy from surv
    left join macro on FirstPaymentDate = yyyymm""", ("surv", "macro"), "mortgage_rate unemployment hpi_yoy")
def _(v):
    from ..operators.panel import join_macro_at

    x = join_macro_at(v.surv, v.macro, "FirstPaymentDate", "yyyymm")
    return x.select(ID, "FirstPaymentDate", "mortgage_rate", "unemployment", "hpi_yoy")


@query("annual_macro_join", """select loan_key, VintageYear, m.mortgage_rate, m.unemployment, m.hpi_yoy, OriginalInterestRate - m.mortgage_rate as rate_incentive
    from surv left join (select yyyymm // 100 as year, avg(mortgage_rate) as mortgage_rate, avg(unemployment) as unemployment, avg(hpi_yoy) as hpi_yoy
    from macro group by 1) m on VintageYear = year""", ("surv", "macro"), "mortgage_rate unemployment hpi_yoy rate_incentive")
def _(v):
    from ..operators.panel import annual_means, join_macro_at

    m = annual_means(v.macro, ["mortgage_rate", "unemployment", "hpi_yoy"])
    x = join_macro_at(v.surv, m, "VintageYear", "year")
    return x.select(ID, F.col("VintageYear").cast("int").alias("VintageYear"), "mortgage_rate", "unemployment", "hpi_yoy",
                    (F.col("OriginalInterestRate") - F.col("mortgage_rate")).alias("rate_incentive"))


@query("delinquency_join", """select o.loan_key, least(greatest(coalesce(t.MaxDelinquency, 0), 0), 12)::double as MaxDelinquency,
    case when t.EverDelinquent90Plus then 1e0 else 0e0 end as EverDelinquent90 from orig o left join term t on o.loan_key = t.loan_key""", ("orig", "term"))
def _(v):
    return terminal.add_delinquency_history(v.origination, v.terminal, ID).select(ID, "MaxDelinquency", "EverDelinquent90")


@query("semi_join", """select loan_key, MonthlyReportingPeriod, LoanAge, tie_breaker from perf
    where loan_key in (select loan_key from surv where CreditTerminated)""", ("perf", "surv"))
def _(v):
    return split.members(v.perf, v.surv.where("CreditTerminated"), ID).select(ID, "MonthlyReportingPeriod", "LoanAge", "tie_breaker")


@query("distinct_values", """select 'PropertyState' as "column", count(distinct PropertyState) as n_distinct from surv union all
    select 'VintageYear', count(distinct VintageYear) from surv union all select 'Channel', count(distinct Channel) from surv""", ("surv",))
def _(v):
    return terminal.distinct_counts(v.surv, "PropertyState", "VintageYear", "Channel")


@query("yearly_union", """select VintageYear, count(*) as n, sum(OriginalUPB) as upb from orig where VintageYear is not null group by 1""", ("orig",), "upb", digits=2)
def _(v):
    years = sorted(r[0] for r in v.origination.select("VintageYear").distinct().dropna().collect())
    parts = [v.origination.where(F.col("VintageYear") == y) for y in years]
    return tables.union_all(parts).groupBy(F.col("VintageYear").cast("int").alias("VintageYear")).agg(
        F.count("*").alias("n"), F.sum("OriginalUPB").alias("upb"))


# --- summaries --------------------------------------------------------------------------------
@query("population_summary", """select bucket, n, 100e0 * n / total as pct from (
    select count(*) as total, unnest(['total', 'prepaid_event', 'credit_terminated', 'other_terminated', 'still_active', 'censored_for_prepay_km']) as bucket,
    unnest([count(*), count(*) filter (Prepaid), count(*) filter (CreditTerminated), count(*) filter (Terminated and not Prepaid and not CreditTerminated),
            count(*) filter (not Terminated), count(*) filter (not Prepaid)]) as n from surv)""", ("surv",), "pct")
def _(v):
    return terminal.population_summary(v.surv)


@query("vintage_summary", """select VintageYear, count(*) as n, count(*) filter (Prepaid) as n_prepay, avg(Event_Prepay) as prepay_rate,
    median(Duration) as median_duration from surv group by 1""", ("surv",), "prepay_rate median_duration")
def _(v):
    return terminal.vintage_summary(v.surv, "VintageYear")


@query("bucket_summary", """select VintageBucket, count(*) as n, count(*) filter (Prepaid) as n_prepay, avg(Event_Prepay) as prepay_rate,
    median(Duration) as median_duration from surv group by 1""", ("surv",), "prepay_rate median_duration")
def _(v):
    return terminal.vintage_summary(v.surv)


@query("duration_stats", """select count(*) as n, median(Duration) as median_duration, avg(Duration) as mean_duration, max(Duration) as max_duration,
    avg(Event_Prepay) as prepay_rate from surv""", ("surv",), "median_duration mean_duration prepay_rate")
def _(v):
    return terminal.duration_stats(v.surv)


@query("event_profile", """select case event_type when 1 then 'Prepaid' when 2 then 'Defaulted' else 'Censored' end as event, count(*) as n,
    median(duration) as median_duration, avg(CreditScore) as fico, avg(OriginalLoantoValueLTV) as ltv, avg(OriginalInterestRate) as rate,
    avg(case when OriginalDebttoIncomeRatio < 999 then OriginalDebttoIncomeRatio end) as dti, avg(OriginalUPB) as upb,
    avg(NumberofBorrowers) as borrowers, 100e0 * count(*) / (select count(*) from sl) as share_pct from sl group by 1""", ("sl",),
       "median_duration fico ltv rate dti upb borrowers share_pct", digits=4)
def _(v):
    return terminal.event_profile(v.labels)


@query("duration_histogram", """select case event_type when 1 then 'Prepaid' when 2 then 'Defaulted' else 'Censored' end as event,
    cast(duration // 6 * 6 as int) as bin, count(*) as n from sl group by 1, 2""", ("sl",))
def _(v):
    return terminal.duration_histogram(v.labels)


_MIX = """select VintageYear, n_prepaid, n_defaulted, n_censored, 100e0 * n_prepaid / n as pct_prepaid, 100e0 * n_defaulted / n as pct_defaulted,
    100e0 * n_censored / n as pct_censored from (select VintageYear, count(*) as n, count(*) filter (event_type = 1) as n_prepaid,
    count(*) filter (event_type = 2) as n_defaulted, count(*) filter (event_type = 0) as n_censored from sl group by 1)"""


@query("cohort_mix", _MIX, ("sl",), "pct_prepaid pct_defaulted pct_censored")
def _(v):
    return terminal.cohort_mix(v.labels)


@query("peak_cohort", f"select VintageYear as peak_year, pct_defaulted as peak_rate from ({_MIX}) order by pct_defaulted desc, VintageYear limit 1", ("sl",), "peak_rate")
def _(v):
    return terminal.peak_cohort(terminal.cohort_mix(v.labels))


@query("class_counts", "select VintageYear, event_type, count(*) as n from sl group by 1, 2", ("sl",))
def _(v):
    return terminal.class_counts(v.labels, "VintageYear", "event_type")


# --- targets and splits ------------------------------------------------------------------------
@query("horizon_targets", "select loan_key, MaxObsMonths, " + ", ".join(f"Target_T{h}" for h in V.HORIZONS) + " from targets", ("targets",))
def _(v):
    return v.targets.select(ID, "MaxObsMonths", *[f"Target_T{h}" for h in V.HORIZONS])


@query("binary_targets", "select loan_key, " + ", ".join(f"{V._target(h, 'binary')} as Target_T{h}" for h in V.HORIZONS) + " from surv", ("surv",))
def _(v):
    return targets.horizon_targets(v.surv, V.HORIZONS, "binary", V.CUTOFF).select(ID, *[f"Target_T{h}" for h in V.HORIZONS])


@query("observed_window", "select count(*) as n from targets where MaxObsMonths >= 48", ("targets",))
def _(v):
    return targets.observed_window(v.targets, 48).agg(F.count("*").alias("n"))


@query("target_counts", " union all ".join(f"""select {h} as horizon, count(*) filter (Target_T{h} = 1) as positives, count(*) filter (Target_T{h} = 0) as negatives,
    count(*) filter (Target_T{h} is null) as unknown from targets""" for h in V.HORIZONS), ("targets",))
def _(v):
    return targets.target_counts(v.targets, V.HORIZONS)


@query("landmark_labels", " union all ".join(f"""select {h} as horizon, least(Duration, {h}) as time_h, case when Prepaid and Duration <= {h} then 1 else 0 end as event_h,
    count(*) as n from surv group by 1, 2, 3""" for h in V.HORIZONS), ("surv",))
def _(v):
    x = targets.landmark(v.surv.select("Duration", "Event_Prepay"), V.HORIZONS, "Duration", "Event_Prepay")
    return x.groupBy("horizon", "time_h", "event_h").agg(F.count("*").alias("n"))


@query("truncated_durations", """select loan_key, least(duration, 29) as eff_duration, case when duration > 29 then 0 else event_type end as eff_event from sl""", ("sl",))
def _(v):
    return targets.truncate(v.labels, 30).select(ID, "eff_duration", "eff_event")


@query("vintage_split", """select loan_key, case when VintageYear <= 1998 then 'train' else 'test' end as split from surv where VintageYear <= 2001""", ("surv",))
def _(v):
    return split.vintage_split(v.surv, V.TRAIN_END, V.TEST_START, V.TEST_END).select(ID, "split")


_H = "cast(('0x' || substr(md5('42|' || cast(loan_key as varchar)), 1, 15)) as bigint)"


@query("carve_validation", f"""select loan_key, rank <= round_even(0.1e0 * n, 0) as is_val from (select loan_key,
    row_number() over (order by {_H}, loan_key) as rank, count(*) over () as n from surv where VintageYear <= 1998)""", ("surv",))
def _(v):
    train = v.surv.where(F.col("VintageYear") <= V.TRAIN_END).select(ID)
    return split.carve_validation(train, 0.1, key=ID)


@query("fraction_sample", f"select loan_key from surv where {_H} < cast(floor(0.05e0 * 1152921504606846976) as bigint)", ("surv",))
def _(v):
    return split.fraction_sample(v.surv, 0.05, key=ID).select(ID)


@query("stratified_split", f"""select loan_key, event_type, rank <= round_even(0.2e0 * n, 0) as is_test from (select loan_key, event_type,
    row_number() over (partition by event_type order by {_H}, loan_key) as rank, count(*) over (partition by event_type) as n from sl)""", ("sl",))
def _(v):
    return split.stratified_split(v.labels.select(ID, "event_type"), ["event_type"], 0.2, key=ID)


@query("proportional_sample", f"""select loan_key, VintageYear from (select loan_key, VintageYear, row_number() over (partition by VintageYear order by {_H}, loan_key) as rank,
    count(*) over (partition by VintageYear) as n, count(*) over () as total from sl) where rank <= least(n, greatest(1, floor(500e0 * n / total)))""", ("sl",))
def _(v):
    return split.proportional_sample(v.labels.select(ID, "VintageYear"), ["VintageYear"], 500, key=ID)


@query("quota_sample", f"""select loan_key, event_type from (select loan_key, event_type, row_number() over (partition by event_type order by {_H}, loan_key) as rank from sl)
    where rank <= case event_type when 1 then 600 when 2 then 99999 else 350 end""", ("sl",))
def _(v):
    return split.quota_sample(v.labels.select(ID, "event_type"), "event_type", {1: 600, 2: 99999, 0: 350}, key=ID)


@query("first_ids", f"select loan_key from (select loan_key, row_number() over (order by {_H}, loan_key) as r from surv) where r <= 2000", ("surv",))
def _(v):
    return split.first_ids(v.surv.select(ID), 2000, ID)


def _split_table(v):
    x = split.vintage_split(v.spread_surv, V.TRAIN_END, V.TEST_START, V.TEST_END)
    return tables.split_table(x, key=ID)


@query("canonical_split", f"select loan_key, case when VintageYear <= 1998 then 'train' else 'test' end as split, VintageYear, {_H} as ord from surv", ("surv",))
def _(v):
    return _split_table(v)


@query("restrict_to_split", f"select loan_key, Duration, {_H} as ord from surv where VintageYear between 1999 and 2001", ("surv",))
def _(v):
    return split.restrict_to_split(v.surv, _split_table(v), "test", ID).select(ID, "Duration", "ord")


@query("split_alignment", f"""select (select count(*) from surv where VintageYear >= 1999) as n_left, (select count(*) from surv where VintageYear >= 1998) as n_right,
    0 as left_only, (select count(*) from surv where VintageYear = 1998) as right_only, 0 as order_mismatch""", ("surv",))
def _(v):
    right = v.surv.where("VintageYear >= 1998").select(ID, C.hash60(ID, K.SEED).alias("ord"))
    return split.alignment(_split_table(v).where("split = 'test'"), right, ID)


@query("test_membership", "select count(*) as n, count(*) filter (VintageYear >= 1999) as n_in, avg(case when VintageYear >= 1999 then 1e0 else 0e0 end) as share from surv", ("surv",), "share")
def _(v):
    return split.membership_share(v.surv, _split_table(v).where("split = 'test'"), ID)


# --- encoders -----------------------------------------------------------------------------------
_NUM = [c for c in K.NUMERIC_FEATURES if c != "OriginalCombinedLoantoValueCLTV"]
TRAIN = "VintageYear <= 1998"


@query("numeric_encoder", " union all ".join(f"""select '{c}' as "column", median({c}) as median, avg({c}) as mean, stddev_samp({c}) as std from surv where {TRAIN}""" for c in _NUM),
       ("surv",), "median mean std", digits=4)
def _(v):
    return encode.numeric_stats(v.surv, _NUM, fit_on=TRAIN)


@query("exact_quantiles", " union all ".join(f"""select {y} as VintageYear, 'OriginalUPB' as "column", count(*) as n,
    [round(quantile_cont(OriginalUPB, 0.1), 4), round(quantile_cont(OriginalUPB, 0.5), 4), round(quantile_cont(OriginalUPB, 0.99), 4)] as q from surv where VintageYear = {y}"""
                                              for y in range(1995, 2002)), ("surv",))
def _(v):
    x = ordered.quantiles(v.surv, ["OriginalUPB"], [0.1, 0.5, 0.99], ["VintageYear"])
    return x.withColumn("q", F.transform("q", lambda e: F.round(e, 4)))


@query("top_levels", " union all ".join(f"""select '{c}' as "column", level, n, rank from (select {c} as level, count(*) as n,
    row_number() over (order by count(*) desc, {c}) as rank from surv where {TRAIN} and {c} is not null group by {c}) where rank <= 20""" for c in K.CATEGORICAL_FEATURES), ("surv",))
def _(v):
    return encode.top_levels(v.surv, K.CATEGORICAL_FEATURES, fit_on=TRAIN)


def _num_sql():
    return ", ".join(f"coalesce({c}::double, (select median({c}) from surv where {TRAIN})) as {c}, case when {c} is null then 1 else 0 end as {c}__missing" for c in _NUM)


def _cat_sql(c):
    top = f"(select level from (select {c} as level, row_number() over (order by count(*) desc, {c}) as r from surv where {TRAIN} and {c} is not null group by {c}) where r <= 20)"
    return f"case when {c} in {top} then {c} else 'OTHER' end as {c}"


@query("feature_matrix", f"select loan_key, {_num_sql()}, {', '.join(_cat_sql(c) for c in K.CATEGORICAL_FEATURES)}, VintageYear from surv", ("surv",),
       " ".join(_NUM), digits=4)
def _(v):
    enc = encode.Encoder.fit(v.surv, fit_on=TRAIN)
    x = encode.feature_matrix(v.surv, enc, keep=[ID])
    # fold the one-hot columns back to the level that is set
    out = {}
    for c in K.CATEGORICAL_FEATURES:
        levels = [*enc.levels[c], "OTHER", "MISSING"]
        out[c] = F.coalesce(*[F.when(F.col(f"`{c}__{lev}`") == 1, lev) for lev in levels])
    num = [n for c in _NUM for n in (c, f"{c}__missing")]
    return x.select(ID, *num, *[e.alias(c) for c, e in out.items()], F.col("VintageYear").cast("int").alias("VintageYear"))


@query("one_hot_totals", "select feature, n, total from (" + " union all ".join(
    f"""select '{c}__' || lv as feature, count(*) as n, sum(case when x = lv then 1 else 0 end)::bigint as total
        from (select {_cat_sql(c).replace(f' as {c}', ' as x')} from surv) s,
        (select level as lv from (select {c} as level, row_number() over (order by count(*) desc, {c}) as r from surv where {TRAIN} and {c} is not null group by {c}) where r <= 20
         union all select 'OTHER' union all select 'MISSING') group by 1""" for c in K.CATEGORICAL_FEATURES) + ")", ("surv",))
def _(v):
    enc = encode.Encoder.fit(v.surv, fit_on=TRAIN)
    x = encode.feature_matrix(v.surv, enc, numeric=[], vintage_year=False)
    one = x.agg(F.count("*").alias("n"), *[F.sum(f"`{c}`").alias(c) for c in x.columns])
    return one.unpivot("n", [F.col(f"`{c}`") for c in x.columns], "feature", "total")


_COXENC = f"""select median(OriginalDebttoIncomeRatio) as dm from surv where {TRAIN}"""
_COXST = f"""select avg(CreditScore) as m1, stddev_samp(CreditScore) as s1, avg(OriginalLoantoValueLTV) as m2, stddev_samp(OriginalLoantoValueLTV) as s2,
    avg(OriginalInterestRate) as m3, stddev_samp(OriginalInterestRate) as s3, avg(OriginalUPB) as m4, stddev_samp(OriginalUPB) as s4,
    avg(coalesce(OriginalDebttoIncomeRatio, dm)) as m5, stddev_samp(coalesce(OriginalDebttoIncomeRatio, dm)) as s5 from surv, ce where {TRAIN}"""


@query("cox_features", f"""select loan_key, (CreditScore - m1) / s1 as FICO_z, (OriginalLoantoValueLTV - m2) / s2 as LTV_z, (OriginalInterestRate - m3) / s3 as Rate_z,
    (OriginalUPB - m4) / s4 as UPB_z, (coalesce(OriginalDebttoIncomeRatio, dm) - m5) / s5 as DTI_z, case when OriginalDebttoIncomeRatio is null then 1 else 0 end as DTI_missing,
    {_DUMMY} from surv, ce, cs""", ("surv",), "FICO_z LTV_z Rate_z UPB_z DTI_z", extra={"ce": _COXENC, "cs": _COXST})
def _(v):
    enc = encode.fit_cox_encoder(v.surv, fit_on=TRAIN)
    return encode.cox_features(v.surv, enc).select(ID, *K.COX_COVARIATES)


@query("standardised_frames", f"""select case when VintageYear <= 1998 then 'train' else 'test' end as split, count(*) as n,
    avg((OriginalUPB - m) / s) as mean_upb, stddev_samp((OriginalUPB - m) / s) as std_upb, avg((OriginalInterestRate - mr) / sr) as mean_rate, avg(OriginalLoanTerm - 360e0) as mean_term
    from surv, (select avg(OriginalUPB) as m, stddev_samp(OriginalUPB) as s, avg(OriginalInterestRate) as mr, stddev_samp(OriginalInterestRate) as sr from surv where {TRAIN}) group by 1""",
       ("surv",), "mean_upb std_upb mean_rate mean_term")
def _(v):
    cols = ["OriginalUPB", "OriginalInterestRate", "OriginalLoanTerm"]
    x = v.surv.select("VintageYear", *[F.col(c).cast("double").alias(c) for c in cols])
    train, test = x.where(TRAIN), x.where("VintageYear > 1998")
    a, _, b, _ = encode.standardize_three(train, train, test, cols)
    both = tables.union_all([a.withColumn("split", F.lit("train")), b.withColumn("split", F.lit("test"))])
    return both.groupBy("split").agg(
        F.count("*").alias("n"), F.avg("OriginalUPB").alias("mean_upb"), F.stddev_samp("OriginalUPB").alias("std_upb"),
        F.avg("OriginalInterestRate").alias("mean_rate"), F.avg("OriginalLoanTerm").alias("mean_term"))


@query("scaler_round_trip", """select loan_key, OriginalUPB, OriginalInterestRate from surv""", ("surv",), "OriginalUPB OriginalInterestRate", digits=4)
def _(v):
    cols = ["OriginalUPB", "OriginalInterestRate"]
    s = encode.fit_scaler(v.surv, cols, ddof=0)
    return encode.unscale(encode.scale(v.surv.select(ID, *cols), s), s)


@query("macro_z", """select loan_key, coalesce((mortgage_rate - mm) / sm, 0) as mortgage_rate_z, coalesce((hpi_yoy - mh) / sh, 0) as hpi_yoy_z, 0e0 as flat_z from
    (select loan_key, mortgage_rate, hpi_yoy from surv left join macro on FirstPaymentDate = yyyymm) x,
    (select avg(mortgage_rate) as mm, stddev_samp(mortgage_rate) as sm, avg(hpi_yoy) as mh, stddev_samp(hpi_yoy) as sh from surv left join macro on FirstPaymentDate = yyyymm)""",
       ("surv", "macro"), "mortgage_rate_z hpi_yoy_z flat_z")
def _(v):
    from ..operators.panel import join_macro_at

    x = join_macro_at(v.surv, v.macro, "FirstPaymentDate", "yyyymm").withColumn("flat", F.lit(3.0))
    return encode.macro_z(x, ["mortgage_rate", "hpi_yoy", "flat"]).select(ID, "mortgage_rate_z", "hpi_yoy_z", "flat_z")


_REPLAY = ["CreditScore", "CreditScore__missing", "LoanPurpose__P", "LoanPurpose__MISSING", "PropertyState__CA", "PropertyState__OTHER", "VintageYear", "NotThere"]


@query("replay_encoder", """select loan_key, (coalesce(CreditScore, 0) - 700) / 50e0 as CreditScore, (case when CreditScore is null then 1 else 0 end - 0.5e0) / 1e0 as CreditScore__missing,
    (case when LoanPurpose = 'P' then 1 else 0 end - 0.5e0) / 1e0 as LoanPurpose__P, (case when LoanPurpose is null then 1 else 0 end - 0.5e0) / 1e0 as LoanPurpose__MISSING,
    (case when PropertyState = 'CA' then 1 else 0 end - 0.5e0) / 1e0 as PropertyState__CA,
    (case when PropertyState is not null and PropertyState not in ('CA','FL','IL','TX','MI','NY','OH','PA','VA','NC','WA','MN','GA','NJ','AZ','CO','MA','MD','WI','MO') then 1 else 0 end - 0.5e0) / 1e0 as PropertyState__OTHER,
    (VintageYear - 2000) / 2e0 as VintageYear, -0.5e0 as NotThere from surv""", ("surv",),
       "CreditScore CreditScore__missing LoanPurpose__P LoanPurpose__MISSING PropertyState__CA PropertyState__OTHER VintageYear NotThere")
def _(v):
    means = {n: 0.5 for n in _REPLAY} | {"CreditScore": 700.0, "VintageYear": 2000.0}
    stds = {n: 0.0 for n in _REPLAY} | {"CreditScore": 50.0, "VintageYear": 2.0}
    return encode.replay_features(v.surv, _REPLAY, means, stds, keep=[ID])


@query("model_metadata", """select loan_key, CreditScore, LoanPurpose from surv""", ("surv",))
def _(v):
    packed = tables.metadata_json(v.surv.select(ID, "CreditScore", "LoanPurpose"))
    return tables.parse_metadata(packed, "loan_key bigint, CreditScore int, LoanPurpose string")


@query("model_lists", """select array_agg(distinct LoanPurpose) is not null as found, list_sort(['C', 'N', 'P']) as drawn, ['X'] as absent from surv""", ("surv",))
def _(v):
    x = reports.drawn_strata(v.surv.where("LoanPurpose is not null"), ["X", "P", "N", "C"], "LoanPurpose")
    return x.select(F.lit(True).alias("found"), F.array_sort("drawn").alias("drawn"), "absent")
