"""Loan views derived from the supplied order tables, as DataFrames and as SQL for the check.

`Views` builds each view with the library; `CTES` states the same view in plain SQL, written
independently so that comparing the two means something.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..functions import loans as L
from ..operators import encode, panel, targets, terminal

KEY = "loan_key"
HORIZONS = [12, 24, 36, 48]
CUTOFF = 200112
TRAIN_END, TEST_START, TEST_END = 1998, 1999, 2001

LOAN_EXPRS = [
    "concat('F', lpad(cast(year(o_orderdate) % 100 as string), 2, '0'), 'Q', cast(quarter(o_orderdate) as string), lpad(cast(o_orderkey as string), 7, '0')) as LoanSequenceNumber",
    "o_orderkey as loan_key",
    "cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as FirstPaymentDate",
    "cast(case when o_orderkey % 97 = 0 then 9999 else 560 + (o_custkey * 37) % 281 end as int) as CreditScore",
    "cast(case when o_orderkey % 211 = 0 then 999 else 40 + (o_orderkey * 13) % 61 end as int) as OriginalLoantoValueLTV",
    "cast(case when o_orderkey % 11 = 0 then 999 else 15 + (o_orderkey * 7) % 36 end as int) as OriginalDebttoIncomeRatio",
    "cast(case when o_orderkey % 307 = 0 then 999 when (o_orderkey * 13) % 61 > 40 then 25 else 0 end as int) as MortgageInsurancePercentage",
    "cast(case when o_orderkey % 401 = 0 then 99 else 1 + o_orderkey % 2 end as int) as NumberofBorrowers",
    "o_totalprice as OriginalUPB",
    "3e0 + cast((o_orderkey * 17) % 45 as double) / 10e0 as OriginalInterestRate",
    "cast(case when o_orderkey % 13 = 0 then 180 else 360 end as int) as OriginalLoanTerm",
    "case when o_orderkey % 151 = 0 then '9' when o_orderstatus = 'P' then 'P' when o_orderstatus = 'F' then 'N' else 'C' end as LoanPurpose",
    "case when o_orderpriority = '1-URGENT' then 'I' when o_orderpriority = '2-HIGH' then 'S' else 'P' end as OccupancyStatus",
    "case when o_orderkey % 101 = 0 then '9' when o_orderkey % 5 = 0 then 'Y' else 'N' end as FirstTimeHomebuyerFlag",
    "case when o_orderkey % 173 = 0 then '99' when c_mktsegment = 'AUTOMOBILE' then 'PU' when c_mktsegment = 'MACHINERY' then 'CO' when c_mktsegment = 'FURNITURE' then 'MH' else 'SF' end as PropertyType",
    "case when o_orderkey % 4 = 0 then 'R' when o_orderkey % 4 = 1 then 'T' when o_orderkey % 4 = 2 then 'C' else 'B' end as Channel",
    "n_name as PropertyState",
]
PERF_EXPRS = [
    "l_orderkey as loan_key",
    "cast(year(l_shipdate) * 100 + month(l_shipdate) as int) as MonthlyReportingPeriod",
    "cast(l_quantity as int) as LoanAge",
    "case when l_returnflag = 'R' then '01' when l_returnflag = 'A' and l_linestatus = 'F' and l_linenumber <= 3 then '03' when l_returnflag = 'A' and l_linenumber = 7 then '15' end as ZeroBalanceCode",
    "3e0 + l_discount * 40e0 as CurrentInterestRate",
    "case when l_tax > 0.075e0 then 'RA' else cast(l_linenumber - 1 as string) end as CurrentLoanDelinquencyStatus",
    "l_extendedprice as CurrentActualUPB",
    "l_linenumber as tie_breaker",
]
MACRO_SQL = (
    "select cast(year(l_shipdate) * 100 + month(l_shipdate) as int) as yyyymm, avg(l_discount) * 100e0 as mortgage_rate, "
    "avg(l_tax) * 100e0 as unemployment, avg(l_extendedprice) as hpi from lineitem group by 1")


class Views:
    """Lazily built views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def loans(self) -> DataFrame:
        o, c, n = self.table("orders"), self.table("customer"), self.table("nation")
        return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).selectExpr(*LOAN_EXPRS)

    @cached_property
    def perf(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*PERF_EXPRS)

    @cached_property
    def origination(self) -> DataFrame:
        return L.prepare_origination(self.loans)

    @cached_property
    def terminal(self) -> DataFrame:
        # period, tie-breaker and price in one number: the ordering key stays a primitive
        seq = (F.col("MonthlyReportingPeriod").cast("bigint") * F.lit(10 ** 10)
               + F.col("tie_breaker").cast("bigint") * F.lit(10 ** 9)
               + F.round(F.col("CurrentActualUPB") * 100).cast("bigint"))
        return terminal.terminal_records(self.perf, KEY, seq)

    @cached_property
    def surv(self) -> DataFrame:
        return terminal.survival_table(self.origination, self.terminal, KEY)

    @cached_property
    def spread_surv(self) -> DataFrame:
        """`surv` joined in the session's number of shuffle partitions, which adaptive execution does not merge into a few large ones."""
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return terminal.survival_table(self.origination.repartition(n, KEY), self.terminal, KEY)

    @cached_property
    def labels(self) -> DataFrame:
        sl = terminal.survival_loans(self.surv, KEY)
        return sl.withColumn("event_type", L.event_code())

    @cached_property
    def macro(self) -> DataFrame:
        x = self.table("lineitem").groupBy(C.yyyymm_of("l_shipdate").alias("yyyymm")).agg(
            (F.avg("l_discount") * 100.0).alias("mortgage_rate"),
            (F.avg("l_tax") * 100.0).alias("unemployment"), F.avg("l_extendedprice").alias("hpi"))
        return panel.year_on_year(x, "hpi", "hpi_yoy", "yyyymm")

    @cached_property
    def panel(self) -> DataFrame:
        return panel.expand_panel(self.surv, self.macro, KEY)

    @cached_property
    def panel_features(self) -> DataFrame:
        return panel.panel_features(self.panel)

    @cached_property
    def targets(self) -> DataFrame:
        return targets.horizon_targets(self.surv, HORIZONS, cutoff=CUTOFF)

    @cached_property
    def scores(self) -> DataFrame:
        """Targets with two deterministic scores per horizon, rounded so that ties exist."""
        out = {}
        for h in HORIZONS:
            out[f"pred_Rate_T{h}"] = F.round(F.lit(0.05) + F.lit(0.1) * (F.col("OriginalInterestRate") - F.lit(3.0)) + F.lit(h * 0.002), 4)
            out[f"pred_Score_T{h}"] = F.round(F.lit(0.95) - (F.col("CreditScore") - F.lit(560)) / F.lit(400.0) + F.lit(h * 0.001), 4)
        return self.targets.withColumns(out)

    @cached_property
    def cox_rows(self) -> DataFrame:
        """Survival table with the 15 covariates in raw-unit expressions, complete rows only."""
        x = self.surv.dropna(subset=["CreditScore", "OriginalLoantoValueLTV", "OriginalInterestRate"])
        return encode.cox_features(x, encode.fit_cox_encoder(x))


# --- the same views in SQL -----------------------------------------------------------------
def _case(col: str, cuts, labels, op: str, missing: str | None = None) -> str:
    parts = [f"when {col} is null then '{missing}'"] if missing else []
    parts += [f"when {col} {op} {c} then '{lab}'" for c, lab in zip(cuts, labels)]
    return "case " + " ".join(parts) + f" else '{labels[-1]}' end"


_FICO = _case("CreditScore", K.FICO_CUTS, K.FICO_LABELS, "<", "Missing")
_LTV = _case("OriginalLoantoValueLTV", K.LTV_CUTS, K.LTV_LABELS, "<=", "Missing")
_VINT = _case("VintageYear", K.VINTAGE_CUTS, K.VINTAGE_LABELS, "<=")


def _target(h: int, mode: str = "cause_specific") -> str:
    other = f"(Terminated and Event_Prepay = 0 and Duration <= {h})"
    zero = f"Duration >= {h} and not {other}" if mode == "cause_specific" else f"Duration >= {h} or {other}"
    return f"case when Event_Prepay = 1 and Duration <= {h} then 1e0 when {zero} then 0e0 end"


CTES: dict[str, tuple[list[str], str]] = {
    "loans": ([], "select " + ", ".join(LOAN_EXPRS) + " from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"),
    "perf": ([], "select " + ", ".join(PERF_EXPRS) + " from lineitem"),
    "macro0": ([], MACRO_SQL),
    "macro": (["macro0"], "select *, 100e0 * (hpi / lag(hpi, 12) over (order by yyyymm) - 1) as hpi_yoy from macro0"),
    "clean": (["loans"], """select LoanSequenceNumber, loan_key, FirstPaymentDate,
        case when CreditScore >= 9999 then null else CreditScore end as CreditScore,
        case when OriginalLoantoValueLTV >= 999 then null else OriginalLoantoValueLTV end as OriginalLoantoValueLTV,
        case when OriginalDebttoIncomeRatio >= 999 then null else OriginalDebttoIncomeRatio end as OriginalDebttoIncomeRatio,
        case when MortgageInsurancePercentage >= 999 then null else MortgageInsurancePercentage end as MortgageInsurancePercentage,
        case when NumberofBorrowers >= 99 then null else NumberofBorrowers end as NumberofBorrowers,
        OriginalUPB, OriginalInterestRate, OriginalLoanTerm,
        nullif(LoanPurpose, '9') as LoanPurpose, nullif(OccupancyStatus, '9') as OccupancyStatus,
        nullif(FirstTimeHomebuyerFlag, '9') as FirstTimeHomebuyerFlag, nullif(PropertyType, '99') as PropertyType,
        nullif(Channel, '9') as Channel, PropertyState,
        cast(case when cast(substr(LoanSequenceNumber, 2, 2) as int) >= 90 then 1900 else 2000 end
             + cast(substr(LoanSequenceNumber, 2, 2) as int) as int) as VintageYear,
        cast(substr(LoanSequenceNumber, 5, 1) as int) as VintageQuarter
        from loans where OriginalLoanTerm = 360"""),
    "orig": (["clean"], f"select *, {_FICO} as FICO_bucket, {_LTV} as LTV_bucket, {_VINT} as VintageBucket from clean"),
    "perf_cast": (["perf"], """select *, try_cast(ZeroBalanceCode as smallint) as zbc, try_cast(CurrentLoanDelinquencyStatus as smallint) as dq,
        row_number() over (partition by loan_key order by MonthlyReportingPeriod desc, tie_breaker desc, CurrentActualUPB desc) as from_last,
        row_number() over (partition by loan_key order by MonthlyReportingPeriod, tie_breaker, CurrentActualUPB) as from_first from perf"""),
    "zbc_first": (["perf_cast"], """select loan_key, zbc from (select loan_key, zbc,
        row_number() over (partition by loan_key order by from_first) as r from perf_cast where zbc is not null) where r = 1"""),
    "term": (["perf_cast", "zbc_first"], """select p.loan_key, max(LoanAge) as Duration0, max(MonthlyReportingPeriod) as LastReportingPeriod,
        max(z.zbc) as ZeroBalanceCode, max(case when from_last = 1 then CurrentInterestRate end) as LastInterestRate,
        max(dq) as MaxDelinquency, coalesce(max(case when dq >= 3 then 1 when dq < 3 then 0 end), 0) = 1 as EverDelinquent90Plus
        from perf_cast p left join zbc_first z on p.loan_key = z.loan_key group by p.loan_key"""),
    "surv": (["orig", "term"], """select o.*, case when Duration0 is null or Duration0 <= 0 then 1 else Duration0 end as Duration,
        LastReportingPeriod, ZeroBalanceCode, LastInterestRate, MaxDelinquency, EverDelinquent90Plus,
        coalesce(ZeroBalanceCode = 1, false) as Prepaid, coalesce(ZeroBalanceCode in (2, 3, 9), false) as CreditTerminated,
        ZeroBalanceCode is not null as Terminated, case when ZeroBalanceCode = 1 then 1 else 0 end as Event_Prepay,
        OriginalInterestRate - LastInterestRate as RateChange
        from orig o join term t on o.loan_key = t.loan_key"""),
    "sl": (["surv"], """select loan_key, VintageYear, Duration as duration, cast(Prepaid as int) as prepaid, cast(CreditTerminated as int) as defaulted,
        CreditScore, OriginalLoantoValueLTV, OriginalInterestRate, OriginalDebttoIncomeRatio, OriginalUPB, NumberofBorrowers, LoanPurpose, OccupancyStatus,
        case when Prepaid then 1 when CreditTerminated then 2 else 0 end as event_type from surv"""),
    "panel": (["surv", "macro"], """select loan_key as loan_id, VintageYear as vintage_year, age as loan_age, ym as yyyymm,
        cast(Prepaid and age = Duration - 1 as int) as prepaid_month, cast(CreditTerminated and age = Duration - 1 as int) as default_month,
        CreditScore as FICO, OriginalLoantoValueLTV as LTV, OriginalDebttoIncomeRatio as DTI, OriginalUPB as UPB, OriginalInterestRate as orig_rate,
        LoanPurpose as loan_purpose, OccupancyStatus as occupancy, mortgage_rate, unemployment, hpi_yoy, OriginalInterestRate - mortgage_rate as rate_incentive
        from (select *, cast(((FirstPaymentDate // 100) * 12 + FirstPaymentDate % 100 - 1 + age) // 12 * 100
                + ((FirstPaymentDate // 100) * 12 + FirstPaymentDate % 100 - 1 + age) % 12 + 1 as int) as ym
              from surv, unnest(range(0, Duration)) as u(age)) x left join macro m on x.ym = m.yyyymm"""),
    "hpi": (["panel"], """select *, exp(sum(ln(1 + coalesce(hpi_yoy, 0) / 1200e0)) over (partition by loan_id order by loan_age)) as hpi_cumul from panel"""),
    "feat": (["hpi"], """select *, case when LTV is not null then least(greatest(LTV * least(greatest((pow(1 + rm, 360) - pow(1 + rm, loan_age)) / (pow(1 + rm, 360) - 1), 0), 1) / hpi_cumul, 0), 200) end as ELTV,
        case when loan_purpose = 'P' then 1e0 else 0e0 end as LP_Purchase, case when loan_purpose = 'N' then 1e0 else 0e0 end as LP_NoCashRefi,
        case when occupancy = 'I' then 1e0 else 0e0 end as Occ_Investment, case when occupancy = 'S' then 1e0 else 0e0 end as Occ_SecondHome
        from (select *, greatest(orig_rate / 1200e0, 1e-6) as rm from hpi)"""),
    "targets": (["surv"], "select *, cast((2001 * 12 + 12) - ((FirstPaymentDate // 100) * 12 + FirstPaymentDate % 100) as int) as MaxObsMonths, "
                + ", ".join(f"{_target(h)} as Target_T{h}" for h in HORIZONS) + " from surv"),
    "scored": (["targets"], "select *, " + ", ".join(
        f"round(0.05e0 + 0.1e0 * (OriginalInterestRate - 3e0) + {h * 0.002!r}::double, 4) as pred_Rate_T{h}, "
        f"round(0.95e0 - (CreditScore - 560) / 400e0 + {h * 0.001!r}::double, 4) as pred_Score_T{h}" for h in HORIZONS) + " from targets"),
    "long": (["scored"], " union all ".join(
        f"select '{m}' as model, {h} as horizon, cast(Target_T{h} as int) as y, pred_{m}_T{h} as p, VintageYear, FICO_bucket, loan_key from scored where Target_T{h} is not null"
        for m in ("Rate", "Score") for h in HORIZONS)),
    "grid360": ([], "select cast(t as int) as t from range(1, 361) r(t)"),
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix `body` with the named views and everything they need."""
    order: list[str] = []

    def add(n):
        for d in CTES[n][0]:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} as materialized ({CTES[n][1]})" for n in order]
    parts += [f"{n} as materialized ({q})" for n, q in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" + body if parts else body
