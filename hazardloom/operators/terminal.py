"""Monthly performance rows to one terminal record per loan, and the survival table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import loans as L


def terminal_records(perf: DataFrame, key: str = "LoanSequenceNumber",
                     sequence: Column | str = "MonthlyReportingPeriod") -> DataFrame:
    """One row per loan: longest age, last period, first termination code, rate at the last
    period, worst delinquency.

    `sequence` orders a loan's rows. Keep it one numeric column (pack tie-breakers into it):
    every aggregation buffer is then a primitive, so the reduction stays a hash aggregate with
    map-side combine, and the rows are never sorted. A hot loan key is combined before the
    shuffle like any other.
    """
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    zbc = C.small_int("ZeroBalanceCode")
    dq = C.small_int("CurrentLoanDelinquencyStatus")
    rows = perf.select(
        key, "LoanAge", "MonthlyReportingPeriod", "CurrentInterestRate",
        seq.alias("__seq"), zbc.alias("__zbc"), dq.alias("__dq"))
    return rows.groupBy(key).agg(
        F.max("LoanAge").alias("Duration"),
        F.max("MonthlyReportingPeriod").alias("LastReportingPeriod"),
        F.min_by("__zbc", F.when(F.col("__zbc").isNotNull(), F.col("__seq"))).alias("ZeroBalanceCode"),
        F.max_by("CurrentInterestRate", "__seq").alias("LastInterestRate"),
        F.max("__dq").alias("MaxDelinquency"),
        F.coalesce(F.bool_or(F.col("__dq") >= 3), F.lit(False)).alias("EverDelinquent90Plus"),
    )


def survival_table(origination: DataFrame, terminal: DataFrame,
                   key: str = "LoanSequenceNumber") -> DataFrame:
    """Inner join on the loan key plus event flags, floored duration and rate change."""
    joined = origination.join(terminal, key)
    return L.add_rate_change(L.floor_duration(L.add_event_flags(joined)))


def survival_loans(surv: DataFrame, key: str = "LoanSequenceNumber") -> DataFrame:
    """Label table of the competing-risk stages."""
    return surv.select(
        key, "VintageYear", F.col("Duration").alias("duration"),
        F.col("Prepaid").cast("int").alias("prepaid"),
        F.col("CreditTerminated").cast("int").alias("defaulted"),
        "CreditScore", "OriginalLoantoValueLTV", "OriginalInterestRate",
        "OriginalDebttoIncomeRatio", "OriginalUPB", "NumberofBorrowers",
        "LoanPurpose", "OccupancyStatus")


def add_delinquency_history(loans: DataFrame, terminal: DataFrame,
                            key: str = "LoanSequenceNumber") -> DataFrame:
    """Left join of delinquency history; loans without any count as never delinquent."""
    hist = terminal.select(key, "MaxDelinquency", "EverDelinquent90Plus")
    joined = loans.join(hist, key, "left")
    return joined.withColumns({
        "MaxDelinquency": C.clip(F.coalesce("MaxDelinquency", F.lit(0)), 0, 12).cast("double"),
        "EverDelinquent90": F.coalesce(F.col("EverDelinquent90Plus"), F.lit(False)).cast("double"),
    }).drop("EverDelinquent90Plus")


# --- population summaries ------------------------------------------------------------
def population_summary(surv: DataFrame) -> DataFrame:
    """Counts and shares by exit type, long (bucket, n, pct)."""
    one = surv.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("Event_Prepay") == 1).alias("prepaid_event"),
        F.count_if("CreditTerminated").alias("credit_terminated"),
        F.count_if("Terminated").alias("terminated"))
    wide = one.select(
        "total", "prepaid_event", "credit_terminated",
        (F.col("terminated") - F.col("prepaid_event") - F.col("credit_terminated")).alias("other_terminated"),
        (F.col("total") - F.col("terminated")).alias("still_active"),
        (F.col("total") - F.col("prepaid_event")).alias("censored_for_prepay_km"))
    names = wide.columns
    return wide.withColumn("__n", F.col("total")).unpivot("__n", names, "bucket", "n").select(
        "bucket", "n", (F.lit(100.0) * F.col("n") / F.nullif(F.col("__n"), F.lit(0))).alias("pct"))


def vintage_summary(surv: DataFrame, by: str = "VintageBucket") -> DataFrame:
    """Per bucket: size, prepayments, rate and median duration. Months are few, so the exact
    median keeps a small count map per group."""
    return surv.groupBy(by).agg(
        F.count("*").alias("n"),
        F.sum(F.col("Event_Prepay").cast("bigint")).alias("n_prepay"),
        F.avg("Event_Prepay").alias("prepay_rate"),
        F.median("Duration").alias("median_duration"))


def duration_stats(surv: DataFrame) -> DataFrame:
    return surv.agg(
        F.count("*").alias("n"), F.median("Duration").alias("median_duration"),
        F.avg("Duration").alias("mean_duration"), F.max("Duration").alias("max_duration"),
        F.avg("Event_Prepay").alias("prepay_rate"))


def event_profile(loans: DataFrame) -> DataFrame:
    """Per exit type: size, share, median duration and mean characteristics."""
    x = loans.withColumn("event", L.event_name())
    dti = F.col("OriginalDebttoIncomeRatio")
    per = x.groupBy("event").agg(
        F.count("*").alias("n"), F.median("duration").alias("median_duration"),
        F.avg("CreditScore").alias("fico"), F.avg("OriginalLoantoValueLTV").alias("ltv"),
        F.avg("OriginalInterestRate").alias("rate"),
        F.avg(F.when(dti < 999, dti)).alias("dti"),
        F.avg("OriginalUPB").alias("upb"), F.avg("NumberofBorrowers").alias("borrowers"))
    total = x.agg(F.count("*").alias("__total"))
    return per.crossJoin(total).withColumn(  # both sides have at most three rows
        "share_pct", F.lit(100.0) * F.col("n") / F.col("__total")).drop("__total")


def duration_histogram(loans: DataFrame, width: int = 6) -> DataFrame:
    x = loans.withColumn("event", L.event_name())
    return x.groupBy("event", C.fixed_width("duration", width).alias("bin")).agg(F.count("*").alias("n"))


def cohort_mix(loans: DataFrame) -> DataFrame:
    """Vintage by exit type, counts and row percentages, empty cells 0."""
    names = ["Prepaid", "Defaulted", "Censored"]
    wide = (loans.withColumn("event", L.event_name()).groupBy("VintageYear")
            .pivot("event", names).agg(F.count(F.lit(1))).fillna(0, names))
    total = F.col("Prepaid") + F.col("Defaulted") + F.col("Censored")
    return wide.select(
        "VintageYear", *[F.col(n).alias(f"n_{n.lower()}") for n in names],
        *[(F.lit(100.0) * F.col(n) / total).alias(f"pct_{n.lower()}") for n in names])


def peak_cohort(mix: DataFrame, rate: str = "pct_defaulted", year: str = "VintageYear") -> DataFrame:
    """Cohort with the highest rate; the earlier one on a tie."""
    best = mix.select(year, rate).orderBy(F.desc(rate), year).limit(1)
    return best.select(F.col(year).alias("peak_year"), F.col(rate).alias("peak_rate"))


def class_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Number of distinct values of each column, long (column, n_distinct).

    Counts distinct (column, value) pairs after unpivoting, so each is a plain two-step hash
    aggregate and not one wide expand with a sort."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
        .alias("kv")).select("kv.*").where("value is not null")
    return long.distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))
