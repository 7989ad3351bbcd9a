"""Monthly macro panel and the loan-month panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..functions import loans as L
from ..sources import tables
from ..sources.staging import small_table, stage
from .ordered import medians

# --- macro ---------------------------------------------------------------------------


def monthly_means(series: Mapping[str, DataFrame]) -> DataFrame:
    """Mixed-frequency (date, value) series to one row per month, gaps inside a series filled
    forward, months outside its range NULL. All series share one aggregate."""
    long = tables.union_all([
        df.select(F.lit(name).alias("name"), C.month_number(C.yyyymm_of("date")).alias("m"),
                  F.col(name).cast("double").alias("v")) for name, df in series.items()])
    means = long.groupBy("m").pivot("name", list(series)).agg(F.avg("v"))
    spine = means.agg(F.min("m").alias("a"), F.max("m").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("m"))
    x = spine.join(means, "m", "left")
    back = W.partitionBy().orderBy("m").rowsBetween(W.unboundedPreceding, 0)  # one row per month
    ahead = W.partitionBy().orderBy("m").rowsBetween(0, W.unboundedFollowing)
    cols = {n: F.when(F.first(n, ignorenulls=True).over(ahead).isNotNull(),
                      F.last(n, ignorenulls=True).over(back)) for n in series}
    return x.select("m", *[e.alias(n) for n, e in cols.items()])


def forward_fill(df: DataFrame, column: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def year_on_year(df: DataFrame, column: str, name: str, order: str = "m") -> DataFrame:
    """100·(v / v twelve rows earlier - 1) on the forward-filled level."""
    w = W.partitionBy().orderBy(order)
    held = F.last(column, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    x = df.withColumn("__held", held)
    return x.withColumn(name, (F.try_divide(F.col("__held"), F.lag("__held", 12).over(w)) - 1)
                        * F.lit(100.0)).drop("__held")


def macro_panel(series: Mapping[str, DataFrame]) -> DataFrame:
    """YYYYMM, every series, HPI_YoY where a level series HPI exists; an annual CPI series is
    carried to the end of the spine."""
    if not series:
        raise FileNotFoundError("no macro series to build the panel from")
    x = monthly_means(series)
    if "CPI_YoY" in series:
        x = forward_fill(x, "CPI_YoY", "m")
    if "HPI" in series:
        x = year_on_year(x, "HPI", "HPI_YoY")
    return x.select(C.yyyymm("m").alias("YYYYMM"), *[c for c in x.columns if c != "m"])


def macro_from_csv(spark, folder: str) -> DataFrame:
    found = {}
    for file, name in K.FRED_SERIES:
        df = tables.read_series_csv(spark, f"{folder}/{file}", name)
        if df is not None:
            found[name] = df
    return macro_panel(found)


def annual_means(macro: DataFrame, columns: Sequence[str], month: str = "yyyymm") -> DataFrame:
    return macro.groupBy(F.floor(F.col(month) / 100).cast("int").alias("year")).agg(
        *[F.avg(c).alias(c) for c in columns])


def join_macro_at(df: DataFrame, macro: DataFrame, month: str, macro_month: str) -> DataFrame:
    """Left join on a calendar month; the month table is small and checked, so the loan side
    is not shuffled."""
    m = small_table(macro).withColumnRenamed(macro_month, month)
    return df.join(m, month, "left")


# --- loan months -------------------------------------------------------------------------
#: Loan months a partition of the panel holds on average: a sort by loan then stays in memory.
PANEL_ROWS = 1 << 20


def hpi_levels(macro: DataFrame) -> DataFrame:
    """(m, hpi_log): running log of Π(1 + hpi_yoy/1200) over calendar months, missing = flat."""
    x = macro.select(C.month_number("yyyymm").alias("m"), "hpi_yoy")
    spine = x.agg(F.min("m").alias("a"), F.max("m").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("m"))
    w = W.partitionBy().orderBy("m").rowsBetween(W.unboundedPreceding, 0)
    return spine.join(x, "m", "left").select("m", F.sum(
        F.log1p(F.coalesce("hpi_yoy", F.lit(0.0)) / F.lit(1200.0))).over(w).alias("hpi_log"))


def expand_panel(surv: DataFrame, macro: DataFrame, key: str = "LoanSequenceNumber") -> DataFrame:
    """One row per loan and month of age 0..Duration-1 with macro at its calendar month.

    The loan table is staged and spread by loan over partitions of about PANEL_ROWS months each; the
    explode keeps that partitioning and both macro lookups are broadcast month tables, so later
    windows by loan need no shuffle and sort a bounded number of months at a time.
    The cumulative house-price factor of a loan is a difference of two month levels, so it
    needs no per-loan window either.
    """
    m = small_table(macro.select("yyyymm", "mortgage_rate", "unemployment", "hpi_yoy"))
    levels = small_table(hpi_levels(m))
    edge = levels.agg(F.max("m"), F.max_by("hpi_log", "m")).collect()[0]

    def level(df, month_no, name):
        got = df.join(levels.select(F.col("m").alias(month_no), F.col("hpi_log").alias("__l")), month_no, "left")
        held = F.when(F.col(month_no) > edge[0], F.lit(edge[1])).otherwise(0.0)
        return got.withColumn(name, F.coalesce(F.col("__l"), held)).drop("__l")

    loans = surv.select(
        F.col(key).alias("loan_id"), F.col("VintageYear").alias("vintage_year"),
        F.col("CreditScore").alias("FICO"), F.col("OriginalLoantoValueLTV").alias("LTV"),
        F.col("OriginalDebttoIncomeRatio").alias("DTI"), F.col("OriginalUPB").alias("UPB"),
        F.col("OriginalInterestRate").alias("orig_rate"), F.col("LoanPurpose").alias("loan_purpose"),
        F.col("OccupancyStatus").alias("occupancy"),
        (C.month_number("FirstPaymentDate") - 1).alias("__m0"), "Duration", "Prepaid", "CreditTerminated")
    loans = stage(level(loans, "__m0", "__base"))
    months = loans.agg(F.sum("Duration")).collect()[0][0] or 0
    # not fewer than a loan table joined to it has: Spark would move the panel to the larger number
    parts = max(int(loans.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-months // PANEL_ROWS))
    loans = loans.repartition(parts, "loan_id")
    x = loans.withColumn("loan_age", F.explode(F.sequence(F.lit(0), F.col("Duration") - 1)))
    last = F.col("loan_age") == F.col("Duration") - 1
    x = x.withColumns({
        "__m": F.col("__m0") + F.col("loan_age") + 1,
        "prepaid_month": (F.col("Prepaid") & last).cast("int"),
        "default_month": (F.col("CreditTerminated") & last).cast("int")})
    x = level(x, "__m", "__now").withColumn("yyyymm", C.yyyymm("__m"))
    x = x.join(m, "yyyymm", "left")
    return x.select(
        "loan_id", "vintage_year", "loan_age", "yyyymm", "prepaid_month", "default_month",
        "FICO", "LTV", "DTI", "UPB", "orig_rate", "loan_purpose", "occupancy",
        "mortgage_rate", "unemployment", "hpi_yoy",
        (F.col("orig_rate") - F.col("mortgage_rate")).alias("rate_incentive"),
        F.exp(F.col("__now") - F.col("__base")).alias("hpi_cumul"))


def cumulative_hpi(panel: DataFrame) -> DataFrame:
    """Per-loan running product of (1 + hpi_yoy/1200) over the rows present, for panels that
    were not built by `expand_panel`."""
    w = W.partitionBy("loan_id").orderBy("loan_age").rowsBetween(W.unboundedPreceding, 0)
    f = F.log1p(F.coalesce("hpi_yoy", F.lit(0.0)) / F.lit(1200.0))
    return panel.withColumn("hpi_cumul", F.exp(F.sum(f).over(w)))


def current_ltv(panel: DataFrame) -> DataFrame:
    """ELTV: LTV times the remaining balance share over cumulative house-price growth."""
    if "hpi_cumul" not in panel.columns:
        panel = cumulative_hpi(panel)
    # a column a step: clipping names its argument twice, and nested it makes a method too long for the compiler
    x = panel.withColumn("__left", C.remaining_fraction("orig_rate", "loan_age", clipped=False))
    x = x.withColumn("__left", C.clip("__left", 0.0, 1.0))
    x = x.withColumn("ELTV", F.col("LTV") * F.col("__left") / F.col("hpi_cumul")).drop("__left")
    return x.withColumn("ELTV", C.clip("ELTV", 0.0, 200.0))


def counting_process(panel: DataFrame, convention: str = "start") -> DataFrame:
    """(tstart, tstop, event). "start" gives [age, age+1); "end" gives (age-1, age] and drops
    the age-0 row."""
    age = F.col("loan_age")
    if convention == "start":
        x = panel.withColumns({"tstart": age, "tstop": age + 1})
    elif convention == "end":
        x = panel.withColumns({"tstart": F.greatest(age - 1, F.lit(0)), "tstop": age}).where("tstop > tstart")
    else:
        raise ValueError(f"convention must be 'start' or 'end', got {convention!r}")
    return x.withColumn("event", F.col("prepaid_month").cast("int"))


def panel_features(panel: DataFrame) -> DataFrame:
    """Current LTV, dummies, DTI sentinel to NULL."""
    return L.replace_value(L.panel_dummies(current_ltv(panel)), "DTI", 999)


def origination_snapshot(panel: DataFrame) -> DataFrame:
    return panel.where("loan_age = 0")


def loan_exits(panel: DataFrame) -> DataFrame:
    """Duration (last age + 1) and exit flags per loan, from the panel alone."""
    return panel.groupBy("loan_id").agg(
        (F.max("loan_age") + 1).alias("duration"), F.max("prepaid_month").alias("event_prepay"))


def first_values(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    return panel.groupBy("loan_id").agg(*[F.min_by(c, "loan_age").alias(c) for c in columns])


def last_rows(panel: DataFrame, columns: Sequence[str], upto: int | None = None,
              time: str = "tstop") -> DataFrame:
    """Last row of every loan, optionally among rows with time <= upto. One max_by per column
    keeps primitive buffers and so a hash aggregate."""
    x = panel if upto is None else panel.where(F.col(time) <= upto)
    return x.groupBy("loan_id").agg(F.max(time).alias(time), *[F.max_by(c, time).alias(c) for c in columns])


def trajectories(panel: DataFrame, columns: Sequence[str] = ("rate_incentive", "ELTV"),
                 vintages: Sequence[int] | None = None, small: int = 100_000) -> DataFrame:
    """Exact median of each column by vintage and age, wide.

    Groups of at most `small` rows are ordered inside the aggregate, all columns in one pass; only
    larger ones go through the bucketed search, which never holds a group. Group sizes are one
    row per vintage and age.
    """
    x = panel if vintages is None else panel.where(F.col("vintage_year").isin(list(vintages)))
    by = ["vintage_year", "loan_age"]
    large = small_table(x.groupBy(*by).agg(F.count("*").alias("__n")).where(F.col("__n") > small).drop("__n"))
    rest = x.join(large, by, "left_anti")
    out = rest.groupBy(*by).agg(*[F.median(F.col(c).cast("double")).alias(c) for c in columns])
    if not large.isEmpty():
        long = medians(x.join(large, by, "left_semi"), list(columns), by)
        out = out.unionByName(long.groupBy(*by).pivot("column", list(columns)).agg(F.first("median")))
    return out.where(F.coalesce(*columns).isNotNull())


def sequences(panel: DataFrame, features: Sequence[str], months: int = K.SEQUENCE_MONTHS) -> DataFrame:
    """Per loan the feature rows in age order, at most `months` of them; the array length is
    the mask. The position filter comes before the collect, so an array is bounded."""
    w = W.partitionBy("loan_id").orderBy("loan_age")
    x = panel.withColumn("pos", F.row_number().over(w) - 1).where(F.col("pos") < months)
    return x.groupBy("loan_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", *features))).alias("steps"),
        F.count("*").cast("int").alias("length"))


def padded_sequences(panel: DataFrame, features: Sequence[str], months: int = K.SEQUENCE_MONTHS, fill: float = 0.0) -> DataFrame:
    """(loan_id, one array of exactly `months` values per feature, mask, length): place i holds the
    i-th month of the loan, `fill` where it is missing or beyond the end; the mask tells months
    that exist, and is what a sequence model reads."""
    x = sequences(panel, features, months)
    pad = F.greatest(F.lit(months) - F.col("length"), F.lit(0))
    out = [F.concat(F.transform(F.col("steps")[c], lambda x: F.coalesce(x.cast("double"), F.lit(float(fill)))),
                    F.array_repeat(F.lit(float(fill)), pad)).alias(c) for c in features]
    mask = F.concat(F.array_repeat(F.lit(True), F.col("length")), F.array_repeat(F.lit(False), pad))
    return x.select("loan_id", *out, mask.alias("mask"), "length")


def longest_sequences(lengths: DataFrame, by: str, n: int) -> DataFrame:
    """The n longest sequences of every class, ties by loan id."""
    w = W.partitionBy(by).orderBy(F.desc("length"), "loan_id")
    return lengths.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def archetype_paths(macro: DataFrame, first: int, last: int, months: int = K.SEQUENCE_MONTHS) -> DataFrame:
    """Feature paths of the three archetype loans over a stretch of macro history."""
    w = W.partitionBy().orderBy("yyyymm")
    m = macro.where(F.col("yyyymm").between(first, last)).withColumn(
        "loan_age", F.row_number().over(w) - 1).where(F.col("loan_age") < months)
    loans = macro.sparkSession.createDataFrame(
        [(n, float(a), float(b), float(r), float(d), float(u)) for n, a, b, r, d, u in K.ARCHETYPES],
        "loan_id string, FICO double, LTV double, orig_rate double, DTI double, UPB double")
    x = loans.crossJoin(m).withColumns({  # three loans by a few hundred months
        "LP_Purchase": F.lit(1.0), "LP_NoCashRefi": F.lit(0.0),
        "Occ_Investment": F.lit(0.0), "Occ_SecondHome": F.lit(0.0),
        "rate_incentive": F.col("orig_rate") - F.col("mortgage_rate")})
    return current_ltv(cumulative_hpi(x))
