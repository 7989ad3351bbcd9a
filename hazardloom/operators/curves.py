"""Non-parametric survival curves from one (stratum, month) aggregate.

Every function below works on the event table: a few hundred rows per stratum, so the windows
over months are tiny whatever the number of loans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from . import lookup

Z95 = 1.959963984540054


def _w(by: Sequence[str]):
    return W.partitionBy(*by).orderBy("t")


def running(expr: Column, by: Sequence[str]) -> Column:
    return F.sum(expr).over(_w(by).rowsBetween(W.unboundedPreceding, 0))


def at_risk(count: Column, by: Sequence[str]) -> Column:
    """Reverse running sum: everybody whose month is t or later."""
    return F.sum(count).over(_w(by).rowsBetween(0, W.unboundedFollowing))


def running_product(factor: Column, by: Sequence[str]) -> Column:
    """Product over months with a guard for a factor of zero."""
    frame = _w(by).rowsBetween(W.unboundedPreceding, 0)
    zero = F.min(factor).over(frame) <= 0
    logs = F.sum(F.when(factor > 0, F.log(factor)).otherwise(0.0)).over(frame)
    return F.when(zero, F.lit(0.0)).otherwise(F.exp(logs))


def event_table(df: DataFrame, time: str, events: Mapping[str, str | Column],
                by: Sequence[str] = ()) -> DataFrame:
    """(by..., t, n_exit, one count per event, at_risk).

    The month is a smallint, which bounds a stratum at 32,767 rows; the cast fails on data
    that breaks the contract instead of growing the summary.
    """
    by = list(by)
    x = df.select(*by, F.col(time).cast("smallint").cast("int").alias("t"),
                  *[(F.col(e) if isinstance(e, str) else e).cast("int").alias(n)
                    for n, e in events.items()])
    agg = x.groupBy(*by, "t").agg(
        F.count("*").alias("n_exit"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in events])
    return agg.withColumn("at_risk", at_risk(F.col("n_exit"), by))


def overall_event_table(df: DataFrame, time: str = "Duration", event: str = "Event_Prepay",
                        by: Sequence[str] = ()) -> DataFrame:
    et = event_table(df, time, {"d": event}, by)
    return et.withColumn("censored", F.col("n_exit") - F.col("d"))


def stack_strata(df: DataFrame, variables: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per (loan, stratum variable): all stratifications then share one aggregate.

    `variables` maps a label to its column. Exploding four short strings happens before the
    map-side combine, so only month counts are shuffled.
    """
    pairs = [F.struct(F.lit(label).alias("variable"), F.col(c).cast("string").alias("stratum"))
             for label, c in variables.items()]
    return df.select(*keep, F.explode(F.array(*pairs)).alias("s")).select(
        *keep, "s.*").where("stratum is not null")


def kaplan_meier(et: DataFrame, by: Sequence[str] = (), event: str = "d") -> DataFrame:
    """S(t) with 95 % log-log Greenwood bounds at each month of the event table."""
    by = list(by)
    d, n = F.col(event), F.col("at_risk")
    x = et.withColumns({
        "S": running_product(F.lit(1.0) - d / n, by),
        "__v": running(F.when(n > d, d / (n * (n - d)).cast("double")), by),
        "n_in_stratum": F.sum("n_exit").over(W.partitionBy(*by)),
        "n_events": F.sum(event).over(W.partitionBy(*by)),
    })
    s = F.col("S")
    inside = (s > 0) & (s < 1)
    spread = F.lit(Z95) * F.sqrt("__v") / F.log(F.when(inside, s))
    base = F.log(-F.log(F.when(inside, s)))
    lower = F.exp(-F.exp(base - spread))
    upper = F.exp(-F.exp(base + spread))
    return x.withColumns({
        "S_lower": F.when(s == 1, F.lit(1.0)).when(inside, lower),
        "S_upper": F.when(s == 1, F.lit(1.0)).when(inside, upper),
    }).drop("__v")


def on_grid(km: DataFrame, by: Sequence[str] = (), months=K.MONTH_GRID) -> DataFrame:
    """Step values of a Kaplan-Meier curve on the month grid; all one before the first month."""
    by = list(by)
    keep = [*by, *(["n_in_stratum", "n_events"] if by else [])]
    grid = lookup.month_grid(km.select(*keep), keep, months)
    out = lookup.step(km, grid, {"S": 1.0, "S_lower": 1.0, "S_upper": 1.0}, keep)
    return out


def median_survival(km: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First month with S <= 0.5, NULL when the curve stays above."""
    return km.groupBy(*by).agg(
        F.first("n_in_stratum").alias("n"), F.first("n_events").alias("n_events"),
        F.min(F.when(F.col("S") <= 0.5, F.col("t"))).alias("median_survival_time")).withColumn(
        "prepay_rate", F.col("n_events") / F.col("n"))


def key_months(grid: DataFrame, months: Sequence[int] = tuple(K.KEY_MONTHS)) -> DataFrame:
    return grid.where(F.col("t").isin(list(months))).select(
        "t", "S", (F.lit(100.0) * (F.lit(1.0) - F.col("S"))).alias("pct_prepaid"))


def nelson_aalen(et: DataFrame, by: Sequence[str] = (), event: str = "d", ties: str = "sum") -> DataFrame:
    """Cumulative hazard. `ties="sum"` adds d/n; `ties="split"` adds Σ_{k<d} 1/(n-k)."""
    d, n = F.col(event), F.col("at_risk")
    inc = d / n if ties == "sum" else C.harmonic_increment(n, d)
    return et.withColumn("cum_hazard", running(inc, list(by)))


def hazard_table(et: DataFrame, months: int = K.MONTH_GRID, window: int = 6,
                 na_lookup: str = "step", na_ties: str = "sum") -> DataFrame:
    """Discrete and smoothed hazard, -ln S and Nelson-Aalen on the month grid.

    The centred moving average of an even window w covers rows [-w/2, w/2 - 1].
    """
    km = kaplan_meier(et)
    na = nelson_aalen(et, ties=na_ties)
    grid = lookup.month_grid(km, [], months)
    s = lookup.step(km, grid, {"S": 1.0})
    if na_lookup == "step":
        h = lookup.step(na, grid, {"cum_hazard": 0.0})
    else:
        origin = km.sparkSession.range(1).select(F.lit(0).alias("t"), F.lit(0.0).alias("cum_hazard"))
        h = lookup.linear(na.select("t", "cum_hazard").unionByName(origin), grid, "cum_hazard")
    floor = F.lit(1e-10)
    x = s.join(h, "t").withColumn("h_discrete", F.lit(1.0) - F.col("S") / F.greatest(
        F.lag("S", 1, 1.0).over(_w([])), floor))
    lo, hi = -(window // 2), (window - 1) // 2
    return x.select(
        "t", "h_discrete", F.avg("h_discrete").over(_w([]).rowsBetween(lo, hi)).alias("h_smoothed"),
        (-F.log(F.greatest("S", floor))).alias("cum_hazard_km"),
        F.col("cum_hazard").alias("cum_hazard_na"))


def annualised_hazard(hazard: DataFrame, months: Sequence[int]) -> DataFrame:
    return hazard.where(F.col("t").isin(list(months))).select(
        "t", "h_discrete", (F.lit(100.0) * C.annualised("h_discrete")).alias("annual_pct"))


def hazard_gap(hazard: DataFrame) -> DataFrame:
    gap = F.abs(F.col("cum_hazard_km") - F.col("cum_hazard_na"))
    return hazard.agg(F.max(gap).alias("max_gap"), F.avg(gap).alias("mean_gap"))


STRATA = {"FICO": "FICO_bucket", "LTV": "LTV_bucket", "Vintage": "VintageBucket",
          "LoanPurpose": "LoanPurpose"}


def stratified_km(surv: DataFrame, variables: Mapping[str, str] = STRATA, min_n: int = 100,
                  time: str = "Duration", event: str = "Event_Prepay") -> DataFrame:
    """Kaplan-Meier of every stratum of every variable from one pass; small strata and the
    "Missing" bucket are left out."""
    by = ["variable", "stratum"]
    x = stack_strata(surv, variables, [time, event]).where("stratum <> 'Missing'")
    km = kaplan_meier(overall_event_table(x, time, event, by), by)
    return km.where(F.col("n_in_stratum") >= min_n)


def loglog_curves(surv: DataFrame, min_n: int = 100, time: str = "Duration",
                  event: str = "Event_Prepay") -> DataFrame:
    """log(t+1) against log(-log S) at the months where 0 < S < 1, for the drawn strata."""
    spec = surv.sparkSession.createDataFrame(
        [(c, title, v) for c, title, vals in K.LOGLOG_STRATA for v in vals],
        "variable string, stratum_label string, stratum string")
    columns = {c: c for c, _, _ in K.LOGLOG_STRATA}
    by = ["variable", "stratum"]
    x = stack_strata(surv, columns, [time, event])
    km = kaplan_meier(overall_event_table(x, time, event, by), by).where(
        (F.col("n_in_stratum") >= min_n) & (F.col("S") > 0) & (F.col("S") < 1))
    return km.join(spec, by).select(
        F.col("variable").alias("stratum_var"), "stratum_label", "stratum", "n_in_stratum", "t",
        F.log(F.col("t") + F.lit(1)).alias("log_t"), "S",
        F.log(-F.log("S")).alias("log_log_S"))


def censoring_survival(df: DataFrame, time: str, any_event: str | Column) -> DataFrame:
    """Kaplan-Meier G(t) of the censoring times."""
    e = F.col(any_event) if isinstance(any_event, str) else any_event
    et = event_table(df, time, {"d": (e == 0).cast("int")})
    return kaplan_meier(et).select("t", F.col("S").alias("G"))
