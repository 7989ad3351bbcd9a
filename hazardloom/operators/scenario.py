"""Rate-shock scenarios: survival paths, prepayment speeds and loan cash flows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K


def shock_table(spark: SparkSession, shocks: Sequence[int] = tuple(K.SHOCKS_BP),
                coupon: float = K.COUPON_PCT, market: float = K.MARKET_PCT) -> DataFrame:
    """(shock_bp, market, rate_incentive) of every scenario."""
    return spark.createDataFrame([(int(s),) for s in shocks], "shock_bp int").select(
        "shock_bp", (F.lit(market) + F.col("shock_bp") / F.lit(100.0)).alias("market"),
        (F.lit(coupon) - (F.lit(market) + F.col("shock_bp") / F.lit(100.0))).alias("rate_incentive"))


def representative_eta(beta: Mapping[str, float], loan: Mapping[str, float] = K.REPRESENTATIVE_LOAN) -> Column:
    """β·x with the held-fixed values, the rate incentive taken from the row."""
    fixed = sum(beta[n] * loan[n] for n in beta if n != "rate_incentive")
    return F.lit(float(fixed)) + F.lit(float(beta["rate_incentive"])) * F.col("rate_incentive")


def shock_response(shocks: DataFrame, beta: Mapping[str, float]) -> DataFrame:
    """Change of log-hazard against the unshocked scenario and its closed form -β·Δr/100."""
    x = shocks.withColumn("log_hazard", representative_eta(beta))
    base = x.where("shock_bp = 0").select(F.col("log_hazard").alias("__b"))
    return x.crossJoin(base).select(  # base is one row
        "shock_bp", "rate_incentive", "log_hazard",
        (F.col("log_hazard") - F.col("__b")).alias("delta"),
        (-F.lit(float(beta["rate_incentive"])) * F.col("shock_bp") / F.lit(100.0)).alias("analytic"))


def covariate_shock(loans: DataFrame, shocks: DataFrame, beta: Mapping[str, float], column: str,
                    std: float) -> DataFrame:
    """Mean score change when a standardised static covariate moves by shock/100/std."""
    x = loans.select(C.linear_score(beta).alias("__eta"))
    base = x.agg(F.avg("__eta").alias("base_score"), F.count("*").alias("n"))
    move = F.lit(float(beta[column])) * F.col("shock_bp") / F.lit(100.0) / F.lit(std)
    return shocks.crossJoin(base).select(  # base is one row
        "shock_bp", "n", (F.col("base_score") + move).alias("mean_score"), move.alias("delta"))


def monthly_increments(baseline: DataFrame, months: int = K.SCENARIO_MONTHS) -> DataFrame:
    """Baseline hazard increment of every month 1..months: cumulative hazard interpolated on
    the grid (0 before the first event, flat after the last), then first differences."""
    from .lookup import linear, month_grid

    grid = month_grid(baseline, [], months)
    h = linear(baseline, grid, "H0")
    w = W.partitionBy().orderBy("t")
    return h.select("t", (F.col("H0") - F.lag("H0", 1, 0.0).over(w)).alias("h0"))


def survival_paths(scenarios: DataFrame, increments: DataFrame, eta: Column, by: Sequence[str] = ("shock_bp",)) -> DataFrame:
    """Monthly hazard and S(t) = exp(-Σ Δ H0·e^η) for every scenario row."""
    x = scenarios.withColumn("__eta", eta).crossJoin(increments)  # scenarios × months
    x = x.withColumn("hazard", F.col("h0") * F.exp("__eta"))
    w = W.partitionBy(*by).orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    return x.select(*by, "t", "hazard", F.exp(-F.sum("hazard").over(w)).alias("S"))


def path_summary(paths: DataFrame, by: str = "shock_bp") -> DataFrame:
    """Survival at the last month and the first month below one half (NULL if none)."""
    return paths.groupBy(by).agg(
        F.max_by("S", "t").alias("S_end"),
        F.min(F.when(F.col("S") < 0.5, F.col("t"))).alias("median_month"))


def increment_at(increments: DataFrame, age: int = K.PEAK_AGE) -> DataFrame:
    return increments.where(F.col("t") == age).select(F.col("h0").alias("__h0"))


def linspace(spark: SparkSession, low: float, high: float, n: int, name: str) -> DataFrame:
    step = F.lit((high - low) / (n - 1))
    return spark.range(n).select(F.col("id").cast("int").alias(f"{name}_i"),
                                 (F.lit(low) + F.col("id") * step).alias(name))


def cpr_sweep(spark: SparkSession, increments: DataFrame, beta: Mapping[str, float], low: float = -3.0,
              high: float = 4.0, n: int = 80, age: int = K.PEAK_AGE) -> DataFrame:
    """SMM and annual CPR along a sweep of the rate incentive, with its slope per basis point."""
    x = linspace(spark, low, high, n, "rate_incentive").crossJoin(increment_at(increments, age))  # one row
    x = x.withColumn("smm", F.col("__h0") * F.exp(representative_eta(beta)))
    x = x.withColumn("cpr", F.lit(100.0) * C.annualised("smm"))
    w = W.partitionBy().orderBy("rate_incentive_i")
    up = F.coalesce(F.lead("cpr").over(w), F.col("cpr"))
    down = F.coalesce(F.lag("cpr").over(w), F.col("cpr"))
    x_up = F.coalesce(F.lead("rate_incentive").over(w), F.col("rate_incentive"))
    x_down = F.coalesce(F.lag("rate_incentive").over(w), F.col("rate_incentive"))
    return x.select("rate_incentive_i", "rate_incentive", "smm", "cpr",
                    ((up - down) / ((x_up - x_down) * F.lit(100.0))).alias("slope"))


def sweep_summary(sweep: DataFrame) -> DataFrame:
    nearest = F.abs("rate_incentive")
    return sweep.agg(
        F.min_by("cpr", "rate_incentive_i").alias("cpr_low"), F.min_by("cpr", nearest).alias("cpr_zero"),
        F.max_by("cpr", "rate_incentive_i").alias("cpr_high"), F.min_by("slope", nearest).alias("slope_zero"))


def cpr_surface(spark: SparkSession, increments: DataFrame, beta: Mapping[str, float], axis: str,
                low: float, high: float, n: int = 45, age: int = K.PEAK_AGE) -> DataFrame:
    """CPR on a grid of the rate incentive against one other covariate."""
    a = linspace(spark, -3.0, 4.0, n, "rate_incentive")
    b = linspace(spark, low, high, n, axis)
    x = a.crossJoin(b).crossJoin(increment_at(increments, age))  # n × n points
    fixed = {k: v for k, v in K.REPRESENTATIVE_LOAN.items() if k != axis}
    eta = F.lit(float(sum(beta[k] * v for k, v in fixed.items() if k in beta)))
    eta = eta + F.lit(beta["rate_incentive"]) * F.col("rate_incentive") + F.lit(beta[axis]) * F.col(axis)
    return x.select("rate_incentive_i", f"{axis}_i", "rate_incentive", axis,
                    (F.lit(100.0) * C.annualised(F.col("__h0") * F.exp(eta))).alias("cpr"))


def rate_paths(spark: SparkSession, n: int = K.PATHS, sigma_bp: float = K.PATH_SIGMA_BP) -> DataFrame:
    """(path, noise_bp): one constant perturbation per path at evenly spaced normal quantiles."""
    nd = NormalDist()
    return spark.createDataFrame(
        [(i, sigma_bp * nd.inv_cdf((i - 0.5) / n)) for i in range(1, n + 1)], "path int, noise_bp double")


def perturbed_scenarios(shocks: DataFrame, paths: DataFrame, coupon: float = K.COUPON_PCT) -> DataFrame:
    """Every scenario with every path; discounting stays at the unperturbed market rate."""
    return shocks.crossJoin(paths).withColumn(  # scenarios × paths
        "rate_incentive", F.lit(coupon) - (F.col("market") + F.col("noise_bp") / F.lit(100.0)))


def hazard_array(increments: DataFrame) -> list[float]:
    """Increments as a list in month order (one value per month of the projection)."""
    return [r["h0"] for r in increments.orderBy("t").collect()]


def smm_array(h0: Sequence[float], eta: Column) -> Column:
    """Monthly prepayment rates of a row as an array, clipped to [0, 1]."""
    base = F.array(*[F.lit(float(h)) for h in h0])
    return F.transform(base, lambda h: F.least(F.greatest(h * F.exp(eta), F.lit(0.0)), F.lit(1.0)))


def cash_flows(df: DataFrame, h0: Sequence[float], eta: Column, coupon: Column, discount: Column,
               face: Column, term: int = 360) -> DataFrame:
    """Adds `wal` (years) and `price` (per 100 face) of a level-pay loan that prepays at the
    clipped monthly rate h0(t)·e^eta.

    The balance recursion never leaves a row, so this is a map without a shuffle over loan ×
    scenario rows. The month loop runs on whole Arrow batches; an array fold in SQL is
    interpreted per element and was about fifty times slower. The balance left at the last
    month is paid then; a balance below one is settled.
    """
    steps = [float(h) for h in h0]

    @F.pandas_udf("wal double, price double")
    def project(eta: pd.Series, coupon: pd.Series, discount: pd.Series, face: pd.Series) -> pd.DataFrame:
        mc, md = coupon.to_numpy() / 1200.0, discount.to_numpy() / 1200.0
        f, speed = face.to_numpy(), np.exp(eta.to_numpy())
        pay = f * mc / (1.0 - (1.0 + mc) ** -term)
        bal, wal, pv = f.copy(), np.zeros(len(f)), np.zeros(len(f))
        for t, h in enumerate(steps, start=1):
            live = bal >= 1
            interest = bal * mc
            sched = np.minimum(pay - interest, bal)
            paid = sched + np.clip(h * speed, 0.0, 1.0) * np.maximum(bal - sched, 0.0)
            wal += np.where(live, t / 12.0 * paid, 0.0)
            pv += np.where(live, (interest + paid) / (1.0 + md) ** t, 0.0)
            bal = np.where(live, bal - paid, bal)
        end, left = len(steps), np.where(bal >= 1, bal, 0.0)
        wal += end / 12.0 * left
        pv += left / (1.0 + md) ** end
        return pd.DataFrame({"wal": wal / f, "price": pv / f * 100.0})

    args = [c.cast("double") for c in (eta, coupon, discount, face)]
    x = df.withColumn("__r", project(*args))
    return x.withColumns({"wal": F.col("__r.wal"), "price": F.col("__r.price")}).drop("__r")


def scenario_summary(flows: DataFrame, by: str = "shock_bp") -> DataFrame:
    return flows.groupBy(by).agg(
        F.count("*").alias("n"),
        F.avg("wal").alias("wal_mean"), F.stddev_pop("wal").alias("wal_std"),
        F.avg("price").alias("price_mean"), F.stddev_pop("price").alias("price_std"))


def cpr_profile(flows: DataFrame, smm: str = "smm", by: str = "shock_bp") -> DataFrame:
    """Annual CPR of the mean monthly rate, by scenario and month."""
    x = flows.select(by, F.posexplode(smm).alias("pos", "rate"))
    return x.groupBy(by, (F.col("pos") + 1).cast("int").alias("t")).agg(F.avg("rate").alias("smm_mean")).withColumn(
        "cpr", F.lit(100.0) * C.annualised("smm_mean"))


def rate_risk(summary: DataFrame, price: str = "price_mean") -> DataFrame:
    """Modified duration and convexity from the ±100 and ±200 bp prices."""
    p = {s: F.max(F.when(F.col("shock_bp") == s, F.col(price))).alias(f"p{i}")
         for i, s in enumerate((-200, -100, 0, 100, 200))}
    x = summary.agg(*p.values())
    m2, m1, p0, p1, p2 = (F.col(f"p{i}") for i in range(5))
    return x.select(
        (-(p1 - m1) / (F.lit(2.0) * p0 * F.lit(0.01))).alias("duration_100"),
        ((p1 + m1 - F.lit(2.0) * p0) / (p0 * F.lit(0.0001))).alias("convexity_100"),
        (-(p2 - m2) / (F.lit(2.0) * p0 * F.lit(0.02))).alias("duration_200"),
        ((p2 + m2 - F.lit(2.0) * p0) / (p0 * F.lit(0.0004))).alias("convexity_200"))
