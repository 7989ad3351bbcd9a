"""Horizon and landmark labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K

MODES = ("cause_specific", "binary")


def horizon_target(horizon: int, mode: str = "cause_specific") -> Column:
    """1 prepaid by T, 0 observed through T, NULL when unknown.

    Another termination by T is unknown in cause-specific mode and 0 in binary mode.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    d, event = F.col("Duration"), F.col("Event_Prepay") == 1
    other = F.col("Terminated") & (F.col("Event_Prepay") == 0) & (d <= horizon)
    known = F.when(event & (d <= horizon), 1.0)
    if mode == "cause_specific":
        return known.when((d >= horizon) & ~other, 0.0)
    return known.when((d >= horizon) | other, 0.0)


def horizon_targets(df: DataFrame, horizons: Sequence[int] = tuple(K.HORIZONS),
                    mode: str = "cause_specific", cutoff: int = K.DATA_CUTOFF) -> DataFrame:
    """Adds Target_T<h> for every horizon and MaxObsMonths, the calendar window up to the
    cutoff month."""
    window = C.month_number(F.lit(cutoff)) - C.month_number("FirstPaymentDate")
    return df.withColumns({"MaxObsMonths": window.cast("int"),
                           **{f"Target_T{h}": horizon_target(h, mode) for h in horizons}})


def observed_window(df: DataFrame, horizon: int) -> DataFrame:
    """Optional filter: the calendar window must reach the horizon."""
    return df.where(F.col("MaxObsMonths") >= horizon)


def target_counts(df: DataFrame, horizons: Sequence[int] = tuple(K.HORIZONS)) -> DataFrame:
    """Positives, negatives and unknowns per horizon, long."""
    one = df.agg(*[a for h in horizons for a in (
        F.count_if(F.col(f"Target_T{h}") == 1).alias(f"p{h}"),
        F.count_if(F.col(f"Target_T{h}") == 0).alias(f"n{h}"),
        F.count_if(F.col(f"Target_T{h}").isNull()).alias(f"u{h}"))])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"p{h}").alias("positives"),
                 F.col(f"n{h}").alias("negatives"), F.col(f"u{h}").alias("unknown"))
        for h in horizons])).alias("r")).select("r.*")


def landmark(df: DataFrame, horizons: Sequence[int], time: str, event: str) -> DataFrame:
    """One row per (row, horizon): time capped at the horizon, event only if it came by then."""
    x = df.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return x.withColumns({
        "time_h": F.least(F.col(time), F.col("horizon")).cast("int"),
        "event_h": C.flag((F.col(event) == 1) & (F.col(time) <= F.col("horizon")))})


def cause_by(time: str, cause: str, k: int, horizon: int | Column) -> Column:
    """Label of the horizon metrics: cause k happened by the horizon."""
    h = F.lit(horizon) if isinstance(horizon, int) else horizon
    return C.flag((F.col(cause) == k) & (F.col(time) <= h))


def truncate(df: DataFrame, months: int = K.SEQUENCE_MONTHS, time: str = "duration",
             cause: str = "event_type") -> DataFrame:
    """Cap durations at months-1; a later exit counts as censored there."""
    late = F.col(time) > months - 1
    return df.withColumns({
        "eff_duration": F.least(F.col(time), F.lit(months - 1)).cast("int"),
        "eff_event": F.when(late, 0).otherwise(F.col(cause)).cast("int")})
