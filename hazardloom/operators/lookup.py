"""Step, nearest and linear lookups into small curve tables keyed by an integer month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def month_grid(curve: DataFrame, by: Sequence[str], months, time: str = "t") -> DataFrame:
    """Every (group, month); `months` is an upper bound (1..months) or a list of months."""
    grid = F.sequence(F.lit(1), F.lit(months)) if isinstance(months, int) else F.array(
        *[F.lit(int(m)) for m in months])
    if by:
        return curve.select(*by).distinct().select(*by, F.explode(grid).alias(time))
    return curve.sparkSession.range(1).select(F.explode(grid).alias(time))


def step(curve: DataFrame, grid: DataFrame, columns: dict[str, float | None], by: Sequence[str] = (),
         time: str = "t") -> DataFrame:
    """Value at the largest curve time <= grid time; the given default before the first one.

    The union of grid and curve rows is ordered once per group, so no range join is needed.
    """
    by = list(by)
    g = grid.select(*by, F.col(time).cast("int").alias(time), F.lit(True).alias("__grid"))
    c = curve.select(*by, F.col(time).cast("int").alias(time), F.lit(False).alias("__grid"),
                     F.struct(*columns).alias("__v"))
    both = g.unionByName(c, allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy(time, "__grid").rowsBetween(W.unboundedPreceding, 0)
    held = both.withColumn("__v", F.last("__v", ignorenulls=True).over(w)).where("__grid")
    out = []
    for name, default in columns.items():
        v = F.col("__v")[name]
        out.append((v if default is None else
                    F.when(F.col("__v").isNull(), F.lit(default)).otherwise(v)).alias(name))
    return held.select(*by, time, *out)


def nearest(curve: DataFrame, at: Sequence[int], value: str, by: Sequence[str] = (),
            time: str = "t") -> DataFrame:
    """Value at the curve time closest to each requested time (the earlier one on a tie)."""
    by = list(by)
    wanted = F.explode(F.array(*[F.lit(int(a)) for a in at]))
    x = curve.select(*by, F.col(time).cast("int").alias("__t"), value).withColumn("at", wanted)
    rank = F.abs(F.col("__t") - F.col("at")).cast("bigint") * F.lit(1 << 20) + F.col("__t")
    return x.groupBy(*by, "at").agg(F.min_by("__t", rank).alias("t_used"),
                                    F.min_by(value, rank).alias(value))


def linear(curve: DataFrame, grid: DataFrame, value: str, by: Sequence[str] = (),
           time: str = "t", left: float = 0.0) -> DataFrame:
    """Linear interpolation between curve points, `left` before the first point and the last
    value after the last one."""
    by = list(by)
    g = grid.select(*by, F.col(time).cast("double").alias(time), F.lit(1).alias("__grid"))
    c = curve.select(*by, F.col(time).cast("double").alias(time), F.lit(0).alias("__grid"),
                     F.struct(F.col(time).cast("double").alias("t"), F.col(value).alias("v")).alias("__p"))
    both = g.unionByName(c, allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy(time, "__grid")
    x = both.withColumns({
        "__a": F.last("__p", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)),
        "__b": F.first("__p", ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)),
    }).where("__grid = 1")
    a, b = F.col("__a"), F.col("__b")
    v = (F.when(a.isNull(), F.lit(left)).when(b.isNull(), a["v"])
         .otherwise(a["v"] + (b["v"] - a["v"]) * (F.col(time) - a["t"]) / (b["t"] - a["t"])))
    return x.select(*by, F.col(time).cast("int").alias(time), v.alias(value))
