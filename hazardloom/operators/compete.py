"""Competing risks: Aalen-Johansen incidence, its bias against Kaplan-Meier, discrete-time
incidence from monthly hazards and the evaluation losses built on it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..functions import constants as K
from . import curves, lookup


def cause_table(df: DataFrame, time: str = "duration", cause: str = "event_type",
                by: Sequence[str] = ()) -> DataFrame:
    """Event table with one count per cause (d1 = prepaid, d2 = defaulted)."""
    return curves.event_table(df, time, {
        "d1": (F.col(cause) == 1).cast("int"), "d2": (F.col(cause) == 2).cast("int")}, by)


def aalen_johansen(et: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F_k(t) = Σ S(s-)·d_k/n with S from all exits by either cause."""
    by = list(by)
    n = F.col("at_risk")
    x = et.withColumn("S", curves.running_product(
        F.lit(1.0) - (F.col("d1") + F.col("d2")) / n, by))
    prev = F.lag("S", 1, 1.0).over(W.partitionBy(*by).orderBy("t"))
    x = x.withColumn("__prev", prev)
    return x.withColumns({
        f"cif{k}": curves.running(F.col("__prev") * F.col(f"d{k}") / n, by) for k in (1, 2)
    }).drop("__prev")


def partition_check(aj: DataFrame) -> DataFrame:
    """Largest deviation of F_1 + F_2 + S from one."""
    gap = F.abs(F.col("cif1") + F.col("cif2") + F.col("S") - F.lit(1.0))
    return aj.agg(F.max(gap).alias("max_gap"), F.count("*").alias("n_months"))


def km_bias(et: DataFrame) -> DataFrame:
    """1 - KM of cause 1 (competing exits censored) against its Aalen-Johansen incidence."""
    km = curves.kaplan_meier(et, event="d1").select("t", (F.lit(1.0) - F.col("S")).alias("km"))
    aj = aalen_johansen(et).select("t", F.col("cif1").alias("aj"))
    return km.join(aj, "t").withColumn("bias", F.col("km") - F.col("aj"))


def bias_at(bias: DataFrame, horizons: Sequence[int] = (60, 120, 240)) -> DataFrame:
    grid = lookup.month_grid(bias, [], list(horizons))
    return lookup.step(bias, grid, {"km": 0.0, "aj": 0.0, "bias": 0.0}).withColumn(
        "bias_pp", F.col("bias") * F.lit(100.0)).withColumnRenamed("t", "horizon")


def stratified_incidence(df: DataFrame, variables: dict[str, str], min_rows: int = 50,
                         min_events: int = 10, min_at_risk: int = 500,
                         time: str = "duration", cause: str = "event_type") -> DataFrame:
    """Incidence per stratum and cause, long; a stratum needs enough rows and events of the
    cause, and its curve stops at the last month with enough loans at risk (it is kept whole
    when no month has that many)."""
    by = ["variable", "stratum"]
    x = curves.stack_strata(df, variables, [time, cause])
    aj = aalen_johansen(cause_table(x, time, cause, by), by)
    w = W.partitionBy(*by)
    full = aj.withColumns({
        "n": F.sum("n_exit").over(w),
        "events1": F.sum("d1").over(w), "events2": F.sum("d2").over(w),
        "last_t": F.max(F.when(F.col("at_risk") >= min_at_risk, F.col("t"))).over(w),
    })
    long = full.select(*by, "t", "at_risk", "n", "last_t", F.explode(F.array(*[
        F.struct(F.lit(k).alias("cause"), F.col(f"cif{k}").alias("cif"),
                 F.col(f"events{k}").alias("n_events")) for k in (1, 2)])).alias("c"))
    return long.select(*by, "c.*", "t", "at_risk", "n", "last_t").where(
        (F.col("n") >= min_rows) & (F.col("n_events") >= min_events)
        & (F.col("last_t").isNull() | (F.col("t") <= F.col("last_t")))).drop("last_t")


# --- discrete time, per loan ----------------------------------------------------------
EPS = 1e-7


#: Months whose running sums are formed at once; a longer path is taken whole.
PIECE = 1 << 17


def chain_products(l1: np.ndarray, l2: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """S, F1 and F2 after each month for paths laid end to end, each from its place in `start`."""
    l1, l2 = (np.clip(np.nan_to_num(x, nan=0.0), EPS, 1 - EPS) for x in (l1, l2))
    path = np.zeros(len(l1), np.int64)
    path[start[start < len(l1)]] = 1
    path = np.cumsum(path) - 1
    first = np.flatnonzero(np.diff(path, prepend=-1))

    def within(x):
        total = np.cumsum(x)
        return total - (total[first] - x[first])[path]

    logs = np.log1p(-l1) + np.log1p(-l2)
    after = within(logs)
    before = np.exp(after - logs)
    return np.exp(after), within(l1 * before), within(l2 * before)


def incidence_arrays(df: DataFrame, h1: str, h2: str, name: str = "path") -> DataFrame:
    """Chain-product incidence for rows that hold both hazard paths as arrays of equal length:
    adds array<struct<s, f1, f2>>, as long as the paths.

    Paths of an Arrow batch lie end to end, so a few running sums serve all of them and the work
    is linear in their length. A NULL path stays NULL, a NULL hazard counts as none.
    """
    kind = "array<struct<s: double, f1: double, f2: double>>"
    item = pa.struct([("s", pa.float64()), ("f1", pa.float64()), ("f2", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, c = (b.column(x).cast(pa.list_(pa.float64())) for x in (h1, h2))
            known = pc.and_(a.is_valid(), c.is_valid()).to_numpy(zero_copy_only=False)
            length = pc.fill_null(pc.list_value_length(a), 0).to_numpy() * known
            if (length != pc.fill_null(pc.list_value_length(c), 0).to_numpy() * known).any():
                raise ValueError(f"{h1} and {h2} must be of equal length")
            mask = pa.array(known)
            flat = [np.asarray(x.filter(mask).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), float) for x in (a, c)]
            offsets = np.concatenate([[0], np.cumsum(length)])
            out = [np.empty(offsets[-1]) for _ in range(3)]
            low = 0
            while low < b.num_rows:  # pieces of whole paths
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, side="right")) - 1)
                part = slice(offsets[low], offsets[high])
                if part.stop > part.start:
                    starts = offsets[low:high][length[low:high] > 0] - offsets[low]
                    for x, y in zip(out, chain_products(flat[0][part], flat[1][part], starts)):
                        x[part] = y
                low = high
            values = pa.StructArray.from_arrays([pa.array(x) for x in out], fields=list(item))
            path = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=pa.array(~known))
            yield pa.RecordBatch.from_arrays([*b.columns, path], [*b.schema.names, name])

    schema = StructType([*df.schema.fields, StructField(name, _parse_datatype_string(kind))])
    return df.mapInArrow(run, schema)


def incidence_rows(panel: DataFrame, loan: str, month: str, h1: str, h2: str) -> DataFrame:
    """Chain-product incidence for a loan-month table: CIF_k(t) = Σ λ_k(s)·S(s-1).

    One window spec serves all columns, and it keeps the partitioning of a panel that is
    already distributed by loan.
    """
    def clamp(c):
        return F.greatest(F.least(F.col(c), F.lit(1 - EPS)), F.lit(EPS))

    w = W.partitionBy(loan).orderBy(month)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    before = w.rowsBetween(W.unboundedPreceding, -1)
    l1, l2 = clamp(h1), clamp(h2)
    logs = F.log1p(-l1) + F.log1p(-l2)
    x = panel.withColumn("S_prev", F.exp(F.coalesce(F.sum(logs).over(before), F.lit(0.0))))
    return x.withColumns({
        "S": F.col("S_prev") * (F.lit(1.0) - l1) * (F.lit(1.0) - l2),
        "cif1": F.sum(l1 * F.col("S_prev")).over(upto),
        "cif2": F.sum(l2 * F.col("S_prev")).over(upto),
    }).drop("S_prev")


def _nlls(panel: DataFrame, loan: str, month: str, hazards: Sequence[str], time: str, cause: str,
          causes: Sequence[int]) -> DataFrame:
    """One row with nll<k> of every cause k, all from one pass."""
    before = F.col(month) < F.col(time)
    at = F.col(month) == F.col(time)
    aggs = [F.greatest(F.count_if(before), F.lit(1)).alias("__m")]
    for h, k in zip(hazards, causes):
        lam = F.greatest(F.least(F.col(h), F.lit(1 - EPS)), F.lit(EPS))
        point = F.when(F.col(cause) == k, -F.log(lam)).otherwise(-F.log1p(-lam))
        aggs += [F.coalesce(F.sum(F.when(before, -F.log1p(-lam))), F.lit(0.0)).alias(f"__s{k}"),
                 F.max(F.when(at, point)).alias(f"__p{k}")]
    return panel.groupBy(loan).agg(*aggs).agg(*[
        (F.avg(F.col(f"__s{k}") / F.col("__m")) + F.avg(f"__p{k}")).alias(f"nll{k}") for k in causes])


def cause_nll(panel: DataFrame, loan: str, month: str, hazard: str, time: str, cause: str,
              k: int) -> DataFrame:
    """Discrete cause-specific negative log-likelihood: mean over loans of the survival term
    averaged over the months before the exit, plus the mean point term at the exit month.

    `time` is the exit month index of the loan on the same scale as `month`.
    """
    return _nlls(panel, loan, month, [hazard], time, cause, [k]).select(F.col(f"nll{k}").alias("nll"))


def _rankings(panel: DataFrame, month: str, cifs: Sequence[str], time: str, cause: str,
              causes: Sequence[int], sigma: float) -> DataFrame:
    """One row with rank<k> of every cause k, all from one total per month and cause."""
    later, now = F.col(time) > F.col(month), F.col(time) == F.col(month)
    cells, out = [], []
    for c, k in zip(cifs, causes):
        e, of = F.exp(F.col(c) / F.lit(sigma)), F.col(cause) == k
        cells += [F.sum(F.when(of & later, e)).alias(f"__g{k}"), F.count_if(of & later).alias(f"__m{k}"),
                  F.sum(F.when(of & now, F.lit(1.0) / e)).alias(f"__own{k}"), F.count_if(of & now).alias(f"__n{k}")]
        valid = F.col(f"__m{k}") > 0
        out.append(F.coalesce(F.try_divide(
            F.sum(F.when(valid, F.col(f"__own{k}") * F.col(f"__g{k}") / F.col(f"__m{k}"))),
            F.sum(F.when(valid, F.col(f"__n{k}")))), F.lit(0.0)).alias(f"rank{k}"))
    return panel.where(F.col(cause).isin(*causes)).groupBy(month).agg(*cells).agg(*out)


def ranking_loss(panel: DataFrame, loan: str, month: str, cif: str, time: str, cause: str,
                 k: int, sigma: float = K.RANKING_SIGMA) -> DataFrame:
    """Soft pairwise ranking loss over every pair of cause-k loans with t_j > t_i.

    exp((F_j(t_i) - F_i(t_i))/σ) factors into a term of j and a term of i, so the sum over
    all partners of a loan is one total per month. The result is the loss over all pairs, no
    pair is formed and none is left out.
    """
    return _rankings(panel, month, [cif], time, cause, [k], sigma).select(F.col(f"rank{k}").alias("ranking_loss"))


def total_loss(panel: DataFrame, loan: str, month: str, time: str, cause: str,
               hazards=("h1", "h2"), cifs=("cif1", "cif2"), alpha: float = K.RANKING_WEIGHT) -> DataFrame:
    """NLL of both causes plus α times the ranking losses, one row: one pass by loan, one by month."""
    causes = range(1, len(hazards) + 1)
    one = _nlls(panel, loan, month, hazards, time, cause, causes).crossJoin(
        _rankings(panel, month, cifs, time, cause, causes, K.RANKING_SIGMA))  # one row each
    return one.select("nll1", "rank1", "nll2", "rank2").withColumn(
        "total_loss", F.col("nll1") + F.col("nll2") + F.lit(alpha) * (F.col("rank1") + F.col("rank2")))
