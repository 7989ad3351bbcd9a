"""Ranking, calibration and concordance metrics from score counts.

Rows are first reduced to (group, score) -> positives, negatives. Everything that follows
(AUC, ROC, Brier, log-loss, calibration, lift) is computed from those counts with the
bucketed running totals of `ordered`, so neither a heavy score nor a heavy group ends up in
one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..sources.staging import stage
from . import targets
from .ordered import quantiles, running_totals

CLIP = 1e-7


def predictions_long(wide: DataFrame, models: Sequence[str], horizons: Sequence[int],
                     keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., model, horizon, y, p) from pred_<model>_T<h> and Target_T<h> columns; rows with
    an unknown target are dropped, a missing score stays NULL."""
    cells = [F.struct(F.lit(m).alias("model"), F.lit(h).alias("horizon"),
                      F.col(f"Target_T{h}").cast("int").alias("y"),
                      F.col(f"pred_{m}_T{h}").cast("double").alias("p"))
             for m in models for h in horizons if f"pred_{m}_T{h}" in wide.columns]
    return wide.select(*keep, F.explode(F.array(*cells)).alias("c")).select(
        *keep, "c.*").where("y is not null")


def score_counts(long: DataFrame, by: Sequence[str], label: str = "y", score: str = "p") -> DataFrame:
    return long.groupBy(*by, F.col(score).cast("double").alias("p")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def metrics_from_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """auc, brier, log_loss, accuracy, n, n_events; the first four are NULL for one class."""
    by = list(by)
    run = running_totals(counts, by, "p", ["neg"])
    pc = C.clip("p", CLIP, 1 - CLIP)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    agg = run.groupBy(*by).agg(
        F.sum(pos * (F.col("neg__before") + neg / 2)).alias("__u"),
        F.sum(pos * F.pow(F.lit(1.0) - pc, F.lit(2)) + neg * pc * pc).alias("__b"),
        F.sum(-pos * F.log(pc) - neg * F.log1p(-pc)).alias("__l"),
        F.sum(F.when(pc >= 0.5, pos).otherwise(neg)).alias("__a"),
        F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    n, p = F.col("__p") + F.col("__n"), F.col("__p")
    both = (F.col("__p") > 0) & (F.col("__n") > 0)
    return agg.select(
        *by,
        F.when(both, F.col("__u") / (p.cast("double") * F.col("__n"))).alias("auc"),
        F.when(both, F.col("__b") / n).alias("brier"),
        F.when(both, F.col("__l") / n).alias("log_loss"),
        F.when(both, F.col("__a") / n).alias("accuracy"),
        n.alias("n"), p.alias("n_events"))


def binary_metrics(long: DataFrame, by: Sequence[str] = (), label: str = "y", score: str = "p") -> DataFrame:
    x = long.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    return metrics_from_counts(score_counts(x, by, label, score), by)


def stratified_metrics(long: DataFrame, strata: Mapping[str, str], min_n: int = 100,
                       allowed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Metrics overall and by every stratum, long (model, horizon, stratum_type, stratum_value).

    One count per (model, horizon, strata, score) feeds the grouping sets; a stratum is kept
    when it has `min_n` rows with a known target, scored or not. `allowed` limits the values of
    a stratum type.
    """
    cols = list(strata.values())
    fine = score_counts(long, ["model", "horizon", *cols])
    sets = [F.struct(F.lit("all").alias("stratum_type"), F.lit("all").alias("stratum_value"))]
    sets += [F.struct(F.lit(t).alias("stratum_type"), F.col(c).cast("string").alias("stratum_value"))
             for t, c in strata.items()]
    by = ["model", "horizon", "stratum_type", "stratum_value"]
    x = fine.select("model", "horizon", "p", "pos", "neg", F.explode(F.array(*sets)).alias("s")).select(
        "model", "horizon", "s.*", "p", "pos", "neg").where("stratum_value is not null")
    for t, values in (allowed or {}).items():
        x = x.where((F.col("stratum_type") != t) | F.col("stratum_value").isin(list(values)))
    counts = x.groupBy(*by, "p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sizes = counts.groupBy(*by).agg(F.sum(F.col("pos") + F.col("neg")).alias("__n"))
    keep = sizes.where((F.col("__n") >= min_n) | (F.col("stratum_type") == "all")).select(*by)
    return metrics_from_counts(counts.where("p is not null").join(keep, by, "left_semi"), by)


def pooled_errors(long: DataFrame) -> DataFrame:
    """Brier and accuracy as SQL grouping sets over model, horizon and vintage."""
    pc = C.clip("p", CLIP, 1 - CLIP)
    hit = F.when(pc >= 0.5, F.col("y")).otherwise(1 - F.col("y"))
    x = long.where("p is not null")
    return x.groupingSets(
        [["model", "horizon"], ["model", "horizon", "VintageYear"], ["model"]],
        "model", "horizon", "VintageYear").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"),
        F.avg(F.pow(pc - F.col("y"), F.lit(2))).alias("brier"), F.avg(hit).alias("accuracy"))


def roc_points(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, fpr, tpr): one point per distinct score, rows with p >= threshold."""
    by = list(by)
    counts = score_counts(long.where("p is not null"), by)
    run = running_totals(counts, by, "p", ["pos", "neg"])
    total = counts.groupBy(*by).agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    x = run.join(total, by) if by else run.crossJoin(total)  # total has one row per group
    return x.select(
        *by, F.col("p").alias("threshold"),
        F.try_divide(F.col("__n") - F.col("neg__before"), F.col("__n")).alias("fpr"),
        F.try_divide(F.col("__p") - F.col("pos__before"), F.col("__p")).alias("tpr"))


def calibration(long: DataFrame, by: Sequence[str] = ("model", "horizon"), bins: int = 10) -> DataFrame:
    """Equal-frequency bins on exact quantile edges, repeated edges dropped, right-closed."""
    by = list(by)
    x = long.where("p is not null")
    edges = quantiles(x, ["p"], [i / bins for i in range(bins + 1)], by).select(
        *by, F.array_distinct("q").alias("__edges"))
    counts = score_counts(x, by)
    joined = counts.join(edges, by) if by else counts.crossJoin(edges)  # edges: one row per group
    b = F.greatest(F.size(F.filter("__edges", lambda e: e < F.col("p"))) - 1, F.lit(0))
    n = F.col("pos") + F.col("neg")
    return joined.withColumn("bin", b.cast("int")).groupBy(*by, "bin").agg(
        (F.sum(F.col("p") * n) / F.sum(n)).alias("pred_mean"),
        (F.sum("pos") / F.sum(n)).alias("observed_rate"),
        F.min("p").alias("pred_lower"), F.max("p").alias("pred_upper"), F.sum(n).alias("n_in_bin"))


def top_share_lift(long: DataFrame, by: Sequence[str] = ("model", "horizon"), share: float = 0.1,
                   min_n: int = 100) -> DataFrame:
    """Event rate among scores at or above the upper quantile, against the base rate of all
    rows with a known target."""
    by = list(by)
    scored = long.where("p is not null")
    cut = quantiles(scored, ["p"], [1 - share], by).select(*by, F.element_at("q", 1).alias("__cut"), "n")
    counts = score_counts(long, by)
    x = counts.join(cut, by) if by else counts.crossJoin(cut)  # cut: one row per group
    n = F.col("pos") + F.col("neg")
    top = F.col("p") >= F.col("__cut")
    agg = x.groupBy(*by).agg(
        (F.sum("pos") / F.sum(n)).alias("baseline"),
        F.sum(F.when(top, F.col("pos"))).alias("__tp"), F.sum(F.when(top, n)).alias("n_top"),
        F.first("n").alias("__n"))
    return agg.where(F.col("__n") >= min_n).select(
        *by, "baseline", (F.col("__tp") / F.col("n_top")).alias("top_decile_rate"),
        F.try_divide(F.col("__tp") / F.col("n_top"), F.col("baseline")).alias("lift"), "n_top")


def score_histogram(long: DataFrame, by: Sequence[str] = ("model", "horizon"), bins: int = 40) -> DataFrame:
    """Density of the scores per class in equal-width bins over each class's own range."""
    keys = [*by, "y"]
    counts = long.where("p is not null").groupBy(*keys, "p").agg(F.count("*").alias("c"))
    span = counts.groupBy(*keys).agg(
        F.min("p").alias("__lo"), F.max("p").alias("__hi"), F.sum("c").alias("__n")).where("__hi > __lo")
    x = counts.join(span, keys).withColumn("bin", C.equal_width("p", "__lo", "__hi", bins))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    return x.groupBy(*keys, "bin").agg(
        F.sum("c").alias("n"), (F.sum("c") / (F.first("__n") * F.first(width))).alias("density"))


# --- concordance ---------------------------------------------------------------------------
def concordance(df: DataFrame, time: str, event: str, score: str, by: Sequence[str] = (),
                higher_is_riskier: bool = True, max_time: int = 32767) -> DataFrame:
    """Harrell's C, exact, without forming a pair.

    A pair with t_i < t_j differs first at one binary digit of the month. For each digit the
    rows that agree above it form a group, and counting "event row with digit 0 against row
    with digit 1" there is a Mann-Whitney count over the scores. Fifteen digits cover every smallint
    month, so a row is counted sixteen times instead of being joined with every later row. Equal months
    compare events with censored rows; tied scores count one half.
    """
    by = list(by)
    sign = 1.0 if higher_is_riskier else -1.0
    t = F.col(time).cast("int")
    t = F.when(t.between(0, max_time), t).otherwise(
        F.raise_error(F.lit(f"month outside 0..{max_time}")).cast("int"))
    rows = df.where(F.col(score).isNotNull()).groupBy(
        *by, t.alias("t"), (F.col(event).cast("int") == 1).alias("e"),
        (F.lit(sign) * F.col(score)).alias("p")).agg(F.count("*").alias("c"))
    c, e = F.col("c"), F.col("e")
    zero = F.lit(0).cast("bigint")

    def cell(level, prefix, pos, neg):
        return F.struct(F.lit(level).alias("level"), prefix.alias("prefix"),
                        F.when(pos, c).otherwise(zero).alias("pos"),
                        F.when(neg, c).otherwise(zero).alias("neg"))

    cells = [cell(-1, F.col("t"), e, ~e)]
    for bit in range(max_time.bit_length()):
        one = F.shiftright("t", bit).bitwiseAND(F.lit(1)) == 1
        cells.append(cell(bit, F.shiftright("t", bit + 1), e & ~one, one))
    keys = [*by, "level", "prefix"]
    x = rows.select(*by, "p", F.explode(F.filter(F.array(*cells), lambda s: (s["pos"] > 0) | (s["neg"] > 0)))
                    .alias("s")).select(*by, "p", "s.*")
    counts = x.groupBy(*keys, "p").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    run = running_totals(counts, keys, "p", ["neg"])
    per = run.groupBy(*keys).agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg__before") + F.col("neg") / 2)).alias("conc"),
        (F.sum("pos").cast("double") * F.sum("neg")).alias("pairs"))
    return per.groupBy(*by).agg(F.sum("conc").alias("concordant"), F.sum("pairs").alias("pairs")).withColumn(
        "c_index", F.try_divide("concordant", "pairs"))


def _guarded(c: DataFrame, sizes: DataFrame, min_rows: int, min_events: int) -> DataFrame:
    ok = (F.col("n") >= min_rows) & (F.col("n_events") >= min_events)
    return sizes.join(c, "horizon", "left").select(
        "horizon", "n", "n_events", F.when(ok, F.col("c_index")).alias("c_index"))


def landmark_concordance(df: DataFrame, horizons: Sequence[int], time: str, event: str, risk: str,
                         min_rows: int = 0, min_events: int = 2) -> DataFrame:
    """C by horizon with times capped at it (static covariates); NULL for too few events."""
    x = targets.landmark(df.select(time, event, risk), horizons, time, event)
    sizes = x.groupBy("horizon").agg(F.count("*").alias("n"), F.sum("event_h").alias("n_events"))
    return _guarded(concordance(x, "time_h", "event_h", risk, ["horizon"]), sizes, min_rows, min_events)


def dynamic_concordance(panel: DataFrame, horizons: Sequence[int], risk: str, event: str = "event",
                        min_rows: int = 10, min_events: int = 2) -> DataFrame:
    """C by horizon where a loan is scored with its last row that ends by the horizon.

    All snapshots come from one aggregate by loan (conditional max_by), not one per horizon.
    """
    stop = F.col("tstop")
    snap = panel.groupBy("loan_id").agg(
        F.max(stop).alias("duration"), F.max(event).alias("event"),
        *[F.max_by(risk, F.when((stop <= h) & F.col(risk).isNotNull(), stop)).alias(f"r{h}") for h in horizons])
    x = snap.select("duration", "event", F.explode(F.array(*[
        F.struct(F.lit(h).alias("horizon"), F.col(f"r{h}").alias("risk")) for h in horizons]))
        .alias("s")).select("duration", "event", "s.*").where("risk is not null")
    x = x.withColumns({"time_h": F.least("duration", "horizon"),
                       "event_h": C.flag((F.col("event") == 1) & (F.col("duration") <= F.col("horizon")))})
    sizes = x.groupBy("horizon").agg(F.count("*").alias("n"), F.sum("event_h").alias("n_events"))
    return _guarded(concordance(x, "time_h", "event_h", "risk", ["horizon"]), sizes, min_rows, min_events)


def landmark_comparison(panel: DataFrame, horizons: Sequence[int], static: str, dynamic: str, event: str = "event",
                        time: str = "tstop", start: str = "tstart") -> DataFrame:
    """Two fits judged on the same loans at each horizon: C and the Breslow partial log-likelihood of
    their scores (as offsets) with times capped at the horizon.

    The static score is that of a loan's first interval, the dynamic one of its last interval that
    ends by the horizon; one aggregate by loan gives both for all horizons, and a loan without
    either score is left out for both fits.
    """
    stop = F.col(time)
    snap = stage(panel.groupBy("loan_id").agg(
        F.max(stop).alias("duration"), F.max(event).alias("event"), F.max(F.when(F.col(start) == 0, F.col(static))).alias("static"),
        *[F.max_by(dynamic, F.when((stop <= h) & F.col(dynamic).isNotNull(), stop)).alias(f"r{h}") for h in horizons]))
    cells = [F.struct(F.lit(h).alias("horizon"), F.lit(m).alias("model"), F.when(F.col("static").isNotNull() & F.col(f"r{h}").isNotNull(), F.col(c)).alias("risk"))
             for h in horizons for m, c in (("static", "static"), ("time_varying", f"r{h}"))]
    x = snap.select("duration", "event", F.explode(F.array(*cells)).alias("s")).select("duration", "event", "s.*").where("risk is not null")
    x = x.withColumns({"time_h": F.least("duration", "horizon"), "event_h": C.flag((F.col("event") == 1) & (F.col("duration") <= F.col("horizon")))})
    by = ["model", "horizon"]
    months = x.groupBy(*by, "time_h").agg(F.count("*").alias("n"), F.sum("event_h").alias("d"), F.sum(F.exp("risk")).alias("r"),
                                          F.sum(F.col("event_h") * F.col("risk")).alias("eta"))
    w = W.partitionBy(*by).orderBy(F.desc("time_h")).rowsBetween(W.unboundedPreceding, 0)
    months = months.withColumn("at_risk", F.sum("r").over(w))
    fit = months.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("d").alias("n_events"), F.sum(
        F.when(F.col("d") > 0, F.col("eta") - F.col("d") * F.log("at_risk")).otherwise(0.0)).alias("loglik"))
    c = concordance(x, "time_h", "event_h", "risk", by).select(*by, "c_index")
    return fit.join(c, by, "left").select(*by, "n", "n_events", "c_index", "loglik")


def horizon_incidence_metrics(df: DataFrame, horizons: Sequence[int], time: str, cause: str, k: int,
                              prefix: str = "cif", min_class: int = 2) -> DataFrame:
    """AUC and Brier of incidence columns <prefix>_<h> against "cause k by h"."""
    cells = [F.struct(F.lit(h).alias("horizon"), F.col(f"{prefix}_{h}").alias("p"),
                      targets.cause_by(time, cause, k, h).alias("y")) for h in horizons]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    m = binary_metrics(long, ["horizon"])
    enough = (F.col("n_events") >= min_class) & (F.col("n") - F.col("n_events") >= min_class)
    return m.select("horizon", "n", "n_events", F.when(enough, F.col("auc")).alias("auc"), "brier")


def subset_metrics(long: DataFrame, ids: DataFrame, key: str, min_n: int, by: Sequence[str] = ("model", "horizon")) -> DataFrame:
    """Metrics on the members of `ids`; NULL scores where fewer than `min_n` of them exist."""
    x = long.join(ids.select(key).distinct(), key, "left_semi")
    m = binary_metrics(x, by)
    ok = F.col("n") >= min_n
    return m.select(*by, "n", "n_events", *[F.when(ok, F.col(c)).alias(c) for c in ("auc", "brier", "log_loss", "accuracy")])
