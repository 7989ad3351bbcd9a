"""Cox family: proportional hazards, cause-specific, weighted, Andersen-Gill, Fine-Gray and a
nonlinear basis, all fitted by Newton steps on month sums over every row."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..sources.staging import stage, stage_columns
from . import curves
from .metrics import concordance
from .ordered import quantiles
from .partial_likelihood import Evaluation, Factor, Model, evaluate, month_sums

Z95 = curves.Z95


@dataclass
class CoxFit:
    """Fitted coefficients and the month-level quantities derived from them."""

    names: list[str]
    coef: np.ndarray
    variance: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    loglik: float
    penalised_loglik: float
    n: int
    n_events: int
    penalizer: float
    ties: str
    time: str
    event: str
    at: Evaluation
    history: list[dict] = field(default_factory=list)
    concordance: float | None = None
    label: str = "cox"
    converged: bool = True
    best: int | None = None   # step with the best validation likelihood, when that was asked for

    @property
    def beta(self) -> dict[str, float]:
        return dict(zip(self.names, map(float, self.coef)))

    def baseline(self, at_mean: bool = False) -> list[tuple[int, float, float]]:
        """Breslow (t, increment, cumulative hazard) for a subject with x = 0 or x = mean."""
        shift = 1.0 if at_mean else math.exp(-float(self.coef @ self.mean))
        inc = self.at.weight / self.at.risk * shift
        return [(int(t), float(i), float(h)) for t, i, h in zip(self.at.t, inc, np.cumsum(inc))]

    def baseline_table(self, spark: SparkSession, at_mean: bool = False) -> DataFrame:
        return spark.createDataFrame(self.baseline(at_mean), "t int, increment double, H0 double")

    def cumulative_at(self, month: int, lookup: str = "step") -> float:
        """H0 at a month: step value (0 before the first event) or nearest event month."""
        rows = self.baseline()
        if lookup == "nearest":
            return min(rows, key=lambda r: (abs(r[0] - month), r[0]))[2]
        upto = [h for t, _, h in rows if t <= month]
        return upto[-1] if upto else 0.0

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """covariate, coef, hazard ratio, standard error, 95 % limits, z, p, label."""
        se = np.sqrt(np.diag(self.variance))
        rows = []
        for n, b, s in zip(self.names, self.coef, se):
            z = float(b / s)
            p = math.erfc(abs(z) / math.sqrt(2.0))
            lo, hi = float(b - Z95 * s), float(b + Z95 * s)
            rows.append((n, float(b), math.exp(b), float(s), lo, hi, math.exp(lo), math.exp(hi), z, p,
                         K.COVARIATE_LABELS.get(n, n)))
        return spark.createDataFrame(rows, (
            "covariate string, coef double, hazard_ratio double, se double, coef_lower double, "
            "coef_upper double, hr_lower double, hr_upper double, z double, p double, label string"))

    def metadata(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(
            self.label, self.n, self.n_events, len(self.names), self.concordance,
            -2.0 * self.loglik + 2.0 * len(self.names), float(self.loglik),
            float(self.penalised_loglik), float(self.penalizer), self.converged)], (
            "label string, n bigint, n_events bigint, n_covariates int, concordance double, "
            "partial_AIC double, log_likelihood double, penalised_log_likelihood double, penalizer double, converged boolean"))

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(h["iteration"], h["loglik"], h.get("val_loglik"), h["max_step"],
              None if self.best is None else h["iteration"] == self.best) for h in self.history],
            "iteration int, train_loglik double, val_loglik double, max_step double, best boolean")


def _fit_space(df, covariates, factors, events):
    """(n, events, mean, scale, deviation): indicators of factors are neither centred nor scaled,
    but their deviation is known for the ridge term."""
    aggs = [F.count("*").alias("n")]
    aggs += [F.sum(F.col(e).cast("bigint")).alias(f"ev{i}") for i, e in enumerate(events)]
    aggs += [F.avg(c).alias(f"m{i}") for i, c in enumerate(covariates)]
    aggs += [F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(covariates)]
    hits = [F.stddev_samp((F.col(f.column) == k).cast("double")) for f in factors for k in range(1, len(f.names) + 1)]
    aggs += [h.alias(f"d{i}") for i, h in enumerate(hits)]
    r = df.agg(*aggs).collect()[0]
    p = len(covariates)
    mean = np.array([r[f"m{i}"] for i in range(p)] + [0.0] * len(hits), float)
    scale = np.array([r[f"s{i}"] or 1.0 for i in range(p)] + [1.0] * len(hits), float)
    deviation = np.array([1.0] * p + [r[f"d{i}"] or 1.0 for i in range(len(hits))], float)
    return r["n"], [r[f"ev{i}"] for i in range(len(events))], mean, scale, deviation


def fit_many(df: DataFrame, covariates: Sequence[str], *, time: str, events: Mapping[str, str],
             penalizer: float = 0.0, ties: str = "efron", start: str | None = None,
             weight: str | None = None, competing: str | None = None,
             censoring: Callable[[int], float] | None = None, max_iter: int = 30,
             tol: float = 1e-9, validation: DataFrame | None = None,
             penalty_scale: str = "standardised", staged: bool = True, patience: int | None = None,
             min_gain: float = 1e-9, factors: Sequence[Factor] = ()) -> dict[str, CoxFit]:
    """Fit one model per event column; every Newton step is one pass shared by all models.

    Covariates are centred and scaled internally. The ridge term is n·penalizer/2·Σβ², on the
    standardised coefficients by default or on the raw ones. `start` makes rows counting-process
    intervals (start, time]. `competing` with `censoring` keeps competing exits at risk with
    weight G(t)/G(s). `factors` add mutually exclusive indicators held as integer columns.

    With `validation`, its partial log-likelihood is taken after every step. With `patience` too, a
    model ends once that many steps in a row have not raised it by more than the share `min_gain`,
    and the best step's state is returned (`best` is its number, the first of equals).
    """
    covariates, names, factors = list(covariates), list(events), list(factors)
    columns = [*covariates, *[f.column for f in factors]]
    p = len(covariates) + sum(len(f.names) for f in factors)
    keep = [time, *dict.fromkeys(events.values()), *columns, *[c for c in (start, weight, competing) if c]]
    rows = df.select(*dict.fromkeys(keep))
    if staged:
        # every iteration reads it; only beta changes between plans. Intervals are many times the subjects
        rows = stage_columns(rows) if start else stage(rows)
    # after the lineage cut: a null filter over many derived columns makes constraint
    # inference explode when it sits on top of their projection
    rows = rows.dropna(subset=[time, *columns])
    if validation is not None:
        validation = stage(validation.select(*dict.fromkeys(keep))).dropna(subset=[time, *columns])
    n, n_ev, mean, scale, deviation = _fit_space(rows, covariates, factors, list(events.values()))
    ridge = penalizer * n * (deviation ** 2 if penalty_scale == "standardised" else 1.0 / scale ** 2)
    beta = {m: np.zeros(p) for m in names}
    best: dict[str, tuple] = {}   # model: (validation likelihood, step, coefficients, state)
    state: dict[str, tuple] = {}
    trial = dict(beta)
    open_ = list(names)
    history: dict[str, list] = {m: [] for m in names}
    halvings = dict.fromkeys(names, 0)
    stuck: set[str] = set()

    def sums_at(frame, which, values):
        return month_sums(frame, covariates, [Model(events[m], values[m]) for m in which], time=time,
                          start=start, weight=weight, competing=competing, factors=factors,
                          center=mean[:len(covariates)], scale=scale[:len(covariates)])

    for iteration in range(max_iter + 1):
        for m, s in zip(open_, sums_at(rows, open_, trial)):
            with np.errstate(all="ignore"):
                ev = evaluate(s, trial[m], ties, censoring)
            pll = ev.loglik - 0.5 * float(ridge @ trial[m] ** 2)
            if m in state and not pll >= state[m][1] - 1e-9 * abs(state[m][1]) and halvings[m] < 20:
                halvings[m] += 1  # overshoot: half the step, same iteration budget
                trial[m] = (trial[m] + beta[m]) / 2
                continue
            if m in state and not pll >= state[m][1] - 1e-9 * abs(state[m][1]):
                stuck.add(m)  # no step improves: the last good point stays, flagged
                continue
            step = trial[m] - beta[m]
            beta[m], state[m], halvings[m] = trial[m].copy(), (ev, pll), 0
            history[m].append({"iteration": len(history[m]), "loglik": float(ev.loglik),
                               "max_step": float(np.abs(step).max()) if len(history[m]) else math.nan})
        moved = [m for m in open_ if m not in stuck and "val_loglik" not in history[m][-1]]
        if validation is not None and moved:
            for m, s in zip(moved, sums_at(validation, moved, beta)):
                val = float(evaluate(s, beta[m], ties, censoring).loglik)
                history[m][-1]["val_loglik"] = val
                if m not in best or val > best[m][0] + min_gain * abs(best[m][0]):
                    best[m] = (val, history[m][-1]["iteration"], beta[m].copy(), state[m])
        still = []
        for m in open_:
            if m in stuck:
                continue
            if patience is not None and m in best and history[m][-1]["iteration"] - best[m][1] >= patience:
                continue
            ev = state[m][0]
            g = ev.score - ridge * beta[m]
            h = ev.hessian - np.diag(ridge)
            move = np.linalg.solve(-h, g)
            if halvings[m] == 0:
                if np.abs(move).max() < tol:
                    continue
                trial[m] = beta[m] + move
            still.append(m)
        open_ = still
        if not open_:
            break

    out = {}
    for i, m in enumerate(names):
        chosen = patience is not None and m in best
        if chosen:
            _, _, beta[m], state[m] = best[m]
        ev, pll = state[m]
        var = np.linalg.inv(-(ev.hessian - np.diag(ridge))) / np.outer(scale, scale)
        out[m] = CoxFit([*covariates, *[x for f in factors for x in f.names]], beta[m] / scale, var, mean, scale, float(ev.loglik), float(pll), n,
                        int(n_ev[i] or 0), penalizer, ties, time, events[m], ev, history[m], label=m,
                        converged=m not in open_ and m not in stuck, best=best[m][1] if chosen else None)
    return out


def fit(df: DataFrame, covariates: Sequence[str], *, time: str = "Duration",
        event: str = "Event_Prepay", label: str = "cox", with_concordance: bool = False, **kw) -> CoxFit:
    """Single-event Cox fit over all rows."""
    columns = [*covariates, *[f.column for f in kw.get("factors", ())]]
    keep = list(dict.fromkeys([time, event, *columns, *[kw[c] for c in ("start", "weight", "competing") if kw.get(c)]]))
    rows = stage(df.select(*keep)).dropna(subset=[time, *columns]) if with_concordance else df
    model = fit_many(rows, covariates, time=time, events={label: event},
                     staged=not with_concordance, **kw)[label]
    if with_concordance:
        scored = with_indicators(rows, kw.get("factors", ())).withColumn("__risk", log_hazard(model.beta))
        model.concordance = concordance(scored, time, event, "__risk").collect()[0]["c_index"]
    return model


def at_fixed(df: DataFrame, beta: Mapping[str, float], *, time: str, event: str, ties: str = "efron",
             start: str | None = None, weight: str | None = None, competing: str | None = None,
             censoring=None, native: bool | None = None, factors: Sequence[Factor] = ()) -> Evaluation:
    """Likelihood, score and Hessian at given raw-unit coefficients, those of factors last."""
    names = list(beta)
    b = np.array([beta[n] for n in names], float)
    coded = {n for f in factors for n in f.names}
    (s,) = month_sums(df, [n for n in names if n not in coded], [Model(event, b)], time=time, start=start,
                      weight=weight, competing=competing, native=native, factors=factors)
    return evaluate(s, b, ties, censoring)


def with_indicators(df: DataFrame, factors: Sequence[Factor]) -> DataFrame:
    """The indicators of factors as columns, for scoring."""
    return df.withColumns({name: (F.col(f.column) == k).cast("double") for f in factors for k, name in enumerate(f.names, 1)})


def log_hazard(beta: Mapping[str, float]):
    return C.linear_score(beta)


# --- predictions -----------------------------------------------------------------------
def horizon_probabilities(df: DataFrame, model: CoxFit, horizons: Sequence[int],
                          prefix: str = "pred_Cox", lookup: str = "step") -> DataFrame:
    """1 - exp(-H0(T)·e^η) per horizon; NULL where a covariate is missing."""
    eta = log_hazard(model.beta)
    return df.withColumns({
        f"{prefix}_T{h}": F.lit(1.0) - F.exp(-F.lit(model.cumulative_at(h, lookup)) * F.exp(eta))
        for h in horizons})


def breslow(df: DataFrame, beta: Mapping[str, float], time: str, event: str) -> DataFrame:
    """Baseline at fixed coefficients as a DataFrame: one aggregate by month, then windows."""
    r = F.exp(log_hazard(beta))
    x = df.select(F.col(time).cast("smallint").cast("int").alias("t"),
                  F.col(event).cast("int").alias("e"), r.alias("r"))
    m = x.groupBy("t").agg(F.sum("r").alias("r"), F.sum(F.col("e").cast("bigint")).alias("d"))
    m = m.withColumn("risk", curves.at_risk(F.col("r"), []))
    inc = F.col("d") / F.col("risk")
    return m.select("t", "d", "risk", inc.alias("increment"), curves.running(inc, []).alias("H0"))


# --- diagnostics -------------------------------------------------------------------------
def schoenfeld(df: DataFrame, model: CoxFit) -> DataFrame:
    """Residuals x - E[x|R(t)] of every event row, long (t, covariate, residual, label).

    The month means are a few hundred rows, so only event rows are touched and none shuffled.
    """
    spark = df.sparkSession
    means = model.at.mean * model.scale + model.mean
    table = spark.createDataFrame(
        [(int(t), *map(float, row)) for t, row in zip(model.at.t, means)],
        "t int, " + ", ".join(f"`__m_{n}` double" for n in model.names))
    x = df.where(F.col(model.event).cast("int") == 1).dropna(subset=model.names).withColumn(
        "t", F.col(model.time).cast("int")).join(table, "t")
    wide = x.select("t", *[(F.col(n) - F.col(f"__m_{n}")).alias(n) for n in model.names])
    return wide.unpivot("t", model.names, "covariate", "residual").withColumn(
        "label", C.lookup("covariate", K.COVARIATE_LABELS))


def residual_trend(residuals: DataFrame, max_bins: int = 40) -> DataFrame:
    """Mean time and mean residual per equal-width time bin and covariate."""
    span = residuals.groupBy("covariate").agg(
        F.min("t").alias("lo"), F.max("t").alias("hi"), F.count_distinct("t").alias("u"))
    bins = F.least(F.lit(max_bins), F.greatest(F.lit(5), F.col("u")))
    x = residuals.groupBy("covariate", "t").agg(F.sum("residual").alias("s"), F.count("*").alias("n"))
    x = x.join(span, "covariate")
    pos = F.ceil((F.col("t") - F.col("lo")) * bins / F.nullif(F.col("hi") - F.col("lo"), F.lit(0)))
    x = x.withColumn("bin", F.greatest(F.coalesce(pos, F.lit(1)), F.lit(1)).cast("int"))
    return x.groupBy("covariate", "bin").agg(
        (F.sum(F.col("t") * F.col("n")) / F.sum("n")).alias("mean_t"),
        (F.sum("s") / F.sum("n")).alias("mean_residual"), F.sum("n").alias("n"))


def ph_test(model: CoxFit, spark: SparkSession) -> DataFrame:
    """Score test of residual drift with the average rank of the event months.

    Σ g(t)·residual is a sum over months of g(t)·(Σ x - d·E[x]), so no residual row is read.
    """
    ev = model.at
    before = np.concatenate([[0.0], np.cumsum(ev.d)[:-1]])
    rank = before + (ev.d + 1) / 2
    g = rank - (rank * ev.d).sum() / ev.d.sum()
    drift = (g[:, None] * (ev.event_x - ev.weight[:, None] * ev.mean)).sum(axis=0)
    var = model.variance * np.outer(model.scale, model.scale)
    deaths = ev.d.sum()
    num = (deaths * (var @ drift)) ** 2
    stat = num / (deaths * np.diag(var) * (g ** 2 * ev.d).sum())
    rows = [(n, float(s), math.erfc(math.sqrt(s / 2.0)), K.COVARIATE_LABELS.get(n, n))
            for n, s in zip(model.names, stat)]
    return spark.createDataFrame(rows, "covariate string, test_statistic double, p double, label string").withColumn(
        "neg_log2_p", -F.log2(F.greatest("p", F.lit(1e-300))))


# --- competing risks ------------------------------------------------------------------------
def censoring_lookup(g: DataFrame) -> Callable[[int], float]:
    """Step function of the censoring survival (one value per month, collected)."""
    rows = sorted((r["t"], r["G"]) for r in g.collect())
    ts = np.array([r[0] for r in rows])
    gs = np.array([r[1] for r in rows])

    def at(t):
        i = int(np.searchsorted(ts, t, side="right")) - 1
        return float(gs[i]) if i >= 0 else 1.0

    return at


def fine_gray_weights(df: DataFrame, g: DataFrame, time: str = "duration",
                      defaulted: str = "defaulted", floor: float = 1e-6) -> DataFrame:
    """Weighted-Cox approximation: competing exits weigh G at their own exit month."""
    from ..sources.staging import small_table

    gt = small_table(g.select(F.col("t").alias("__t"), "G"))
    x = df.withColumn("__t", F.col(time).cast("int")).join(gt, "__t", "left")
    w = F.when(F.col(defaulted) == 1, F.coalesce("G", F.lit(1.0))).otherwise(1.0)
    return x.withColumn("fg_weight", F.greatest(w, F.lit(floor))).drop("__t", "G")


def fit_fine_gray(df: DataFrame, covariates: Sequence[str], *, time: str = "duration",
                  event: str = "prepaid", competing: str = "defaulted", mode: str = "subdistribution",
                  **kw) -> CoxFit:
    """`reference` weights the competing rows and leaves their times; `subdistribution` keeps
    them at risk after their exit with weight G(t)/G(s)."""
    none = ((F.col(event) == 1) | (F.col(competing) == 1)).cast("int")
    g = curves.censoring_survival(df, time, none)
    if mode == "reference":
        return fit(fine_gray_weights(df, g, time, competing), covariates, time=time, event=event,
                   weight="fg_weight", label="fine_gray", **kw)
    if mode != "subdistribution":
        raise ValueError(f"mode must be 'reference' or 'subdistribution', got {mode!r}")
    return fit(df, covariates, time=time, event=event, competing=competing,
               censoring=censoring_lookup(g), label="fine_gray", **kw)


def compare_coefficients(tables: Mapping[str, DataFrame], alias: Mapping[str, str] | None = None) -> DataFrame:
    """One row per covariate with a coefficient column per model; `alias` renames covariates
    of later tables onto those of the first."""
    out = None
    for name, t in tables.items():
        c = t.select(C.lookup("covariate", alias).alias("covariate") if alias and out is not None
                     else F.col("covariate"), F.col("coef").alias(name))
        out = c if out is None else out.join(c, "covariate", "full")
    return out


def divergence(df: DataFrame, a: str, b: str, strong: float = 0.05, gap: float = 0.3):
    """'opposite' for signs that differ with both beyond `strong`, 'diverge' for a gap."""
    x, y = F.col(a), F.col(b)
    flag = (F.when((x * y < 0) & (F.abs(x) > strong) & (F.abs(y) > strong), "opposite")
            .when(F.abs(x - y) > gap, "diverge").otherwise(""))
    return df.withColumn("flag", flag)


def shifts(df: DataFrame, a: str, b: str, levels: Sequence[float] = (0.1, 0.2)) -> DataFrame:
    """Difference of two coefficient columns with the largest of `levels` that it exceeds as its flag."""
    gap = F.col(a) - F.col(b)
    flag = F.lit("")
    for level in sorted(levels):
        flag = F.when(F.abs(gap) > level, f">{level:g}").otherwise(flag)
    return df.withColumns({"difference": gap, "flag": flag})


# --- nonlinear basis --------------------------------------------------------------------------
def bin_factors(df: DataFrame, columns: Sequence[str], bins: int = 4, fit_on=None) -> tuple[DataFrame, list[Factor]]:
    """Quantile bins of the given columns as factors: code i holds values above the i-th edge and
    not above the next. Repeated edges are dropped; a NULL value has no code."""
    rows = df if fit_on is None else df.where(fit_on)
    found = {r["column"]: sorted(set(r["q"])) for r in quantiles(rows, columns, [i / bins for i in range(1, bins)]).collect()}
    out, factors = {}, []
    for c in columns:
        code = F.lit(0)
        for edge in found.get(c, []):
            code = code + (F.col(c) > F.lit(edge)).cast("int")
        out[f"{c}__bin"] = code
        factors.append(Factor(f"{c}__bin", [f"{c}__b{i}" for i in range(1, len(found.get(c, [])) + 1)]))
    return df.withColumns(out), factors


def expand_basis(df: DataFrame, columns: Sequence[str], bins: int = 4, squares: bool = True,
                 interactions: bool = True, fit_on=None) -> tuple[DataFrame, list[str]]:
    """Quantile-bin indicators, squares and pairwise products of the given columns.

    With bins=1 and both switches off this is the linear model."""
    rows = df if fit_on is None else df.where(fit_on)
    out: dict = {}
    if bins > 1:
        probs = [i / bins for i in range(1, bins)]
        for r in quantiles(rows, columns, probs).collect():
            edges = sorted(set(r["q"]))
            for i, e in enumerate(edges):
                out[f"{r['column']}__q{i + 1}"] = (F.col(r["column"]) > F.lit(e)).cast("double")
    if squares:
        out.update({f"{c}__sq": F.col(c) * F.col(c) for c in columns})
    if interactions:
        out.update({f"{a}__x__{b}": F.col(a) * F.col(b)
                    for i, a in enumerate(columns) for b in columns[i + 1:]})
    return df.withColumns(out), [*columns, *out]
