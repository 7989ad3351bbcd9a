"""Month sums of the Cox partial likelihood.

The likelihood, its gradient and its Hessian depend on the data only through sums of e^η,
x·e^η and x·xᵀ·e^η per month, over all rows and over event rows. Spark computes those sums in
one pass; a month is a smallint, so what reaches the driver is bounded by the time axis and not
by the data. Wide models build partial sums with numpy per Arrow batch, narrow ones stay in
SQL aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NATIVE_MAX = 3
SUMS_SCHEMA = "k int, t int, s array<double>"


@dataclass
class Layout:
    """Position of each block in the flat vector of sums: all, event, competing rows, then the
    event weight, event count and weighted event covariates."""

    p: int

    @property
    def tri(self) -> int:
        return self.p * (self.p + 1) // 2

    @property
    def block(self) -> int:
        return 1 + self.p + self.tri

    @property
    def size(self) -> int:
        return 3 * self.block + 2 + self.p


@dataclass
class Factor:
    """Mutually exclusive indicators held as one integer column: code 0 is the reference, code i
    the i-th name. Their products are counts by code, never columns."""

    column: str
    names: list[str]


@dataclass
class Model:
    """One event definition with its coefficients."""

    event: str
    beta: np.ndarray


@dataclass
class Sums:
    """Month sums of one model, times ascending."""

    t: np.ndarray
    s: np.ndarray
    p: int

    def _split(self, i: int):
        lay = Layout(self.p)
        b = self.s[:, i * lay.block:(i + 1) * lay.block]
        c = np.zeros((len(self.t), self.p, self.p))
        iu = np.triu_indices(self.p)
        c[:, iu[0], iu[1]] = b[:, 1 + self.p:]
        c[:, iu[1], iu[0]] = b[:, 1 + self.p:]
        return b[:, 0], b[:, 1:1 + self.p], c

    @property
    def tail(self):
        lay = Layout(self.p)
        r = self.s[:, 3 * lay.block:]
        return r[:, 0], r[:, 1], r[:, 2:]

    def risk(self):
        """Risk-set sums: everybody with exit month >= t (entries already subtracted)."""
        return tuple(np.cumsum(x[::-1], axis=0)[::-1] for x in self._split(0))

    def events(self):
        return self._split(1)

    def competing(self):
        return self._split(2)


def month_sums(df: DataFrame, covariates: Sequence[str], models: Sequence[Model], *, time: str,
               start: str | None = None, weight: str | None = None, competing: str | None = None,
               center: np.ndarray | None = None, scale: np.ndarray | None = None,
               native: bool | None = None, factors: Sequence[Factor] = ()) -> list[Sums]:
    """Sums for every model from one pass over `df`; the indicators of `factors` come after the
    covariates, neither centred nor scaled."""
    center = np.zeros(len(covariates)) if center is None else np.asarray(center, float)
    scale = np.ones(len(covariates)) if scale is None else np.asarray(scale, float)
    if native is None:
        native = len(covariates) <= NATIVE_MAX and len(models) == 1
    args = (df, list(covariates), list(models), time, start, weight, competing, center, scale)
    rows = (_native_sums(*args) if native and not factors else _arrow_sums(*args, list(factors))).toArrow()
    p = len(covariates) + sum(len(f.names) for f in factors)
    out = []
    k, t = rows["k"].to_numpy(), rows["t"].to_numpy()
    s = np.asarray(rows["s"].combine_chunks().flatten()).reshape(len(t), Layout(p).size)
    for i in range(len(models)):
        sel = np.flatnonzero(k == i)
        sel = sel[np.argsort(t[sel])]
        out.append(Sums(t[sel], s[sel], p))
    return out


def _native_sums(df, covariates, models, time, start, weight, competing, center, scale):
    (model,) = models
    p = len(covariates)
    x = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(covariates, center, scale)]
    eta = F.lit(0.0)
    for xi, b in zip(x, model.beta):
        eta = eta + F.lit(float(b)) * xi
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    base = df.select(
        F.col(time).cast("smallint").cast("int").alias("t"),
        (F.col(start).cast("smallint").cast("int") if start else F.lit(None).cast("int")).alias("t0"),
        (F.col(model.event).cast("int") == 1).alias("e"), w.alias("w"), (w * F.exp(eta)).alias("r"),
        ((F.col(competing).cast("int") == 1) if competing else F.lit(False)).alias("c"),
        *[xi.alias(f"x{i}") for i, xi in enumerate(x)])
    names = ["r"] + [f"r * x{i}" for i in range(p)] + [
        f"r * x{i} * x{j}" for i in range(p) for j in range(i, p)]
    aggs = [F.sum(F.expr(n)) for n in names]
    aggs += [F.sum(F.when(F.col("e"), F.expr(n)).otherwise(0.0)) for n in names]
    aggs += [F.sum(F.when(F.col("c"), F.expr(n)).otherwise(0.0)) for n in names]
    aggs += [F.sum(F.when(F.col("e"), F.col("w")).otherwise(0.0)), F.sum(F.when(F.col("e"), 1.0).otherwise(0.0))]
    aggs += [F.sum(F.when(F.col("e"), F.expr(f"w * x{i}")).otherwise(0.0)) for i in range(p)]
    wide = base.groupBy("t", *(["t0"] if start else [])).agg(*[a.alias(f"s{i}") for i, a in enumerate(aggs)])
    if start:  # a row leaves at its stop and, with the opposite sign, enters at its start; rows of one interval go as one
        sides = F.explode(F.array(F.struct(F.col("t"), F.lit(1.0).alias("g"), F.lit(1.0).alias("x")),
                                  F.struct(F.col("t0").alias("t"), F.lit(-1.0).alias("g"), F.lit(0.0).alias("x"))))
        wide = wide.select(sides.alias("m"), *[f"s{i}" for i in range(len(aggs))]).groupBy(F.col("m.t").alias("t")).agg(
            *[F.sum(F.col("m.g" if i < len(names) else "m.x") * F.col(f"s{i}")).alias(f"s{i}") for i in range(len(aggs))])
    return wide.select(F.lit(0).alias("k"), "t", F.array(*[f"s{i}" for i in range(len(aggs))]).alias("s"))


#: Rows whose sums are formed at once: months then have enough rows for a matrix product.
CHUNK = 65_536


def _segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by key, where each key starts in it)."""
    order = np.argsort(keys, kind="stable")
    ks = keys[order]
    return order, np.flatnonzero(np.r_[True, ks[1:] != ks[:-1]])


def _blocks(x: np.ndarray, codes: np.ndarray, sizes: Sequence[int], r: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Σ r, Σ r·x and the upper triangle of Σ r·x·xᵀ of every segment of rows; x are the covariates,
    codes the factors. Covariates take one matrix product a segment, factors one count a pair."""
    n, pd = x.shape
    g, last = len(first), np.append(first[1:], n)
    p = pd + sum(sizes)
    total = np.add.reduceat(r, first)
    one, two = np.zeros((g, p)), np.zeros((g, p, p))
    xr = x * r[:, None]
    if pd:
        one[:, :pd] = np.add.reduceat(xr, first, axis=0)
        for i, (lo, hi) in enumerate(zip(first, last)):
            two[i, :pd, :pd] = x[lo:hi].T @ xr[lo:hi]
    seg = np.repeat(np.arange(g), last - first)
    at = pd + np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    for i, k in enumerate(sizes):
        cell = seg * (k + 1) + codes[:, i]
        count = lambda w: np.bincount(cell, w, g * (k + 1)).reshape(g, k + 1)[:, 1:]  # noqa: B023, E731
        here = slice(at[i], at[i + 1])
        one[:, here] = count(r)
        two[:, range(at[i], at[i + 1]), range(at[i], at[i + 1])] = one[:, here]
        for j in range(pd):
            two[:, j, here] = count(xr[:, j])
        for j in range(i):
            m = sizes[j]
            both = np.bincount(cell * (m + 1) + codes[:, j], r, g * (k + 1) * (m + 1)).reshape(g, k + 1, m + 1)
            two[:, at[j]:at[j + 1], here] = both[:, 1:, 1:].transpose(0, 2, 1)
    iu = np.triu_indices(p)
    return np.column_stack([total, one, two[:, iu[0], iu[1]]])


def _arrow_sums(df, covariates, models, time, start, weight, competing, center, scale, factors):
    events = [m.event for m in models]
    cols = [F.col(time).cast("smallint").cast("int").alias("t")]
    cols += [F.col(e).cast("int").alias(f"e{i}") for i, e in enumerate(events)]
    cols += [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(covariates)]
    cols += [F.col(f.column).cast("int").alias(f"f{i}") for i, f in enumerate(factors)]
    if start:
        cols.append(F.col(start).cast("smallint").cast("int").alias("t0"))
    if weight:
        cols.append(F.col(weight).cast("double").alias("w"))
    if competing:
        cols.append(F.col(competing).cast("int").alias("c"))
    sizes = [len(f.names) for f in factors]
    pd, betas = len(covariates), [np.asarray(m.beta, float) for m in models]
    p = pd + sum(sizes)
    at = pd + np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    width, size = Layout(p).block, Layout(p).size
    has_start, has_weight, has_comp = start is not None, weight is not None, competing is not None

    def add(acc, k, keys, block, offset, sign=1.0):
        for key, row in zip(keys, block):
            slot = acc.setdefault((k, int(key)), np.zeros(size))
            slot[offset:offset + block.shape[1]] += sign * row

    def rows(acc, b: pa.Table):
        get = lambda n: b.column(n).to_numpy()
        t, t0 = get("t"), get("t0") if has_start else None
        # rows of one (start, stop) are multiplied once; where intervals hardly repeat, by stop and by start
        keys, sides = t, [(t, 1.0)]
        if has_start:
            pair = t.astype(np.int64) * (1 << 16) + t0
            few = len(np.unique(pair)) <= len(np.unique(t)) + len(np.unique(t0))
            keys, sides = (pair, [(t, 1.0), (t0, -1.0)]) if few else (t, sides)
        order, first = _segments(keys)
        x = (np.column_stack([get(f"x{i}") for i in range(pd)])[order] - center) / scale if pd else np.zeros((len(t), 0))
        codes = np.column_stack([get(f"f{i}") for i in range(len(sizes))])[order].astype(np.int64) if sizes else np.zeros((len(t), 0), np.int64)
        w = get("w")[order] if has_weight else np.ones(len(t))
        for k, beta in enumerate(betas):
            eta = x @ beta[:pd]
            for i in range(len(sizes)):
                eta = eta + np.append(0.0, beta[at[i]:at[i + 1]])[codes[:, i]]
            r = w * np.exp(eta)
            block = _blocks(x, codes, sizes, r, first)
            for side, sign in sides:
                add(acc, k, side[order][first], block, 0, sign)
            if has_start and len(sides) == 1:
                again, cuts = _segments(t0[order])
                add(acc, k, t0[order][again][cuts], _blocks(x[again], codes[again], sizes, r[again], cuts), 0, -1.0)
            for flag, offset in ((f"e{k}", width), ("c", 2 * width)):
                if flag == "c" and not has_comp:
                    continue
                on = np.flatnonzero(get(flag)[order] == 1)
                if not len(on):
                    continue
                again, cuts = _segments(t[order][on])
                on = on[again]
                months = t[order][on][cuts]
                add(acc, k, months, _blocks(x[on], codes[on], sizes, r[on], cuts), offset)
                if flag != "c":
                    plain = _blocks(x[on], codes[on], sizes, w[on], cuts)
                    count = np.diff(np.append(cuts, len(on)))
                    add(acc, k, months, np.column_stack([plain[:, 0], count, plain[:, 1:1 + p]]), 3 * width)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) >= CHUNK:
                rows(acc, pa.Table.from_batches(held))
                held = []
        if sum(h.num_rows for h in held):
            rows(acc, pa.Table.from_batches(held))
        yield from emit(acc)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            ks, ts = b.column("k").to_numpy(), b.column("t").to_numpy()
            flat = np.asarray(b.column("s").flatten()).reshape(b.num_rows, size)
            for k, t, row in zip(ks, ts, flat):
                slot = acc.setdefault((int(k), int(t)), np.zeros(size))
                slot += row
        yield from emit(acc)

    def emit(acc):
        if acc:
            keys = list(acc)
            flat = pa.array(np.concatenate(list(acc.values())))
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in keys], pa.int32()), pa.array([t for _, t in keys], pa.int32()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * size, pa.int32()), flat)], ["k", "t", "s"])

    parts = df.select(*cols).mapInArrow(partial, SUMS_SCHEMA)
    return parts.repartition("k", "t").mapInArrow(merge, SUMS_SCHEMA)


# --- likelihood on the driver: a few hundred months, p columns ---------------------------
NODES = 16


@lru_cache(maxsize=None)
def _sum_rule(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and positive weights with Σ_{l<n} g(l) ≈ Σ w·g(x), exact for polynomials of degree 31.

    The Gauss rule of n equally spaced points, from the recurrence of their orthogonal polynomials;
    up to NODES points are taken one by one.
    """
    if n <= NODES:
        return np.arange(n, dtype=float), np.ones(n)
    k = np.arange(1.0, NODES)
    off = np.sqrt(k * k * (float(n) * n - k * k) / (4.0 * (4.0 * k * k - 1.0)))
    x, v = np.linalg.eigh(np.diag(np.full(NODES, (n - 1) / 2.0)) + np.diag(off, 1) + np.diag(off, -1))
    return x, n * v[0] ** 2


def tie_sums(a: float, e: float, d: int, ties: str):
    """Σ over the d tied events of log φ, 1/φ, f/φ, 1/φ², f/φ², f²/φ² with φ = a - f·e.

    f is l/d for Efron and 0 for Breslow. The l are cut into blocks that are no longer than the
    distance of their end to the zero of φ, so a rule of 16 nodes sums each block to rounding
    error; block lengths are powers of two. All terms are evaluated as they stand, so nothing
    cancels, whatever e/a, and the work grows with log d.
    """
    if ties == "breslow" or d == 1:
        return d * math.log(a), d / a, 0.0, d / a ** 2, 0.0, 0.0
    zero = a * d / e if e > 0 else math.inf
    nodes, weights, end = [], [], d
    while end > 0:
        reach = min(float(end), max(float(NODES), zero - end + 1))
        n = end if end <= NODES else 1 << (int(reach).bit_length() - 1)
        x, w = _sum_rule(n)
        nodes.append(end - n + x)
        weights.append(w)
        end -= n
    x, w = np.concatenate(nodes), np.concatenate(weights)
    f, phi = x / d, (a - e) + e * ((d - x) / d)
    r = w / phi
    q = r / phi
    return float(w @ np.log(phi)), r.sum(), f @ r, q.sum(), f @ q, (f * f) @ q


@dataclass
class Evaluation:
    loglik: float
    score: np.ndarray
    hessian: np.ndarray
    t: np.ndarray          # months with events
    d: np.ndarray          # event counts there
    weight: np.ndarray     # event weights there
    risk: np.ndarray       # Σ e^η over the risk set
    mean: np.ndarray       # tie-adjusted mean covariate of the risk set
    spread: np.ndarray     # tie-adjusted covariance sum per month
    event_x: np.ndarray    # Σ w·x over the events


def evaluate(sums: Sums, beta: np.ndarray, ties: str = "efron", censoring=None) -> Evaluation:
    """Partial log-likelihood, score and Hessian at `beta` (the value used for the sums).

    `censoring` maps a month to G(t); when given, competing exits stay at risk after their
    month s with weight G(t)/G(s).
    """
    a, b, c = sums.risk()
    if censoring is not None:
        g = np.array([censoring(t) for t in sums.t])
        ok = np.where(g > 0, 1.0 / np.where(g > 0, g, 1.0), 0.0)
        ca, cb, cc = sums.competing()
        lag = lambda x: np.concatenate([np.zeros_like(x[:1]), np.cumsum(x, axis=0)[:-1]])
        a = a + g * lag(ca * ok)
        b = b + g[:, None] * lag(cb * ok[:, None])
        c = c + g[:, None, None] * lag(cc * ok[:, None, None])
    ea, eb, ec = sums.events()
    wd, d, ex = sums.tail
    on = np.flatnonzero(d > 0)
    p = sums.p
    loglik, score, hess = 0.0, np.zeros(p), np.zeros((p, p))
    means, spreads = np.zeros((len(on), p)), np.zeros((len(on), p, p))
    for row, i in enumerate(on):
        n = int(round(d[i]))
        wbar = wd[i] / n
        s0, s1, f1, q, g1, g2 = tie_sums(a[i], ea[i], n, ties)
        zsum = s1 * b[i] - f1 * eb[i]
        second = (s1 * c[i] - f1 * ec[i]) - (
            q * np.outer(b[i], b[i]) - g1 * (np.outer(b[i], eb[i]) + np.outer(eb[i], b[i]))
            + g2 * np.outer(eb[i], eb[i]))
        loglik += ex[i] @ beta - wbar * s0
        score += ex[i] - wbar * zsum
        hess -= wbar * second
        means[row], spreads[row] = zsum / n, wbar * second
    return Evaluation(loglik, score, hess, sums.t[on], d[on], wd[on], a[on], means, spreads, ex[on])
