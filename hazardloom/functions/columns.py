"""Scalar column expressions: cuts, clips, dates, labels, hashing, elementary statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- conditional values ---------------------------------------------------------
def null_from(x, threshold) -> Column:
    """NULL when the value reaches `threshold`; NULL stays NULL."""
    x = _c(x)
    return F.when(x >= F.lit(threshold), None).otherwise(x)


def clip(x, low=None, high=None) -> Column:
    """Clamp to [low, high], keeping NULL (greatest/least alone would skip it)."""
    x = _c(x)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def flag(condition: Column, dtype: str = "int") -> Column:
    """0/1 from a condition, NULL counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast(dtype)


def small_int(x) -> Column:
    """Tolerant cast of mixed text to a small integer ("RA" and the like become NULL)."""
    return _c(x).try_cast("smallint")


# --- cuts -------------------------------------------------------------------------
def bucket(x, cuts: Sequence, labels: Sequence[str], *, right_closed: bool, missing=None) -> Column:
    """Label by cut points; the last label takes everything above the last cut."""
    x = _c(x)
    expr = None
    for cut, label in zip(cuts, labels):
        cond = x <= F.lit(cut) if right_closed else x < F.lit(cut)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(x.isNull(), F.lit(missing)).otherwise(expr.otherwise(labels[-1]))


def interval(x, edges: Sequence, labels: Sequence[str]) -> Column:
    """Right-closed interval label, NULL outside the outer edges."""
    x = _c(x)
    expr = None
    for low, high, label in zip(edges, edges[1:], labels):
        cond = (x > F.lit(low)) & (x <= F.lit(high))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def fixed_width(x, width: int) -> Column:
    return (F.floor(_c(x) / F.lit(width)) * F.lit(width)).cast("int")


def equal_width(x, low, high, bins: int) -> Column:
    """1..bins, the maximum falling into the last bin."""
    return F.least(F.width_bucket(_c(x), _c(low), _c(high), F.lit(bins)), F.lit(bins)).cast("int")


def equal_width_right(x, low, high, bins: int) -> Column:
    """1..bins with right-closed bins, the minimum falling into the first."""
    x, low, high = _c(x), _c(low), _c(high)
    pos = F.ceil((x - low) * F.lit(float(bins)) / F.nullif(high - low, F.lit(0)))
    return F.greatest(F.coalesce(pos, F.lit(1)), F.lit(1)).cast("int")


# --- YYYYMM dates -------------------------------------------------------------------
def month_number(yyyymm) -> Column:
    """Months since year 0 of a YYYYMM integer."""
    y = _c(yyyymm).cast("int")
    return F.floor(y / F.lit(100)).cast("int") * F.lit(12) + y % F.lit(100) - F.lit(1)


def yyyymm(month_no) -> Column:
    m = _c(month_no).cast("int")
    return (F.floor(m / F.lit(12)).cast("int") * F.lit(100) + m % F.lit(12) + F.lit(1)).cast("int")


def yyyymm_of(date) -> Column:
    d = _c(date)
    return (F.year(d) * F.lit(100) + F.month(d)).cast("int")


def yyyymm_date(ym) -> Column:
    y = _c(ym).cast("int")
    return F.make_date(F.floor(y / F.lit(100)).cast("int"), y % F.lit(100), F.lit(1))


# --- labels ---------------------------------------------------------------------------
def lookup(x, mapping: Mapping[str, str]) -> Column:
    """Dictionary label, the value itself where it has none."""
    x = _c(x)
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), x), x)


def category_rank(x, order: Sequence[str]) -> Column:
    """Position in a custom category order (1-based; 0 when absent) for sorting."""
    return F.array_position(F.array(*[F.lit(o) for o in order]), _c(x)).cast("int")


def significance(p) -> Column:
    p = _c(p)
    return (F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise(""))


def direction(hazard_ratio) -> Column:
    return F.when(_c(hazard_ratio) > 1, "↑ faster prepayment").otherwise("↓ slower prepayment")


# --- elementary functions ----------------------------------------------------------------
def logit(p) -> Column:
    p = _c(p)
    return F.log(p / (F.lit(1.0) - p))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def annualised(monthly) -> Column:
    """Annual rate of a monthly hazard or SMM: 1 - (1 - h)^12."""
    return F.lit(1.0) - F.pow(F.lit(1.0) - _c(monthly), F.lit(12))


def remaining_fraction(annual_rate_pct, age, term: int = 360, clipped: bool = True) -> Column:
    """Scheduled balance left after `age` payments as a share of the original balance."""
    r = clip(_c(annual_rate_pct) / F.lit(100.0) / F.lit(12.0), low=1e-6)
    full = F.pow(F.lit(1.0) + r, F.lit(float(term)))
    frac = (full - F.pow(F.lit(1.0) + r, _c(age).cast("double"))) / (full - F.lit(1.0))
    return clip(frac, 0.0, 1.0) if clipped else frac


def linear_score(coefficients: Mapping[str, float]) -> Column:
    """Log partial hazard Σ β_j x_j as one expression."""
    out = F.lit(0.0)
    for name, beta in coefficients.items():
        out = out + F.lit(float(beta)) * F.col(name)
    return out


def harmonic_increment(n, d) -> Column:
    """Σ_{k<d} 1/(n-k) without a loop over d: exact below 16, asymptotic expansion above."""
    n, d = _c(n).cast("double"), _c(d).cast("double")
    table, total = [0.0], 0.0
    for k in range(1, 16):
        total += 1.0 / k
        table.append(total)
    arr = F.array(*[F.lit(v) for v in table])
    euler = 0.5772156649015329

    def tail(x):
        return F.lit(0.5) / x - F.lit(1.0 / 12.0) / (x * x) + F.lit(1.0 / 120.0) / F.pow(x, F.lit(4))

    def full(x):
        return F.when(x < 16, F.element_at(arr, (x + 1).cast("int"))).otherwise(
            F.log(x) + F.lit(euler) + tail(x))

    m = n - d
    far = -F.log1p(-d / n) + tail(n) - tail(m)
    return F.when(d <= 0, F.lit(0.0)).when(m >= 16, far).otherwise(full(n) - full(m))


# --- deterministic sampling keys ------------------------------------------------------------
def hash60(key, seed: int) -> Column:
    """60-bit integer from md5(seed|key): stable under repartitioning and across engines."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), _c(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sampled(key, fraction: float, seed: int) -> Column:
    """Bernoulli sample predicate; its negation is exactly the complement."""
    return hash60(key, seed) < F.lit(int(fraction * (1 << 60)))
