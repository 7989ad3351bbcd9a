"""Running totals, exact ranks and exact quantiles over a whole table without a global sort
in one task.

A value column is first reduced to distinct values with counts, then cut into buckets whose
bounds come from a mergeable quantile sketch. Bucket totals give the offset of each bucket and
an ordinary window works inside it. Bounds only steer the load: the result is exact whatever
they are, and a group holding most of the rows is spread over all buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET = "__bucket"


def _bucket_count(df: DataFrame) -> int:
    """A square near the number of shuffle partitions: 16, 64, 256 or 1024."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return next(b for b in (16, 64, 256, 1024) if b >= min(parts, 1024))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys)) if keys else left.crossJoin(right)  # right has one row


def with_buckets(df: DataFrame, by: Sequence[str], order: str, buckets: int) -> DataFrame:
    """Bucket number of `order` within its group, increasing with `order`.

    The bucket is the number of bounds below the value, found in two steps: which stretch of
    √buckets bounds, then where inside it. Both are flat sums of comparisons that stay in
    generated code; a lambda over the bounds array would be interpreted for every bound.
    """
    side = math.isqrt(buckets)
    probs = [i / buckets for i in range(1, side * side)]
    bounds = df.groupBy(*by).agg(
        F.percentile_approx(order, probs, 20 * buckets).alias("__bounds"))

    def below(position) -> Column:
        return F.when(F.get("__bounds", position) < F.col(order), 1).otherwise(0)

    def total(terms):
        out = F.lit(0)
        for t in terms:
            out = out + t
        return out

    coarse = total(below(F.lit(i * side - 1)) for i in range(1, side))
    fine = total(below(F.col("__c") * F.lit(side) + F.lit(j)) for j in range(side - 1))
    out = _join(df, bounds, by).withColumn("__c", coarse)
    return out.withColumn(BUCKET, F.col("__c") * F.lit(side) + fine).drop("__bounds", "__c")


def running_totals(df: DataFrame, by: Sequence[str], order: str, values: Sequence[str],
                   ties: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Add `<v>__before`: the sum of `v` over rows of the group that come earlier in
    (order, *ties). Rows must be unique in (by, order, ties)."""
    by = list(by)
    # always-true filter over all columns: every consumer below then reads the same columns,
    # so Spark reuses one exchange of the input instead of pruning it three different ways
    df = df.where(F.hash(*df.columns) >= F.lit(-(1 << 31)))
    b = with_buckets(df, by, order, buckets or _bucket_count(df))
    cell = by + [BUCKET]
    totals = b.groupBy(*cell).agg(*[F.sum(v).alias(f"__{v}") for v in values])
    w = W.partitionBy(*by).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *cell, *[F.coalesce(F.sum(f"__{v}").over(w), F.lit(0)).alias(f"__{v}") for v in values])
    inner = W.partitionBy(*cell).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, -1)
    out = b.join(offsets, cell)
    return out.select(
        *df.columns,
        *[(F.col(f"__{v}") + F.coalesce(F.sum(v).over(inner), F.lit(0))).alias(f"{v}__before")
          for v in values])


def ranked(df: DataFrame, by: Sequence[str], order: str, ties: Sequence[str] = (),
           name: str = "rank") -> DataFrame:
    """Exact 1-based rank within the group; `order` must be numeric."""
    one = df.withColumn("__one", F.lit(1).cast("bigint"))
    out = running_totals(one, by, order, ["__one"], ties)
    return out.withColumn(name, F.col("__one__before") + 1).drop("__one", "__one__before")


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles, long: (by..., column, n, q) with `q` an array in the
    order of `probs`. NULLs are ignored."""
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("kv")).select(*by, "kv.*").where("value is not null")
    cell = by + ["column"]
    counts = long.groupBy(*cell, "value").agg(F.count("*").alias("cnt"))
    run = running_totals(counts, cell, "value", ["cnt"])
    totals = counts.groupBy(*cell).agg(F.sum("cnt").alias("n"))
    first, last = F.col("cnt__before"), F.col("cnt__before") + F.col("cnt") - 1
    picks = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        for tag, pos in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            picks.append(F.max(F.when((first <= pos) & (pos <= last), F.col("value")))
                         .alias(f"__{tag}{i}"))
    got = run.join(totals, cell).groupBy(*cell, "n").agg(*picks)
    values = []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        values.append(lo + (h - F.floor(h)) * (hi - lo))
    return got.select(*cell, "n", F.array(*values).alias("q"))


#: Bins of a pass of `selected`, and distinct values of a column that are counted one by one.
BINS, DISTINCT = 1 << 14, 20_000


def bounds(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, tuple]]:
    """Rows, and (values, smallest, largest) of every column, from one pass."""
    first = df.agg(F.count("*").alias("n"), *[a for i, c in enumerate(columns) for a in (
        F.count(F.col(c)).alias(f"n{i}"), F.min(F.col(c).cast("double")).alias(f"a{i}"), F.max(F.col(c).cast("double")).alias(f"b{i}"))]).collect()[0]
    return first["n"], {c: tuple(first[f"{k}{i}"] for k in "nab") for i, c in enumerate(columns)}


def _binned(x: DataFrame, spans: Sequence[tuple[int, float, float]]) -> list[list[tuple[int, float, float]]]:
    """(values, smallest, largest) of the filled bins of every span (column, low, high), in order."""
    schema = "s int, k array<int>, n array<long>, a array<double>, b array<double>"
    used = sorted({i for i, _, _ in spans})
    place = {i: j for j, i in enumerate(used)}

    def emit(found):
        for s, (n, a, b) in found.items():
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), *[
                pa.ListArray.from_arrays(pa.array([0, len(k)], pa.int32()), pa.array(v, t))
                for v, t in ((k, pa.int32()), (n[k], pa.int64()), (a[k], pa.float64()), (b[k], pa.float64()))]], ["s", "k", "n", "a", "b"])

    def empty():
        return np.zeros(BINS + 2, np.int64), np.full(BINS + 2, np.inf), np.full(BINS + 2, -np.inf)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for s, (i, a, b) in enumerate(spans):
                v = batch.column(place[i]).to_numpy(zero_copy_only=False)
                v = v[(v >= a) & (v <= b)]
                if not len(v):
                    continue
                width = (b - a) / BINS
                # values that cannot be told apart by bins any more are counted as they are
                cell = np.minimum((v - a) / width, BINS + 1).astype(np.int64) if width > 0 else np.zeros(len(v), np.int64)
                n, low, high = found.setdefault(s, empty())
                n += np.bincount(cell, minlength=len(n))
                np.minimum.at(low, cell, v)
                np.maximum.at(high, cell, v)
        yield from emit(found)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        for batch in batches:
            for j, s in enumerate(batch.column("s").to_pylist()):
                k, n, a, b = (np.asarray(batch.column(c)[j].values) for c in "knab")
                whole = found.setdefault(s, empty())
                whole[0][k] += n
                whole[1][k] = np.minimum(whole[1][k], a)
                whole[2][k] = np.maximum(whole[2][k], b)
        yield from emit(found)

    rows = x.select(*[f"c{i}" for i in used]).mapInArrow(count, schema).repartition("s").mapInArrow(merge, schema).toArrow()
    out: list[list] = [[] for _ in spans]
    for s, n, a, b in zip(*(rows[c].to_pylist() for c in "snab")):
        out[s] = list(zip(n, a, b))
    return out


def _values(x: DataFrame, spans: Sequence[tuple[int, float, float]]) -> list[list[tuple[float, int]]]:
    """The different values of every span with their numbers, ascending."""
    used = sorted({i for i, _, _ in spans})
    place = {i: j for j, i in enumerate(used)}

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, (i, a, b) in enumerate(spans):
                v = batch.column(place[i]).to_numpy(zero_copy_only=False)
                v, n = np.unique(v[(v >= a) & (v <= b)], return_counts=True)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), s), pa.int32()), pa.array(v), pa.array(n, pa.int64())], ["s", "v", "n"])

    rows = x.select(*[f"c{i}" for i in used]).mapInArrow(near, "s int, v double, n long").groupBy("s", "v").agg(F.sum("n").alias("n")).collect()
    out: list[list] = [[] for _ in spans]
    for r in sorted(rows, key=lambda r: (r["s"], r["v"])):
        out[r["s"]].append((r["v"], r["n"]))
    return out


def selected(df: DataFrame, columns: Sequence[str], prob: float = 0.5, known: Mapping[str, tuple] | None = None) -> dict[str, float | None] | None:
    """Exact quantile of every column without moving rows; None where a column has values that are not finite.

    Each pass counts the values of every column in equal bins between its bounds, and the bin that
    holds the wanted rank gives the next bounds; a column ends when few values are left. A bin's
    number never falls as the value rises, so bins only steer the search and the result is exact.
    `known` has the columns' `bounds` if they were taken before.
    """
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    known = known or bounds(df, columns)[1]
    out: dict[str, float | None] = {}
    wanted: dict[tuple[int, int], tuple[float, float, int]] = {}  # (column, which end): low, high, rank between them
    found: dict[tuple[int, int], float] = {}
    for i, c in enumerate(columns):
        n, a, b = known[c]
        if n and not (math.isfinite(a) and math.isfinite(b) and math.isfinite(b - a)):
            return None
        if n:
            h = (n - 1) * prob
            for end, rank in enumerate((math.floor(h), math.ceil(h))):
                wanted[i, end] = (a, b, rank)
    while wanted:
        for key in [k for k, (a, b, _) in wanted.items() if a == b]:
            found[key] = wanted.pop(key)[0]
        spans = list(dict.fromkeys((i, a, b) for (i, _), (a, b, _) in wanted.items()))
        if not spans:
            break
        table = _binned(x, spans)
        small: dict[tuple[int, float, float], None] = {}
        for key, (a, b, rank) in list(wanted.items()):
            for n, low, high in table[spans.index((key[0], a, b))]:
                if rank < n:
                    wanted[key] = (low, high, rank)
                    if low < high and (n <= DISTINCT or (low, high) == (a, b)):
                        small[key[0], low, high] = None
                    break
                rank -= n
        if small:
            small = list(small)
            values = _values(x, small)
            for key, (a, b, rank) in list(wanted.items()):
                if (key[0], a, b) in small:
                    for v, n in values[small.index((key[0], a, b))]:
                        if rank < n:
                            found[key] = v
                            del wanted[key]
                            break
                        rank -= n
    for i, c in enumerate(columns):
        n = known[c][0]
        h = (n - 1) * prob
        out[c] = found[i, 0] + (h - math.floor(h)) * (found[i, 1] - found[i, 0]) if n else None
    return out


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Exact medians, long: (by..., column, median)."""
    return quantiles(df, columns, [0.5], by).select(
        *by, "column", F.element_at("q", 1).alias("median"))
