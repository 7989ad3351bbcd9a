"""Grouped prefix join: documents linked by the Jaccard similarity of their word shingles.

1. A pass counts, for hashed counters of a fixed number, how many documents hold a shingle that falls there.
   Shingles ordered by (counter, hash) put rare ones first; any order is correct, this one keeps prefixes rare.
2. A second pass gives each text its set size, a signature of the whole set and its prefix: the first
   n - ceil(t n) + 1 shingles in that order. Equal sets are one class; classes with equal prefix and size one group.
3. Groups that share a prefix shingle are candidates. Two linear rounds compare each group with hubs (of a
   shingle's holders the one with the fewest unshared prefix shingles), so that the members of a large family
   meet in one component without any pair of them being formed. The exact round then takes every pair of
   groups in different components that shares a shingle in the shorter one's index prefix and passes the
   size and position bounds, expands it to members, and verifies these on their whole texts.

Results are the exact components: the linear rounds only save pairs whose ends are already connected.
Defined results: null, empty and wordless texts have an empty set and stand alone; rows that repeat an id get
one row each with the component of their own text, and equal texts share a component; a row without an id has the
component of an equal text that has one, else none; columns beside doc_id and text are not read; a text of fewer words than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.llm.common import Scratch, components, slices, utf8

WORDS, PERCENT = 5, 75
#: Counters of the order: 2 MB on the driver and in each task, whatever the input.
COUNTERS = 1 << 18
_CHUNK = 1 << 12

_LETTER = np.arange(1, 257, dtype=np.uint64)
_LETTER[65:91] += np.uint64(32)
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STEP = 12  # a power is one of 2^12 low ones times a high one
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^i for i < 2^12, base^(2^12 i) as far as exponents up to n need them), modulo 2^64."""
    low = np.cumprod(np.concatenate([[np.uint64(1)], np.full((1 << _STEP) - 1, base, np.uint64)]), dtype=np.uint64)
    high = np.full((n >> _STEP) + 1, low[-1:] * base, np.uint64)
    high[0] = 1
    return low, np.cumprod(high, dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the first word of each text and the end)."""
    gap = _GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(~gap & (edge[:-1] | np.concatenate([[True], gap[:-1]]))) if len(data) else np.zeros(0, np.int64)
    end = np.flatnonzero(~gap & (edge[1:] | np.concatenate([gap[1:], [True]]))) + 1 if len(data) else start
    low, high = _powers(_BASE, len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    total[1:] = _LETTER[data]
    total[1:] *= np.multiply.outer(high, low).ravel()[:len(data)]
    np.cumsum(total, out=total)
    low, high = _powers(_INVERSE, len(data))
    hashed = total[end] - total[start]
    hashed *= low[start & ((1 << _STEP) - 1)]
    hashed *= high[start >> _STEP]
    hashed += (end - start).astype(np.uint64)
    return mix(hashed), np.searchsorted(start, offsets)


def _sort_within(value: np.ndarray, bounds: np.ndarray) -> None:
    """Sort each text's stretch of an array in place."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        value[a:b].sort()


def _by_weight(weight: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places ordered within each text by weight (below 2^32), then as they stand."""
    key = weight.astype(np.uint64) << np.uint64(32)
    key |= np.arange(len(key), dtype=np.uint64)
    _sort_within(key, bounds)
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text, sorted within it; number of the first of each text and the end)."""
    hashed, first = word_hashes(data, offsets)
    count = np.diff(first)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(count)), n)
    at = np.arange(len(doc)) + (first[:-1] - bounds[:-1])[doc]
    width = np.minimum(count, words)[doc]
    short = np.flatnonzero(width < words)
    value = width.astype(np.uint64)
    for k in range(words if len(doc) else 0):
        longer = value * _BASE
        longer += hashed[np.minimum(at + k, len(hashed) - 1)]
        longer = mix(longer)
        over = short[width[short] <= k]
        longer[over] = value[over]
        value = longer
    _sort_within(value, bounds)
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[bounds[:-1][n > 0]] = True
    return value[new], np.concatenate([[0], np.cumsum(new)])[bounds]


def signatures(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: together with its size they name it."""
    out = []
    for salt in (1, 2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(salt)), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _least(n: np.ndarray, t: Fraction) -> np.ndarray:
    """ceil(t n)"""
    return -(-n * t.numerator // t.denominator)


def counters(docs: DataFrame, words: int, n_counters: int) -> np.ndarray:
    """Documents that hold a shingle, by counter; each task sends its sums in chunks that are added by chunk."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_counters, np.int64)
        for batch in slices(batches, 0):
            value, _ = shingle_sets(*utf8(batch.column(0)), words)
            total += np.bincount((value % np.uint64(n_counters)).astype(np.int64), minlength=n_counters)
        for k in range(0, n_counters, _CHUNK):
            if total[k:k + _CHUNK].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([total[k:k + _CHUNK].tobytes()], pa.binary())], ["k", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist()), np.zeros(1, np.int64))
        return pa.table({"k": table.column("k")[:1].cast(pa.int64()), "sums": pa.array([total.tobytes()], pa.binary())})

    # sums of a chunk meet in two steps, so that no task gets one array from each map task
    parts = docs.select("text").mapInArrow(count, "k long, sums binary").withColumn("part", F.spark_partition_id() % 64)
    half = parts.groupBy("k", "part").applyInArrow(lambda t: add(t.select(["k", "sums"])), "k long, sums binary")
    out = np.zeros(n_counters, np.int64)
    for row in half.groupBy("k").applyInArrow(add, "k long, sums binary").collect():
        out[row.k:row.k + _CHUNK] = np.frombuffer(row.sums, np.int64)
    return out


def _described(docs: DataFrame, words: int, t: Fraction, total: np.ndarray) -> DataFrame:
    """(doc_id, n, h1, h2, prefix, heavy): prefix is 8 bytes a shingle, heavy one byte, in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(total, 2**31 - 1).astype(np.int32))
    limit = int(max(64, 4 * total.mean()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches):
            value, bounds = shingle_sets(*utf8(batch.column(1)), words)
            n = np.diff(bounds)
            h1, h2 = signatures(value, bounds)
            weight = table[(value % np.uint64(len(table))).astype(np.int64)]
            order = _by_weight(weight, bounds)
            value, heavy = value[order], (weight[order] > limit).astype(np.uint8)
            size = np.where(n > 0, n - _least(n, t) + 1, 0)
            prefix = [value[a:a + k].tobytes() for a, k in zip(bounds[:-1], size, strict=True)]
            marks = [heavy[a:a + k].tobytes() for a, k in zip(bounds[:-1], size, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(h1), pa.array(h2), pa.array(prefix, pa.binary()), pa.array(marks, pa.binary())],
                ["doc_id", "n", "h1", "h2", "prefix", "heavy"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n int, h1 long, h2 long, prefix binary, heavy binary")


def _exploded(groups: DataFrame) -> DataFrame:
    """(token, gid, n, pos, heavy) of (gid, n, prefix, heavy)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, 1 << 21):
            n = batch.column(1).to_numpy(zero_copy_only=False)
            prefix = batch.column(2).to_pylist()
            size = np.array([len(x) // 8 for x in prefix])
            pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(prefix), np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), size), pa.int64()),
                 pa.array(np.repeat(n, size), pa.int32()), pa.array(pos, pa.int32()),
                 pa.array(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).astype(bool))],
                ["token", "gid", "n", "pos", "heavy"])

    return groups.select("gid", "n", "prefix", "heavy").mapInArrow(run, "token long, gid long, n int, pos int, heavy boolean")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are similar enough. texts: (cid, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            left, left_at = shingle_sets(*utf8(batch.column(2)), words)
            right, right_at = shingle_sets(*utf8(batch.column(3)), words)
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = left[left_at[i]:left_at[i + 1]], right[right_at[i]:right_at[i + 1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    joined = (pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
              .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return joined.mapInArrow(run, "a long, b long")


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, n_counters: int = COUNTERS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text, ...)."""
    t, scratch = Fraction(percent, 100), Scratch(docs.sparkSession, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = _described(docs, words, t, counters(docs, words, n_counters))
    described = scratch.save(described.withColumn("rid", F.monotonically_increasing_id()))
    # a class is named by one of its rows, as an id may repeat with different texts; did finds its text
    classes = scratch.save(described.where("n > 0 and doc_id is not null").groupBy("n", "h1", "h2")
                           .agg(F.min("rid").alias("cid"), F.min("doc_id").alias("did"), F.first(F.xxhash64("prefix")).alias("ph")))
    members = scratch.save(classes.join(classes.groupBy("n", "ph").agg(F.min("cid").alias("gid")), ["n", "ph"])
                           .select("cid", "did", "gid", "n", "h1", "h2"))
    heads = members.where("cid = gid").select(F.col("gid").alias("rid"))
    groups = described.join(heads, "rid").select(F.col("rid").alias("gid"), "n", "prefix", "heavy")
    # shingles held by one group only can't make a pair; a light one's holders are few, a heavy one is kept unseen
    rows = _exploded(groups)
    held = rows.withColumn("salt", F.when(F.col("heavy"), F.xxhash64("gid")).otherwise(0))
    counted = held.withColumn("df", F.count("*").over(Window.partitionBy("token", "salt")))
    posts = scratch.save(counted.where("heavy or df > 1").select("token", "gid", "n", "pos"))
    slim = scratch.save(described.select("doc_id", "n", "h1", "h2"))
    scratch.drop(described)
    del rows, held, counted, groups, described
    scratch.release()
    prefix_size = F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1
    rare = posts.groupBy("gid").agg((F.count("*") / F.first(prefix_size)).alias("common"))
    crowded = members.groupBy("gid").agg(F.count("*").alias("m")).where("m > 1").select("gid")
    wanted = members.join(posts.select("gid").union(crowded).distinct(), "gid", "left_semi")

    def same_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, met = None, set()  # a merge join returns the rows of an id one after the other
        for batch in slices(batches):
            value, bounds = shingle_sets(*utf8(batch.column(1)), words)
            h1, h2 = signatures(value, bounds)
            ok = (h1 == batch.column(2).to_numpy(zero_copy_only=False)) & (h2 == batch.column(3).to_numpy(zero_copy_only=False))
            ids, classes = batch.column(4).to_numpy(zero_copy_only=False), batch.column(0).to_numpy(zero_copy_only=False)
            at = []
            for i in np.flatnonzero(ok).tolist():
                if ids[i] != last:
                    last, met = ids[i], set()
                if classes[i] not in met:
                    met.add(classes[i])
                    at.append(i)
            yield batch.select(["cid", "text"]).take(pa.array(at, pa.int64()))

    texts = (docs.hint("merge").join(wanted.select(F.col("did").alias("doc_id"), "cid", "h1", "h2"), "doc_id")
             .select("cid", "text", "h1", "h2", "doc_id"))
    texts = scratch.save(texts.mapInArrow(same_set, "cid long, text string"))
    scratch.release()
    marked = scratch.save(posts.join(rare, "gid"))
    scratch.drop(posts)
    size_ok = F.least("n", "hn") * 100 >= F.greatest("n", "hn") * percent

    # members of a group against its head
    near = members.where("cid <> gid").select(F.col("cid").alias("a"), F.col("gid").alias("b"))
    edges = scratch.save(_verified(near, texts, words, percent))
    comp = None
    for _ in range(2):
        now = marked if comp is None else marked.join(comp.withColumnRenamed("node", "gid"), "gid", "left")
        now = now.withColumn("comp", F.coalesce("component", "gid") if comp is not None else F.col("gid"))
        hub = (now.groupBy("token").agg(F.max(F.struct("common", F.xxhash64("gid").alias("tie"), "gid", "n", "comp")).alias("h"),
                                        F.min("comp").alias("low"), F.max("comp").alias("high"))
               .where("low <> high").select("token", F.col("h.gid").alias("hub"), F.col("h.n").alias("hn"), F.col("h.comp").alias("hc")))
        stars = (now.join(hub, "token").where((F.col("comp") != F.col("hc")) & size_ok)
                 .groupBy("gid", "hub").agg(F.count("*").alias("shared")))
        best = (stars.groupBy("gid").agg(F.max(F.struct("shared", "hub")).alias("s"))
                .select(F.col("gid").alias("a"), F.col("s.hub").alias("b")))
        edges = scratch.save(edges.union(_verified(best, texts, words, percent)))
        scratch.release()
        comp = scratch.save(components(edges, scratch))

    # exact round: pairs of groups in different components
    now = marked.join(comp.withColumnRenamed("node", "gid"), "gid", "left").withColumn("comp", F.coalesce("component", "gid"))
    spread = now.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    scratch.release()
    now = scratch.save(now.join(spread, "token").select("token", "gid", "n", "pos", "comp"))
    # prefix shingles without a holder in another component can't be shared: `most` bounds any overlap
    most = now.groupBy("gid").agg((F.first("n") - F.first(prefix_size) + F.count("*")).alias("most"))
    now = now.join(most, "gid")
    need = lambda a, b: F.ceil((a + b) * percent / (100.0 + percent) - 1e-9)
    index_size = F.col("n") - F.ceil(F.col("n") * (2.0 * percent / (100 + percent)) - 1e-9) + 1
    x = now.where(F.col("pos") < index_size)
    y = now.select("token", *[F.col(c).alias(f"{c}2") for c in ("gid", "n", "pos", "comp", "most")])
    # at a pair's first common shingle nothing before it is shared; only that row of a pair has to pass
    bound = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"), "most", "most2")
    met = ((F.col("comp") != F.col("comp2")) & ((F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("gid") < F.col("gid2"))))
           & (F.col("n") * 100 >= F.col("n2") * percent) & (bound >= need(F.col("n"), F.col("n2"))))
    pairs = (x.join(y, (x["token"] == y["token"]) & met).groupBy("gid", "gid2").agg(F.first("comp").alias("c1"), F.first("comp2").alias("c2")))
    of = members.select("cid", "gid")
    expanded = (pairs.join(of.withColumnRenamed("cid", "a"), "gid").join(of.select(F.col("cid").alias("b"), F.col("gid").alias("gid2")), "gid2")
                .select("a", "b"))
    # members of one group that its head did not link
    loose = of.join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn("c", F.coalesce("component", "cid")).join(crowded, "gid", "left_semi")
    other = loose.select(F.col("gid").alias("g2"), F.col("cid").alias("b"), F.col("c").alias("c2"))
    inner = (loose.where("cid <> gid").join(other, (loose["gid"] == other["g2"]) & (loose["c"] < other["c2"]))
             .select(F.col("cid").alias("a"), "b"))
    edges = edges.union(_verified(expanded.union(inner).distinct(), texts, words, percent))
    comp = components(edges, scratch)
    comp = scratch.save(comp.withColumnRenamed("node", "cid"))
    least = members.join(comp, "cid").groupBy("component").agg(F.min("did").alias("least"))
    named = (members.join(comp.join(least, "component"), "cid", "left")
             .select("n", "h1", "h2", F.coalesce("least", "did").alias("component_id")))
    out = slim.select("doc_id", "n", "h1", "h2").join(named, ["n", "h1", "h2"], "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stand for their component: those with its least id (texts with an empty set all stay)."""
    found = similar_components(docs, words, percent).where("doc_id is null or doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))  # names of docs can't clash inside
    return rows.join(found, F.col("_row.doc_id").eqNullSafe(F.col("_keep")), "left_semi").select("_row.*")
