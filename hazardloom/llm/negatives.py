"""Hard negatives of anchors among all vectors, searched with score bounds along spanning trees of anchors.

Components become floor(256 x); a score is the integer inner product with the anchor. Anchors are the query set: they
are ranked (near labels together) and cut into blocks of a fixed number, each with its least spanning tree by
Euclidean distance, built in one task. A wave of blocks of bounded bytes is broadcast, and every task takes its rows
past all trees of the wave. For a child c of a parent p, score(c, x) = score(p, x) + <c - p, x>, so the parent's score
(or interval) plus and minus |c - p| |x| bounds the child's. Only candidates whose interval meets the child's window
are scored again; the others hand their interval on.

1. Positives: the window of an anchor is open above and starts at the `positives`-th best score met so far.
2. Negatives: each positive gives a window of scores, low <= 100 score / positive score <= high; what is met first
   raises its lower end, as only the best `negatives` in it are wanted.

What tasks find for an anchor (at most `positives`, or `negatives` for each positive) is merged by ranking. Results
are exact: bounds only save inner products.

Defined results: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; nor do
those with a component of 2^18 or more in size, whose products would not fit 64 bits. Shorter vectors count as if
filled with zeros. Rows with the anchor's own vec_id are not `other` rows; repeated rows count as often as they stand,
and an anchor that stands twice has its rows twice. Ties go to the smaller vec_id. Empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazardloom.llm.common import Scratch, numbered

POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95
#: Anchors of a tree, bytes of vectors in a wave (or one block if that is larger), rows scored at once.
BLOCK, WAVE_BYTES, ROWS = 512, 8 << 20, 2048
_SCALE, _MOST = 256.0, 1 << 18
_BLOCK = "block long, ordinal array<long>, vec_id array<long>, label array<long>, parent array<int>, edge array<double>, vectors binary"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, label: Column, width: int) -> DataFrame:
    """(vec_id, label, x): x is a binary row of `width` int32 components."""
    size = F.lit(float(_MOST))
    good = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < size))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(good)
    rows = rows.select("vec_id", label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding")).where("label is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            start = column.offsets.to_numpy().astype(np.int64)
            flat = np.floor(column.values.to_numpy(zero_copy_only=False) * _SCALE)
            length = np.diff(start)
            x = np.zeros((batch.num_rows, width), np.int32)
            at = np.repeat(np.arange(batch.num_rows), length)
            x[at, np.arange(start[0], start[-1]) - np.repeat(start[:-1], length)] = flat[start[0]:start[-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "label", "x"])

    return rows.mapInArrow(run, "vec_id long, label long, x binary")


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of a with those of b; floating point only where no rounding can occur."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): nodes so that parents come first (the root's parent is -1), and the distance to the parent."""
    n = len(x)
    x = x.astype(np.float64)
    square = np.einsum("ij,ij->i", x, x)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    order, edge, done = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
    node = 0
    for k in range(n):
        order[k], done[node] = node, True
        edge[node] = np.sqrt(max(near[node], 0.0)) if k else 0.0
        far = square + square[node] - 2.0 * (x @ x[node])
        closer = ~done & (far < near)
        near[closer], parent[closer] = far[closer], node
        if k + 1 < n:
            node = int(np.argmin(np.where(done, np.inf, near)))
    # distances between integer vectors, computed again without cancellation and rounded up
    some = parent >= 0
    edge[some] = np.sqrt(((x[some] - x[parent[some]]) ** 2).sum(1)) * (1 + 1e-12)
    return order, parent, edge


def blocks(anchors: DataFrame, size: int) -> DataFrame:
    """One row for each `size` anchors (ordinal, vec_id, label, x), in tree order: parent is a place in the row."""
    def tree(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ordinal")
        x = np.stack([np.frombuffer(v, np.int32) for v in rows.column("x").to_pylist()])
        order, parent, edge = spanning_tree(x)
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        up = np.where(parent[order] >= 0, place[parent[order]], -1)
        pick = pa.array(order)
        lists = [pa.array([c.to_pylist()], t) for c, t in (
            (rows.column("ordinal").take(pick), pa.list_(pa.int64())), (rows.column("vec_id").take(pick), pa.list_(pa.int64())),
            (rows.column("label").take(pick), pa.list_(pa.int64())), (pa.array(up, pa.int32()), pa.list_(pa.int32())), (pa.array(edge[order]), pa.list_(pa.float64())))]
        return pa.table([rows.column("block").slice(0, 1).combine_chunks(), *lists, pa.array([x[order].tobytes()], pa.binary())],
                        ["block", "ordinal", "vec_id", "label", "parent", "edge", "vectors"])

    return (anchors.withColumn("block", F.floor(F.col("ordinal") / size).cast("long")).groupBy("block").applyInArrow(tree, _BLOCK))


class Tree:
    """A block of anchors on the side of a task."""

    def __init__(self, row: dict):
        self.ordinal, self.vec_id, self.label = (np.array(row[k], np.int64) for k in ("ordinal", "vec_id", "label"))
        self.parent, self.edge = np.array(row["parent"]), np.array(row["edge"])
        self.x = np.frombuffer(row["vectors"], np.int32).reshape(len(self.parent), -1)

    def walk(self, rows: np.ndarray, meets: object, found: object) -> int:
        """Bounds all anchors' scores of rows; meets(c, low, high) tells which to score, found(c, at, scores) takes these.

        Returns how many inner products were computed.
        """
        norm = np.sqrt(np.einsum("ij,ij->i", rows.astype(np.float64), rows.astype(np.float64))) * (1 + 1e-12)
        low, high = (np.empty((len(self.parent), len(rows)), np.int64) for _ in range(2))
        scored = 0
        for c, p in enumerate(self.parent):
            if p < 0:
                at, low[c] = np.arange(len(rows)), exact(self.x[c:c + 1], rows)[0]
                high[c] = low[c]
            else:
                reach = np.ceil(self.edge[c] * norm).astype(np.int64) + 1
                np.subtract(low[p], reach, out=low[c])
                np.add(high[p], reach, out=high[c])
                at = np.flatnonzero(meets(c, low[c], high[c]))
                low[c, at] = high[c, at] = exact(self.x[c:c + 1], rows[at])[0]
            scored += len(at)
            if len(at):
                found(c, at, low[c, at])
        return scored


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by score descending, id ascending."""
    if len(score) > 4 * k:
        kept = np.flatnonzero(score >= np.partition(score, -k)[-k])
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((ids[kept], -score[kept]))[:k]]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            yield (part.column(0).to_numpy(), part.column(1).to_numpy(),
                   np.frombuffer(b"".join(part.column(2).to_pylist()), np.int32).reshape(part.num_rows, -1))


def _found_positives(rows: DataFrame, wave: object, k: int) -> DataFrame:
    """(ordinal, id, score): the best k same-label rows of each anchor in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(row) for row in wave.value]
        best = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in t.parent] for t in trees]
        for ids, label, x in _rows_of(batches):
            for t, mine in zip(trees, best, strict=True):
                def meets(c, low, high, t=t, mine=mine):
                    worst = mine[c][1][-1] if len(mine[c][1]) == k else None
                    return (label == t.label[c]) & (ids != t.vec_id[c]) & (True if worst is None else high >= worst)

                def found(c, at, score, t=t, mine=mine):
                    ok = (label[at] == t.label[c]) & (ids[at] != t.vec_id[c])  # the root's scores are of all rows
                    i, s = np.concatenate([mine[c][0], ids[at][ok]]), np.concatenate([mine[c][1], score[ok]])
                    first = _best(s, i, k)
                    mine[c] = i[first], s[first]

                t.walk(x, meets, found)
        out = [(np.repeat(t.ordinal[c], len(i)), i, s) for t, mine in zip(trees, best, strict=True) for c, (i, s) in enumerate(mine)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["ordinal", "id", "score"])

    return rows.mapInArrow(run, "ordinal long, id long, score long")


def _found_negatives(rows: DataFrame, wave: object, windows: object, k: int) -> DataFrame:
    """(ordinal, place, id, score): for each window (place) of an anchor the best k rows of another label in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Tree(row) for row in wave.value]
        spans = windows.value
        state = [[[[low, high, place, np.zeros(0, np.int64), np.zeros(0, np.int64)] for place, low, high in spans.get(int(o), ())] for o in t.ordinal] for t in trees]
        for ids, label, x in _rows_of(batches):
            for t, mine in zip(trees, state, strict=True):
                def meets(c, low, high, t=t, mine=mine):
                    out = np.zeros(len(low), bool)
                    for a, b, *_ in mine[c]:
                        out |= (high >= a) & (low <= b)
                    return out & (label != t.label[c])

                def found(c, at, score, t=t, mine=mine):
                    other = label[at] != t.label[c]
                    at, score = at[other], score[other]
                    for window in mine[c]:
                        ok = (score >= window[0]) & (score <= window[1])
                        if not ok.any():
                            continue
                        i, s = np.concatenate([window[3], ids[at[ok]]]), np.concatenate([window[4], score[ok]])
                        first = _best(s, i, k)
                        window[3], window[4] = i[first], s[first]
                        if len(first) == k:
                            window[0] = max(window[0], int(window[4][-1]))

                t.walk(x, meets, found)
        out = [(np.repeat(t.ordinal[c], len(i)), np.repeat(place, len(i)), i, s) for t, mine in zip(trees, state, strict=True)
               for c, own in enumerate(mine) for _, _, place, i, s in own if len(i)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)], ["ordinal", "place", "id", "score"])

    return rows.mapInArrow(run, "ordinal long, place long, id long, score long")


def _ranked(found: DataFrame, by: list[str], name: str, k: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column | None = None, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    vectors: (vec_id, embedding, label); anchor: condition on vec_id that makes a row an anchor; label: the label to use.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    if width <= 0:
        return spark.createDataFrame([], _RESULT)
    rows = scratch.save(usable(vectors, F.col("label") if label is None else label, width))
    chosen = rows.where(anchor)
    total = chosen.count()
    if not total:
        return spark.createDataFrame([], _RESULT)
    ranked = numbered(chosen, [F.pmod(F.xxhash64("label"), F.lit(16)), F.xxhash64("vec_id")], "ordinal", total, ties=["vec_id", "label", "x"])
    trees = scratch.save(blocks(ranked, block))
    ids = scratch.save(trees.select(F.explode(F.arrays_zip("ordinal", "vec_id")).alias("e")).select("e.ordinal", F.col("e.vec_id").alias("anchor_id")))
    step = max(1, WAVE_BYTES // (block * width * 4))
    found, shown = None, None
    for first in range(0, -(-total // block), step):
        wave = spark.sparkContext.broadcast([r.asDict() for r in trees.where(F.col("block").between(first, first + step - 1)).collect()])
        near = scratch.save(_ranked(_found_positives(rows, wave, positives), ["ordinal"], "place", positives))
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for r in near.collect():
            a, b = -(-r.score * low // 100), r.score * high // 100
            if a <= b:
                spans.setdefault(r.ordinal, []).append((r.place, a, b))
        windows = spark.sparkContext.broadcast(spans)
        far = scratch.save(_ranked(_found_negatives(rows, wave, windows, negatives), ["ordinal", "place"], "rank", negatives))
        shown, found = (near, far) if found is None else (shown.union(near), found.union(far))
        wave.destroy()
        windows.destroy()
    return (found.join(shown.select("ordinal", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["ordinal", "place"])
            .join(ids, "ordinal")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
