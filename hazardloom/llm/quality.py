"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line's score uses its own features and those of the
lines before and after it, and a learned 2 x 2 table links neighbouring labels. Forward and backward
messages (kept as log-odds, so nothing under- or overflows) give each line's marginal, and the marginals
weighted by line length give the document's quality, which a two-parameter logistic maps to a probability.

Defined results: a null or empty text is one empty line and gets a score as any other. Rows that repeat
an id are scored each. Without labels of both classes the score is the labelled share of good documents
(0.5 without labels). Extra columns of `docs` play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import slices, utf8

#: Documents of each class that a fit uses at most, each of them whole.
SAMPLE_DOCS = 4000

_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t",
                             b"!?", b"#$%&*+=@^~\\", b"|<>[]{}()/_", b".,;:'\"-"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9
_KINDS = 10
#: own features and those of both neighbours, first and last line, constant
N_OWN = _KINDS + 9
N_FEATURES = 3 * N_OWN + 3


def _at(data: np.ndarray, at: np.ndarray, fallback: int = 0) -> np.ndarray:
    return np.where((at >= 0) & (at < len(data)), data[np.clip(at, 0, max(0, len(data) - 1))] if len(data) else fallback, fallback)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, its bytes, number of the first line of each text and the end)."""
    n_docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    inside = np.searchsorted(breaks, offsets)
    first = inside[:-1] - inside[0] + np.arange(n_docs)
    bounds = np.append(first, inside[-1] - inside[0] + n_docs)
    start = np.empty(bounds[-1], np.int64)
    is_first = np.zeros(bounds[-1], bool)
    is_first[first] = True
    start[is_first] = offsets[:-1]
    start[~is_first] = breaks + 1
    end = np.empty_like(start)
    is_last = np.zeros(bounds[-1], bool)
    is_last[bounds[1:] - 1] = True
    end[is_last] = offsets[1:]
    end[~is_last] = breaks
    size = end - start
    kind = _CLASS[data]

    def within(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[end] - total[start]

    own = np.empty((len(start), N_OWN), np.float32)
    length = np.maximum(size, 1)
    counts = [within(kind == k) for k in range(_KINDS)]
    for k in range(_KINDS):
        own[:, k] = counts[k] / length
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    words = counts[3] + 1
    own[:, _KINDS] = np.log1p(size) / 5
    own[:, _KINDS + 1] = np.minimum(size / words, 40) / 10
    own[:, _KINDS + 2] = within(same) / length
    own[:, _KINDS + 3] = (counts[4] + counts[5] + counts[6]) / words
    own[:, _KINDS + 4] = np.isin(_at(data, end - 1), (33, 46, 58, 63)) & (size > 0)
    own[:, _KINDS + 5] = size == 0
    # a line that repeats an earlier one of the same text
    weight = np.full(len(data), 1099511628211, np.uint64)
    weight = np.cumprod(weight, dtype=np.uint64) if len(data) else weight
    mixed = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * weight, dtype=np.uint64)])
    # words that repeat the word before them
    gap = (kind == 3) | (data == 10)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = np.flatnonzero(~gap & (edge[:-1] | np.concatenate([[True], gap[:-1]])))
    until = np.flatnonzero(~gap & (edge[1:] | np.concatenate([gap[1:], [True]]))) + 1
    key = (mixed[until] - mixed[word]) * _inverse(weight[word]) if len(word) else np.zeros(0, np.uint64)
    line = np.searchsorted(start, word, side="right") - 1
    echo = np.flatnonzero((key[1:] == key[:-1]) & (line[1:] == line[:-1])) + 1
    own[:, _KINDS + 8] = np.bincount(line[echo], minlength=len(start)) / words
    power = _at(weight, start, 1).astype(np.uint64)
    inverse = _inverse(power)
    doc = np.cumsum(is_first) - 1
    key = ((mixed[end] - mixed[start]) * inverse) ^ (size.astype(np.uint64) << np.uint64(40))
    order = np.lexsort((np.arange(len(key)), key, doc))
    again = np.zeros(len(key), bool)
    again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    own[:, _KINDS + 6] = again & (size > 0)
    own[:, _KINDS + 7] = counts[1] / np.maximum(counts[1] + counts[2], 1)
    out = np.zeros((len(start), N_FEATURES), np.float32)
    out[:, :N_OWN] = own
    out[1:, N_OWN:2 * N_OWN] = own[:-1]
    out[is_first, N_OWN:2 * N_OWN] = 0
    out[:-1, 2 * N_OWN:3 * N_OWN] = own[1:]
    out[is_last, 2 * N_OWN:3 * N_OWN] = 0
    out[:, -3], out[:, -2], out[:, -1] = is_first, is_last, 1
    return out, size, bounds


def _inverse(odd: np.ndarray) -> np.ndarray:
    """Inverse modulo 2^64 by Newton's rule."""
    x = odd.copy()
    for _ in range(6):
        x = x * (np.uint64(2) - odd * x)
    return x


def messages(score: np.ndarray, bounds: np.ndarray, link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward (own score included) and backward log-odds of every line; chains advance side by side."""
    forward, backward = score.astype(np.float64).copy(), np.zeros(len(score))
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    start, size = bounds[:-1][order], size[order]
    lead, tail = start, start + size - 1
    active = len(size)
    for t in range(1, int(size[0]) if len(size) else 0):
        active = int(np.searchsorted(-size[:active], -t, side="left"))
        at = lead[:active] + t
        f = forward[at - 1]
        forward[at] += np.logaddexp(link[0, 1], link[1, 1] + f) - np.logaddexp(link[0, 0], link[1, 0] + f)
        at = tail[:active] - t
        b = backward[at + 1] + score[at + 1]
        backward[at] = np.logaddexp(link[1, 0], link[1, 1] + b) - np.logaddexp(link[0, 0], link[0, 1] + b)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class QualityModel:
    weights: np.ndarray
    link: np.ndarray
    scale: tuple[float, float]
    constant: float | None = None

    def document(self, features: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals."""
        forward, backward = messages(features @ self.weights, bounds, self.link)
        weight = size + 1.0
        return np.add.reduceat(_sigmoid(forward + backward) * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])

    def score(self, quality: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(quality), self.constant)
        return _sigmoid(self.scale[0] * _logit(quality) + self.scale[1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, keep, per_class: int) -> DataFrame:
    """(_text, _y): at most `per_class` labelled documents of each class, chosen by a hash of the id."""
    marked = (labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_y")).where("_id is not null and _y is not null")
              .groupBy("_id").agg(F.max("_y").cast("int").alias("_y")))
    marked = marked.where(keep(F.col("_id")))
    order = F.xxhash64(F.lit(label), "_id")
    chosen = None
    for y in (0, 1):
        part = marked.where(F.col("_y") == y).orderBy(order, "_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    return texts.join(F.broadcast(chosen), "_id").select("_id", "_text", "_y")


def fit_quality(docs: DataFrame, labels: DataFrame, keep=lambda doc_id: F.lit(True), per_class: int = SAMPLE_DOCS,
                steps: int = 120) -> QualityModel:
    """Fit on labelled documents for which keep(doc_id) holds; a line inherits its document's label.

    The sample is bounded by `per_class` documents of each class, chosen by a hash of the id and learnt from whole;
    the features of their lines (not texts) reach the driver.
    """
    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, size, bounds = line_features(*utf8(batch.column(1)))
            ids, y = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = []
            for i in range(len(ids)):
                a, b = int(bounds[i]), int(bounds[i + 1])
                rows.append((ids[i], y[i], x[a:b].tobytes(), size[a:b].astype(np.int64).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], ["id", "y", "x", "size"])

    sample = training_sample(docs, labels, "quality", keep, per_class)
    got = sorted(sample.mapInArrow(prepare, "id long, y int, x binary, size binary").collect(), key=lambda r: (r.id, r.x))
    y = np.array([r.y for r in got], np.float64)
    weights, link = np.zeros(N_FEATURES), np.zeros((2, 2))
    if len(set(y)) < 2:
        return QualityModel(weights, link, (0.0, 0.0), float(y.mean()) if len(y) else 0.5)
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got])
    size = np.concatenate([np.frombuffer(r.size, np.int64) for r in got])
    bounds = np.concatenate([[0], np.cumsum([len(r.size) // 8 for r in got])])
    of = np.repeat(np.arange(len(y)), np.diff(bounds))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    gold, per = y[of], (balance / np.diff(bounds))[of]
    inner = np.flatnonzero(of[1:] == of[:-1]) + 1
    mean, rms = np.zeros(N_FEATURES), np.sqrt((x ** 2).mean(0) + 1e-6)
    xs = x / rms
    theta, m, v = np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4), np.zeros(N_FEATURES + 4)
    for step in range(1, steps + 1):
        w, link = theta[:-4], theta[-4:].reshape(2, 2)
        score = xs @ w
        f, b = messages(score, bounds, link)
        grad_w = xs.T @ ((gold - _sigmoid(f + b)) * per) / len(y)
        left, right = f[inner - 1], score[inner] + b[inner]
        cells = np.stack([np.full(len(inner), link[0, 0]), link[0, 1] + right, link[1, 0] + left, link[1, 1] + left + right], 1)
        cells = np.exp(cells - cells.max(1, keepdims=True))
        cells /= cells.sum(1, keepdims=True)
        true = np.stack([1 - gold[inner], 0 * gold[inner], 0 * gold[inner], gold[inner]], 1)
        grad_t = ((true - cells) * per[inner, None]).sum(0) / len(y)
        grad = np.concatenate([grad_w - 1e-3 * w, grad_t - 2e-2 * theta[-4:]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = QualityModel(theta[:-4] / rms, theta[-4:].reshape(2, 2), (1.0, 0.0))
    z = _logit(model.document(x, size, bounds))
    coef = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(coef[0] * z + coef[1])
        g = np.array([((y - p) * z).sum() - 0.1 * coef[0], (y - p).sum() - 0.1 * coef[1]])
        r = p * (1 - p) + 1e-6
        h = np.array([[(r * z * z).sum() + 0.1, (r * z).sum()], [(r * z).sum(), r.sum() + 0.1]])
        coef = coef + np.clip(np.linalg.solve(h, g), -2, 2)
    model.scale = (float(coef[0]), float(coef[1]))
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score, line_quality): one row for each row of docs; a map without shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            quality = model.document(*line_features(*utf8(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(quality)), pa.array(quality)],
                                             ["doc_id", "score", "line_quality"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, line_quality double")


def good_documents(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of docs whose score reaches the threshold, columns as they are; a map without shuffle."""
    schema, at = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            score = model.score(model.document(*line_features(*utf8(batch.column(at)))))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, schema)
