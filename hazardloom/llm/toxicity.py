"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A window is a white-space separated word with a blank on either side (longer ones are cut into windows of 48
bytes), since few words of a toxic text are toxic. The ordinary dictionary is trained on windows as they occur in
ordinary texts; the toxic one on the windows of toxic texts that occur in them more often than ordinary texts
explain. A window's gain is how many bytes shorter it becomes under the toxic dictionary. A text's evidence is its
largest gain and the number of windows whose gain reaches the threshold; the threshold is calibrated on training
texts that the dictionaries did not see, and so is the logistic that turns the evidence into a score.

The fit uses at most `per_class` labelled documents of each class, each of them whole: Spark tasks count their
windows, and the counts (not texts) reach the driver. The logistic knows how many windows a text has, so that a long
text needs more evidence. Scores use whole texts. Defined results: null and empty texts have no window and get the
score of no evidence; without labels of both classes the score is the labelled share of toxic documents (0 without
labels); rows that repeat an id are scored each.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import slices
from hazardloom.llm.quality import training_sample

PER_CLASS, DICTIONARY, WINDOW = 4000, 8_000, 48
#: Windows whose gain a task remembers.
REMEMBERED = 500_000
#: Every window stands between two fixed strings that close both dictionaries: zstandard stores very short inputs
#: as they are and starts no match in an input's last bytes.
_LEAD, _TAIL = bytes(range(128, 192)), bytes(range(200, 216))


def windows(text: str | None) -> list[bytes]:
    if not text:
        return []
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if max(map(len, words), default=0) <= WINDOW:
        return words
    return [w[k:k + WINDOW] for w in words for k in range(0, len(w), WINDOW)]


@dataclass
class ToxicityModel:
    toxic: bytes = b""
    ordinary: bytes = b""
    threshold: int = 1
    weights: tuple[float, ...] = ()
    constant: float | None = None
    _pair: list = field(default_factory=list)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_pair": []}

    def gain(self, window: bytes) -> int:
        """Bytes that the toxic dictionary saves against the ordinary one."""
        if not self._pair:
            import zstandard

            for raw in (self.toxic, self.ordinary):
                raw = raw + _LEAD + _TAIL
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                parameters = zstandard.ZstdCompressionParameters.from_level(
                    9, dict_size=len(raw), source_size=128, format=zstandard.FORMAT_ZSTD1_MAGICLESS, min_match=3, strategy=zstandard.STRATEGY_LAZY2, window_log=18, hash_log=16, chain_log=16,
                    write_content_size=False, write_checksum=False, write_dict_id=False)
                d.precompute_compress(compression_params=parameters)
                self._pair.append(zstandard.ZstdCompressor(dict_data=d, compression_params=parameters).compress)
        toxic, ordinary = self._pair
        w = _LEAD + b" " + window + b" " + _TAIL
        return len(ordinary(w)) - len(toxic(w))

    def evidence(self, texts: list[str | None], known: dict[bytes, int]) -> np.ndarray:
        """(largest gain, windows at or over the threshold, log of all windows) of each text."""
        rows = []
        for text in texts:
            most, over, n = -9, 0, 0
            for w, times in Counter(windows(text)).items():
                g = known.get(w)
                if g is None:
                    g = known[w] = self.gain(w)
                n += times
                most = g if g > most else most
                if g >= self.threshold:
                    over += times
            rows.append((most, over, math.log1p(n)))
        if len(known) > REMEMBERED:
            known.clear()
        return np.array(rows, np.float64).reshape(-1, 3)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(evidence), self.constant)
        z = inputs(evidence, self.threshold) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def inputs(e: np.ndarray, threshold: int) -> np.ndarray:
    """Constant, largest gain over the threshold, windows that reach it, whether one does, log of all windows."""
    return np.stack([np.ones(len(e)), np.clip(e[:, 0] - threshold, -4, 8), np.minimum(e[:, 1], 4), (e[:, 1] > 0) * 1.0, (e[:, 2] - 5) / 2], 1)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The content of a trained dictionary (its segments; windows are too short for its entropy tables), or the
    samples themselves where there are too few to train on."""
    import zstandard

    try:
        trained = zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    return trained[trained.rfind(b"\x08\x00\x00\x00") + 4:] if b"\x08\x00\x00\x00" in trained[:1024] else trained


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, y, words, times, shingles) of (id, text, y): distinct windows of a whole text, blank between them, how often
    each occurs, and digests of a share of its three-word shingles."""
    for batch in slices(batches):
        rows = []
        for i, text, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            w = windows(text)
            times = Counter(w)
            own = {zlib.crc32(b" ".join(w[k:k + 3])) for k in range(max(1, len(w) - 2))}
            own = {x for x in own if x % 8 == 0} or own
            rows.append((i, y, b" ".join(times), np.array(list(times.values()), np.int32).tobytes(), np.array(sorted(own), np.uint32).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["id", "y", "words", "times", "shingles"])


def _without_copies(rows: list) -> list:
    """Rows whose text does not mostly repeat the three-word shingles of earlier ones: a copied text is one observation."""
    met: set[int] = set()
    out = []
    for row in rows:
        own = set(np.frombuffer(row.shingles, np.uint32).tolist())
        if 2 * len(own & met) <= len(own):
            out.append(row)
        met |= own
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, keep=lambda doc_id: F.lit(True), per_class: int = PER_CLASS,
                 dictionary: int = DICTIONARY) -> ToxicityModel:
    sample = training_sample(docs, labels, "toxic", keep, per_class).select("_id", "_text", "_y")
    got = sample.mapInArrow(counted, "id long, y int, words binary, times binary, shingles binary").collect()
    got = _without_copies(sorted(got, key=lambda r: (r.id, r.words)))
    y = np.array([r.y for r in got])
    if len(set(y.tolist())) < 2:
        return ToxicityModel(constant=float(y.mean()) if len(y) else 0.0)
    split = [dict(zip(r.words.split(), np.frombuffer(r.times, np.int32).tolist(), strict=True)) for r in got]
    fold = np.arange(len(got)) % 4 == 0  # for calibration, unseen by the dictionaries
    seen = {c: Counter(w for s, v, f in zip(split, y, fold, strict=True) if v == c and not f for w in s) for c in (0, 1)}
    n = {c: max(1, int(((y == c) & ~fold).sum())) for c in (0, 1)}
    # roots: how much more often a window, or a beginning of at least four bytes, is in toxic texts
    heads = {c: Counter() for c in (0, 1)}
    for c in (0, 1):
        for w, k in seen[c].items():
            for m in range(4, min(len(w), 16) + 1):
                heads[c][w[:m]] += k

    # a beginning counts if its share of toxic texts can't be chance among so many beginnings
    share, chance = n[1] / (n[0] + n[1]), math.log(max(2, len(heads[1]))) + 3

    def lift(x: bytes) -> float:
        k1, k0 = heads[1][x], heads[0][x]
        odds = k1 * -math.log(share) - (math.lgamma(k1 + k0 + 1) - math.lgamma(k1 + 1) - math.lgamma(k0 + 1))
        return odds if odds > chance and k1 * n[0] > 4 * k0 * n[1] else 0.0

    weight = {w: max((lift(w[:m]) for m in range(4, min(len(w), 16) + 1)), default=0.0) for w in seen[1]}
    chosen = sorted((w for w in weight if weight[w] > 0), key=lambda w: (weight[w], w))
    if not chosen:
        return ToxicityModel(constant=float(y.mean()))
    frequent = [w for w, _ in sorted(seen[0].items(), key=lambda x: (x[1], x[0]))]
    both = {w for w in chosen if seen[0][w] > 0}
    toxic = [b" " + w + b" " for w in chosen if w not in both for _ in range(min(seen[1][w], 8))]
    ordinary = [b" " + w + b" " for w in frequent for _ in range(min(seen[0][w], 3))]
    join = lambda words: [b"".join(words[k:k + 12]) for k in range(0, len(words), 12)]
    model = ToxicityModel(_dictionary(join(toxic), dictionary), _dictionary(join(ordinary), dictionary))
    gain = {w: model.gain(w) for w in {w for s in split for w in s}}
    part = []  # of each text: how many of its windows have which gain
    for s in split:
        by_gain: Counter = Counter()
        for w, times in s.items():
            by_gain[gain[w]] += times
        part.append(by_gain)
    most = np.array([max(p, default=-9) for p in part])
    held_y, held = y[fold], most[fold]
    values = range(-4, 32)
    # least weighted error, an ordinary text counting as the labels' shares are in use
    model.threshold = min(values, key=lambda t: ((held[held_y == 0] >= t).mean() * 3 + (held[held_y == 1] < t).mean(), t))
    e = np.array([(m, sum(k for g, k in p.items() if g >= model.threshold), math.log1p(sum(p.values()))) for m, p in zip(most, part, strict=True)], np.float64)
    x, target = inputs(e, model.threshold)[fold], held_y.astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 0.3 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x.T @ (target - p) - 0.3 * w), -2, 2)
    model.weights = tuple(w.tolist())
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, gain, n_toxic): score and evidence of each row's whole text; a map without shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in slices(batches):
            e = model.evidence(batch.column(1).to_pylist(), known) if model.constant is None else np.zeros((batch.num_rows, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(e)), pa.array(e[:, 0].astype(np.int64)), pa.array(e[:, 1].astype(np.int64))],
                                             ["doc_id", "score", "gain", "n_toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, gain long, n_toxic long")
