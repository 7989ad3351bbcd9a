"""Personal data: rule-based spans, and further ones that boosted trees pick from high-recall candidates.

Base spans are the fixed patterns with their checks. Generators then propose, often overlapping, addresses with a
plain, spaced, bracketed or spoken "at" and dots, groups that could be an IP address however their dots are written,
and every digit run with separators. Gradient-boosted trees score a candidate of a kind from its format and context.
Positives are the base spans of the texts and altered writings of them in the same surroundings (other separators,
no leading plus, spoken or bracketed signs); negatives are candidates that overlap no base span, other kinds' writings, dates, amounts and
numbers that fail their check, written with the digits of base spans. All different examples count, each once. Splits see
features by their place among quantiles, so examples alike in these places are one weighted cell of a Spark table, and a split
comes from sums of whole numbers over all cells: the same trees in any layout. Each kind's threshold is calibrated on a
quarter of the examples, chosen by hash, that the trees did not see: the lowest margin, 0 at least, from which on at most one
candidate in a hundred is a negative. A candidate that reaches it is added unless it overlaps a base span or a better added one.

Defined results: null and empty texts have no spans; rows that repeat an id are treated each; a kind without positive
candidates to learn from gets no added span. Extra columns, whatever their names, play no part and stay in `redacted`.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import Scratch, before, slices

KINDS = ("email", "ip", "card", "phone")
#: Cells of a task, and the unit of the whole numbers that gradients are summed in.
CELLS, UNIT = 200_000, 2.0**30
#: Rounds, learning rate and quantiles of the trees.
ROUNDS, RATE, QUANTILES = 160, 0.3, 32
#: A kind with fewer unseen positives is calibrated on all its examples.
FEW = 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"\+?\(?[0-9](?:[\x20().,:/_-]{0,2}[0-9])+")
_DOT = r"(?: ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )"
_LABEL = r"[A-Za-z0-9-]{1,63}"
# the sign and the domain of a written address; a bare " at " needs spoken dots
_WRITTEN = re.compile(rf"(?: ?@ ?| ?[\[({{<] ?(?:at|AT|@) ?[\])}}>] ?){_LABEL}(?:(?:\.|{_DOT}){_LABEL})+| (?:at|AT) {_LABEL}(?:{_DOT}{_LABEL})+")
_SIGNS = ("@", "dot", "DOT", "(at", "[at", "{at", "<at", "(AT", "[AT", "{AT", "<AT")
_GROUPS = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?: ?[.,:] ?|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns that pass their checks; linear in the text."""
    out = []
    at = text.find("@")
    free = 0  # end of the match before
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of everything that could be personal data of the kind."""
    out = []
    if any(sign in text for sign in _SIGNS):
        for m in _WRITTEN.finditer(text):
            start = m.start()
            while start > 0 and m.start() - start < 64 and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
    if _DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in _GROUPS.finditer(text)]
        for m in _RUN.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            for kind, low, high in ((2, 13, 19), (3, 7, 15)):
                if low <= n <= high:
                    out.append((kind, m.start(), m.end()))
    return out


def altered(kind: int, span: str) -> list[str]:
    """Other writings of a base span."""
    if kind == 0:
        local, domain = span.rsplit("@", 1)
        return [f"{local} @ {domain}", f"{local} at {domain.replace('.', ' dot ')}", f"{local}[at]{domain}",
                f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local}[at]{domain.replace('.', '[dot]')}"]
    if kind == 1:
        return [span.replace(".", sign) for sign in ("[.]", " . ", "(dot)", " dot ", ",")]
    digits = re.sub("[^0-9]", "", span)
    if kind == 2:
        groups = [digits[k:k + 4] for k in range(0, len(digits), 4)]
        return [sign.join(groups) for sign in (".", "/", "_", "  ", " - ")]
    plain = span[1:].lstrip()
    return [plain, "00" + plain, f"({digits[:2]}) {digits[2:5]}-{digits[5:]}", f"0{digits[2:5]}/{digits[5:]}", f"({digits[:3]}) {digits[3:6]}-{digits[6:]}", f"+{digits[:2]}/{digits[2:5]}/{digits[5:]}"]


def ordinary(kind: int, span: str) -> list[str]:
    """Everyday numbers written with a base span's digits, and a card number that fails its check."""
    d = re.sub("[^0-9]", "", span)
    if kind == 0 or len(d) < 8:
        return []
    year, later = 1900 + int(d[:2]), 1950 + int(d[2:4])
    date = f"{1 + int(d[4]) :02d}", f"{1 + int(d[5:7]) % 28:02d}"
    clock = f"{int(d[2:4]) % 24:02d}:{int(d[4:6]) % 60:02d}"
    out = [f"{year}-{later}", f"{later}, {d[4:6]} {d[5:8]}", f"{later}-{date[0]}-{date[1]}", f"{later}-{date[0]}-{date[1]} {clock}", f"{date[1]}.{date[0]}.{later}", f"{date[1]}/{date[0]}/{later} {clock}",
           f"1{d[0]},{d[1:4]},{d[4:7]},{d[2:5]}", f"{d[:2]}.{d[2:8]}", f"978-{d[0]}-{d[1:3]}-{d[2:8]}-{d[4]}", f"{d[:3]} {d[3:6]} {d[5:8]}", f"{clock}:{int(d[6:8]) % 60:02d}:{d[:2]}", d[:8]]
    if kind == 2:
        wrong = d[:-1] + str((int(d[-1]) + 1) % 10)
        groups = [wrong[k:k + 4] for k in range(0, len(wrong), 4)]
        out += [sign.join(groups) for sign in ("", " ", "-", ".", "/", "_", " - ")]
    return out


class Covered:
    """Answers whether a place overlaps a base span, of one kind or any; spans of a kind do not overlap each other."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [[s for k, s, _ in spans if k == kind] for kind in range(4)]
        self.ends = [[e for k, _, e in spans if k == kind] for kind in range(4)]

    def by(self, kind: int, a: int, b: int) -> bool:
        before = bisect_left(self.starts[kind], b)
        return before > 0 and self.ends[kind][before - 1] > a

    def alike(self, kind: int, a: int, b: int) -> bool:
        """Whether a span of the kind shares four fifths of what both cover."""
        before = bisect_left(self.starts[kind], b)
        if not before:
            return False
        s, e = self.starts[kind][before - 1], self.ends[kind][before - 1]
        return 5 * (min(b, e) - max(a, s)) >= 4 * (max(b, e) - min(a, s))

    def any(self, a: int, b: int) -> bool:
        return any(self.by(kind, a, b) for kind in range(4))


_CUES = ("tel", "phone", "call", "fax", "mobil", "card", "visa", "iban", "mail", "contact", "addr", "ip", "host", "server")
_SPELLED = re.compile(r"[\[({<] ?(?:at|AT|@|dot|DOT|\.) ?[\])}>]| (?:at|AT|dot|DOT) ")


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span, with its sums and its leading plus aside from the rest, and its surroundings."""
    s = text[start:end]
    found = re.findall(r"[0-9]+", s)
    groups = [len(g) for g in found] or [0]
    before, after = text[max(0, start - 24):start], text[end:end + 8]
    word = re.findall(r"\w+", before.lower())[-1:] or [""]
    last = re.findall(r"[A-Za-z0-9-]+", s)[-1:] or [""]
    octets = len(found) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in found)
    return [float(kind), float(len(s)), float(sum(groups)), float(len(groups)), float(groups[0]), float(groups[-1]), float(max(groups)),
            float(min(groups)), float(s.count(" ")), float(s.count(".")), float(s.count("-")), float(s.count("(")), float(s.count("/") + s.count(":") + s.count(",") + s.count("_")),
            float(len(word[0])), float(any(c in before.lower() for c in _CUES)), float(after[:1].isalnum()), float(before[-1:].isdigit()), float(before[-1:].isalpha()),
            float(before[-1:] in "=/#:" and before != ""), float(len(_SPELLED.findall(s))), float(len(last[0])), float(last[0].isalpha()),
            float(octets), float(kind == 2 and luhn("".join(found))), float(s[:1] == "+" or s[:2] == "00"), float(s[:1] == "(")]


@dataclass
class Trees:
    """Gradient-boosted depth-2 trees for the log-odds, on features cut at quantiles."""

    prior: float = 0.0
    nodes: list[tuple] = field(default_factory=list)
    limits: dict[int, float] = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        for f, c, (lf, lc, la, lb), (rf, rc, ra, rb) in self.nodes:
            out += np.where(x[:, f] <= c, np.where(x[:, lf] <= lc, la, lb), np.where(x[:, rf] <= rc, ra, rb))
        return out


def cut_points(values: dict[float, int]) -> np.ndarray:
    """Different lower quantiles of the values with their counts."""
    v = np.array(sorted(values))
    ends = np.cumsum([values[x] for x in v.tolist()])
    return np.unique(v[np.searchsorted(ends, (ends[-1] - 1) * np.arange(QUANTILES) // QUANTILES, side="right")])


def coded(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Place of each feature among its cuts: code <= k just where the feature is <= cut k."""
    return np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.uint8)


def _best_split(g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, float]:
    """(feature, code) of the largest gain from sums by feature and code, the first of equals."""
    best = (-1.0, 0, np.inf)
    for f, edges in enumerate(cuts):
        gl, hl = np.cumsum(g[f])[:len(edges)] / UNIT, np.cumsum(h[f])[:len(edges)] / UNIT
        total_g, total_h = g[f].sum() / UNIT, h[f].sum() / UNIT
        gain = gl ** 2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float(k))
    return best[1], best[2]


def _sums(y: np.ndarray, code: np.ndarray, n: np.ndarray, margin: np.ndarray, root: tuple[int, float], width: int) -> np.ndarray:
    """Gradients and second derivatives of n-fold rows by (side of the root, feature, code), in whole UNITs."""
    features = code.shape[1]
    p = 1 / (1 + np.exp(-margin))
    side = (code[:, root[0]] > root[1]).astype(np.int64)
    at = ((side[:, None] * features + np.arange(features)) * width + code).ravel()
    rows = [np.bincount(at, np.repeat(np.rint(value * UNIT) * n, features), 2 * features * width) for value in (y - p, p * (1 - p))]
    return np.array(rows).astype(np.int64).reshape(2, 2, features, width)


def _grown(sums: Callable[[Trees, tuple[int, float]], np.ndarray], prior: float, cuts: list[np.ndarray], rounds: int, rate: float) -> Trees:
    """Trees over codes; sums(trees so far, root): two calls a round, for the root and for both sides."""
    model = Trees(prior)
    for _ in range(rounds):
        g, h = sums(model, (0, np.inf))
        f, c = _best_split(g[0], h[0], cuts)
        g, h = sums(model, (f, c))
        sides = []
        for k in range(2):
            lf, lc = _best_split(g[k], h[k], cuts) if h[k].any() else (0, np.inf)
            low = slice(0, len(cuts[lf]) + 1 if lc == np.inf else int(lc) + 1)
            gl, hl, gt, ht = g[k][lf][low].sum() / UNIT, h[k][lf][low].sum() / UNIT, g[k][lf].sum() / UNIT, h[k][lf].sum() / UNIT
            sides.append((lf, lc, float(rate * gl / (hl + 1)), float(rate * (gt - gl) / (ht - hl + 1))))
        model.nodes.append((f, c, *sides))
    return model


def boost(cells: DataFrame, share: float, cuts: list[np.ndarray], parts: int = 1, rounds: int = ROUNDS, rate: float = RATE) -> Trees:
    """Trees over codes from a saved table of cells (y, code, n); share: of positives. With one part a task grows them from
    its block, with more a pass over all parts gives each of the sums; the trees are the same."""
    width = max(map(len, cuts)) + 1
    mean = np.clip(share, 1e-3, 1 - 1e-3)
    prior = float(np.log(mean / (1 - mean)))
    cells = cells.select("y", "code", "n").coalesce(parts)

    def block(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        return batch.column(0).to_numpy(), code, batch.column(2).to_numpy()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        y, code, n = block(pa.Table.from_batches(held))
        margin, done = np.full(len(y), prior), 0

        def sums(model: Trees, root: tuple[int, float]) -> np.ndarray:
            nonlocal done
            for node in model.nodes[done:]:
                margin[:] += Trees(0.0, [node]).margin(code)
            done = len(model.nodes)
            return _sums(y, code, n, margin, root, width)

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_grown(sums, prior, cuts, rounds, rate).nodes)], pa.binary())], ["nodes"])

    def spread(model: Trees, root: tuple[int, float]) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = [_sums(y, code, n, model.margin(code), root, width) for y, code, n in (block(b) for b in batches if b.num_rows)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([sum(out).tobytes()], pa.binary())], ["sums"])

        found = cells.mapInArrow(run, "sums binary").toArrow().column(0).to_pylist()
        return sum(np.frombuffer(x, np.int64) for x in found).reshape(2, 2, len(cuts), width)

    if parts > 1:
        return _grown(spread, prior, cuts, rounds, rate)
    return Trees(prior, pickle.loads(cells.mapInArrow(whole, "nodes binary").first().nodes))


def uncoded(model: Trees, cuts: list[np.ndarray]) -> Trees:
    """Trees over codes as trees over features."""
    def at(f: int, c: float) -> float:
        return float(cuts[f][int(c)]) if c < np.inf else c

    return Trees(model.prior, [(f, at(f, c), *((lf, at(lf, lc), a, b) for lf, lc, a, b in sides)) for f, c, *sides in model.nodes])


def examples(text: str) -> list[tuple[int, list[float]]]:
    """(label, features) of the candidates of a text and of altered writings of its base spans."""
    base = base_spans(text)
    good, out = Covered(base), []
    for kind, a, b in candidates(text):
        if good.alike(kind, a, b):
            out.append((1, features(text, kind, a, b)))
        elif not good.any(a, b):
            out.append((0, features(text, kind, a, b)))
    for kind, a, b in base:
        lead, tail = text[max(0, a - 24):a], text[b:b + 8]
        for other in altered(kind, text[a:b]):
            x = lead + other + tail
            mine, held = Covered([(kind, len(lead), len(lead) + len(other))]), Covered(base_spans(x))
            for c in candidates(x):
                if c[0] == kind and mine.alike(*c):
                    out.append((1, features(x, *c)))
                elif c[0] != kind and mine.any(*c[1:]) and not held.any(*c[1:]):
                    out.append((0, features(x, *c)))
        for other in ordinary(kind, text[a:b]):
            x = lead + other + tail
            held = Covered(base_spans(x))
            out += [(0, features(x, *c)) for c in candidates(x) if not held.any(*c[1:]) and c[1] < len(lead) + len(other) and c[2] > len(lead)]
    return out


def fit_pii(docs: DataFrame, block: int = CELLS) -> Trees:
    """Trees and thresholds from all different examples of the texts. The driver gets sums, cuts, and how often each value of a feature occurs; block: cells of a task."""
    names = ["kind", "y", "key", "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            rows = {}
            for text in batch.column(0).to_pylist():
                for y, x in examples(text or ""):
                    x = np.array(x, np.float64).tobytes()
                    rows[int(np.frombuffer(x, np.float64, 1)[0]), y, int.from_bytes(hashlib.blake2b(bytes([y]) + x, digest_size=7).digest(), "big"), x] = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names)

    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.save(docs.select("text").mapInArrow(run, "kind int, y int, key long, x binary").distinct().withColumn("unseen", F.expr("key div 7 % 4 = 0")))
    n = {(r.kind, r.y, r.unseen): r["count"] for r in found.groupBy("kind", "y", "unseen").count().collect()}  # 16 rows at most
    seen = [sum(c for (_, y, unseen), c in n.items() if y == label and not unseen) for label in (0, 1)]
    if not all(seen):
        scratch.drop(found)
        return Trees()

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.float64).reshape(batch.num_rows, -1)
                parts = [(f, *np.unique(x[:, f], return_counts=True)) for f in range(x.shape[1])]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*((np.full(len(v), f, np.int32), v, k) for f, v, k in parts), strict=True)], ["f", "v", "n"])

    counts: dict[int, dict[float, int]] = {}
    for r in found.where(~F.col("unseen")).select("x").mapInArrow(values, "f int, v double, n long").groupBy("f", "v").agg(F.sum("n").alias("n")).collect():
        counts.setdefault(r.f, {})[r.v] = r.n
    cuts = [cut_points(counts[f]) for f in range(len(counts))]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float64).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([row.tobytes() for row in coded(x, cuts)], pa.binary())], ["kind", "y", "unseen", "code"])

    cells = scratch.save(found.select("kind", "y", "unseen", "x").mapInArrow(code, "kind int, y int, unseen boolean, code binary").groupBy("kind", "y", "unseen", "code").agg(F.count("*").alias("n")))
    scratch.drop(found)
    parts = 1 + cells.count() // block
    over_codes = boost(cells.where(~F.col("unseen")), seen[1] / sum(seen), cuts, parts)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(over_codes.margin(at))], ["kind", "y", "n", "margin"])

    few = [kind for kind in range(len(KINDS)) if n.get((kind, 1, True), 0) < FEW]
    judged = cells.where(F.col("unseen") | F.col("kind").isin(few)).select("kind", "y", "code", "n").coalesce(parts)
    judged = scratch.save(judged.mapInArrow(margins, "kind int, y int, n long, margin double").groupBy("kind", "margin").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("bad")))
    scratch.drop(cells)
    model = uncoded(over_codes, cuts)
    limits = thresholds(judged, scratch)
    scratch.drop(judged)
    model.limits = {kind: limits.get(kind, float("inf")) for kind in range(len(KINDS)) if n.get((kind, 1, True), 0) or n.get((kind, 1, False), 0)}
    return model


def threshold(margin: np.ndarray, y: np.ndarray, wrong: float = 0.01) -> float:
    """What thresholds() gives for the margins of one kind; infinite if there is none."""
    order = np.argsort(-margin, kind="stable")
    m, bad = margin[order], np.cumsum(y[order] == 0)
    last = np.append(m[1:] != m[:-1], True)  # equal margins stand or fall together
    fine = np.flatnonzero(last & (bad <= wrong * np.arange(1, len(m) + 1)) & (m >= 0))
    if not len(fine):
        return float(np.inf)
    low = fine[-1]
    return max(0.0, float(m[low] + m[low + 1]) / 2) if low + 1 < len(m) else 0.0


def thresholds(judged: DataFrame, scratch: Scratch, wrong: float = 0.01) -> dict[int, float]:
    """By kind half-way below the lowest margin from which on at most the share `wrong` are negatives, 0 at least; kinds
    without one are left out. judged: a saved table (kind, margin, n, bad), one row a margin."""
    high = scratch.save(judged.where("margin >= 0"))
    order = [F.floor(F.col("margin") * -64)]
    run = scratch.save(before(high, "n", order, [F.desc("margin")], "n_before", ["kind"]))
    run = before(run, "bad", order, [F.desc("margin")], "bad_before", ["kind"])
    fine = run.where(F.col("bad_before") + F.col("bad") <= F.lit(wrong) * (F.col("n_before") + F.col("n")))
    low = {r.kind: r.low for r in fine.groupBy("kind").agg(F.min("margin").alias("low")).collect()}
    below = F.lit(False)
    for kind, m in low.items():
        below = below | ((F.col("kind") == kind) & (F.col("margin") < m))
    under = {r.kind: r.under for r in judged.where(below).groupBy("kind").agg(F.max("margin").alias("under")).collect()}
    return {kind: max(0.0, (m + under[kind]) / 2) if kind in under else 0.0 for kind, m in low.items()}


def all_spans(texts: list[str | None], model: Trees) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    out, rows, where = [], [], []
    for k, text in enumerate(texts):
        text = text or ""
        base = base_spans(text)
        out.append((base, []))
        if model.limits:
            covered = Covered(base)
            for kind, a, b in candidates(text):
                if kind in model.limits and not covered.any(a, b):
                    rows.append(features(text, kind, a, b))
                    where.append((k, kind, a, b))
    if rows:
        margin = model.margin(np.array(rows))
        passed = sorted((-m, k, a, b, kind) for (k, kind, a, b), m in zip(where, margin.tolist(), strict=True) if m >= model.limits[kind])
        taken: dict[int, list[tuple[int, int]]] = {}
        for _, k, a, b, kind in passed:
            spans = taken.setdefault(k, [])
            at = bisect_left(spans, (a, b))
            if (at == 0 or spans[at - 1][1] <= a) and (at == len(spans) or spans[at][0] >= b):
                spans.insert(at, (a, b))
                out[k][1].append((kind, a, b))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_pii(docs: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans); counts are of base spans. A map without shuffle."""
    types = [pa.int64()] * 5 + [pa.string()] * 2
    names = ["n_email", "n_ip", "n_card", "n_phone", "n_added", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for base, added in all_spans(batch.column(1).to_pylist(), model):
                count = [sum(s[0] == k for s in base) for k in range(4)]
                rows.append((*count, len(added), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or chain of overlapping ones, replaced by the kind of its first in angle brackets."""
    out, done = [], 0
    merged: list[list[int]] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[done:a], f"<{KINDS[kind].upper()}>"]
        done = b
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, model: Trees) -> DataFrame:
    """docs with its texts redacted and, where there is a column n_chars, the new length in code points."""
    at = docs.columns.index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            texts = batch.column(at).to_pylist()
            new = [None if t is None else redact(t, base + added) for t, (base, added) in zip(texts, all_spans(texts, model), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                length = pa.array([old if t is None else len(t) for t, old in zip(new, columns[k].to_pylist(), strict=True)])
                columns[k] = length.cast(batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
