"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

A passage of m bytes that occurs with at most k edits shares at least m - q + 1 - q k of its q-grams with the
place, all within k + 1 neighbouring diagonals (place in the text minus place in the passage). Shared q-grams
are counted in bands of diagonals that overlap by k, so one band holds every such occurrence whole; bands that
reach the bound are aligned by dynamic programming restricted to the band. Nothing that is within the edit
budget can be missed.

Texts are compared as UTF-8 with A-Z and accented Latin-1 letters lower-cased. Passages of fewer than `min_bytes` bytes are too common to be
evidence and are left out. Defined results: null or empty texts and passages match nothing; a passage with a null item_id is searched like any
other and reported with a null item_id; repeated rows are
reported each; of overlapping matches of a passage in a text the one with fewest edits stays (then the first).
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import slices, utf8

Q, RATE, MIN_BYTES = 10, 0.08, 24
#: Passages are searched in blocks of about this many bytes; one block's index is in a task at a time.
BLOCK_BYTES = 4 << 20
_BITS = 22
#: Candidates are aligned in groups of passages that take about this many bytes.
ALIGN_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 with A-Z and the two-byte Latin letters after C3 in lower case; lengths stay."""
    out = _LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    after = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[after] += 32
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit value for each of the q-grams (Q = 10 bytes: eight bytes mixed with the last eight)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    words = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data), strides=(1,))
    return words[:n] * np.uint64(0x9E3779B97F4A7C15) ^ (words[Q - 8:Q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(7))


class Passages:
    """Index of one block of passages."""

    def __init__(self, rows: list[tuple[int, str]], rate: float = RATE, min_bytes: int = MIN_BYTES):
        self.ids, self.text = [], []
        for item, text in rows:
            data = lowered(np.frombuffer(text.encode(), np.uint8)) if text else np.zeros(0, np.uint8)
            if len(data) >= max(min_bytes, Q):
                self.ids.append(item)
                self.text.append(data)
        self.size = np.array([len(x) for x in self.text], np.int64)
        self.edits = np.minimum((self.size * rate).astype(np.int64), (self.size - Q) // Q)
        self.least = self.size - Q + 1 - Q * self.edits
        self.step = np.maximum(8, self.edits)
        gram = [_grams(x) for x in self.text]
        key = np.concatenate(gram) if gram else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(gram)), [len(g) for g in gram])
        at = np.concatenate([np.arange(len(g)) for g in gram]) if gram else item
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.at = key[order], item[order].astype(np.int64), at[order].astype(np.int64)
        self.known = np.zeros(1 << _BITS, bool)
        self.known[(self.key >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, passage, band) with enough shared q-grams."""
        gram = _grams(data)
        pos = np.flatnonzero(self.known[(gram >> np.uint64(64 - _BITS)).astype(np.int64)])
        low, high = np.searchsorted(self.key, gram[pos], "left"), np.searchsorted(self.key, gram[pos], "right")
        have = high > low
        pos, low, high = pos[have], low[have], high[have]
        doc = np.searchsorted(offsets, pos, side="right") - 1
        inside = pos + Q <= offsets[doc + 1]
        pos, low, high, doc = pos[inside], low[inside], high[inside], doc[inside]
        times = high - low
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]) if len(low) else low, times) + np.arange(times.sum())
        doc, pos = np.repeat(doc, times), np.repeat(pos, times)
        item = self.item[entry]
        diagonal = pos - offsets[doc] - self.at[entry] + self.size[item]
        step = self.step[item]
        band = diagonal // step
        twice = (diagonal - band * step < self.edits[item]) & (band > 0)
        doc, item, band = (np.concatenate([x, y]) for x, y in ((doc, doc[twice]), (item, item[twice]), (band, band[twice] - 1)))
        if not len(doc):
            return doc, item, band
        order = np.lexsort((band, item, doc))
        doc, item, band = doc[order], item[order], band[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])]))
        enough = new[np.diff(np.append(new, len(doc))) >= self.least[item[new]]]
        return doc[enough], item[enough], band[enough]

    def align(self, data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, item: np.ndarray, band: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, passage, start, end, edits) of candidates within their budget; of overlapping ones the best stays."""
        order = np.argsort(self.size[item], kind="stable")
        found: set[tuple[int, int, int, int, int]] = set()
        while len(order):
            n = max(1, int((self.size[item[order]] * np.arange(1, len(order) + 1) <= ALIGN_BYTES).sum()))
            found |= set(self._align(data, offsets, doc[order[:n]], item[order[:n]], band[order[:n]]))
            order = order[n:]
        kept: list[tuple[int, int, int, int, int]] = []
        taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for hit in sorted(found, key=lambda h: (h[0], h[1], h[4], h[2], h[3])):
            spans = taken.setdefault(hit[:2], [])
            before = bisect_left(spans, (hit[3], 0))
            if not before or spans[before - 1][1] <= hit[2]:
                insort(spans, (hit[2], hit[3]))
                kept.append(hit)
        return kept

    def _align(self, data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, item: np.ndarray, band: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Every candidate within its budget; all of them advance row by row."""
        width = int((self.step[item] + self.edits[item]).max()) + 1
        first = band * self.step[item] - self.size[item]
        size, n = self.size[item], offsets[doc + 1] - offsets[doc]
        unit, far = 1 << 20, 1 << 40
        lane = np.arange(width)
        inside = lane < (self.step[item] + self.edits[item] + 1)[:, None]
        start_at = first[:, None] + lane
        cost = np.where(inside & (start_at >= 0) & (start_at <= n[:, None]), lane, far + lane).astype(np.int64)
        result: dict[int, tuple[int, int]] = {}
        text = np.zeros((len(item), int(size.max())), np.uint8)
        for r, i in enumerate(item):
            text[r, :size[r]] = self.text[i]
        base = offsets[doc]
        for row in range(1, int(size.max()) + 1):
            at = first[:, None] + lane + row - 1
            legal = (at >= 0) & (at < n[:, None])
            char = data[np.clip(base[:, None] + at, 0, len(data) - 1)]
            step = np.where(legal, cost + unit * (char != text[:, row - 1][:, None]), far)
            skip = np.concatenate([cost[:, 1:], np.full((len(item), 1), far)], 1) + unit
            best = np.minimum(step, skip)
            best = np.where(inside & (at + 1 <= n[:, None]), best, far)
            cost = np.minimum(np.minimum.accumulate(best - lane * unit, 1) + lane * unit, far * 2)
            cost = np.where(inside & (at + 1 <= n[:, None]), cost, far)
            for r in np.flatnonzero(size == row):
                lane_at = int(np.argmin(cost[r]))
                value = int(cost[r, lane_at])
                if value // unit <= self.edits[item[r]]:
                    result[int(r)] = (lane_at, value)
        found = []
        for r, (lane_at, value) in result.items():
            start, end = int(first[r]) + value % unit, int(first[r]) + lane_at + int(size[r])
            found.append((int(doc[r]), int(item[r]), start, end, value // unit))
        return found


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    rows = benchmark.select(F.col("item_id").alias("item"), F.col("text").alias("passage")).where("passage is not null")
    total = rows.agg(F.sum(F.octet_length("passage"))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    return [rows.where(F.pmod(F.xxhash64("item", "passage"), F.lit(n)) == k) for k in range(n)]


def _sorted_rows(block: DataFrame) -> list[tuple[int | None, str]]:
    """(item, passage) in order; a null item comes last."""
    return sorted(((r.item, r.passage) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, edits): one row a match; places in code points, end exclusive. A map for each block."""
    spark = docs.sparkSession

    def search(block: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(_sorted_rows(block))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Passages(shared.value, rate, min_bytes)
            for batch in slices(batches):
                data, offsets = utf8(batch.column(1))
                data = lowered(data)
                hits = index.align(data, offsets, *index.candidates(data, offsets)) if len(index.ids) else []
                if not hits:
                    continue
                ids = batch.column(0).to_pylist()
                rows = []
                for d, i, a, b, e in hits:
                    lead = (data[offsets[d]:offsets[d] + b] & 0xC0) != 0x80
                    rows.append((ids[d], index.ids[i], int(lead[:a].sum()), int(lead.sum()), e))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "item_id", "start", "end", "edits"])

        return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, start long, end long, edits long")

    return reduce(DataFrame.union, [search(b) for b in _blocks(benchmark)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The rows of docs in which no passage occurs, columns as they are; a map for each block, no shuffle."""
    at = docs.columns.index("text")
    for block in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(_sorted_rows(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Passages(shared.value, rate, min_bytes)
            for batch in slices(batches, at):
                data, offsets = utf8(batch.column(at))
                data = lowered(data)
                keep = np.ones(batch.num_rows, bool)
                if len(index.ids):
                    keep[[h[0] for h in index.align(data, offsets, *index.candidates(data, offsets))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
