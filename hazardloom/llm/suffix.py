"""Removal of repeated byte strings, found by bounded interval expansion on Burrows-Wheeler transforms.

Equal strings of `length` bytes must meet in one task without moving the corpus there. Each such string names an
anchor: the least-hashed `gram` bytes in it (the last of equals), which its bytes alone decide. A segment is an
anchor's place with all strings around it that name it. Segments whose anchor occurs once are unique; those with
equal bytes repeat whole; only segments with an anchor in common and different bytes go on. Their quarters (strings
whose anchor lies in the same quarter) share at least 357 bytes or cannot match, so they are grouped by the
hash of these bytes, and groups of one are dropped. A passage in many different surroundings makes a group that
grows with the corpus: groups over a fixed size are split into single strings, whose repeats are counted by hash.

A task joins its groups' quarters, each with an own end sign, sorts the suffixes and takes the Burrows-Wheeler
transform. Intervals are extended backwards, breadth first: an interval of strings of n bytes that ends where no
common prefix is known yet fixes it there as n. Expansion stops at `length`; neighbours in suffix order whose
common prefix is still open share at least `length` bytes, so both starts are repeats.

Defined results: null texts are empty; texts shorter than `length` bytes are kept whole; equal texts have equal
results, however often they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import Scratch, hash_bits, in_bits, slices, utf8
from hazardloom.llm.jaccard import mix

LENGTH, GRAM = 400, 225
#: A text is read in blocks of this many starts; quarters are joined up to about this many bytes for one transform,
#: and a group of more bytes never goes into one.
BLOCK, JOINED = 1 << 20, 1 << 19
_BASE1, _BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 23) - 1)


class Rolling:
    """Hashes of substrings of a byte array."""

    def __init__(self, data: np.ndarray, base: np.uint64):
        n = len(data)
        power = np.full(n + 1, base, np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64, out=self.total[1:])
        back = np.full(n + 1, pow(int(base), -1, 1 << 64), np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.back[start])


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, segment hash, first start, number of starts, anchor place less first start) of all strings."""
    out: list[tuple[np.ndarray, ...]] = []
    size = np.diff(offsets)
    w = length - gram + 1
    if size.max(initial=0) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    for low in range(0, len(data), BLOCK):
        high = min(len(data), low + BLOCK + length - 1)
        part = data[low:high]
        m = len(part) - gram + 1
        if m < w:
            continue
        r1, r2 = Rolling(part, _BASE1), Rolling(part, _BASE2)
        at = np.arange(m)
        hashed = r1.of(at, at + gram)
        key = (hashed & ~_PLACE) | (_PLACE - at.astype(np.uint64))
        pad = (-m) % w
        blocks = np.concatenate([key, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, 1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        starts = min(m - w + 1, BLOCK)
        anchor = (_PLACE - (np.minimum(behind[:starts], ahead[w - 1:w - 1 + starts]) & _PLACE)).astype(np.int64)
        s = np.arange(starts)
        doc = np.searchsorted(offsets, s + low, side="right") - 1
        valid = s + low + length <= offsets[doc + 1]
        s, anchor, doc = s[valid], anchor[valid], doc[valid]
        if not len(s):
            continue
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(s)) - 1
        a, b, p, d = s[first], s[last], anchor[first], doc[first]
        out.append((d, hashed[p].view(np.int64), (r2.of(a, b + length) ^ mix((b - a).astype(np.uint64))).view(np.int64), a + low - offsets[d], b - a + 1, p - a))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(6))


def suffix_order(code: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; end signs must be distinct and no suffix may run over two of them undecided."""
    n = len(code)
    rank = np.unique(code, return_inverse=True)[1].astype(np.int64)
    h = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-h] = rank[h:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        h *= 2


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the starts of strings of `length` bytes that start at another place of the texts too."""
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size + 1) - 1
    n_texts = len(texts)
    code = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + n_texts
    code[ends] = np.arange(n_texts)
    n = len(code)
    order = suffix_order(code)
    bwt = code[order - 1]
    # last-to-first: the place in order of the suffix one byte longer
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    longer = place[order - 1]
    shorter = np.empty(n, np.int64)
    shorter[longer] = np.arange(n)
    head = code[order]
    open_ = np.ones(n + 1, bool)  # no common prefix of the suffixes at i - 1 and i known yet
    open_[0] = open_[n] = False
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    owner = np.zeros(n, np.int64)
    for _ in range(length):
        # extend every interval [low, high) backwards by each byte before its suffixes
        width = high - low
        which = np.repeat(np.arange(len(low)), width)
        element = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + low[which]
        owner[element] = which
        moved = np.sort(longer[element])
        source = owner[shorter[moved]]
        first = np.flatnonzero(np.concatenate([[True], (source[1:] != source[:-1]) | (head[moved[1:]] != head[moved[:-1]])]))
        low, high = moved[first], moved[np.append(first[1:], len(moved)) - 1] + 1
        fresh = open_[high]
        low, high = low[fresh], high[fresh]
        open_[high] = False
        if not len(low):
            break
    shared = open_[:n].copy()
    shared[:-1] |= open_[1:n]
    hits = np.sort(order[shared])
    begin = ends - size
    of = np.searchsorted(ends, hits)
    bounds = np.searchsorted(of, np.arange(n_texts + 1))
    return [hits[bounds[k]:bounds[k + 1]] - begin[k] for k in range(n_texts)]


def _quarters(cut: DataFrame, length: int, gram: int) -> DataFrame:
    """(sub, anchor, seg, start, bytes) of (anchor, seg, off, cnt, bytes): the strings of each quarter of anchor places."""
    w = length - gram + 1
    step = -(-w // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4, 1 << 20):
            rows = []
            for anchor, seg, off, cnt, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for j in range(4):
                    # starts s with off - s in [j step, (j + 1) step)
                    a, b = max(0, off - (j + 1) * step + 1), min(cnt - 1, off - j * step)
                    if a <= b:
                        core = data[off - j * step:off - (j + 1) * step + 1 + length]
                        sub = int.from_bytes(hashlib.blake2b(core, digest_size=8, salt=bytes([j])).digest(), "little", signed=True)
                        rows.append((sub, anchor, seg, a, data[a:b + length]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["sub", "anchor", "seg", "start", "bytes"])

    return cut.select("anchor", "seg", "off", "cnt", "bytes").mapInArrow(run, "sub long, anchor long, seg long, start int, bytes binary")


def _expanded(groups: DataFrame, length: int) -> DataFrame:
    """(anchor, seg, a, b): repeated starts a..b of a segment; groups are sorted by sub within partitions."""
    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = repeated_starts([r[4] for r in rows], length)
        out = []
        for (_, anchor, seg, start, _), hits in zip(rows, found, strict=True):
            if len(hits):
                cut = np.flatnonzero(np.diff(hits) > 1)
                for a, b in zip(np.append(hits[0], hits[cut + 1]), np.append(hits[cut], hits[-1]), strict=True):
                    out.append((anchor, seg, start + int(a), start + int(b)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["anchor", "seg", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= JOINED and row[0] != rows[-1][0]:
                    yield from solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield from solve(rows)

    return groups.mapInArrow(run, "anchor long, seg long, a int, b int")


def _singles(quarters: DataFrame, length: int) -> DataFrame:
    """(h1, h2, anchor, seg, start): a 128-bit digest of each string of the quarters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3, 1 << 19):
            anchor, seg, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            digests, times = [], []
            for data in batch.column(3).to_pylist():
                times.append(len(data) - length + 1)
                digests += [hashlib.blake2b(data[s:s + length], digest_size=16).digest() for s in range(times[-1])]
            n = np.array(times)
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])), pa.array(np.repeat(anchor, n)), pa.array(np.repeat(seg, n)), pa.array(at, pa.int32())],
                                             ["h1", "h2", "anchor", "seg", "start"])

    return quarters.select("anchor", "seg", "start", "bytes").mapInArrow(run, "h1 long, h2 long, anchor long, seg long, start int")


def _counted(quarters: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(anchor, seg, a, b) of groups of any size: equal strings have equal anchor places, so each stands in another segment."""
    singles = _singles(quarters, length)
    often = scratch.save(singles.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2"))
    starts = singles.join(often, ["h1", "h2"]).groupBy("anchor", "seg").agg(F.collect_set("start").alias("s"))
    ends = [F.array_sort(F.expr(f"filter(s, x -> NOT array_contains(s, x + {d}))")) for d in (-1, 1)]
    return starts.select("anchor", "seg", F.explode(F.zip_with(*ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("r")).select("anchor", "seg", "r.a", "r.b")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of docs; spans: start:end of removed bytes."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text", F.lit(1)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, BLOCK):
            doc, anchor, seg, lo, cnt, off = segments(*utf8(batch.column(1)), length, gram)
            th = batch.column(0).to_numpy(zero_copy_only=False)[doc] if len(doc) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(seg), pa.array(th), pa.array(lo), pa.array(cnt, pa.int32()), pa.array(off, pa.int32())], ["anchor", "seg", "th", "lo", "cnt", "off"])

    segs = scratch.save(docs.select("th", "text").mapInArrow(find, "anchor long, seg long, th long, lo long, cnt int, off int"))
    often = (segs.groupBy("anchor").agg(F.count("*").alias("c"), F.min("seg").alias("s0"), F.max("seg").alias("s1"))
             .where("c > 1").select("anchor", (F.col("s0") != F.col("s1")).alias("mixed")))
    met = scratch.save(segs.join(often, "anchor").groupBy("anchor", "seg", "th", "lo", "cnt", "off", "mixed").agg(F.count("*").alias("n")))
    scratch.drop(segs)
    scratch.release()
    unlike = scratch.save(met.where("mixed").groupBy("anchor", "seg").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("th", "lo", "cnt", "off")]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches):
            data, offsets = utf8(batch.column(1))
            th = batch.column(0).to_pylist()
            rows = []
            for k, segs_of in enumerate(batch.column(2).to_pylist()):
                if th[k] == last:  # a copy of the text before
                    continue
                last = th[k]
                raw = data[offsets[k]:offsets[k + 1]].tobytes()
                rows += [(s["anchor"], s["seg"], s["off"], s["cnt"], raw[s["lo"]:s["lo"] + s["cnt"] - 1 + length]) for s in segs_of]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["anchor", "seg", "off", "cnt", "bytes"])

    def marked(bits: object, wanted: bool) -> object:
        """Keeps rows (h, _, text, ...) whose hash is in the bitmap, or those whose hash is not; h goes."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 2):
                on = in_bits(bits.value, batch.column(0).to_numpy()) == wanted
                if on.any():
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(on)) for c in batch.columns[1:]], batch.schema.names[1:])
        return run

    # one row of each text with places moves: its least id, found by a bitmap, so that no other text is shuffled
    places = scratch.save(unlike.groupBy("th").agg(F.collect_list(F.struct("anchor", "seg", "lo", "cnt", "off")).alias("s")))
    one = F.xxhash64("th", "doc_id").alias("h")
    first = docs.groupBy("th").agg(F.min("doc_id").alias("doc_id")).join(places.select("th"), "th", "left_semi")
    chosen = scratch.save(first.select(one))
    bits = spark.sparkContext.broadcast(hash_bits(chosen, "h"))
    movers = docs.select(one, "th", "text").mapInArrow(marked(bits, True), "th long, text string")
    source = movers.hint("merge").join(places, "th").select("th", "text", "s")
    bytes_ = scratch.save(source.mapInArrow(cut, "anchor long, seg long, off int, cnt int, bytes binary"))
    scratch.drop(places)
    scratch.release()
    quarters = _quarters(bytes_, length, gram)
    crowded = scratch.save(quarters.select("sub", F.octet_length("bytes").alias("size")).groupBy("sub").agg(F.count("*").alias("c"), F.sum("size").alias("size"))
                           .where("c > 1").select("sub", (F.col("size") > JOINED).alias("large")))
    groups = quarters.join(crowded.where("not large").select("sub"), "sub").repartition("sub").sortWithinPartitions("sub", "anchor", "seg")
    parts = scratch.save(_expanded(groups.select("sub", "anchor", "seg", "start", "bytes"), length))
    large = crowded.where("large").select("sub")
    more = split = None
    if not large.isEmpty():
        # each has over JOINED bytes, so they are few beside the quarters: these are not shuffled to find theirs
        split = scratch.save(quarters.join(F.broadcast(large), "sub").select("anchor", "seg", "start", "bytes"))
        more = scratch.save(_counted(split, length, scratch))
    for table in (bytes_, crowded, split):
        if table is not None:
            scratch.drop(table)
    scratch.release()
    ranges = unlike.where("n > 1").select("anchor", "seg", F.lit(0).alias("a"), (F.col("cnt") - 1).alias("b")).union(parts if more is None else parts.union(more))
    spans = (met.where("not mixed").select("th", "lo", F.lit(0).alias("a"), (F.col("cnt") - 1).alias("b"))
             .union(met.where("mixed").join(ranges, ["anchor", "seg"]).select("th", "lo", "a", "b")))
    spans = scratch.save(spans.groupBy("th").agg(F.collect_set(F.struct((F.col("lo") + F.col("a")).alias("s"), (F.col("lo") + F.col("b") + length).alias("e"))).alias("spans")))
    for table in (met, unlike, parts, more):
        if table is not None:
            scratch.drop(table)
    scratch.release()

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = utf8(batch.column(1))
            rows = []
            for k, found in enumerate(batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows):
                raw = data[offsets[k]:offsets[k + 1]]
                runs: list[list[int]] = []
                for s in sorted((s["s"], s["e"]) for s in found or ()):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                keep = hashlib.sha256()
                done = 0
                for a, b in runs:
                    keep.update(raw[done:a].tobytes())
                    done = b
                keep.update(raw[done:].tobytes())
                rows.append((len(raw), sum(b - a for a, b in runs), len(runs), keep.hexdigest(), ",".join(f"{a}:{b}" for a, b in runs)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans string"
    cut_bits = spark.sparkContext.broadcast(hash_bits(spans, "th"))
    touched = docs.select(F.col("th").alias("h"), "doc_id", "text", "th").mapInArrow(marked(cut_bits, True), "doc_id long, text string, th long")
    rest = marked(cut_bits, False)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return kept(rest(batches))

    return (touched.join(spans, "th", "left").select("doc_id", "text", "spans").mapInArrow(kept, result)
            .union(docs.select(F.col("th").alias("h"), "doc_id", "text").mapInArrow(untouched, result)))
