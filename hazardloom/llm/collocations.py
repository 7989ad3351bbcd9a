"""Phrase collocations from stripes: each prefix keys an associative counter of its next words.

Level k counts phrases of k words. A task turns slices of whole texts into stripes (language, prefix of k - 1 words,
next words with counts) and Spark merges them elementwise where their prefix is dealt to, so that a shuffled entry is
a word and a number. With P shuffle partitions, a prefix with more than a P-th of all words (P prefixes at most) is
dealt out in parts by its next words, as many as it has P-ths; the empty prefix as single entries summed before they
are shuffled. So no task gets much more than its share. The merged stripes give everything: entries
are the extensions of a prefix, the total of the empty prefix's stripe is the number of words, entries of lower
levels are the counts of both parts of a cut, and the largest entry over the stripes that extend a phrase to the
right or to the left decides whether a longer phrase subsumes it (a phrase is never more frequent than one within it,
so phrases one word longer suffice).

A phrase of k words is frequent only if its first and its last k - 1 words are. Level k therefore counts only at places
where both are in a bitmap of the frequent phrases of level k - 1. The bitmap has at most 2^27 bits whatever the
corpus; a false hit adds a rare entry that the exact counts remove, so it never changes a result.

Defined results: null or empty texts hold no word; a null lang is `und`, one language with texts that say `und`; every
row counts, repeated ones too; equal scores and counts are ranked by phrase in byte order; other columns, whatever
their names, are not read; empty tables give no rows. A text is never cut: a very long one is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hazardloom.llm.common import Scratch, slices, utf8
from hazardloom.llm.jaccard import mix

LONGEST, LEAST, TOP, SUBSUMED = 5, 100, 2000, 100
#: Bytes of text whose stripes are made at once, and the largest bitmap of frequent phrases (as a power of 2).
SLICE, BITS = 8 << 20, 27
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_STRIPE = "lang string, prefix string, part int, next string, times array<int>"
_RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def words(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """All words of a column of texts in a row, lower-cased; the piece and the text that each stands in."""
    data, offsets = utf8(column)
    data = _LOWER[data]
    kind = _KIND[data]
    inside = kind == 0
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[:-1]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | first))
    piece = np.cumsum((kind == 2) | first, dtype=np.int32)[start]
    text = np.searchsorted(offsets, start, side="right") - 1
    kept = np.cumsum(inside, dtype=np.int32)
    ends = np.append(kept[start] - 1, kept[-1] if len(kept) else 0)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[inside])])
    return found.dictionary_encode(), piece, text


def _hashes(values: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x) for x in values.to_pylist()), np.uint64, len(values))


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its prefix and of its last word."""
    return mix(prefix * np.uint64(0x9E3779B97F4A7C15) + word)


def stripes(docs: DataFrame, k: int, seen: object = None, hot: object = None) -> DataFrame:
    """(lang, prefix, part, next, times) of phrases of k words: next holds words with blanks between, times their counts.

    seen: broadcast bitmap of frequent phrases of k - 1 words; hot: broadcast (hashes, sorted, of prefixes whose
    stripes are cut by their next words, in how many parts).
    """
    def of(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        coded, piece, text = words(batch.column(1))
        word, known = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        langs = batch.column(0).dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        if len(word) < k:
            return None
        whole = piece[k - 1:] == piece[:len(piece) - k + 1]
        if seen is not None:
            bits = seen.value
            name = _hashes(known)
            own = _hashes(langs.dictionary.cast(pa.large_binary()))
            h = own[lang]
            for j in range(k - 1):
                h = _longer(h[:len(word) - j], name[word[j:]])
            whole_hash = h
            mask = np.uint64(len(bits) * 64 - 1)
            hit = (bits[(h & mask) >> np.uint64(6)] >> (h & np.uint64(63))) & np.uint64(1) == 1
            whole &= hit[:-1] & hit[1:]
        at = np.flatnonzero(whole)
        if not len(at):
            return None
        size = len(known)
        prefix = lang[at]
        for j in range(k - 1):
            prefix = np.unique(prefix * size + word[at + j], return_inverse=True)[1]
        key, one, times = np.unique(prefix * size + word[at + k - 1], return_index=True, return_counts=True)
        group, follows = key // size, key % size
        part = np.zeros(len(key), np.int64)
        if hot is not None and len(hot.value[0]):
            names, parts = hot.value
            h = whole_hash[at[one]]
            which = np.searchsorted(names, h).clip(max=len(names) - 1)
            is_hot = names[which] == h
            part[is_hot] = (name[follows[is_hot]] % parts[which[is_hot]]).astype(np.int64)
            order = np.lexsort((part, group))
            group, follows, part, one, times = (x[order] for x in (group, follows, part, one, times))
        new = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (part[1:] != part[:-1])]))
        head = at[one[new]]
        text_of = known.cast(pa.large_string())
        blank = pa.scalar(" ", pa.large_string())
        firsts = [text_of.take(pa.array(word[head + j])) for j in range(k - 1)]
        joined = pc.binary_join_element_wise(*firsts, blank) if k > 2 else firsts[0] if k == 2 else pa.array([""] * len(head), pa.large_string())
        cuts = np.append(new, len(key))
        nexts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts), text_of.take(pa.array(follows))), blank)
        return pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(lang[head])).cast(pa.string()), joined.cast(pa.string()), pa.array(part[new], pa.int32()), nexts.cast(pa.string()),
             pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(times, pa.int32()))],
            ["lang", "prefix", "part", "next", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, SLICE):
            found = of(batch)
            if found is not None:
                yield found

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, _STRIPE)


def merged(dealt: DataFrame, k: int) -> DataFrame:
    """(lang, prefix, next, f): stripes added elementwise; from k = 2 on where their prefixes (or parts) have been dealt to."""
    entry = F.explode(F.arrays_zip(F.split("next", " ").alias("next"), "times")).alias("e")
    if k > 1:
        dealt = dealt.repartition("lang", "prefix", "part")
    return (dealt.select("lang", "prefix", "part", entry).groupBy("lang", "prefix", "part", F.col("e.next").alias("next"))
            .agg(F.sum("e.times").alias("f")).drop("part"))


def _phrase(prefix: str = "prefix") -> Column:
    return F.when(F.col(prefix) == "", F.col("next")).otherwise(F.concat_ws(" ", prefix, "next"))


def _phrase_hashes(lang: pa.Array, phrase: pa.Array, k: int) -> np.ndarray:
    h = _hashes(lang.cast(pa.large_binary()))
    parts = _hashes(pc.list_flatten(pc.split_pattern(phrase, " ")).cast(pa.large_binary())).reshape(-1, k)
    for j in range(k):
        h = _longer(h, parts[:, j])
    return h


def bitmap(frequent: DataFrame, k: int, rows: int) -> np.ndarray:
    """Bits of the hashes of frequent phrases (lang, phrase) of k words: about 16 for each, 2^27 at most."""
    size = 1 << min(BITS, max(10, (16 * rows - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h = _phrase_hashes(batch.column(0), batch.column(1), k) & np.uint64(size - 1)
            slot, which = np.unique(h >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(slot), np.uint64)
            np.bitwise_or.at(bits, which, np.uint64(1) << (h & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(bits.view(np.int64))], ["slot", "bits"])

    found = frequent.select("lang", "phrase").mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def hot_prefixes(frequent: DataFrame, k: int, total: int, shares: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sorted, of the phrases of k words that hold over 1/shares of all words, how many such shares); at most `shares`."""
    found = frequent.where(F.col("f") * shares > total).select("lang", "phrase", F.ceil(F.col("f") * shares / total).cast("long").alias("p")).toArrow().combine_chunks()
    if not found.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = _phrase_hashes(found.column(0).combine_chunks(), found.column(1).combine_chunks(), k)
    order = np.argsort(h)
    return h[order], found.column(2).to_numpy().astype(np.uint64)[order]


def scored(levels: list[DataFrame], totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates in the levels from 2 on, by their lowest-scoring cut."""
    every = levels[0]
    for level in levels[1:]:
        every = every.union(level)
    cuts = []
    for k, level in enumerate(levels[1:], 2):
        part = level.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
        sides = [F.struct(F.lit(i).alias("cut"), F.lit(left).alias("left"), F.array_join(F.slice("w", *((1, i) if left else (i + 1, k - i))), " ").alias("part"))
                 for i in range(1, k) for left in (True, False)]
        cuts.append(part.select("lang", "phrase", "a", F.explode(F.array(*sides)).alias("c")).select("lang", "phrase", "a", "c.*"))
    both = cuts[0]
    for more in cuts[1:]:
        both = both.union(more)
    met = both.join(every.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    pairs = met.groupBy("lang", "phrase", "cut").agg(
        F.first("a").alias("a"), F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    pairs = pairs.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang").withColumn("over", (big("a") * big("n")).cast("decimal(38,0)") * F.lit(1000).cast("decimal(4,0)"))
    pairs = pairs.withColumn("under", (big("l") * big("r")).cast("decimal(38,0)")).withColumn("score", F.expr("over div under"))
    least = pairs.groupBy("lang", "phrase", "n").agg(F.min(F.struct("score", "cut", "a", "l", "r")).alias("m"))
    return least.select("lang", "phrase", "m.a", "m.l", "m.r", "n", "m.score")


def subsumers(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, most): the largest entry among the stripes that extend a phrase by a word on either side."""
    sides = [side for level in levels for side in (
        level.select("lang", F.col("prefix").alias("phrase"), "f"),
        level.select("lang", F.expr("substr(phrase, instr(phrase, ' ') + 1)").alias("phrase"), "f"))]
    out = sides[0]
    for side in sides[1:]:
        out = out.union(side)
    return out.groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words found `least` times or more.

    A phrase goes if a longer candidate that holds it has `subsumed` percent of its count or more.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    levels: list[DataFrame] = []
    totals, seen, hot, size = None, None, None, 0
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k in range(1, longest + 1):
        counted = merged(stripes(docs, k, seen, hot), k)
        if k == 1:
            counted = scratch.save(counted)
            totals = scratch.save(counted.groupBy("lang").agg(F.sum("f").alias("n")))
        frequent = scratch.save(counted.where(F.col("f") >= least).withColumn("phrase", _phrase()))
        if k == 1:
            scratch.drop(counted)
            size = totals.agg(F.sum("n")).first()[0] or 0
        scratch.release()
        if seen is not None:
            seen.destroy()
            hot.destroy()
        rows = frequent.count()
        if not rows:
            break
        levels.append(frequent)
        if k < longest:
            seen = spark.sparkContext.broadcast(bitmap(frequent, k, rows))
            hot = spark.sparkContext.broadcast(hot_prefixes(frequent, k, size, shares))
    if len(levels) < 2:
        return spark.createDataFrame([], _RESULT)
    found = scored(levels, totals).join(subsumers(levels[1:]), ["lang", "phrase"], "left")
    kept = found.where(F.col("most").isNull() | (F.col("most").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * subsumed))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
