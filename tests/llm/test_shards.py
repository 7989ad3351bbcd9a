"""Balanced shards: the law, slots, groups kept whole, quotas, and the state after rounds against a plain version."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from hazardloom.llm import shards

SCHEMA = "doc_id long, text string, lang string, shard int, hub string, row long, size int, w int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", 9, "h", 4, 5, 6) for i, t in rows], SCHEMA)


def checked(frame, rows, n):
    out = frame.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    per = collections.defaultdict(list)
    for r in out:
        per[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(per[s]) for s in range(n)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in per.values())
    return out


def test_quotas():
    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(2, 9))
        now = rng.integers(0, 40, n)
        most = now + rng.integers(0, 5, n) * rng.integers(0, 2, n)
        asked = rng.integers(0, 12, (n, n)) * (1 - np.eye(n, dtype=int))
        asked = (asked * np.minimum(1, now / np.maximum(1, asked.sum(1)))[:, None]).astype(np.int64)
        x = shards.quotas(now, most, asked)
        assert (x >= 0).all() and (x <= asked).all() and (now - x.sum(1) + x.sum(0) <= most).all()
    # two full shards change places
    assert shards.quotas(np.array([5, 5]), np.array([5, 5]), np.array([[0, 3], [2, 0]])).tolist() == [[0, 2], [2, 0]]


def test_groups_stay_whole(spark):
    random.seed(1)
    rows = [(i, f"text {i}") for i in range(600)] + [(1000 + i, f"copy {i % 40}") for i in range(160)]
    rows += [(2000, None), (2001, ""), (None, "copy 1"), (None, "nobody"), (2002, "x" * 300_000)] + [(3000, "copy 2")] * 3
    random.shuffle(rows)
    out = checked(shards.shard_documents(table(spark, rows), 8), rows, 8)
    where = collections.defaultdict(set)
    for r in out:
        where[r["size"], r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert {r.n_linked for r in out if r.doc_id == 3000} == {7} and {r.n_linked for r in out if r.doc_id == 2000} == {2}


def test_hot_group(spark, monkeypatch):
    """A third of all rows are one text; cells far smaller than it."""
    monkeypatch.setattr(shards, "CELL", 16)
    monkeypatch.setattr("hazardloom.llm.common.CELL", 16)
    rows = [(i, "the same text") for i in range(400)] + [(i, f"pair {i // 2}") for i in range(400, 700)] + [(i, f"t{i}") for i in range(700, 1200)]
    out = checked(shards.shard_documents(table(spark, rows), 10), rows, 10)
    where = collections.defaultdict(set)
    for r in out:
        where[r["size"], r.text_crc32].add(r.shard)
    cut = sorted(len(s) for s in where.values() if len(s) > 1)
    assert len(cut) == 1 and math.ceil(400 / 120) <= cut[0] <= math.ceil(400 / 120) + 1


def test_all_linked(spark):
    """No row is free to fill up: the law holds, and most pairs meet by changing places."""
    rows = [(i, f"pair {i // 2}") for i in range(401)]
    out = checked(shards.shard_documents(table(spark, rows), 5), rows, 5)
    where = collections.defaultdict(set)
    for r in out:
        where[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) < 40


def test_links(spark):
    """Rings of documents that share a value pairwise gather, though no value holds the whole ring."""
    rows = [(i, f"text {i}") for i in range(400)]
    links = spark.createDataFrame([(10 * g + k, f"{g}-{e}") for g in range(10) for k in range(10) for e in (k, (k + 1) % 10)] + [(None, "x"), (5, None), (77777, "y")], "doc_id long, hub string")
    alone = checked(shards.shard_documents(table(spark, rows), 4), rows, 4)
    out = checked(shards.shard_documents(table(spark, rows), 4, links), rows, 4)

    def cuts(found):
        where = {r.doc_id: r.shard for r in found}
        return sum(where[10 * g + k] != where[10 * g + (k + 1) % 10] for g in range(10) for k in range(10))

    assert cuts(out) <= 40 < 60 < cuts(alone)


def test_layout_does_not_matter(spark):
    rows = [(i, f"pair {i // 3}") for i in range(90)] + [(i, f"t{i}") for i in range(90, 200)]
    docs = table(spark, rows)
    a, b = ({(r.doc_id, r.shard, r.slot) for r in shards.shard_documents(docs.repartition(k), 7).collect()} for k in (1, 9))
    assert a == b


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a"), (1, "a")]])
def test_small(spark, rows):
    frame = shards.shard_documents(table(spark, rows), 40)
    assert frame.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "n_linked"]
    checked(frame, rows, 40)
