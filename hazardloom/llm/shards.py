"""Balanced shards by label propagation: linked documents gather in their neighbours' shards, row counts stay even.

Documents that share a hub (an equal text, or any value of `links`) are neighbours; pairs are never formed. Documents
with the same hubs are interchangeable, so they are one bundle, and the state is how many rows a bundle has in each
shard. It starts dealt out in turn. A round joins it to its hubs, adds up each hub's rows by shard, joins these votes
back to the bundles, and lets rows outside their bundle's best shards ask for one of them. A hub that fits no shard
has as many best shards as it needs. The driver sees how many rows ask to go from which shard to which (the square of
the number of shards), and takes as many of each as leave no shard over its quota; rows with the most to gain go
first, by exact running totals over hashed cells. Rounds end when no row moves.

Law `rows`: counts of shards differ by one at most. Quotas bound the linked rows; the others have no links to cut and
fill what is left, so the law holds whatever the rounds did. Hot hubs are sums before they are shuffled, and their
rows are numbered in cells of a fixed average size.

Defined results: a null text has no bytes and is equal to an empty one; rows that repeat an id, or whole rows, are
rows of their own with own slots; a null id is a value like others, but has no `links`; empty tables give no rows;
other columns, whatever their names, are not read. For distinct (doc_id, text) the result does not depend on how
the input is laid out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import CELL, Scratch, before, numbered

SHARDS, ROUNDS = 40, 16
_RESULT = "doc_id {0}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int, n_linked long"


def quotas(now: np.ndarray, most: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """How many of the asked[i, j] moves from i to j may be made at once so that no shard ends over `most`."""
    x = asked.copy()
    for _ in range(1000):
        over = now - x.sum(1) + x.sum(0) - most
        if (over <= 0).all():
            return x
        for j in np.flatnonzero(over > 0):
            # the last movers give way: cut the column from its end
            kept = np.cumsum(x[:, j]).clip(max=max(0, x[:, j].sum() - over[j]))
            x[:, j] = np.diff(kept, prepend=0)
    free = (most - now).clip(min=0)
    return np.diff(np.minimum(np.cumsum(asked, 0), free), axis=0, prepend=0)


def _votes(cells: DataFrame, hubs: DataFrame, weights: DataFrame) -> DataFrame:
    """weights with votes: (rows, shard) of all neighbours and the bundle itself, which counts once however many hubs it has."""
    by_hub = cells.join(hubs, "bundle").groupBy("hub", "shard").agg(F.sum("w").alias("w"))
    again = cells.join(weights.where("n_hubs > 1"), "bundle").select("bundle", "shard", ((1 - F.col("n_hubs")) * F.col("w")).alias("w"))
    votes = hubs.join(by_hub, "hub").select("bundle", "shard", "w").union(again).groupBy("bundle", "shard").agg(F.sum("w").alias("v"))
    return votes.groupBy("bundle").agg(F.collect_list(F.struct("v", "shard")).alias("votes")).join(weights, "bundle")


def _moves(cells: DataFrame, votes: DataFrame, quota: int, free: list[int], turn: int) -> DataFrame:
    """(bundle, shard, w, target, gain): the rows of a bundle in a shard that ask for another one.

    Rows outside the best shards ask for one of these that has room. Where none has, a torn bundle whose hub fits a
    shard with room asks for that as a whole; a larger one gathers what is left over in its next best shard with room;
    and with no room anywhere the best shards are asked, as quotas() finds who may change places.
    """
    best = votes.withColumn("votes", F.expr("array_sort(transform(votes, x -> struct(-x.v as v, xxhash64(tie, x.shard) as t, x.shard as shard)))"))
    best = best.withColumn("best", F.expr(f"slice(votes, 1, cast(ceil(need / {max(1, quota)}) as int)).shard"))
    room = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(left).alias("left")) for s, left in enumerate(free)])
    best = best.withColumns({"room": F.filter(room, lambda x: x["left"] > 0)["shard"], "fits": F.filter(room, lambda x: x["left"] >= F.col("need"))["shard"]})
    best = best.withColumn("open", F.array_intersect("best", "room")).withColumn("next", F.slice(F.array_intersect(F.col("votes")["shard"], F.col("room")), 1, 1))
    whole = (F.size("open") == 0) & (F.size("fits") > 0) & (F.size("votes") > F.size("best"))
    pick = F.when(F.size("open") > 0, F.col("open")).when(whole, F.col("fits")).when(F.size("next") > 0, F.col("next")).otherwise(F.col("best"))
    best = best.withColumns({"pick": pick, "whole": whole, "votes": F.expr("map_from_entries(transform(votes, x -> struct(x.shard, -x.v)))")})
    h = F.when(F.col("whole"), F.xxhash64("home", F.lit(turn))).otherwise(F.xxhash64("bundle", "shard", F.lit(turn)))
    asked = cells.join(best.select("bundle", "home", "best", "pick", "whole", "votes"), "bundle").where(F.col("whole") | ~F.array_contains("best", F.col("shard")))
    return (asked.withColumn("h", h).withColumn("target", F.expr("pick[cast(pmod(h, size(pick)) as int)]")).where("target <> shard")
            .withColumn("gain", F.expr("coalesce(votes[target], 0L) - votes[shard] + w")).select("bundle", "shard", "w", "target", "gain"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, links: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, n_linked) for each row; links: (doc_id, hub) besides equal texts.

    n_linked: rows, this one included, in the largest hub of the row (1: no neighbour).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.coalesce("text", F.lit(""))
    rows = scratch.save(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("hub")))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], _RESULT.format(dict(docs.dtypes)["doc_id"]))
    held = rows.select("row", "hub")
    if links is not None:
        extra = links.where("doc_id is not null and hub is not null").select("doc_id", F.concat(F.lit("link:"), F.col("hub").cast("string")).alias("hub"))
        held = scratch.save(held.union(rows.select("row", "doc_id").join(extra, "doc_id").select("row", "hub")).distinct())
    shared = scratch.save(held.groupBy("hub").agg(F.count("*").alias("n")).where("n > 1"))
    linked = held.join(shared, "hub")
    if links is None:
        linked = linked.select("row", F.col("hub").alias("bundle"), F.col("n").alias("need"), F.array("hub").alias("hubs"))
    else:
        linked = linked.groupBy("row").agg(F.array_sort(F.collect_set("hub")).alias("hubs"), F.max("n").alias("need"))
        linked = linked.select("row", F.md5(F.to_json("hubs")).alias("bundle"), "need", "hubs")
    tagged = scratch.save(rows.drop("hub").join(linked, "row", "left") if links is not None else
                          rows.join(shared, "hub", "left").select("row", "doc_id", "size", "text_crc32", F.when(F.col("n").isNotNull(), F.col("hub")).alias("bundle"),
                                                                  F.col("n").alias("need"), F.array("hub").alias("hubs")))
    tagged = tagged.withColumn("key", F.xxhash64("doc_id", "text_crc32", "size"))
    bundles = scratch.save(tagged.where("bundle is not null").groupBy("bundle").agg(F.count("*").alias("w"), F.max("need").alias("need"), F.first("hubs").alias("hubs")))
    n_bundles, n_linked = bundles.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    most = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    if n_linked:
        cells = _propagated(bundles, n_bundles, most, rounds, links is None, scratch)
        now = _counts(cells, shards)
        placed = _placed(tagged.where("bundle is not null"), cells, scratch)
    else:
        now, placed = np.zeros(shards, np.int64), None
    alone = scratch.save(numbered(tagged.where("bundle is null").select("row", "doc_id", "size", "text_crc32", "need", "key"), [F.col("key")], "rank", total - n_linked, ["key", "row"]))
    ends = F.array(*[F.lit(int(e)) for e in np.cumsum(most - now)]).cast("array<long>")
    out = alone.withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col("rank"))))
    columns = ["row", "doc_id", "size", "text_crc32", "need", "key", "shard"]
    out = scratch.save(out.select(columns) if placed is None else out.select(columns).union(placed.select(columns)))
    slots = numbered(out, [F.col("key")], "slot", total // shards, ["key", "row"], ["shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"), F.coalesce("need", F.lit(1).cast("long")).alias("n_linked"))


def _counts(cells: DataFrame, shards: int) -> np.ndarray:
    out = np.zeros(shards, np.int64)
    for r in cells.groupBy("shard").agg(F.sum("w").alias("w")).collect():
        out[r.shard] = r.w
    return out


def _propagated(bundles: DataFrame, n_bundles: int, most: np.ndarray, rounds: int, simple: bool, scratch: Scratch) -> DataFrame:
    """(bundle, shard, w): rows of each bundle in each shard when no more rows move."""
    shards, quota = len(most), int(most.min())
    hubs = scratch.save(bundles.select("bundle", F.explode("hubs").alias("hub")))
    home, n_hubs = F.array_min("hubs"), F.size("hubs")
    # neighbours must break ties alike: those of one hub by it, the others by the shard alone
    weights = bundles.select("bundle", "need", home.alias("home"), n_hubs.alias("n_hubs"), F.when(F.lit(simple), home).otherwise("").alias("tie"))
    dealt = before(bundles.select("bundle", "w"), "w", [F.pmod(F.xxhash64("bundle"), F.lit(n_bundles // CELL + 1))], ["bundle"], "past")
    turns = F.expr(f"transform(sequence(0, cast(least(w, {shards}) - 1 as int)), i -> struct(cast(pmod(past + i, {shards}) as int) as shard, (w - i + {shards - 1}) div {shards} as w))")
    cells = scratch.save(dealt.select("bundle", F.explode(turns).alias("c")).select("bundle", "c.shard", F.col("c.w").cast("long").alias("w")))
    for turn in range(rounds):
        now = _counts(cells, shards)
        moves = scratch.save(_moves(cells, _votes(cells, hubs, weights), quota, (most - now).tolist(), turn))
        asked = np.zeros((shards, shards), np.int64)
        for r in moves.groupBy("shard", "target").agg(F.sum("w").alias("w")).collect():
            asked[r.shard, r.target] = r.w
        taken = quotas(now, most, asked)
        if not taken.sum():
            break
        given = scratch.spark.createDataFrame([(int(i), int(j), int(taken[i, j])) for i, j in zip(*np.nonzero(taken), strict=True)], "shard int, target int, given long")
        # log2 of the gain, the largest first, then hashed cells
        order = [-F.floor(F.log2(F.greatest(F.col("gain"), F.lit(1)))).cast("int"), F.pmod(F.xxhash64("bundle", F.lit(turn)), F.lit(n_bundles // CELL + 1))]
        went = before(moves, "w", order, ["bundle"], "past", ["shard", "target"])
        went = went.join(F.broadcast(given), ["shard", "target"]).withColumn("m", F.least("w", F.col("given") - F.col("past"))).where("m > 0")  # at most shards^2 rows
        both = F.explode(F.array(F.struct(F.col("shard").alias("s"), (-F.col("m")).alias("w")), F.struct(F.col("target").alias("s"), F.col("m").alias("w"))))
        change = went.select("bundle", both.alias("c")).select("bundle", F.col("c.s").alias("shard"), F.col("c.w").alias("w"))
        after = scratch.save(cells.union(change).groupBy("bundle", "shard").agg(F.sum("w").alias("w")).where("w > 0"))
        scratch.drop(cells)
        scratch.drop(moves)
        cells = after
    return cells


def _placed(rows: DataFrame, cells: DataFrame, scratch: Scratch) -> DataFrame:
    """The linked rows with a shard: the rows of a bundle, numbered, go to its shards in turn."""
    cell = F.pmod("key", F.floor(F.col("need") / CELL).cast("long") + 1)
    ranked = scratch.save(before(rows.drop("hubs").withColumn("_one", F.lit(1).cast("long")), "_one", [cell], ["key", "row"], "rank", ["bundle"]).drop("_one"))
    sizes = scratch.save(cells.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("shard", "w"))).alias("c")))
    ends = F.expr("transform(sequence(1, size(c)), k -> struct(aggregate(slice(c, 1, k), 0L, (t, x) -> t + x.w) as e, c[k - 1].shard as shard))")
    return ranked.join(sizes.select("bundle", ends.alias("ends")), "bundle").withColumn("shard", F.expr("filter(ends, x -> rank < x.e)[0].shard"))

