"""Invertible Bloom sketches of a text's paragraphs, subtracted and peeled; DataFrame and SQL functions only.

A text's key set holds a 64-bit digest of each distinct non-empty line. Its sketch is three rows of `side` cells;
each key adds one to the count, and its value and check hash by xor, in one cell of every row. The difference of
two sketches holds only the keys that differ; cells with a single key are peeled in parallel rounds until nothing
is left, which recovers the differing digests. Sketches that do not empty are retried three times larger; before
the first retry long texts are split by digest into shards of about 64 keys, each with a sketch of its own, so the
work stays in proportion to the text and a row stays small.

Likeness is (|A| + |B| - d) / (|A| + |B| + d) with d recovered digests, the Jaccard similarity of the key sets.
Defined results: null texts count as empty; two empty sets are alike (1.0); of one row its next row is itself;
rows that repeat an id are ordered by a hash of their text; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardloom.llm.common import Scratch

SIDE, ROUNDS, SHARD = 12, 10, 64


def keys_of(text: Column) -> Column:
    lines = F.array_distinct(F.filter(F.split(text, "\n"), lambda x: x != ""))
    return F.transform(lines, lambda x: F.xxhash64(x))


def sketch(keys: str, side: int) -> Column:
    """Cells (n, k, h) of the keys in a column."""
    return F.expr(f"""transform(sequence(0, {3 * side - 1}), c -> aggregate(
        filter({keys}, k -> pmod(xxhash64(k, c div {side}), {side}) = c % {side}),
        named_struct('n', 0, 'k', 0L, 'h', 0), (a, k) -> named_struct('n', a.n + 1, 'k', a.k ^ k, 'h', a.h ^ hash(k, 77))))""")



def peeled(cells: str, side: int, rounds: int) -> Column:
    """(cells left, keys recovered) after peeling."""
    pure = "array_distinct(filter(s.cells, c -> abs(c.n) = 1 AND c.h = hash(c.k, 77)))"
    return F.expr(f"""aggregate(sequence(1, {rounds}), named_struct('cells', {cells}, 'keys', cast(array() as array<bigint>)),
        (s, r) -> aggregate(array({pure}), s, (t, pure) -> named_struct(
            'cells', transform(t.cells, (c, i) -> aggregate(
                filter(pure, p -> pmod(xxhash64(p.k, i div {side}), {side}) = i % {side}), c,
                (a, p) -> named_struct('n', a.n - p.n, 'k', a.k ^ p.k, 'h', a.h ^ p.h))),
            'keys', concat(t.keys, transform(pure, p -> p.k)))))""")


def difference(peel: str) -> Column:
    """Number of recovered keys, null where cells are left."""
    return F.expr(f"CASE WHEN NOT exists({peel}.cells, c -> c.n <> 0 OR c.k <> 0 OR c.h <> 0) THEN size(array_distinct({peel}.keys)) END")


def printed(cells: str) -> Column:
    return F.expr(f"array_join(transform({cells}, c -> concat_ws(':', c.n, hex(c.k), hex(c.h))), ',')")


def _with_next(docs: DataFrame, parts: int) -> DataFrame:
    """docs with next_text: the text of the next row in the order of (doc_id, tie); the last one's is the first's.

    Rows are dealt to ranges of ids (bounds from a quantile sketch); the first row of a range is also put at the
    end of the range before, so that a window within ranges finds every next row.
    """
    bounds = docs.select(F.col("doc_id").cast("double").alias("x")).approxQuantile("x", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    edges = F.array(*[F.lit(int(b)) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<bigint>")
    placed = docs.withColumn("part", F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(edges, lambda b: b <= F.col("doc_id")))))
    firsts = sorted(placed.groupBy("part").agg(F.min(F.struct("doc_id", "tie")).alias("f")).select("part", "f.*").collect(), key=lambda r: r.part)
    guards = [(firsts[k - 1].part, r.doc_id, r.tie) for k, r in enumerate(firsts)]
    if not guards:
        return placed.withColumn("next_text", F.lit(None).cast("string")).drop("part")
    wanted = docs.sparkSession.createDataFrame(guards, "part int, doc_id long, tie long")
    same = placed["doc_id"].eqNullSafe(F.col("g.doc_id")) & (placed["tie"] == F.col("g.tie"))
    ends = (placed.join(F.broadcast(wanted.alias("g")), same).select(F.col("g.part").alias("part"), placed["doc_id"], "text", placed["tie"], F.lit(1).alias("guard"))
            .dropDuplicates(["part"]))
    rows = placed.select("part", "doc_id", "text", "tie", F.lit(0).alias("guard")).unionByName(ends)
    order = Window.partitionBy("part").orderBy("guard", F.asc_nulls_first("doc_id"), "tie")
    return rows.withColumn("next_text", F.lead("text").over(order)).where("guard = 0").drop("part", "guard")


def fingerprints(docs: DataFrame, side: int = SIDE, rounds: int = ROUNDS, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "fingerprint")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    parts = min(2000, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _with_next(docs, parts)
    n, q = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    rows = rows.select("doc_id", "text", "next_text", F.concat(F.substring("text", F.lit(1), n - q), F.substring("next_text", F.lit(1), q)).alias("edited"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       keys_of(F.col("text")).alias("ka"), keys_of(F.col("edited")).alias("ke"), keys_of(F.col("next_text")).alias("kn"))
    keyed = scratch.save(rows.withColumn("rid", F.monotonically_increasing_id()))
    scratch.release()
    cells = keyed.select("*", sketch("ka", side).alias("ca"), sketch("ke", side).alias("ce"), sketch("kn", side).alias("cn"))
    cells = cells.select("*", peeled_of("ca", "ce", side, rounds).alias("pe"), peeled_of("ca", "cn", side, rounds).alias("pn"))
    base = scratch.save(cells.select("rid", "doc_id", "n_chars", "edited_sha256", printed("ca").alias("fingerprint"), printed("ce").alias("edited_fingerprint"),
                                     F.size("ka").alias("na"), F.size("ke").alias("ne"), F.size("kn").alias("nn"), difference("pe").alias("de"), difference("pn").alias("dn")))
    # what did not empty: by shard, three times larger each time
    open_rows = base.where("de IS NULL OR dn IS NULL").select("rid", "de", "dn").join(keyed.select("rid", "ka", "ke", "kn"), "rid")
    left = (open_rows.where("de IS NULL").select("rid", F.lit("e").alias("w"), F.col("ka").alias("x"), F.col("ke").alias("y"))
            .union(open_rows.where("dn IS NULL").select("rid", F.lit("n").alias("w"), F.col("ka").alias("x"), F.col("kn").alias("y"))))
    n_shards = F.ceil(F.greatest(F.size("x"), F.size("y")) / shard).cast("int")
    both = F.concat(F.transform("x", lambda k: F.struct(k.alias("k"), F.lit(1).alias("s"))), F.transform("y", lambda k: F.struct(k.alias("k"), F.lit(2).alias("s"))))
    exploded = left.select("rid", "w", n_shards.alias("m"), F.explode(both).alias("b")).select("rid", "w", F.pmod(F.xxhash64("b.k", F.lit(99)), F.col("m")).alias("part"), "b.*")
    todo = scratch.save(exploded.groupBy("rid", "w", "part").agg(F.collect_list(F.when(F.col("s") == 1, F.col("k"))).alias("x"), F.collect_list(F.when(F.col("s") == 2, F.col("k"))).alias("y")))
    solved, size = None, side
    while not todo.isEmpty():
        size *= 3
        tried = todo.select("*", sketch("x", size).alias("cx"), sketch("y", size).alias("cy"))
        tried = scratch.save(tried.select("rid", "w", "part", "x", "y", peeled_of("cx", "cy", size, rounds + 6).alias("p")).select("rid", "w", "part", "x", "y", difference("p").alias("d")))
        done = tried.where("d IS NOT NULL").select("rid", "w", "d")
        solved = done if solved is None else solved.union(done)
        todo = tried.where("d IS NULL").select("rid", "w", "part", "x", "y")
    if solved is not None:
        sums = solved.groupBy("rid").agg(F.sum(F.when(F.col("w") == "e", F.col("d"))).alias("xe"), F.sum(F.when(F.col("w") == "n", F.col("d"))).alias("xn"))
        base = base.join(sums, "rid", "left").withColumn("de", F.coalesce("de", "xe")).withColumn("dn", F.coalesce("dn", "xn"))
    near = lambda a, b, d: F.when(F.col(a) + F.col(b) == 0, 1.0).otherwise((F.col(a) + F.col(b) - F.col(d)) / (F.col(a) + F.col(b) + F.col(d)))
    return base.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("na", "ne", "de").alias("near_edited"), near("na", "nn", "dn").alias("near_next"))


def peeled_of(a: str, b: str, side: int, rounds: int) -> Column:
    return peeled(f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))", side, rounds)
