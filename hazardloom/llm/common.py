"""Shared helpers of the corpus operators: staged tables, Arrow byte views, hash splits, components."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Functions of this folder travel to the executors with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules["hazardloom.llm"])

#: Texts are taken out of an Arrow batch in slices of about this many bytes.
SLICE_BYTES = 4 << 20
#: Rows that numbered() and before() order in one task, on average.
CELL = 50_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; a temporary one is set only where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Intermediate tables as Parquet in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def release(self) -> None:
        """Let Spark's cleaner delete shuffle files of finished jobs now, not when the driver's heap fills up."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, df: DataFrame) -> None:
        """Delete a table of save() once everything that reads it has been written itself."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text modulo n (null: -1)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(-1))


def before(df: DataFrame, value: str, cells: list[Column], ties: list[str], name: str, by: list[str] | None = None) -> DataFrame:
    """Adds the sum of `value` over the rows of the same `by` that come earlier in (cells, ties).

    No task orders a whole group: cells are summed first, and a window works inside each of them. `df` is read
    twice, so it must be a saved table; rows alike in all of this get places in any order.
    """
    by, names = by or [], [f"_cell{k}" for k in range(len(cells))]
    df = df.withColumns(dict(zip(names, cells, strict=True)))
    sums = df.groupBy(*by, *names).agg(F.sum(value).alias("_sum"))
    past = W.partitionBy(*by).orderBy(*names).rowsBetween(W.unboundedPreceding, -1)
    past = sums.select(*by, *names, F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_past"))
    inside = W.partitionBy(*by, *names).orderBy(*ties).rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(past, [*by, *names])
    return out.withColumn(name, F.col(name) + F.col("_past")).drop("_past", *names)


def numbered(df: DataFrame, order: list[Column], name: str, rows: int, ties: list[str], by: list[str] | None = None) -> DataFrame:
    """Numbers the rows of each `by` from 0 without gaps, by all but the last of `order`, then by its hash; rows: how many a `by` has."""
    cells = [*order[:-1], F.pmod(order[-1], F.lit(rows // CELL + 1))]
    return before(df.withColumn("_one", F.lit(1).cast("long")), "_one", cells, ties, name, by).drop("_one")


def hash_bits(hashes: DataFrame, column: str, most: int = 27) -> np.ndarray:
    """Bitmap of the low bits of a column of 64-bit hashes of a saved table: about 16 bits a row, 2^most at most."""
    size = 1 << min(most, max(10, (16 * hashes.count() - 1).bit_length()))
    at = F.col(column).bitwiseAND(F.lit(size - 1))
    found = hashes.select(F.shiftright(at, 6).cast("int").alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    found = found.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[found.column("slot").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def in_bits(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the bitmap; never False for one that is."""
    at = hashes.astype(np.int64).view(np.uint64) & np.uint64(len(bits) * 64 - 1)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in a row, and len + 1 offsets into them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `limit` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        part = size // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): connected components of undirected edges; the least node names each.

    Alternating star contraction: every round links neighbours of a node to its least neighbour.
    Only row counts and checksums reach the driver; rounds grow with the logarithm of the longest chain.
    """
    e = scratch.save(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        nxt = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        nxt = scratch.save(nxt)
        now = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(e)
        e = nxt
        if now == seen:
            break
        seen = now
    heads = e.select(F.col("v").alias("node")).distinct()
    return (e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            .union(heads.join(e.select(F.col("u").alias("node")), "node", "left_anti").select("node", F.col("node").alias("component"))))
