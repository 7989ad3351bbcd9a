"""Parquet, CSV and JSON sources and sinks.

Paths are plain strings on any file system Spark can reach; existence is probed through the
session's Hadoop file system, so the same code runs on local disk and on a shared store.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import constants as K

SPLITS = ("train", "val", "test")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


# --- readers ----------------------------------------------------------------------
def scan(spark: SparkSession, path, columns: Sequence[str] | None = None, where=None,
         schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; column list and predicate reach the reader through Catalyst."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*columns)


def scan_years(spark: SparkSession, pattern: str, years: Iterable[int],
               columns: Sequence[str] | None = None) -> DataFrame:
    """One frame over the yearly files that exist; columns a year lacks become NULL.

    `pattern` holds "{year}". Files are grouped into one multi-path scan per schema, so the
    plan stays flat however many years there are.
    """
    years = list(years)
    paths = [p for p in (pattern.format(year=y) for y in years) if exists(spark, p)]
    if not paths:
        raise FileNotFoundError(f"no file matches {pattern} for years {years[:1]}..{years[-1:]}")
    by_schema: dict[str, list[str]] = {}
    for p in paths:
        by_schema.setdefault(spark.read.parquet(p).schema.simpleString(), []).append(p)
    frames = [spark.read.parquet(*ps) for ps in by_schema.values()]
    return union_all([f.select(*[c for c in columns if c in f.columns]) if columns else f
                      for f in frames])


def scan_partitioned(spark: SparkSession, path: str, years: Iterable[int],
                     partition: str = "vintage") -> DataFrame:
    """Same as `scan_years` for a table partitioned by year; other years are never listed."""
    return spark.read.parquet(path).where(F.col(partition).isin([int(y) for y in years]))


def scan_optional(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def read_series_csv(spark: SparkSession, path: str, value_column: str) -> DataFrame | None:
    """(date, value) from a time-series CSV, None when the file or its date column is missing.

    The date column is `observation_date` or `DATE`; the value is the first other column; text
    that is no number becomes NULL and is dropped.
    """
    if not exists(spark, path):
        return None
    raw = spark.read.option("header", True).csv(path)
    date = next((c for c in ("observation_date", "DATE") if c in raw.columns), None)
    if date is None:
        return None
    series = [c for c in raw.columns if c != date][0]
    return raw.select(F.to_date(F.col(date).try_cast("timestamp")).alias("date"),
                      F.col(series).try_cast("double").alias(value_column)).dropna()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --- writers ------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), level: int = 8) -> None:
    """Loan-level sink: zstd parquet, optionally partitioned (vintage for the panel)."""
    w = df.write.mode("overwrite").option("compression", "zstd").option(
        "parquet.compression.codec.zstd.level", str(level))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalog table bucketed by the loan key: later joins on it need no shuffle."""
    (df.write.mode("overwrite").format("parquet").option("compression", "zstd")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def write_summary(df: DataFrame, path: str) -> None:
    """Summary-table sink (curves, coefficients, metrics)."""
    df.write.mode("overwrite").parquet(path)


# --- canonical split -------------------------------------------------------------------
def split_table(blocks: dict[str, DataFrame] | DataFrame, key: str = "LoanSequenceNumber",
                year: str = "VintageYear") -> DataFrame:
    """(key, split, year) rows of the train/val/test blocks, with the order they carry.

    `blocks` is one frame per split, or one frame with a column `split`, which is read once.
    `ord` is a stable rank key (the loan key hash), kept so that readers can restore one
    canonical order without relying on file order.
    """
    if isinstance(blocks, DataFrame):
        missing = {key, year, "split"} - set(blocks.columns)
        if missing:
            raise KeyError(f"the rows lack {sorted(missing)}")
        return blocks.where(F.col("split").isin(list(SPLITS))).select(key, "split", year, C.hash60(key, K.SEED).alias("ord"))
    parts = []
    for name, df in blocks.items():
        if name not in SPLITS:
            raise ValueError(f"split must be one of {SPLITS}, got {name!r}")
        missing = {key, year} - set(df.columns)
        if missing:
            raise KeyError(f"split {name!r} lacks {sorted(missing)}")
        parts.append(df.select(key, F.lit(name).alias("split"), year,
                               C.hash60(key, K.SEED).alias("ord")))
    return union_all(parts)


def write_split(blocks: dict[str, DataFrame], path: str, **kw) -> None:
    split_table(blocks, **kw).write.mode("overwrite").parquet(path)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(f"no split table at {path}; write it before the models are compared")
    df = spark.read.parquet(path)
    if "split" not in df.columns:
        raise KeyError("split table has no 'split' column")
    return df


# --- run configuration and model metadata --------------------------------------------------
def write_run_config(spark: SparkSession, path: str, **options) -> None:
    """One-row table of run options (target mode and the like)."""
    spark.createDataFrame([{k: str(v) for k, v in options.items()}]).coalesce(1) \
        .write.mode("overwrite").parquet(path)


def read_run_option(spark: SparkSession, path: str, name: str, default: str) -> str:
    df = scan_optional(spark, path)
    if df is None or name not in df.columns:
        return default
    row = df.select(name).first()
    return default if row is None or row[0] is None else row[0]


def write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """Model metadata as one JSON document in a one-row text table."""
    spark.createDataFrame([(json.dumps(metadata, default=str),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def metadata_json(df: DataFrame, name: str = "metadata") -> DataFrame:
    """Rows to JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def parse_metadata(df: DataFrame, schema: str, name: str = "metadata") -> DataFrame:
    return df.select(F.from_json(name, schema).alias("m")).select("m.*")
