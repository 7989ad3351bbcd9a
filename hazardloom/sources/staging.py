"""Lineage cuts and size-checked small tables."""

from __future__ import annotations

import logging
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

SMALL_TABLE_ROWS = 100_000


def _checkpoint_dir(spark: SparkSession) -> str | None:
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current or conf:
        if not current:
            spark.sparkContext.setCheckpointDir(conf)
        return current or conf
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="hazardloom-checkpoint-")
        spark.sparkContext.setCheckpointDir(path)
        return path
    return None


def stage(df: DataFrame) -> DataFrame:
    """Materialise a frame that is read many times (iterative fits, several consumers).

    Uses a reliable checkpoint in the shared folder the cluster names in
    `spark.checkpoint.dir`, so a lost executor costs a re-read and not a recomputation. On a
    cluster that names none the frame is persisted to memory and disk, which Spark rebuilds
    from lineage after a loss.
    """
    if _checkpoint_dir(df.sparkSession) is None:
        log.warning("spark.checkpoint.dir is not set; keeping full lineage")
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint(eager=True)


def stage_columns(df: DataFrame) -> DataFrame:
    """As `stage`, for wide tables of many rows: compressed column files in the checkpoint folder.

    Values that repeat from row to row take little room there, and a pass reads only its columns.
    The partitioning is not kept.
    """
    folder = _checkpoint_dir(df.sparkSession)
    if folder is None:
        return stage(df)
    path = f"{folder}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """A summary table as a local relation when it is small, the frame itself when it is not.

    The row count is checked before anything is collected: at most `max_rows + 1` rows are
    fetched. A local relation has an exact size, so Spark broadcasts it on its own and the
    large side of a join is not shuffled; beyond the limit the join stays a shuffle join.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(rows, schema=df.schema)
