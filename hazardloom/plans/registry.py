"""Query registry: name -> Spark query over a data folder, with its SQL for the check."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Views, with_ctes


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int | Mapping[str, int] = 6) -> DataFrame:
    """Round floating columns for comparison; adding zero turns a negative zero positive."""
    out = []
    for f in df.schema.fields:
        d = digits if isinstance(digits, int) else digits.get(f.name, 6)
        c = F.col(f"`{f.name}`")
        is_float = f.dataType.typeName() in ("double", "float")
        out.append((F.round(c.cast("double"), d) + F.lit(0.0)).alias(f.name) if is_float else c)
    return df.select(*out)


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = (), floats: str = "",
          digits: int = 6, extra: dict[str, str] | None = None):
    """Register fn(views) under `name`. `floats` lists the SQL columns to round."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(fn(Views(spark, folder)), digits)

        text = None
        if sql is not None:
            body = sql
            if floats:
                rep = ", ".join(f'round(cast({c} as double), {digits}) + 0e0 as {c}' for c in floats.split())
                body = f"select * replace ({rep}) from ({sql}) q"
            text = with_ctes(body, *ctes, extra=extra)
        CATALOG[name] = Query(name, run, text)
        return fn

    return register
