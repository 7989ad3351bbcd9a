"""Train/validation/test splits and stratified samples with hash-based, reproducible ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..sources.tables import SPLITS
from .ordered import ranked


def vintage_split(df: DataFrame, train_end: int = K.TRAIN_END, test_start: int = K.TEST_START,
                  test_end: int = K.TEST_END, year: str = "VintageYear") -> DataFrame:
    """Rows of the train and test vintages with their `split`."""
    y = F.col(year)
    s = F.when(y <= train_end, "train").when((y >= test_start) & (y <= test_end), "test")
    return df.withColumn("split", s).where("split is not null")


def _hash_rank(df: DataFrame, key: str, seed: int, by: Sequence[str] = ()) -> DataFrame:
    """Rank of the loan in hash order within its stratum.

    Only (stratum, hash, key) goes through the ranking; the rows are joined back by key. A
    stratum with most of the rows is spread over buckets, not sorted in one task.
    """
    ids = df.select(*by, key, C.hash60(key, seed).alias("__h"))
    return ranked(ids, by, "__h", [key], "__rank").drop("__h")


def _attach(df: DataFrame, ranks: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    return df.join(ranks.select(key, *[c for c in ranks.columns if c not in (key, *by)]), key)


def carve_validation(train: DataFrame, frac: float = K.VALIDATION_FRACTION, seed: int = K.SEED,
                     key: str = "LoanSequenceNumber", exact: bool = True) -> DataFrame:
    """Adds `is_val`. Exact mode marks exactly round(n·frac) rows; the other mode is one
    narrow predicate whose complement is the inner training set."""
    if not 0 < frac < 1:
        raise ValueError(f"frac must be in (0, 1), got {frac}")
    if not exact:
        return train.withColumn("is_val", C.sampled(key, frac, seed))
    ranks = _hash_rank(train, key, seed)
    n = train.agg(F.bround(F.count("*") * F.lit(frac), 0).alias("__k"))
    marked = ranks.crossJoin(n).select(key, (F.col("__rank") <= F.col("__k")).alias("is_val"))  # n is one row
    return train.join(marked, key)


def stratified_split(df: DataFrame, strata: Sequence[str], frac: float, seed: int = K.SEED,
                     key: str = "LoanSequenceNumber") -> DataFrame:
    """Adds `is_test`: round(frac·n) rows of every stratum."""
    ranks = _hash_rank(df, key, seed, strata)
    sizes = df.groupBy(*strata).agg(F.bround(F.count("*") * F.lit(frac), 0).alias("__k"))
    marked = ranks.join(sizes, list(strata)).withColumn("is_test", F.col("__rank") <= F.col("__k"))
    return _attach(df, marked.select(key, "is_test"), key, ())


def fraction_sample(df: DataFrame, frac: float, seed: int = K.SEED,
                    key: str = "LoanSequenceNumber") -> DataFrame:
    return df.where(C.sampled(key, frac, seed))


def proportional_sample(df: DataFrame, strata: Sequence[str], total: int, seed: int = K.SEED,
                        key: str = "LoanSequenceNumber") -> DataFrame:
    """min(n_g, max(1, floor(total·n_g/n))) rows of every stratum."""
    ranks = _hash_rank(df, key, seed, strata)
    sizes = df.groupBy(*strata).agg(F.count("*").alias("__n"))
    whole = df.agg(F.count("*").alias("__all"))
    quota = sizes.crossJoin(whole).select(*strata, F.least(  # whole is one row
        "__n", F.greatest(F.lit(1), F.floor(F.lit(total) * F.col("__n") / F.col("__all")))).alias("__k"))
    ids = ranks.join(quota, list(strata)).where(F.col("__rank") <= F.col("__k")).select(key)
    return df.join(ids, key, "left_semi")


def quota_sample(df: DataFrame, stratum: str, quotas: Mapping, seed: int = K.SEED,
                 key: str = "LoanSequenceNumber") -> DataFrame:
    """At most `quotas[value]` rows per class (all of them where fewer exist)."""
    ranks = _hash_rank(df, key, seed, [stratum])
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv]), F.col(stratum))
    ids = ranks.where(F.col("__rank") <= limit).select(key)
    return df.join(ids, key, "left_semi")


def first_ids(df: DataFrame, n: int, key: str = "LoanSequenceNumber") -> DataFrame:
    """First n rows in the stable hash order."""
    ranks = _hash_rank(df, key, K.SEED).where(F.col("__rank") <= n).select(key)
    return df.join(ranks, key, "left_semi")


# --- canonical split --------------------------------------------------------------------
def restrict_to_split(df: DataFrame, split: DataFrame, value: str,
                      key: str = "LoanSequenceNumber") -> DataFrame:
    """Rows the split tags with `value`, carrying the canonical `ord` column. Sort by it only
    on export; nothing downstream depends on row order."""
    if value not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {value!r}")
    ids = split.where(F.col("split") == value).select(key, "ord")
    if ids.isEmpty():
        raise ValueError(f"the split has no rows tagged {value!r}")
    return df.join(ids, key)


def alignment(left: DataFrame, right: DataFrame, key: str = "LoanSequenceNumber",
              order: str = "ord") -> DataFrame:
    """Counts of rows on one side only and of rows whose order key differs, one row."""
    a = left.select(key, F.col(order).alias("__a"), F.lit(1).alias("__l"))
    b = right.select(key, F.col(order).alias("__b"), F.lit(1).alias("__r"))
    x = a.join(b, key, "full")
    return x.agg(
        F.count("__l").alias("n_left"), F.count("__r").alias("n_right"),
        F.count_if(F.col("__r").isNull()).alias("left_only"),
        F.count_if(F.col("__l").isNull()).alias("right_only"),
        F.count_if(F.col("__a") != F.col("__b")).alias("order_mismatch"))


def assert_aligned(left: DataFrame, right: DataFrame, key: str = "LoanSequenceNumber",
                   order: str = "ord") -> None:
    r = alignment(left, right, key, order).collect()[0]
    if r.left_only or r.right_only or r.order_mismatch:
        raise RuntimeError(f"tables are not aligned: {r.asDict()}")


def members(df: DataFrame, ids: DataFrame, key: str = "LoanSequenceNumber") -> DataFrame:
    """Rows whose key is in `ids` (semi-join, never a literal list)."""
    return df.join(ids.select(key), key, "left_semi")


def membership_share(df: DataFrame, ids: DataFrame, key: str = "LoanSequenceNumber") -> DataFrame:
    """How many rows are members of `ids`, and their share."""
    tagged = df.select(key).join(ids.select(key).distinct().withColumn("__in", F.lit(1)), key, "left")
    return tagged.agg(F.count("*").alias("n"), F.count("__in").alias("n_in")).withColumn(
        "share", F.try_divide(F.col("n_in"), F.col("n")))
