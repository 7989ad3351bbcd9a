"""Feature encoders as small tables: fitted with aggregates on the training rows, applied as
plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K
from ..functions import loans as L
from .ordered import bounds, medians, selected


def _fit_rows(df: DataFrame, fit_on: Column | str | None) -> DataFrame:
    return df if fit_on is None else df.where(fit_on)


# --- fitted tables -----------------------------------------------------------------
def numeric_stats(df: DataFrame, columns: Sequence[str], *, fit_on=None, ddof: int = 1) -> DataFrame:
    """(column, median, mean, std) over the fitting rows; the median is exact and distributed."""
    rows = _fit_rows(df, fit_on)
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    long = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("kv")).select("kv.*")
    moments = long.groupBy("column").agg(F.avg("value").alias("mean"), std("value").alias("std"))
    return moments.join(medians(rows, columns), "column", "left").select(
        "column", "median", "mean", "std")


def top_levels(df: DataFrame, columns: Sequence[str], k: int = K.TOP_LEVELS, *, fit_on=None) -> DataFrame:
    """(column, rank, level) of the k most frequent levels, ties by name."""
    rows = _fit_rows(df, fit_on)
    long = rows.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("level")) for c in columns]))
        .alias("kv")).select("kv.*").where("level is not null")
    counts = long.groupBy("column", "level").agg(F.count("*").alias("n"))
    w = W.partitionBy("column").orderBy(F.desc("n"), "level")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


@dataclass
class Encoder:
    """Fitted values of the feature matrix; a few hundred scalars at most."""

    medians: dict[str, float] = field(default_factory=dict)
    levels: dict[str, list[str]] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, *, fit_on=None, k: int = K.TOP_LEVELS,
            numeric: Sequence[str] = tuple(K.NUMERIC_FEATURES),
            categorical: Sequence[str] = tuple(K.CATEGORICAL_FEATURES)) -> Encoder:
        rows = _fit_rows(df, fit_on)
        num = [c for c in numeric if c in df.columns]
        cat = [c for c in categorical if c in df.columns]
        med = selected(rows, num) if num else {}
        if med is None:
            med = {r["column"]: r["median"] for r in medians(rows, num).collect()}
        med = {c: m for c, m in med.items() if m is not None}
        lev: dict[str, list[str]] = {c: [] for c in cat}
        if cat:  # at most k rows per column
            for r in top_levels(rows, cat, k).orderBy("column", "rank").collect():
                lev[r["column"]].append(r["level"])
        return cls(med, lev)

    def tables(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        num = spark.createDataFrame(list(self.medians.items()), "column string, median double")
        lev = spark.createDataFrame(
            [(c, i, v) for c, vs in self.levels.items() for i, v in enumerate(vs, 1)],
            "column string, rank int, level string")
        return num, lev

    @classmethod
    def from_tables(cls, numeric: DataFrame, levels: DataFrame) -> Encoder:
        enc = cls({r["column"]: r["median"] for r in numeric.collect()})
        for r in levels.orderBy("column", "rank").collect():
            enc.levels.setdefault(r["column"], []).append(r["level"])
        return enc

    def save(self, spark: SparkSession, path: str) -> None:
        num, lev = self.tables(spark)
        num.coalesce(1).write.mode("overwrite").parquet(f"{path}/numeric")
        lev.coalesce(1).write.mode("overwrite").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoder:
        return cls.from_tables(spark.read.parquet(f"{path}/numeric"), spark.read.parquet(f"{path}/levels"))


def coded_levels(column: str, levels: Sequence[str], null_level: str = "OTHER") -> Column:
    """The level itself when it is in the vocabulary, else OTHER; NULL goes to `null_level`."""
    c = F.col(column)
    return F.when(c.isNull(), null_level).when(c.isin(list(levels)), c).otherwise("OTHER")


def feature_columns(df: DataFrame, encoder: Encoder, *, impute: str = "median",
                    null_level: str = "OTHER", vintage_year: bool = True,
                    numeric: Sequence[str] = tuple(K.NUMERIC_FEATURES),
                    categorical: Sequence[str] = tuple(K.CATEGORICAL_FEATURES)) -> dict[str, Column]:
    """Name -> expression of every feature: imputed numerics with missing flags, one-hot
    levels with OTHER and MISSING, optionally the vintage year."""
    out: dict[str, Column] = {}
    for c in numeric:
        if c not in df.columns:
            continue
        if impute == "median" and c not in encoder.medians:
            raise KeyError(f"no fitted median for {c!r}; fit the encoder on training rows first")
        fill = 0.0 if impute == "zero" else encoder.medians[c]
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(fill).cast("double"))
        out[f"{c}__missing"] = F.col(c).isNull().cast("int")
    for c in categorical:
        if c not in df.columns:
            continue
        if c not in encoder.levels:
            raise KeyError(f"no fitted levels for {c!r}; fit the encoder on training rows first")
        coded = coded_levels(c, encoder.levels[c], null_level)
        for level in [*encoder.levels[c], "OTHER", "MISSING"]:
            out[f"{c}__{level}"] = (coded == level).cast("int")
    if vintage_year and "VintageYear" in df.columns:
        out["VintageYear"] = F.col("VintageYear").cast("double")
    return out


def feature_matrix(df: DataFrame, encoder: Encoder, keep: Sequence[str] = (), **kw) -> DataFrame:
    feats = feature_columns(df, encoder, **kw)
    return df.select(*keep, *[e.alias(n) for n, e in feats.items()])


def replay_features(df: DataFrame, names: Sequence[str], means: Mapping[str, float],
                    stds: Mapping[str, float], keep: Sequence[str] = ()) -> DataFrame:
    """Stored-vocabulary encoding: zero impute, separate MISSING level, default vintage,
    columns in the saved order, z-scored with the saved scaler; a name the data cannot
    produce is 0 before scaling."""
    enc = Encoder(levels={c: list(v) for c, v in K.REPLAY_LEVELS.items()})
    feats = feature_columns(df, enc, impute="zero", null_level="MISSING")
    feats["VintageYear"] = F.coalesce(F.col("VintageYear"), F.lit(K.REPLAY_DEFAULT_VINTAGE)).cast("double")
    out = []
    for n in names:
        std = stds[n] if stds[n] > 0 else 1.0
        out.append(((feats.get(n, F.lit(0.0)) - F.lit(float(means[n]))) / F.lit(float(std))).alias(n))
    return df.select(*keep, *out)


# --- Cox covariates ----------------------------------------------------------------------
COX_SCALED = {"CreditScore": "FICO_z", "OriginalLoantoValueLTV": "LTV_z",
              "OriginalInterestRate": "Rate_z", "OriginalUPB": "UPB_z"}
DTI = "OriginalDebttoIncomeRatio"


def fit_cox_encoder(df: DataFrame, *, fit_on=None) -> dict[str, float]:
    """Means and standard deviations of the scaled covariates, DTI after median imputation."""
    rows = _fit_rows(df, fit_on)
    med = medians(rows, [DTI]).collect()[0]["median"]
    filled = F.coalesce(F.col(DTI).cast("double"), F.lit(med))
    aggs = [F.avg(filled).alias("DTI__mean"), F.stddev_samp(filled).alias("DTI__std")]
    for c in COX_SCALED:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    return {"DTI__median": med, **rows.agg(*aggs).collect()[0].asDict()}


def cox_features(df: DataFrame, enc: Mapping[str, float]) -> DataFrame:
    """Adds the 15 covariates; a row with a missing score, LTV or rate keeps NULL there."""
    out = {z: (F.col(c) - F.lit(enc[f"{c}__mean"])) / F.lit(enc[f"{c}__std"]) for c, z in COX_SCALED.items()}
    filled = F.coalesce(F.col(DTI).cast("double"), F.lit(enc["DTI__median"]))
    out["DTI_z"] = (filled - F.lit(enc["DTI__mean"])) / F.lit(enc["DTI__std"])
    out["DTI_missing"] = F.col(DTI).isNull().cast("int")
    return L.cox_dummies(df.withColumns(out))


# --- scaling ---------------------------------------------------------------------------------
def fit_scaler(df: DataFrame, columns: Sequence[str], *, fit_on=None, ddof: int = 1) -> dict[str, tuple[float, float]]:
    """column -> (mean, std) with a zero std replaced by one; one aggregate over the rows."""
    rows = _fit_rows(df, fit_on)
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    aggs = [a for c in columns for a in (F.avg(c).alias(f"{c}__m"), std(c).alias(f"{c}__s"))]
    r = rows.agg(*aggs).collect()[0]
    return {c: (r[f"{c}__m"], r[f"{c}__s"] or 1.0) for c in columns}


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


def unscale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(s) + F.lit(m) for c, (m, s) in scaler.items()})


def standardize_three(train: DataFrame, val: DataFrame, test: DataFrame, columns: Sequence[str]):
    """Z-scores of three frames with the statistics of the first, plus the scaler."""
    scaler = fit_scaler(train, columns)
    return scale(train, scaler), scale(val, scaler), scale(test, scaler), scaler


def macro_z(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`<c>_z` covariates: a constant column becomes 0, a missing value 0 after scaling."""
    present = [c for c in columns if c in df.columns]
    r = df.agg(*[a for c in present for a in (F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"))]).collect()[0]
    out = {}
    for c in present:
        m, s = r[f"{c}__m"], r[f"{c}__s"]
        out[f"{c}_z"] = (F.coalesce((F.col(c) - F.lit(m)) / F.lit(s), F.lit(0.0))
                         if s is not None and s > 0 else F.lit(0.0))
    return df.withColumns(out)


def fill_medians(df: DataFrame, columns: Sequence[str], *, fit_on=None) -> DataFrame:
    """Median imputation of several columns with medians of the fitting rows. Only columns that have
    a NULL are brought to the exact quantiles; one aggregate tells which, and their bounds."""
    n, known = bounds(df, columns)
    some = [c for c in columns if known[c][0] < n]
    fit = _fit_rows(df, fit_on)
    med = selected(fit, some, known=known if fit_on is None else None) if some else {}
    if med is None:
        med = {r["column"]: r["median"] for r in medians(fit, some).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(med.get(c)).cast("double"))
                           if c in some else F.col(c).cast("double") for c in columns})
