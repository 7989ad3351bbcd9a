"""Table slices behind the report charts and summary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import constants as K


def metric_pivot(metrics: DataFrame, metric: str, horizons: Sequence[int]) -> DataFrame:
    """model × horizon table of one overall metric."""
    wide = metrics.where("stratum_type = 'all'").groupBy("model").pivot("horizon", list(horizons)).agg(
        F.first(metric))
    return wide.select("model", *[F.col(str(h)).alias(f"{metric}_T{h}") for h in horizons])


def metrics_pivot(metrics: DataFrame, names: Sequence[str], horizons: Sequence[int]) -> DataFrame:
    wide = metrics.where("stratum_type = 'all'").groupBy("model").pivot("horizon", list(horizons)).agg(
        *[F.first(n).alias(n) for n in names])
    return wide.select("model", *[F.col(f"{h}_{n}").alias(f"{n}_T{h}") for n in names for h in horizons])


def ablation(metrics: DataFrame, deep: str, linear: str) -> DataFrame:
    """Per horizon the metrics of two models side by side with their differences."""
    m = metrics.where("stratum_type = 'all'")

    def side(model, tag):
        return m.where(F.col("model") == model).select(
            "horizon", F.col("auc").alias(f"auc_{tag}"), F.col("brier").alias(f"brier_{tag}"),
            F.col("log_loss").alias(f"logloss_{tag}"), *([F.col("n"), F.col("n_events")] if tag == "deep" else []))

    x = side(deep, "deep").join(side(linear, "linear"), "horizon")
    out = ["horizon"]
    for name in ("auc", "brier", "logloss"):
        out += [f"{name}_deep", f"{name}_linear",
                (F.col(f"{name}_deep") - F.col(f"{name}_linear")).alias(f"{name}_delta")]
    return x.select(*out, "n", "n_events")


def metric_slice(metrics: DataFrame, stratum_type: str, metric: str) -> DataFrame:
    """Long chart data of one metric by stratum, in model display order."""
    return metrics.where(F.col("stratum_type") == stratum_type).select(
        C.category_rank("model", K.MODEL_ORDER).alias("model_rank"), "model", "horizon",
        "stratum_value", F.col(metric).alias("value"), "n")


def auc_order(metrics: DataFrame) -> DataFrame:
    """Legend order: models by falling AUC within each horizon."""
    w = W.partitionBy("horizon").orderBy(F.desc("auc"), "model")  # a handful of models
    return metrics.where("stratum_type = 'all'").select(
        "horizon", "model", "auc", F.row_number().over(w).alias("position"))


def forest_rows(coefficients: DataFrame) -> DataFrame:
    """Coefficient table in plotting order with significance and direction."""
    w = W.partitionBy().orderBy("coef")  # one row per covariate
    return coefficients.select(
        F.row_number().over(w).alias("position"), "covariate", "label", "coef", "coef_lower",
        "coef_upper", "hazard_ratio", "hr_lower", "hr_upper", "p",
        C.significance("p").alias("sig"), C.direction("hazard_ratio").alias("direction"))


def macro_rows(coefficients: DataFrame) -> DataFrame:
    """The macro covariates only."""
    return coefficients.where(F.col("covariate").isin([f"{c}_z" for c in K.MACRO_COVARIATES]))


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    w = W.partitionBy("model", "horizon").orderBy(F.desc("importance"), "feature")
    return importance.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best_iteration(history: DataFrame, loss: str = "val_loss", step: str = "iteration",
                   by: Sequence[str] = ()) -> DataFrame:
    """Step with the smallest loss."""
    return history.groupBy(*by).agg(F.min_by(step, loss).alias("best"), F.min(loss).alias("best_loss"))


def present_models(predictions: DataFrame, order: Sequence[str] = tuple(K.MODEL_ORDER)) -> list[str]:
    """Models of the display order that the prediction table has."""
    have = {c.split("_")[1] for c in predictions.columns if c.startswith("pred_")}
    return [m for m in order if m in have]


def drawn_strata(available: DataFrame, wanted: Sequence[str], column: str = "stratum") -> DataFrame:
    """Wanted strata that exist, and those that do not, as arrays in one row."""
    have = available.agg(F.array_sort(F.collect_set(column)).alias("have"))
    want = F.array(*[F.lit(w) for w in wanted])
    return have.select(F.array_intersect(want, "have").alias("drawn"),
                       F.array_except(want, "have").alias("absent"))


def merge_predictions(left: DataFrame, right: DataFrame, key: str = "LoanSequenceNumber") -> DataFrame:
    """Prediction columns of `right` added by key."""
    new = [c for c in right.columns if c.startswith("pred_") and c not in left.columns]
    return left.join(right.select(key, *new), key, "left")
