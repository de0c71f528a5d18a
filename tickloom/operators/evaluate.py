"""Quality of predictions, from one long table (ticker, model, target, prediction)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import format_percent, parse_percent


def long_predictions(df: DataFrame, models: Mapping[str, Column], *keep: str) -> DataFrame:
    """One row per input row and model, without a shuffle."""
    pairs = [
        F.struct(F.lit(name).alias("model"), column.cast("double").alias("prediction"))
        for name, column in models.items()
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))


def accuracy(error: Column, mean_target: Column) -> Column:
    """100 - error as a percentage of the mean target, not below 0.

    A mean that is null or 0 counts as 1, an undefined result as 0.
    """
    base = F.coalesce(F.nullif(mean_target, F.lit(0.0)), F.lit(1.0))
    value = F.lit(100.0) - error / base * 100
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), value)
    )


def evaluate(predictions: DataFrame) -> DataFrame:
    """n, MAE, RMSE and accuracy of every (ticker, model), in one aggregate."""
    miss = F.col("target") - F.col("prediction")
    stats = predictions.groupBy("ticker", "model").agg(
        F.count("*").alias("n"),
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg("target").alias("mean_target"),
    )
    return stats.withColumn("accuracy", accuracy(F.col("mae"), F.col("mean_target")))


def format_metrics(metrics: DataFrame) -> DataFrame:
    """(ticker, model, accuracy as text), the form that is published."""
    return metrics.select("ticker", "model", format_percent(F.col("accuracy")).alias("accuracy"))


def parse_metrics(published: DataFrame) -> DataFrame:
    """Published text back to numbers."""
    return published.withColumn("accuracy", parse_percent(F.col("accuracy")))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the highest accuracy of each ticker; ties go by name."""
    rank = F.struct(F.col("accuracy"), F.col("model"))
    return metrics.groupBy("ticker").agg(
        F.max_by("model", rank).alias("model"), F.max("accuracy").alias("accuracy")
    )


def leaderboard(metrics: DataFrame, good_above: float = 90.0) -> DataFrame:
    """Flags for the best and the good models of each ticker."""
    best = F.max("accuracy").over(Window.partitionBy("ticker"))
    return metrics.select(
        "ticker",
        "model",
        "accuracy",
        (F.col("accuracy") == best).alias("is_best"),
        (F.col("accuracy") > good_above).alias("is_good"),
    )


def base_model_count(metrics: DataFrame) -> DataFrame:
    """How many models of each ticker are no ensembles."""
    is_base = ~F.col("model").endswith("Ensemble")
    return metrics.groupBy("ticker").agg(F.count_if(is_base).alias("base_models"))
