"""Training job: fact -> split -> scale -> forecasters -> comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.dates import date_of_id
from tickloom.operators.clean import latest_per_key
from tickloom.operators.forecast import (
    TREE_SETTINGS, ar_forecast, feature_importance, fit_ar, fit_trees, naive_forecast,
    tree_forecast, with_differences,
)
from tickloom.operators.metrics import comparison_table, forecast_metrics, run_log
from tickloom.operators.mlprep import load_training_rows, scale_features, time_split
from tickloom.operators.serving import prediction_rows
from tickloom.schemas import TARGET
from tickloom.session import cut_lineage


@dataclass
class TrainingResult:
    forecasts: DataFrame
    metrics: DataFrame
    comparison: DataFrame
    importance: DataFrame
    log: DataFrame


def as_scored(rows: DataFrame, model: str, target: str = TARGET) -> DataFrame:
    return rows.select("ticker_id", "date_id", F.lit(model).alias("model"),
                       F.col(target).alias("actual"), "predicted",
                       F.col("close").alias("current_close"))


def prepare(fact: DataFrame) -> DataFrame:
    """Training rows with close differences and split label, stored once for all models."""
    return cut_lineage(time_split(with_differences(load_training_rows(fact))), "training-rows")


def train_and_compare(fact: DataFrame, run_id: str, **tree_settings) -> TrainingResult:
    """Fit on the training rows, score every model on the same test rows."""
    rows = prepare(fact)
    test = rows.filter("split = 'test'")
    phi = fit_ar(rows.filter("split = 'train'"))
    scaled = cut_lineage(scale_features(rows, with_close=True), "scaled-rows")
    model = fit_trees(scaled, **tree_settings)
    trees = tree_forecast(model, scaled.filter("split = 'test'"))
    forecasts = (
        as_scored(naive_forecast(test), "naive")
        .unionByName(as_scored(ar_forecast(test, phi), "ar"))
        .unionByName(as_scored(trees, "trees"))
    )
    forecasts = cut_lineage(forecasts, "forecasts")
    metrics = forecast_metrics(forecasts)
    settings = {"ar": {"order": 5, "differences": 1}, "trees": {**TREE_SETTINGS, **tree_settings}}
    return TrainingResult(
        forecasts, metrics, comparison_table(metrics), feature_importance(model, scaled),
        run_log(metrics, run_id, settings),
    )


def predict_next_close(fact: DataFrame, tickers: DataFrame) -> DataFrame:
    """Service answer per ticker: refit on all rows, forecast from the latest one."""
    rows = cut_lineage(with_differences(fact), "all-rows")
    latest = latest_per_key(rows, ["ticker_id"], ["date_id"])
    answers = ar_forecast(latest, fit_ar(rows)).join(
        tickers.select("ticker_id", F.col("symbol").alias("ticker")), "ticker_id")
    made = answers.select("ticker", date_of_id(F.col("date_id")).cast("timestamp").alias("predicted_at"),
                          "predicted", F.col("close").alias("current_close"))
    return prediction_rows(made, "ar")


def write_comparison(comparison: DataFrame, path: str) -> None:
    comparison.write.mode("overwrite").option("header", True).csv(path)
