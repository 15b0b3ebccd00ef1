"""Scoring of forecasts.

Input is long: ``model, actual, predicted, current_close``.  A NULL or NaN prediction is not
scored; ``n_scored`` shows how many rows each model was scored on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import measured

TRADING_DAYS = 252

# Headings of the comparison table.
HEADINGS = {
    "mae": "MAE", "rmse": "RMSE", "mape_pct": "MAPE (%)",
    "dir_accuracy_pct": "Dir. Accuracy (%)", "sharpe": "Sharpe Ratio",
}


def scored_rows(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter(F.col("predicted").isNotNull() & ~F.isnan("predicted"))


def on_common_rows(forecasts: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """Only rows that every model predicted, so that all models are scored on the same ones."""
    models = forecasts.select("model").distinct().agg(F.count(F.lit(1))).scalar()
    complete = (
        scored_rows(forecasts).groupBy(*row_key)
        .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == models).select(*row_key)
    )
    return forecasts.join(complete, list(row_key), "left_semi")


def forecast_metrics(forecasts: DataFrame, risk_free_rate: float = 0.0, annualise: bool = True) -> DataFrame:
    """Five metrics per model in one aggregation."""
    actual, predicted, current = F.col("actual"), F.col("predicted"), F.col("current_close")
    error = actual - predicted
    # long, short or flat on the predicted move; today's return is earned with that sign
    earned = F.when(current != 0, F.signum(predicted - current) * (actual - current) / current)
    excess = earned - risk_free_rate / TRADING_DAYS
    spread = F.stddev_pop(earned)
    scale = TRADING_DAYS ** 0.5 if annualise else 1.0
    hit = F.signum(actual - current) == F.signum(predicted - current)
    return scored_rows(forecasts).groupBy("model").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (100 * F.avg(F.when(actual != 0, F.abs(error / actual)))).alias("mape_pct"),
        (100.0 * F.count_if(hit) / F.count(F.lit(1))).alias("dir_accuracy_pct"),
        F.coalesce(F.when(spread > 0, F.avg(excess) / spread * scale), F.lit(0.0)).alias("sharpe"),
        F.count(F.lit(1)).alias("n_scored"),
    )


def comparison_table(metrics: DataFrame) -> DataFrame:
    """Model x metric table under its published headings."""
    return metrics.select("model", *[F.col(k).alias(v) for k, v in HEADINGS.items()])


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the least absolute error, and the leader on each metric."""
    def leader(metric: str, low: bool) -> Column:
        order = F.struct(F.col(metric) if low else -F.col(metric), "model")
        return F.min_by("model", order)

    return metrics.agg(
        leader("mae", True).alias("best"),
        F.min("mae").alias("best_mae"),
        leader("rmse", True).alias("best_rmse_model"),
        leader("mape_pct", True).alias("best_mape_model"),
        leader("dir_accuracy_pct", False).alias("best_dir_accuracy_model"),
        leader("sharpe", False).alias("best_sharpe_model"),
    )


def run_log(metrics: DataFrame, run_id: str, params: dict[str, dict[str, object]]) -> DataFrame:
    """Parameters and metrics of a run as (run, model, kind, key, value) rows to append."""
    spark = metrics.sparkSession
    names = [*HEADINGS, "n_scored"]
    values = metrics.select(
        F.lit(run_id).alias("run_id"), "model", F.lit("metric").alias("kind"),
        F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))]))
        .alias("key", "value"),
    )
    settings = [(run_id, m, "param", k, str(v)) for m, kv in params.items() for k, v in kv.items()]
    schema = "run_id string, model string, kind string, key string, value string"
    return values.unionByName(spark.createDataFrame(settings, schema))


def residual_stats(forecasts: DataFrame) -> DataFrame:
    residual = F.col("actual") - F.col("predicted")
    return scored_rows(forecasts).groupBy("model").agg(
        F.avg(residual).alias("mean_residual"), F.stddev_pop(residual).alias("std_residual"),
        F.min(residual).alias("low"), F.max(residual).alias("high"),
    )


def residual_histogram(forecasts: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width bins between least and largest residual per model; the last bin is closed."""
    residual = F.col("actual") - F.col("predicted")
    bounds = measured(residual_stats(forecasts).select("model", "low", "high"), "residual-bounds")
    width = (F.col("high") - F.col("low")) / bins
    slot = F.when(width > 0, F.least(F.floor((residual - F.col("low")) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(bins // 2))
    return (
        scored_rows(forecasts).join(bounds, "model")
        .groupBy("model", slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def forecast_overlay(wide: DataFrame, models: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One column per model -> long rows of the predictions that exist."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("predicted")) for m in models])
    return wide.select(*keep, F.inline(pairs)).filter(
        F.col("predicted").isNotNull() & ~F.isnan("predicted"))
