"""Next-close forecasters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.ordered import block_window, into_blocks, own_rows, with_positions
from tickloom.schemas import FEATURES, TARGET
from tickloom.session import measured

AR_ORDER = 5

# Boosted-tree settings.
TREE_SETTINGS = {
    "maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42,
}


def naive_forecast(rows: DataFrame) -> DataFrame:
    """Tomorrow's close is today's."""
    return rows.withColumn("predicted", F.col("close"))


def with_differences(rows: DataFrame, order: int = AR_ORDER) -> DataFrame:
    """Add ``d1..d<order>``: the latest daily changes of the close, newest first."""
    placed = with_positions(rows, ["ticker_id"], ["date_id"], F.expr("date_id div 10000"))
    over = block_window(["ticker_id"])
    closes = [F.col("close"), *[F.lag("close", i).over(over) for i in range(1, order + 1)]]
    lags = {f"d{i + 1}": closes[i] - closes[i + 1] for i in range(order)}
    return own_rows(into_blocks(placed, back=order).withColumns(lags), "pos", "series_rows")


def fit_ar(train: DataFrame, order: int = AR_ORDER) -> DataFrame:
    """Least-squares AR coefficients of the differenced close, one row per ticker.

    Input has ``d1..d<order>``, the close and the target.  Spark sums the products of the normal
    equations (partial aggregation, so a ticker of any length shuffles 20 numbers per task); only
    the ``order x order`` systems are solved in Python, many tickers per Arrow batch.
    """
    xs = [F.col(f"d{i}") for i in range(1, order + 1)]
    y = F.col(TARGET) - F.col("close")
    known = train.filter(F.col(f"d{order}").isNotNull() & y.isNotNull())
    gram = [F.sum(xs[i] * xs[j]) for i in range(order) for j in range(order)]
    moment = [F.sum(x * y) for x in xs]
    sums = known.groupBy("ticker_id").agg(F.array(*gram).alias("gram"), F.array(*moment).alias("moment"))

    @F.pandas_udf("array<double>")
    def solve(gram: pd.Series, moment: pd.Series) -> pd.Series:
        left = np.stack(gram.to_list()).reshape(-1, order, order)
        right = np.stack(moment.to_list())
        return pd.Series([np.linalg.lstsq(a, b, rcond=None)[0].tolist() for a, b in zip(left, right)])

    return sums.select("ticker_id", solve("gram", "moment").alias("phi"))


def ar_forecast(rows: DataFrame, coefficients: DataFrame, order: int = AR_ORDER) -> DataFrame:
    """One-step forecast from the closes known so far; the last close where there is no model."""
    step = sum((F.col("phi")[i] * F.col(f"d{i + 1}") for i in range(order)), F.lit(0.0))
    return (
        rows.join(measured(coefficients, "ar-coefficients"), "ticker_id", "left")
        .withColumn("predicted", F.coalesce(F.col("close") + step, F.col("close")))
        .drop("phi", *[f"d{i}" for i in range(1, order + 1)])
    )


def fit_trees(scaled: DataFrame, features: Sequence[str] = FEATURES, **settings) -> PipelineModel:
    """Boosted trees on train and validation rows, stopping when validation stops improving.

    ``scaled`` has ``raw_close`` and ``close_unit``.  The label is the change of the close in units of the ticker's
    own deviation, so one model serves tickers of any price level.
    """
    rows = scaled.filter("split in ('train', 'validation')") \
        .withColumn("_change", (F.col(TARGET) - F.col("raw_close")) / F.col("close_unit")) \
        .withColumn("_validation", F.col("split") == "validation")
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTRegressor(
        featuresCol="features", labelCol="_change", predictionCol="predicted",
        validationIndicatorCol="_validation", **{**TREE_SETTINGS, **settings},
    )
    return Pipeline(stages=[assembler, trees]).fit(rows)


def tree_forecast(model: PipelineModel, scaled: DataFrame) -> DataFrame:
    """Forecasts in money; ``close`` is the close in money again, the other features stay scaled."""
    money = F.col("raw_close") + F.col("predicted") * F.col("close_unit")
    return model.transform(scaled).drop("features").withColumns({"predicted": money, "close": F.col("raw_close")}) \
        .drop("raw_close", "close_unit")


def feature_importance(model: PipelineModel, scaled: DataFrame, top: int = 15,
                       features: Sequence[str] = FEATURES) -> DataFrame:
    """The most important features of a fitted model (19 numbers, known to the driver)."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = scaled.sparkSession.createDataFrame(
        list(zip(features, weights)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)
