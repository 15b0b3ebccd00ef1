"""Queries behind the history service and the dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import ratio, rnd
from tickloom.operators.asof import DAY_US, asof_join
from tickloom.operators.indicators import partial_sma
from tickloom.schemas import PREDICTIONS

# RSI guide lines.
OVERBOUGHT, OVERSOLD = 70, 30


def history(fact: DataFrame, tickers: DataFrame, ticker: str, days: int = 30) -> DataFrame:
    """The last ``days`` trading days of a ticker, oldest first, rounded to cents."""
    if days < 1:
        raise ValueError("days must be positive")
    # a symbol has one id: as a literal it reaches the scan of the fact, whose files are in the order of the ids
    wanted = [r["ticker_id"] for r in tickers.filter(F.col("symbol") == ticker.upper()).select("ticker_id").distinct().collect()]
    prices = ["open", "high", "low", "close"]
    recent = (
        fact.filter(F.col("ticker_id").isin(wanted))
        .select("date_id", *prices, "volume", "sma_7", "sma_30", "rsi_14")
        .orderBy(F.desc("date_id")).limit(days)
    )
    return recent.select(
        "date_id", *[rnd(F.col(c), 2).alias(c) for c in prices], "volume",
        *[rnd(F.col(c), 2).alias(c) for c in ("sma_7", "sma_30", "rsi_14")],
    ).orderBy("date_id")


def star(fact: DataFrame, dates: DataFrame, tickers: DataFrame, ticker: str | None = None) -> DataFrame:
    """Fact with its date and symbol, for one ticker or all.

    The dimensions carry no hint: Spark broadcasts them by measured size.
    """
    symbols = tickers.select("ticker_id", "symbol")
    if ticker:
        symbols = symbols.filter(F.col("symbol") == ticker)
    return fact.join(dates.select("date_id", "date"), "date_id").join(symbols, "ticker_id")


def close_with_averages(star_rows: DataFrame) -> DataFrame:
    return star_rows.select("symbol", "date", "close", "sma_7", "sma_30").orderBy("symbol", "date")


def daily_volume(star_rows: DataFrame) -> DataFrame:
    return star_rows.select("symbol", "date", "volume").orderBy("symbol", "date")


def rsi_zones(star_rows: DataFrame) -> DataFrame:
    return star_rows.select(
        "symbol", "date", "rsi_14",
        F.lit(OVERBOUGHT).alias("overbought"), F.lit(OVERSOLD).alias("oversold"),
    ).orderBy("symbol", "date")


def prediction_history(predictions: DataFrame, ticker: str | None = None) -> DataFrame:
    rows = predictions.filter(F.col("ticker") == ticker) if ticker else predictions
    return rows.orderBy("ticker", "predicted_at").select(
        "ticker", F.to_date("predicted_at").alias("date"),
        "predicted_close", "actual_close", "predicted_direction",
    )


def weekly_accuracy(predictions: DataFrame) -> DataFrame:
    """Share of predictions per week whose actual close lies beyond the predicted one in the
    predicted direction."""
    up = (F.col("predicted_direction") == "UP") & (F.col("actual_close") > F.col("predicted_close"))
    down = (F.col("predicted_direction") == "DOWN") & (F.col("actual_close") < F.col("predicted_close"))
    share = 100.0 * F.count_if(up | down) / F.count(F.lit(1))
    return (
        predictions.filter("actual_close is not null")
        .groupBy(F.date_trunc("week", "predicted_at").alias("week"))
        .agg(rnd(share, 1).alias("accuracy_pct"))
        .orderBy("week")
    )


def last_minutes(bars: DataFrame, ticker: str, minutes: int = 60, now: Column | None = None) -> DataFrame:
    """Bars of the last ``minutes``; ``now`` defaults to the wall clock."""
    now = F.current_timestamp() if now is None else now
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    return (
        bars.filter((F.col("ticker") == ticker) & (F.col("window_start") >= since))
        .select("window_start", "open", "high", "low", "close", "volume")
        .orderBy("window_start")
    )


def vwap_with_sma10(bars: DataFrame, day: Column | None = None, ticker: str | None = None) -> DataFrame:
    """Close, VWAP and the 10-bar average of one day; the average starts anew with the day."""
    day = F.current_date() if day is None else day
    rows = bars.filter(F.to_date("window_start") == day)
    if ticker:
        rows = rows.filter(F.col("ticker") == ticker)
    return partial_sma(rows).select("ticker", "window_start", "close", "vwap", "sma_10") \
        .orderBy("ticker", "window_start")


def latest_bars(bars: DataFrame, n: int = 10) -> DataFrame:
    return bars.select("ticker", "window_start", "close", "volume") \
        .orderBy(F.desc("window_start"), "ticker").limit(n)


def latest_close(fact: DataFrame) -> DataFrame:
    return fact.groupBy("ticker_id").agg(
        F.max("date_id").alias("date_id"), F.max_by("close", "date_id").alias("close")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, df in tables.items()
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged


def prediction_rows(forecast: DataFrame, model: str) -> DataFrame:
    """Service answers: change in percent and direction; an unchanged price counts as DOWN."""
    predicted, current = F.col("predicted"), F.col("current_close")
    return forecast.select(
        "ticker", "predicted_at",
        rnd(predicted, 2).alias("predicted_close"),
        rnd(current, 2).alias("current_close"),
        rnd(ratio(predicted - current, current) * 100, 4).alias("predicted_change_pct"),
        F.when(predicted > current, "UP").otherwise("DOWN").alias("predicted_direction"),
        F.lit(model).alias("model_used"),
    )


def prediction_log(answers: DataFrame) -> DataFrame:
    """Rows for the append-only predictions table; the actual close comes later."""
    return answers.withColumn("actual_close", F.lit(None).cast("double")) \
        .select(*PREDICTIONS.fieldNames())


def fill_actuals(predictions: DataFrame, closes: DataFrame) -> DataFrame:
    """Fill ``actual_close`` with the close of the first trading day after the prediction's date.

    ``closes`` has one row per (ticker, date).  A gap in the trading days, however long, adds no rows.
    """
    days = predictions.withColumn("_day", F.to_date("predicted_at"))
    found = asof_join(days, closes.select("ticker", "date", F.col("close").alias("_next")), ["ticker"], "_day", "date", ["_next"],
                      forward=True, exact=False, bucket_us=366 * DAY_US)
    return found.withColumn("actual_close", F.coalesce("actual_close", "_next")).select(*predictions.columns)
