"""Ticks -> OHLCV bars, the same code for batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import exact_sum, rnd

MINUTE_MS = 60_000
DAY_MS = 86_400_000


def with_event_time(ticks: DataFrame) -> DataFrame:
    """Event time from epoch milliseconds, without a detour through doubles."""
    return ticks.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def _arrival_order(window_ms: int) -> Column:
    """(time in window, sequence number) packed into one long.

    ``min_by`` over a struct would turn the whole tick aggregation into a sort aggregate; a long
    keeps it a hash aggregate.  Minute windows leave 47 bits for the sequence number; a number
    that does not fit fails the job rather than picking a wrong open or close.
    """
    seq_bits = 63 - (window_ms - 1).bit_length()
    fits = (F.col("seq") >= 0) & (F.col("seq") < F.lit(1 << seq_bits))
    packed = F.shiftleft(F.pmod(F.col("timestamp_ms"), F.lit(window_ms)), seq_bits) + F.col("seq")
    return F.when(fits, packed).otherwise(
        F.raise_error(F.lit(f"tick sequence number needs more than {seq_bits} bits"))
    )


def _bar_columns() -> list[Column]:
    total = F.col("_volume")
    vwap = F.when(total > 0, F.try_divide(F.col("_pv"), total)).otherwise(F.col("_avg_price"))
    return [
        F.col("ticker"),
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "open", "high", "low", "close",
        total.alias("volume"),
        rnd(vwap, 4).alias("vwap"),
        "trade_count",
    ]


def ohlcv_bars(ticks: DataFrame, window_ms: int = MINUTE_MS) -> DataFrame:
    """Tumbling event-time bars per ticker.

    Open and close follow (timestamp_ms, seq), not arrival.  All buffers are fixed-width, so ticks
    are folded map-side by a hash aggregate and a hot ticker or minute shuffles one row per task.
    """
    if "event_time" not in ticks.columns:
        ticks = with_event_time(ticks)
    at = _arrival_order(window_ms)
    notional = F.col("price") * F.col("volume")
    return (
        ticks.groupBy("ticker", F.window("event_time", f"{window_ms} milliseconds"))
        .agg(
            F.min_by("price", at).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", at).alias("close"),
            F.sum("volume").alias("_volume"),
            exact_sum(notional).alias("_pv"),
            (exact_sum(F.col("price")) / F.count("price")).alias("_avg_price"),
            F.count(F.lit(1)).alias("trade_count"),
        )
        .select(*_bar_columns())
    )


def roll_up(bars: DataFrame, window: str = "1 day") -> DataFrame:
    """Longer bars from shorter ones; VWAP is weighted by volume, falling back to trade count."""
    weighted = exact_sum(F.col("vwap") * F.col("volume"))
    by_trades = exact_sum(F.col("vwap") * F.col("trade_count"))
    volume = F.sum("volume")
    return (
        bars.groupBy("ticker", F.window("window_start", window))
        .agg(
            F.min_by("open", "window_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "window_start").alias("close"),
            volume.alias("_volume"),
            F.when(volume > 0, F.try_divide(weighted, volume))
            .otherwise(F.try_divide(by_trades, F.sum("trade_count"))).alias("_vwap"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select(
            "ticker",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "open", "high", "low", "close",
            F.col("_volume").alias("volume"),
            rnd(F.col("_vwap"), 4).alias("vwap"),
            "trade_count",
        )
    )


def with_ingest_metadata(
    bars: DataFrame, source_api: str, batch_id: str, bar_interval: str, time_col: str = "window_start"
) -> DataFrame:
    """Columns every landed row carries, and the partition date."""
    return bars.withColumns({
        "bar_interval": F.lit(bar_interval),
        "ingested_at": F.current_timestamp(),
        "source_api": F.lit(source_api),
        "batch_id": F.lit(batch_id),
        "date": F.to_date(time_col),
    })


def align_daily(history: DataFrame) -> DataFrame:
    """Daily history in bar shape: a one-day window, no VWAP and no trade count.

    The window ends at the midnight after the date, even when the start is not at midnight.
    """
    return history.select(
        "ticker",
        F.col("date").try_cast("timestamp").alias("window_start"),
        F.date_add(F.to_date("date"), 1).cast("timestamp").alias("window_end"),
        *[F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").try_cast("long").alias("volume"),
        F.lit(None).cast("double").alias("vwap"),
        F.lit(None).cast("long").alias("trade_count"),
    )


def merge_paths(parts: Sequence[DataFrame]) -> DataFrame:
    """Bars of the batch and the streaming path in one table, told apart by ``bar_interval``."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def candles(bars: DataFrame) -> DataFrame:
    """Candlestick geometry: direction, body and wick."""
    return bars.select(
        "ticker", "window_start", "open", "high", "low", "close",
        (F.col("close") >= F.col("open")).alias("is_up"),
        F.least("open", "close").alias("body_bottom"),
        rnd(F.abs(F.col("close") - F.col("open")), 4).alias("body_height"),
    )
