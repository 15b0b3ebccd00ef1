"""Schemas of the tables that jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

TICK = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("timestamp_ms", T.LongType(), False),
    T.StructField("timestamp", T.StringType()),
    T.StructField("conditions", T.ArrayType(T.IntegerType())),
    T.StructField("source", T.StringType()),
])

#: What a tick looks like on the wire.  Volume is read as a double (feeds send ``1.5`` or
#: ``100.0``) and truncated after parsing, so such rows are kept.
TICK_WIRE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("timestamp_ms", T.LongType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("conditions", T.ArrayType(T.IntegerType())),
    T.StructField("source", T.StringType()),
])

#: Outer shape of a feed message; the trades stay as JSON text until each one is checked.
ENVELOPE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(T.StringType())),
])

DAILY_HISTORY = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("date", T.TimestampType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("source", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])

BAR = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
])

#: ``bar_interval`` keeps minute and daily bars of one ticker apart in the shared table.
BRONZE = T.StructType(BAR.fields + [
    T.StructField("bar_interval", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("source_api", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("date", T.DateType()),
])

# Indicator columns in table order.
INDICATORS = [
    "daily_return_pct", "sma_7", "sma_30", "ema_12", "ema_26",
    "macd", "macd_signal", "macd_histogram", "rsi_14",
    "bb_middle", "bb_upper", "bb_lower", "volatility_7d", "volume_zscore",
]

SILVER = T.StructType(
    BRONZE.fields
    + [T.StructField("is_outlier", T.BooleanType())]
    + [T.StructField(name, T.DoubleType()) for name in INDICATORS]
)

QUALITY_REPORT = T.StructType([
    T.StructField("rule", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("pass", T.BooleanType()),
    T.StructField("violations", T.LongType()),
    T.StructField("total_rows", T.LongType()),
])

DIM_TICKER = T.StructType([
    T.StructField("ticker_id", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("company_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("exchange", T.StringType()),
])

DIM_MARKET_SESSION = T.StructType([
    T.StructField("session_id", T.IntegerType(), False),
    T.StructField("session_type", T.StringType(), False),
    T.StructField("open_time", T.StringType(), False),
    T.StructField("close_time", T.StringType(), False),
    T.StructField("description", T.StringType()),
])

# Fact columns in table order.
FACT_COLUMNS = [
    "ticker_id", "date_id", "open", "high", "low", "close", "volume", "vwap",
    "sma_7", "sma_30", "ema_12", "ema_26", "rsi_14", "macd", "macd_signal", "macd_histogram",
    "bb_upper", "bb_middle", "bb_lower", "daily_return_pct", "volatility_7d", "volume_zscore",
    "is_outlier", "target_next_close",
]

# The 19 model inputs and the target.
FEATURES = [
    "open", "high", "low", "close", "volume",
    "sma_7", "sma_30", "ema_12", "ema_26", "rsi_14",
    "macd", "macd_signal", "macd_histogram", "bb_upper", "bb_middle", "bb_lower",
    "daily_return_pct", "volatility_7d", "volume_zscore",
]
TARGET = "target_next_close"

PREDICTIONS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("predicted_at", T.TimestampType()),
    T.StructField("predicted_close", T.DoubleType()),
    T.StructField("predicted_direction", T.StringType()),
    T.StructField("model_used", T.StringType()),
    T.StructField("actual_close", T.DoubleType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("original_message", T.StringType()),
    T.StructField("error_reason", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("ticker", T.StringType()),
])
