"""Star schema: ticker, date and session dimensions, price fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.dates import calendar_columns, date_id
from tickloom.operators.indicators import SERIES
from tickloom.operators.ordered import bar_bucket, block_window, into_blocks, own_rows, with_positions
from tickloom.schemas import DIM_MARKET_SESSION, DIM_TICKER, FACT_COLUMNS
from tickloom.session import measured

# Symbol, company, sector, exchange of known tickers.
KNOWN_TICKERS = [
    ("AAPL", "Apple Inc.", "Technology", "NASDAQ"),
    ("MSFT", "Microsoft Corporation", "Technology", "NASDAQ"),
    ("GOOGL", "Alphabet Inc.", "Technology", "NASDAQ"),
    ("AMZN", "Amazon.com Inc.", "Consumer Discretionary", "NASDAQ"),
    ("TSLA", "Tesla Inc.", "Consumer Discretionary", "NASDAQ"),
    ("META", "Meta Platforms Inc.", "Technology", "NASDAQ"),
    ("NVDA", "NVIDIA Corporation", "Technology", "NASDAQ"),
    ("JPM", "JPMorgan Chase & Co.", "Financials", "NYSE"),
    ("V", "Visa Inc.", "Financials", "NYSE"),
    ("JNJ", "Johnson & Johnson", "Healthcare", "NYSE"),
]

# Market sessions in Eastern Time.
MARKET_ZONE = "America/New_York"
MARKET_SESSIONS = [
    (1, "pre_market", "04:00", "09:30", "Pre-market trading session (ET)"),
    (2, "regular", "09:30", "16:00", "Regular trading session (ET)"),
    (3, "after_hours", "16:00", "20:00", "After-hours trading session (ET)"),
]


def dim_ticker(bars: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per symbol; ids follow symbol order.

    With ``existing``, its rows are kept as they are and new symbols get the next free ids.
    Symbols are cut into ranges of about equal size and numbered inside them, so no task sees all of them whatever they
    begin with.
    """
    spark = bars.sparkSession
    symbols = bars.select(F.col("ticker").alias("symbol")).filter("symbol is not null").distinct()
    base: Column = F.lit(0)
    if existing is not None:
        symbols = symbols.join(existing.select("symbol"), "symbol", "left_anti")
        base = F.coalesce(existing.agg(F.max("ticker_id")).scalar(), F.lit(0))
    known = spark.createDataFrame(KNOWN_TICKERS, "symbol string, company_name string, sector string, exchange string")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = measured(symbols.repartitionByRange(ranges, "symbol").withColumn("_range", F.spark_partition_id()), "symbols")
    ranked = with_positions(ranged, [], ["symbol"], F.col("_range"))
    fresh = ranked.join(F.broadcast(known), "symbol", "left").select(  # ten fixed rows
        (base + F.col("pos")).cast("int").alias("ticker_id"),
        "symbol",
        F.coalesce("company_name", F.concat("symbol", F.lit(" Corp."))).alias("company_name"),
        F.coalesce("sector", F.lit("Unknown")).alias("sector"),
        F.coalesce("exchange", F.lit("Unknown")).alias("exchange"),
    )
    if existing is None:
        return fresh
    return existing.select(*DIM_TICKER.fieldNames()).unionByName(fresh)


def dim_date(bars: DataFrame) -> DataFrame:
    """Every calendar day between the first and the last bar; trading days are marked."""
    days = bars.select(F.to_date("window_start").alias("date")).distinct()
    calendar = days.agg(F.min("date").alias("first"), F.max("date").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    trading = days.withColumn("_trading", F.lit(True))
    return calendar.join(trading, "date", "left").select(
        *calendar_columns(F.col("date")),
        F.coalesce("_trading", F.lit(False)).alias("is_trading_day"),
    )


def dim_market_session(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MARKET_SESSIONS, DIM_MARKET_SESSION)


def fact_prices(silver: DataFrame, tickers: DataFrame, interval: str = "1d") -> DataFrame:
    """Price fact at (ticker, date) grain with the next close as target.

    The dimension is joined without a hint: AQE broadcasts it while it is small and splits skewed
    partitions of the fact side when it is not.
    """
    bars = silver.filter(F.col("bar_interval") == interval)
    placed = with_positions(bars, SERIES, ["window_start"], bar_bucket())
    following = F.lead("close").over(block_window(SERIES))
    targeted = own_rows(into_blocks(placed, ahead=1).withColumn("target_next_close", following))
    keyed = targeted.join(
        tickers.select("ticker_id", F.col("symbol").alias("ticker")), "ticker", "left"
    ).withColumn("date_id", date_id(F.to_date("window_start")))
    return keyed.select(*[c for c in FACT_COLUMNS if c in keyed.columns])


def with_market_session(df: DataFrame, sessions: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Session in force at each row's Eastern clock time; NULL outside all sessions.

    A range condition against a dimension of three rows, sent to every task.
    """
    clock = F.date_format(F.from_utc_timestamp(F.col(time_col), MARKET_ZONE), "HH:mm")
    inside = (F.col("_clock") >= F.col("open_time")) & (F.col("_clock") < F.col("close_time"))
    return (
        df.withColumn("_clock", clock)
        .join(F.broadcast(sessions.select("session_id", "session_type", "open_time", "close_time")),
              inside, "left")
        .drop("_clock", "open_time", "close_time")
    )
