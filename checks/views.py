"""Input views derived from the given tables (definitions in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.dates import iso_utc
from tickloom.session import measured, use_utc

INGESTED = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def as_ticks(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.col("event_type").alias("ticker"),
        F.col("value").alias("price"),
        k.alias("volume"),
        F.unix_millis(ts).alias("timestamp_ms"),
        iso_utc(F.timestamp_millis(F.unix_millis(ts))).alias("timestamp"),
        F.array(F.pmod(k, F.lit(5)).cast("int")).alias("conditions"),
        F.lit("events").alias("source"),
        F.col("event_id").alias("seq"),
    )


def dirty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_defects(ticks(spark, sf_dir))


def with_defects(clean: DataFrame) -> DataFrame:
    """Ticks with one defect each on fixed event ids; the first matching rule wins."""
    e = F.col("seq")

    def hit(n: int):
        return F.pmod(e, F.lit(n)) == 0

    # Which event ids get which defect.
    rule = (
        F.when(hit(97), "null_price").when(hit(89), "negative_price").when(hit(83), "nan_price")
        .when(hit(79), "empty_ticker").when(hit(73), "null_ticker")
        .when(hit(71), "negative_volume").when(hit(67), "zero_time").otherwise("none")
    )
    price = (
        F.when(rule == "null_price", F.lit(None).cast("double"))
        .when(rule == "negative_price", -F.col("price"))
        .when(rule == "nan_price", F.lit(float("nan"))).otherwise(F.col("price"))
    )
    ticker = (
        F.when(rule == "empty_ticker", "").when(rule == "null_ticker", F.lit(None).cast("string"))
        .otherwise(F.col("ticker"))
    )
    return clean.withColumns({
        "price": price,
        "ticker": ticker,
        "volume": F.when(rule == "negative_volume", F.lit(-1)).otherwise(F.col("volume")),
        "timestamp_ms": F.when(rule == "zero_time", F.lit(0)).otherwise(F.col("timestamp_ms")),
    })


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily history rows of the event ticks: few long-lived tickers, one bar a day."""
    day = F.to_date(F.timestamp_millis("timestamp_ms"))
    return (
        ticks(spark, sf_dir).groupBy("ticker", day.cast("timestamp").alias("date"))
        .agg(
            F.min_by("price", "seq").alias("open"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.max_by("price", "seq").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .withColumns({"source": F.lit("events"), "ingested_at": F.lit(INGESTED)})
    )


def daily_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of line items by brand: the large history.

    The order of items is a struct, and an aggregate that keeps one sorts every row of a task.  So the bounds of a bar, of
    fixed width, are hashed first; open and close then come from the items of its first and last order only.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # a null order key comes first; it may tie with the smallest number, which the whole order then decides
    items = table(spark, sf_dir, "lineitem").withColumn("_order", F.coalesce(F.col("l_orderkey").cast("long"), F.lit(-2 ** 63)))
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    price = F.col("l_extendedprice") / F.col("l_quantity")

    def priced(some: DataFrame) -> DataFrame:
        return some.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
            F.upper("p_brand").alias("ticker"), F.col("l_shipdate").cast("timestamp").alias("date"),
            price.alias("price"), "l_quantity", "_order", order.alias("at"))

    bounds = measured(priced(items).groupBy("ticker", "date").agg(
        F.max("price").alias("high"), F.min("price").alias("low"), F.sum(F.col("l_quantity").cast("long")).alias("volume"),
        F.min("_order").alias("_first"), F.max("_order").alias("_last")), "bar-bounds")
    orders = measured(bounds.select(F.explode(F.array("_first", "_last")).alias("_order")).distinct(), "edge-orders")
    edges = priced(items.join(orders, "_order", "left_semi"))
    bars = bounds.select(F.col("ticker").alias("_ticker"), F.col("date").alias("_date"), "high", "low", "volume", "_first", "_last")
    # nulls in a key are one bar
    edges = edges.join(bars, F.col("ticker").eqNullSafe(F.col("_ticker")) & F.col("date").eqNullSafe(F.col("_date"))) \
        .filter("_order = _first or _order = _last")
    return (
        edges.groupBy("ticker", "date", "high", "low", "volume")
        .agg(F.min_by("price", "at").alias("open"), F.max_by("price", "at").alias("close"))
        .select("ticker", "date", "open", "high", "low", "close", "volume",
                F.lit("lineitem").alias("source"), F.lit(INGESTED).alias("ingested_at"))
    )


def as_bars(history: DataFrame, interval: str = "1d") -> DataFrame:
    """History rows as landed bars with fixed metadata."""
    return history.select(
        "ticker", F.col("date").alias("window_start"),
        F.date_add(F.to_date("date"), 1).cast("timestamp").alias("window_end"),
        "open", "high", "low", "close", "volume",
        F.lit(None).cast("double").alias("vwap"), F.lit(None).cast("long").alias("trade_count"),
        F.lit(interval).alias("bar_interval"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        F.lit("history").alias("source_api"), F.lit("batch-0").alias("batch_id"),
        F.to_date("date").alias("date"),
    )


def feed_line(rows: DataFrame) -> DataFrame:
    """Feed messages of up to four trades each, with heartbeats and broken lines in between.

    ``value`` is the message text.  Numbers are written the same way by Spark and SQL.
    """
    trade = F.concat(
        F.lit('{"s":'), F.coalesce(F.concat(F.lit('"'), F.col("ticker"), F.lit('"')), F.lit("null")),
        F.lit(',"p":'), F.coalesce(F.when(~F.isnan("price"), F.col("price")).cast("string"), F.lit("null")),
        F.lit(',"v":'), F.col("volume").cast("string"),
        F.lit(',"t":'), F.col("timestamp_ms").cast("string"),
        F.lit(',"c":['), F.pmod("volume", F.lit(5)).cast("string"), F.lit("]}"),
    )
    group = F.expr("seq div 4").alias("line")
    items = F.array_sort(F.collect_list(F.struct("seq", trade.alias("trade"))))
    data = F.array_join(F.transform(items, lambda i: i["trade"]), ",")
    trades = rows.groupBy(group).agg(
        F.concat(F.lit('{"type":"trade","data":['), data, F.lit("]}")).alias("value"))
    pings = rows.filter("seq % 50 = 0").select(
        F.expr("seq div 4").alias("line"), F.lit('{"type":"ping"}').alias("value"))
    broken = rows.filter("seq % 101 = 0").select(
        F.expr("seq div 4").alias("line"), F.lit("{bad").alias("value"))
    return trades.unionByName(pings).unionByName(broken)


def daily_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-item history with defects on fixed days of the month."""
    day = F.dayofmonth("date")
    # Which days get which defect.
    return daily_li(spark, sf_dir).withColumns({
        "open": F.when(day == 3, F.lit(None).cast("double")).when(day == 5, 0.0).otherwise(F.col("open")),
        "high": F.when(day == 9, F.col("low") - 1).otherwise(F.col("high")),
        "volume": F.when(day == 13, F.lit(-1)).when(day == 17, F.lit(None).cast("long"))
                  .otherwise(F.col("volume")),
        "ticker": F.when(day == 21, "").otherwise(F.col("ticker")),
    })
