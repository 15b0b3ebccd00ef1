"""Trade feed: Kafka source and sink, message parsing, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.dates import iso_utc
from tickloom.schemas import ENVELOPE, TICK_WIRE

def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", fail_on_data_loss: bool = True,
) -> DataFrame:
    """Streaming Kafka source (needs the spark-sql-kafka package on the cluster).

    Offsets that the topic no longer holds stop the query, unless ``fail_on_data_loss`` is false.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def parse_ticks(records: DataFrame) -> DataFrame:
    """Kafka records -> ticks.  A value that does not parse gives a row of nulls, not a lost row.

    ``offset`` becomes the tie-break ``seq``: messages are keyed by ticker, so the offsets of one
    ticker are in publish order.
    """
    trade = F.from_json(F.col("value").cast("string"), TICK_WIRE, {"mode": "PERMISSIVE"})
    return (
        records.select(
            F.col("key").cast("string").alias("kafka_key"),
            trade.alias("trade"),
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("offset").alias("seq"),
        )
        .select("kafka_key", "kafka_timestamp", "trade.*", "seq")
        .withColumn("volume", F.col("volume").try_cast("long"))
    )


#: A trade element.  Number fields refuse JSON strings; the symbol is read untyped because a text
#: field would accept any JSON value.
_TRADE = "s variant, p double, v double, t double, c array<string>"
_LONG_LIMIT = float(2 ** 63)


def feed_trades(lines: DataFrame) -> DataFrame:
    """Feed messages (column ``value``) -> one row per trade element, valid or not.

    Heartbeats and other message types give no row.  A trade message whose ``data`` is no array gives one row that is
    not valid, with the whole message.  Condition codes may be numbers or strings of digits.  The element text is kept for dead letters;
    ``valid`` asks for a non-empty string symbol and JSON numbers in range, as the feed promises.
    """
    message = F.from_json("value", ENVELOPE)
    rest = [c for c in lines.columns if c != "value"]
    fields = F.from_json("trade", _TRADE, {"allowNonNumericNumbers": "false"})
    elements = (
        lines.select(*rest, "value", message.alias("message"))
        .filter(F.col("message.type") == "trade")
        .select(*rest, F.posexplode(F.coalesce("message.data", F.array("value"))).alias("element", "trade"))
        .select(*rest, "element", "trade", fields.alias("_trade"))
        .select(*rest, "element", "trade", "_trade.*")
    )
    valid = (
        (F.schema_of_variant("s") == "STRING")
        & (F.length(F.try_variant_get("s", "$", "string")) > 0)
        & (F.col("p") > 0) & (F.col("p") < float("inf"))
        & (F.col("v") >= 0) & (F.col("v") < _LONG_LIMIT)
        & (F.col("t") > 0) & (F.col("t") < _LONG_LIMIT)
    )
    return elements.withColumn("valid", F.coalesce(valid, F.lit(False))) \
        .withColumn("s", F.try_variant_get("s", "$", "string"))


def unwrap_feed(lines: DataFrame, source: str = "feed_ws") -> DataFrame:
    """Feed messages -> valid ticks."""
    rest = [c for c in lines.columns if c != "value"]
    millis = F.col("t").cast("long")
    return feed_trades(lines).filter("valid").select(
        *rest, "element",
        F.col("s").alias("ticker"),
        F.col("p").alias("price"),
        F.col("v").cast("long").alias("volume"),
        millis.alias("timestamp_ms"),
        iso_utc(F.timestamp_millis(millis)).alias("timestamp"),
        F.coalesce(F.filter(F.transform("c", lambda x: x.try_cast("int")), lambda x: x.isNotNull()), F.array().cast("array<int>")).alias("conditions"),
        F.lit(source).alias("source"),
    )


def dead_letter(message: Column, reason: str, ticker: Column, limit: int | None = None) -> list[Column]:
    """The whole message, so that it can be replayed, or its first ``limit`` characters for a topic that asks for it."""
    return [
        (F.substring(message, 1, limit) if limit else message).alias("original_message"),
        F.lit(reason).alias("error_reason"),
        iso_utc(F.current_timestamp()).alias("timestamp"),
        ticker.cast("string").alias("ticker"),
    ]


def feed_dead_letters(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """Messages that are not JSON, and trade elements that fail the check."""
    broken = lines.filter(F.col("value").isNotNull() & F.try_parse_json("value").isNull())
    rejected = feed_trades(lines).filter("not valid")
    nobody = F.lit(None)
    return broken.select(
        *dead_letter(F.col("value"), "invalid_json", nobody, limit)
    ).unionByName(rejected.select(
        *dead_letter(F.col("trade"), "validation_failed", F.col("s"), limit)
    ))


def feed_counts(lines: DataFrame) -> DataFrame:
    """Messages read, broken messages, trades published and trades rejected."""
    messages = lines.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("value").isNotNull() & F.try_parse_json("value").isNull()).alias("invalid_json"),
    )
    trades = feed_trades(lines).agg(
        F.count_if("valid").alias("published"), F.count_if(~F.col("valid")).alias("rejected"))
    return messages.select(
        "messages", "invalid_json",
        trades.select("published").scalar().alias("published"),
        trades.select("rejected").scalar().alias("rejected"),
    )


def tick_dead_letters(rejected: DataFrame, limit: int | None = None) -> DataFrame:
    """Rejected ticks as dead letters."""
    fields = [f for f in TICK_WIRE.fieldNames() if f in rejected.columns]
    text = F.to_json(F.struct(*fields))
    return rejected.select(
        *dead_letter(text, "validation_failed", F.col("ticker"), limit)
    )


def publish_payload(ticks: DataFrame) -> DataFrame:
    """Key and JSON value of each published tick; the key keeps a ticker on one partition."""
    return ticks.select(
        F.col("ticker").alias("key"),
        F.to_json(F.struct(*TICK_WIRE.fieldNames())).alias("value"),
    )


def letter_payload(letters: DataFrame) -> DataFrame:
    """Dead letters as keyed messages for their topic."""
    return letters.select(F.col("ticker").alias("key"), F.to_json(F.struct(*letters.columns)).alias("value"))


def publish(payload: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) rows, of ticks or of dead letters."""
    payload.write.format("kafka") \
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_stream(
    payload: DataFrame, servers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    return (
        payload.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


def preview(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records with partition, offset, key and text."""
    return records.select(
        "partition", "offset", F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    ).orderBy("partition", "offset").limit(n)
