"""Structured Streaming jobs: bars to the lake, bars to an upsert target, rejects to dead letters.

The operators are the batch ones; only watermark, trigger and sinks live here.
"""

from __future__ import annotations

import logging
import zlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import MINUTE_MS, ohlcv_bars, with_event_time, with_ingest_metadata
from tickloom.operators.upsert import upsert_partitions, with_retry
from tickloom.operators.validate import split_ticks
from tickloom.sources.changes import append_changes
from tickloom.sources.feed import tick_dead_letters
from tickloom.sources.lake import PARTITIONS
from tickloom.sources.release import PARTS

log = logging.getLogger(__name__)

# Lateness bound and trigger interval.
WATERMARK = "5 minutes"
TRIGGER = {"processingTime": "1 minute"}
STREAM_KEY = ("ticker", "window_start")


def _name(kind: str, checkpoint: str) -> str:
    """Query names are unique per session; the checkpoint tells two runs of a kind apart."""
    return f"{kind}_{zlib.crc32(checkpoint.encode()):08x}"


def live_bars(ticks: DataFrame, watermark: str = WATERMARK, window_ms: int = MINUTE_MS) -> DataFrame:
    """Streaming bars of the valid ticks.

    Rows more than ``watermark`` behind the newest event are dropped; Spark counts them in the
    query progress (``numRowsDroppedByWatermark``).  A row is compared with the watermark of the
    batch before its own.
    """
    valid, _ = split_ticks(with_event_time(ticks).withWatermark("event_time", watermark))
    return ohlcv_bars(valid, window_ms)


def start_bronze(
    bars: DataFrame, path: str, checkpoint: str, source_api: str, run_id: str,
    trigger: dict = TRIGGER, partition_by: Sequence[str] = PARTITIONS,
    bar_interval: str = "1m",
) -> StreamingQuery:
    """Append each bar once, when the watermark passes its window."""
    landed = with_ingest_metadata(bars, source_api, run_id, bar_interval)
    return (
        landed.writeStream.format("parquet").outputMode("append").queryName(_name("bars_to_bronze", checkpoint))
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by).trigger(**trigger).start()
    )


def start_upsert(
    bars: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, source_api: str,
    trigger: dict = TRIGGER, stop_on_error: bool = True,
) -> StreamingQuery:
    """Re-emit changed bars and upsert them; repeated bars converge on the final one.

    ``write`` is retried.  If it still fails the query stops and a restart repeats the batch from its checkpoint; the
    bronze query is a query of its own and goes on either way.  Without ``stop_on_error`` the batch is logged and
    skipped, and since finished windows are never sent again, the target then stays without it.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"source_api": F.lit(source_api), "micro_batch": F.lit(batch_id)})
        try:
            with_retry(lambda: write(rows, batch_id))
        except Exception:
            if stop_on_error:
                raise
            log.warning("upsert of micro-batch %d failed and was skipped", batch_id, exc_info=True)
            rows.write.format("noop").mode("overwrite").save()  # the state of the windows must go on all the same

    return (
        bars.writeStream.outputMode("update").queryName(_name("bars_to_upsert", checkpoint)).foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def lake_upsert(path: str) -> Callable[[DataFrame, int], None]:
    """Upsert target in the lake: one folder per day, only the days of the batch are rewritten."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("date", F.to_date("window_start"))
        upsert_partitions(rows, path, STREAM_KEY, "date", ("micro_batch",))

    return write


def lake_changes(root: str, name: str = "bars", parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """Upsert target in the lake that is merged on read: a micro-batch writes its own bars and no others.

    ``changes.read_merged(spark, root, name, STREAM_KEY)`` gives the newest state of each bar.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, root, name, STREAM_KEY, ("micro_batch",), parts)

    return write


def start_dead_letters(
    ticks: DataFrame, path: str, checkpoint: str, trigger: dict = TRIGGER,
) -> StreamingQuery:
    """Ticks that fail validation, as JSON records."""
    _, rejected = split_ticks(ticks)
    return (
        tick_dead_letters(rejected).writeStream.format("json").outputMode("append").queryName(_name("ticks_to_dead_letters", checkpoint))
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def await_all(spark: SparkSession) -> None:
    """Block until any query ends, so that a supervisor can restart the job from its checkpoints."""
    spark.streams.awaitAnyTermination()
