"""Streaming queries run to completion over the event table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from tickloom.session import shared_dir, use_utc
from tickloom.schemas import DEAD_LETTER
from tickloom.sources.changes import read_merged
from tickloom.streaming import jobs

FILES_PER_SLICE = 4
DRAIN = {"availableNow": True}


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _slices(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The events in four slices by time; the cuts fall inside a minute."""
    events = views.table(spark, sf_dir, "events")
    cuts = ["2024-01-11 10:30:30", "2024-01-21 10:30:30", "2024-01-26 10:30:30"]
    ts, cuts = F.col("ts"), [F.lit(c).cast("timestamp_ntz") for c in cuts]
    return {
        "a": events.filter(ts < cuts[0]),
        "b": events.filter((ts >= cuts[0]) & (ts < cuts[1])),
        "c": events.filter((ts >= cuts[1]) & (ts < cuts[2])),
        "d": events.filter(ts >= cuts[2]),
    }


def _arrive(slices: Sequence[DataFrame], folder: str) -> None:
    for part in slices:
        part.repartition(FILES_PER_SLICE).write.mode("append").parquet(folder)


def _arrivals(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    schema = views.table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_SLICE).parquet(folder)


def _drain(start: Callable[[str, str], object], out: str, checkpoint: str) -> None:
    stream = start(out, checkpoint)
    stream.awaitTermination()


def _bronze(bars: DataFrame) -> Callable[[str, str], object]:
    return lambda out, checkpoint: jobs.start_bronze(
        bars, out, checkpoint, "feed_ws", "stream-0", trigger=DRAIN, partition_by=("date",))


BAR_COLUMNS = ["ticker", "window_start", "window_end", "open", "high", "low", "close", "volume",
               "vwap", "trade_count"]


def _landed(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).select(*BAR_COLUMNS)


def stream_bars_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(use_utc(spark), "stream")
    bars = jobs.live_bars(views.as_ticks(_source(spark, sf_dir)))
    _drain(_bronze(bars), f"{work}/out", f"{work}/ck")
    return _landed(spark, f"{work}/out")


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first third of the events arrives once more after its windows closed, to no effect."""
    work = shared_dir(use_utc(spark), "stream")
    parts = _slices(spark, sf_dir)
    _arrive([parts[k] for k in "abcad"], f"{work}/in")
    bars = jobs.live_bars(views.as_ticks(_arrivals(spark, sf_dir, f"{work}/in")))
    _drain(_bronze(bars), f"{work}/out", f"{work}/ck")
    return _landed(spark, f"{work}/out")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped half way and started again from its checkpoint."""
    work = shared_dir(use_utc(spark), "stream")
    parts = _slices(spark, sf_dir)
    for arriving in ("ab", "cd"):
        _arrive([parts[k] for k in arriving], f"{work}/in")
        bars = jobs.live_bars(views.as_ticks(_arrivals(spark, sf_dir, f"{work}/in")))
        _drain(_bronze(bars), f"{work}/out", f"{work}/ck")
    return _landed(spark, f"{work}/out")


def _upserts(bars: DataFrame) -> Callable[[str, str], object]:
    return lambda out, checkpoint: jobs.start_upsert(
        bars, jobs.lake_upsert(out), checkpoint, "feed_ws", trigger=DRAIN, stop_on_error=True)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices cut through open windows; upserts converge on the batch answer."""
    work = shared_dir(use_utc(spark), "stream")
    parts = _slices(spark, sf_dir)
    _arrive([parts[k] for k in "abcd"], f"{work}/in")
    bars = jobs.live_bars(views.as_ticks(_arrivals(spark, sf_dir, f"{work}/in")))
    _drain(_upserts(bars), f"{work}/out", f"{work}/ck")
    return spark.read.parquet(f"{work}/out").select(*BAR_COLUMNS, "source_api")


def stream_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_upsert``, but every micro-batch writes its own bars only; packed at three parts."""
    work = shared_dir(use_utc(spark), "stream")
    parts = _slices(spark, sf_dir)
    _arrive([parts[k] for k in "abcd"], f"{work}/in")
    bars = jobs.live_bars(views.as_ticks(_arrivals(spark, sf_dir, f"{work}/in")))
    _drain(lambda out, ck: jobs.start_upsert(bars, jobs.lake_changes(out, parts=3), ck, "feed_ws", trigger=DRAIN), f"{work}/out", f"{work}/ck")
    return read_merged(spark, f"{work}/out", "bars", jobs.STREAM_KEY).select(*BAR_COLUMNS, "source_api")


def stream_dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sinks at once, each with its own checkpoint."""
    work = shared_dir(use_utc(spark), "stream")
    bars = jobs.live_bars(views.as_ticks(_source(spark, sf_dir)))
    running = [_bronze(bars)(f"{work}/bronze", f"{work}/ck-bronze"),
               _upserts(bars)(f"{work}/upsert", f"{work}/ck-upsert")]
    for stream in running:
        stream.awaitTermination()
    keep = ["ticker", "window_start", "close", "volume"]
    return (
        spark.read.parquet(f"{work}/bronze").select(F.lit("bronze").alias("sink"), *keep)
        .unionByName(spark.read.parquet(f"{work}/upsert").select(F.lit("upsert").alias("sink"), *keep))
    )


def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(use_utc(spark), "stream")
    ticks = views.with_defects(views.as_ticks(_source(spark, sf_dir)))
    _drain(lambda out, ck: jobs.start_dead_letters(ticks, out, ck, trigger=DRAIN),
           f"{work}/out", f"{work}/ck")
    letters = spark.read.schema(DEAD_LETTER).json(f"{work}/out")
    message = F.col("original_message")
    return letters.select(
        "ticker", "error_reason",
        F.get_json_object(message, "$.timestamp_ms").cast("long").alias("timestamp_ms"),
        F.get_json_object(message, "$.volume").cast("long").alias("volume"))
