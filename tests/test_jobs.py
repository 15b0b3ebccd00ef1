"""Batch jobs end to end, and streaming with late data, restarts and a failing sink."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_dicts, plan, ticks
from tickloom.operators.bars import ohlcv_bars
from tickloom.operators import serving as SV
from tickloom.operators.quality import CriticalQualityError
from tickloom.operators.upsert import upsert
from tickloom.plans import pipeline as P
from tickloom.schemas import DAILY_HISTORY
from tickloom.session import shared_dir
from tickloom.streaming import jobs

DRAIN = {"availableNow": True}


def history(spark, path, tickers, days=40, shift=0.0):
    rows = []
    for t in tickers:
        for i in range(days):
            close = float(100 + (i * 7 + len(t)) % 11) + shift
            rows.append((t, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), close, close + 1, close - 1, close,
                         1000 + i, "test", "now"))
    spark.createDataFrame(rows, DAILY_HISTORY).write.mode("overwrite").parquet(path)
    return path


def test_history_to_gold_twice_gives_the_same_tables(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"))
    path = history(spark, str(tmp_path / "h"), ["MSFT", "AAPL"])
    store = {}

    def load(df, name, keys):
        merged = upsert(store[name], df, keys) if name in store else df
        store[name] = spark.createDataFrame(merged.collect(), merged.schema)

    for _ in range(2):
        counts = P.ingest_history(spark, path, lake)
        assert counts == {"total": 80, "valid": 80, "rejected": 0}
        report = P.bronze_to_silver(spark, lake)
        assert report.filter("not pass").count() == 0
        P.silver_to_gold(spark, lake)
        loaded = P.load_gold(spark, lake, load)
        assert loaded == {"dim_ticker": 2, "dim_date": 40, "dim_market_session": 3, "fact_stock_prices": 80}
    assert store["fact_stock_prices"].count() == 80  # bronze holds two copies of each bar
    assert spark.read.parquet(lake.bronze).count() == 160
    # a ticker that sorts first comes later: known ids stay
    P.ingest_history(spark, history(spark, str(tmp_path / "h2"), ["AA"]), lake)
    P.bronze_to_silver(spark, lake, ticker="aa")
    P.silver_to_gold(spark, lake)
    ids = {r["symbol"]: r["ticker_id"] for r in as_dicts(spark.read.parquet(lake.gold("dim_ticker")))}
    assert ids == {"AAPL": 1, "MSFT": 2, "AA": 3}
    assert spark.read.parquet(lake.gold("fact_stock_prices")).count() == 120
    assert len(as_dicts(spark.read.json(lake.quality))) == 8


def test_invalid_history_is_counted_and_left_out(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"))
    history(spark, str(tmp_path / "h"), ["A"], days=3)
    bad = spark.read.parquet(str(tmp_path / "h")).withColumn("high", F.lit(0.5))
    bad.write.mode("append").parquet(str(tmp_path / "h"))
    assert P.ingest_history(spark, str(tmp_path / "h"), lake) == {"total": 6, "valid": 3, "rejected": 3}


def test_critical_quality_stops_the_silver_write_on_request(spark, tmp_path):
    lake = P.Lake(str(tmp_path / "lake"))
    P.ingest_history(spark, history(spark, str(tmp_path / "h"), ["A"], days=3), lake)
    bronze = spark.read.parquet(lake.bronze).withColumn("close", F.lit(-1.0)).withColumn("batch_id", F.lit("z"))
    bronze.withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 hour")) \
        .write.mode("append").partitionBy("date", "ticker").parquet(lake.bronze)
    with pytest.raises(CriticalQualityError):
        P.bronze_to_silver(spark, lake, fail_on_critical=True)
    report = P.bronze_to_silver(spark, lake)  # by default the report tells and the write goes on
    assert report.filter("rule = 'close_positive'").first()["violations"] == 3


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base) and shared_dir(spark, "x") != shared_dir(spark, "x")


# ---- streaming

SCHEMA = "ticker string, price double, volume long, timestamp_ms long, seq long"


def arrive(folder, batches):
    """One JSON file per micro-batch, in name order and with rising times."""
    import os
    folder.mkdir(exist_ok=True)
    start = len(list(folder.glob("*.json")))
    for i, rows in enumerate(batches, start):
        file = folder / f"{i:03d}.json"
        names = ["ticker", "price", "volume", "timestamp_ms", "seq"]
        file.write_text("\n".join(json.dumps(dict(zip(names, r))) for r in rows))
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))


def at(*seconds):
    return [("A", float(s), 1, s * 1000, s) for s in seconds]


def bronze(spark, tmp_path):
    bars = jobs.live_bars(source(spark, tmp_path / "in"))
    return jobs.start_bronze(bars, str(tmp_path / "out"), str(tmp_path / "ck"), "ws", "stream-1", trigger=DRAIN)


def test_late_rows_are_dropped_one_batch_after_the_watermark_moved(spark, tmp_path):
    arrive(tmp_path / "in", [at(60, 65), at(1000), at(62), at(63), at(1100)])
    query = bronze(spark, tmp_path)
    query.awaitTermination()
    rows = as_dicts(spark.read.parquet(str(tmp_path / "out")), "window_start")
    assert [(r["window_start"].minute, r["trade_count"], r["close"]) for r in rows] == [(1, 3, 65.0)]
    dropped = [sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert sum(dropped) == 1


def test_restart_resumes_offsets_and_state(spark, tmp_path):
    arrive(tmp_path / "in", [at(60, 65)])
    bronze(spark, tmp_path).awaitTermination()
    assert not list((tmp_path / "out").glob("date=*"))  # the window is still open
    arrive(tmp_path / "in", [at(70), at(1000), at(1100)])
    bronze(spark, tmp_path).awaitTermination()
    rows = as_dicts(spark.read.parquet(str(tmp_path / "out")))
    assert [(r["trade_count"], r["open"], r["close"], r["bar_interval"]) for r in rows] == [(3, 60.0, 70.0, "1m")]


def test_updates_converge_on_the_batch_answer(spark, tmp_path):
    batches = [at(60, 65), at(70, 130), at(119, 131)]
    arrive(tmp_path / "in", batches)
    bars = jobs.live_bars(source(spark, tmp_path / "in"))
    jobs.start_upsert(bars, jobs.lake_upsert(str(tmp_path / "up")), str(tmp_path / "ck"), "ws",
                      trigger=DRAIN, stop_on_error=True).awaitTermination()
    keep = ["ticker", "window_start", "open", "high", "low", "close", "volume", "vwap", "trade_count"]
    live = as_dicts(spark.read.parquet(str(tmp_path / "up")).select(*keep), "window_start")
    batch = as_dicts(ohlcv_bars(ticks(spark, [r for b in batches for r in b])).select(*keep), "window_start")
    assert live == batch


def test_a_failing_upsert_sink_does_not_stop_bronze(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "with_retry", lambda action: action())
    arrive(tmp_path / "in", [at(60, 65), at(1000), at(1100)])

    def broken(batch, batch_id):
        raise OSError("database is down")

    bars = jobs.live_bars(source(spark, tmp_path / "in"))
    upserts = jobs.start_upsert(bars, broken, str(tmp_path / "ck-up"), "ws", trigger=DRAIN, stop_on_error=False)
    landed = bronze(spark, tmp_path)
    upserts.awaitTermination()
    landed.awaitTermination()
    assert upserts.exception() is None
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    with pytest.raises(Exception, match="database is down"):
        jobs.start_upsert(bars, broken, str(tmp_path / "ck-stop"), "ws", trigger=DRAIN).awaitTermination()


def test_rejected_ticks_become_dead_letters(spark, tmp_path):
    arrive(tmp_path / "in", [at(60) + [("A", -1.0, 1, 61_000, 61), ("", 1.0, 1, 62_000, 62)]])
    jobs.start_dead_letters(source(spark, tmp_path / "in"), str(tmp_path / "dlq"), str(tmp_path / "ck"),
                            trigger=DRAIN).awaitTermination()
    rows = as_dicts(spark.read.json(str(tmp_path / "dlq")))
    assert {json.loads(r["original_message"])["timestamp_ms"] for r in rows} == {61000, 62000}
    assert {r["error_reason"] for r in rows} == {"validation_failed"}


def test_daily_bars_by_month_are_a_few_files_and_the_fact_is_pruned(spark, tmp_path):
    history(spark, str(tmp_path / "h"), ["A", "B", "0700"], days=300)
    lake = P.Lake(str(tmp_path / "lake"), ("month",))
    P.ingest_history(spark, str(tmp_path / "h"), lake)
    P.bronze_to_silver(spark, lake)
    P.silver_to_gold(spark, lake)
    for folder in ("bronze", "silver"):
        assert len(list((tmp_path / "lake" / folder / "stock_prices").rglob("*.parquet"))) <= 12
    with pytest.raises(ValueError):
        P.bronze_to_silver(spark, lake, "A")
    fact, tickers = (spark.read.parquet(lake.gold(n)) for n in ("fact_stock_prices", "dim_ticker"))
    assert fact.count() == 900 and {r["symbol"] for r in tickers.collect()} == {"A", "B", "0700"}
    recent = SV.history(fact, tickers, "0700", 5)
    assert recent.count() == 5 and "PushedFilters: [EqualTo(ticker_id" in plan(recent, "formatted").replace("IsNotNull(ticker_id), ", "")
