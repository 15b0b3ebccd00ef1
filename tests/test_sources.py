"""Feed parsing, dead letters, history files, lake layout."""

import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import as_dicts, bars, plan
from tickloom.schemas import BRONZE
from tickloom.sources import feed as FD
from tickloom.sources import history as H
from tickloom.sources import lake as L


def lines(spark, *messages):
    text = [m if isinstance(m, str) else json.dumps(m, separators=(",", ":")) for m in messages]
    return spark.createDataFrame(list(enumerate(text)), "line int, value string")


def trade(**changes):
    return {**{"s": "AAPL", "p": 1.5, "v": 10, "t": 1700000000123, "c": [1, 2]}, **changes}


def test_trades_are_unwrapped_and_heartbeats_skipped(spark):
    frame = lines(spark, {"type": "trade", "data": [trade(), trade(p=2, v=1.9, c=None)]},
                  {"type": "ping"}, {"type": "other", "data": [trade()]}, {"type": "trade"}, "{bad")
    rows = as_dicts(FD.unwrap_feed(frame), "line", "element")
    assert [(r["ticker"], r["price"], r["volume"], r["timestamp_ms"], r["conditions"]) for r in rows] == [
        ("AAPL", 1.5, 10, 1700000000123, [1, 2]), ("AAPL", 2.0, 1, 1700000000123, [])]
    assert rows[0]["timestamp"] == "2023-11-14T22:13:20.123000+00:00"


@pytest.mark.parametrize("changes", [
    {"s": ""}, {"s": 5}, {"s": None}, {"p": "1.5"}, {"p": 0}, {"p": None}, {"v": -1}, {"v": "x"}, {"t": 0}, {"t": None},
])
def test_wrongly_typed_trades_go_to_dead_letters(spark, changes):
    bad = trade(**changes)
    frame = lines(spark, {"type": "trade", "data": [trade(), bad]})
    assert FD.unwrap_feed(frame).count() == 1
    letter = as_dicts(FD.feed_dead_letters(frame))[0]
    assert letter["error_reason"] == "validation_failed" and json.loads(letter["original_message"]) == bad


def test_dead_letters_are_whole_unless_a_limit_is_asked_for(spark):
    bad = trade(s="", z="y" * 3000)
    frame = lines(spark, "{" + "x" * 3000, {"type": "trade", "data": [bad]})
    letters = {r["error_reason"]: r["original_message"] for r in as_dicts(FD.feed_dead_letters(frame))}
    assert letters["invalid_json"] == "{" + "x" * 3000 and json.loads(letters["validation_failed"]) == bad
    assert {len(r["original_message"]) for r in as_dicts(FD.feed_dead_letters(frame, 500))} == {500}


def test_condition_codes_may_be_strings(spark):
    frame = lines(spark, {"type": "trade", "data": [trade(c=["1", "12"]), trade(c=[3, "4"])]})
    assert [r["conditions"] for r in as_dicts(FD.unwrap_feed(frame), "line", "element")] == [[1, 12], [3, 4]]


def test_trade_data_that_is_no_array_is_a_dead_letter(spark):
    message = {"type": "trade", "data": "zz"}
    frame = lines(spark, message, {"type": "ping", "data": "zz"})
    assert FD.unwrap_feed(frame).count() == 0
    letters = as_dicts(FD.feed_dead_letters(frame))
    assert [json.loads(r["original_message"]) for r in letters] == [message]


def test_an_element_that_is_no_object_is_rejected(spark):
    frame = lines(spark, {"type": "trade", "data": [5, "x"]})
    assert FD.unwrap_feed(frame).count() == 0 and FD.feed_dead_letters(frame).count() == 2


def test_feed_counts(spark):
    frame = lines(spark, {"type": "trade", "data": [trade(), trade(p=-1)]}, {"type": "ping"}, "{bad")
    assert as_dicts(FD.feed_counts(frame))[0] == {"messages": 3, "invalid_json": 1, "published": 1, "rejected": 1}


def test_records_parse_back_to_the_published_ticks(spark):
    sent = spark.sql("""select 'A' ticker, 1.25d price, 3L volume, 1700000000123L timestamp_ms, 'x' timestamp,
                        array(1, 2) conditions, 'test' source""")
    records = FD.publish_payload(sent).select(
        F.col("key").cast("binary"), F.col("value").cast("binary"),
        F.current_timestamp().alias("timestamp"), F.lit(7).cast("long").alias("offset"))
    row = as_dicts(FD.parse_ticks(records))[0]
    assert (row["kafka_key"], row["ticker"], row["price"], row["volume"], row["seq"]) == ("A", "A", 1.25, 3, 7)


def test_fractional_volume_and_broken_values_keep_their_rows(spark):
    records = spark.sql("""select explode(array('{"ticker":"A","price":1.0,"volume":1.5,"timestamp_ms":5}', '{bad'))
                           value, 'k' key, current_timestamp() timestamp, 1L offset""")
    rows = sorted(as_dicts(FD.parse_ticks(records)), key=lambda r: r["ticker"] is None)
    assert rows[0]["volume"] == 1 and rows[1]["ticker"] is None and len(rows) == 2


def test_preview_reads_in_log_order(spark):
    records = spark.sql("select 'k' key, 'v' value, cast(id % 2 as int) partition, 9 - id offset from range(10)")
    rows = as_dicts(FD.preview(records, 3))
    assert [(r["partition"], r["offset"]) for r in rows] == [(0, 1), (0, 3), (0, 5)]


def history_rows(spark):
    return spark.sql("""select '0700' ticker, timestamp'2024-01-02' date, 1d open, 2d high, 1d low, 1.5d close,
                        10L volume, 'x' source, 'now' ingested_at""")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_history_files_keep_numeric_tickers_as_text(spark, tmp_path, fmt):
    H.write_history(history_rows(spark), str(tmp_path))
    assert as_dicts(H.read_history(spark, f"{tmp_path}/{fmt}", fmt)) == as_dicts(history_rows(spark))


def test_missing_history_columns_are_named(spark, tmp_path):
    history_rows(spark).drop("close").write.parquet(str(tmp_path / "h"))
    with pytest.raises(ValueError, match="close"):
        H.read_history(spark, str(tmp_path / "h"))


def test_reordered_csv_is_an_error(spark, tmp_path):
    frame = history_rows(spark)
    frame.select(*reversed(frame.columns)).write.option("header", True).csv(str(tmp_path / "h"))
    with pytest.raises(Exception, match="CSV header"):
        H.read_history(spark, str(tmp_path / "h"), "csv").collect()


def test_vendor_history_is_normalised(spark):
    vendor = spark.sql("""select timestamp'2024-07-01 00:00:00' Date, 1.23456d Open, 2d High, 1d Low, 1.5d Close,
                          10.0d Volume, 0d Dividends""")
    row = as_dicts(H.normalise_history(vendor, "aapl", "vendor", "America/New_York"))[0]
    assert list(row) == ["ticker", "date", "open", "high", "low", "close", "volume", "source", "ingested_at"]
    assert (row["ticker"], str(row["date"]), row["open"], row["volume"]) == ("AAPL", "2024-07-01 04:00:00", 1.2346, 10)


def test_ticker_filter_prunes_partitions_and_keeps_leading_zeros(spark, tmp_path):
    path = str(tmp_path / "bronze")
    L.write_bars(bars(spark, {"0700": [1.0, 2.0], "0005": [3.0]}), path)
    frame = L.read_bars(spark, path, BRONZE, "0700")
    assert {r["ticker"] for r in as_dicts(frame)} == {"0700"} and frame.count() == 2
    text = plan(frame)
    assert "PartitionFilters: [isnotnull(ticker" in text and "0700" in text


def test_one_file_per_folder_and_run(spark, tmp_path):
    path = tmp_path / "bronze"
    L.write_bars(bars(spark, {"A": [1.0, 2.0], "B": [1.0, 2.0]}).repartition(8), str(path))
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in path.glob("date=*/ticker=*"))


def test_overwriting_one_ticker_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "silver")
    L.write_bars(bars(spark, {"A": [1.0], "B": [1.0]}), path, mode="overwrite")
    L.write_bars(bars(spark, {"A": [9.0]}), path, mode="overwrite")
    rows = as_dicts(L.read_bars(spark, path, BRONZE), "ticker")
    assert [(r["ticker"], r["close"]) for r in rows] == [("A", 9.0), ("B", 1.0)]
