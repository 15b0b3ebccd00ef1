import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import as_dicts, plan, shuffled, ticks
from tickloom.functions.numeric import exact_sum, rnd
from tickloom.operators import bars as B
from tickloom.operators import validate as V

M = B.MINUTE_MS


def test_open_and_close_follow_time_then_sequence(spark):
    rows = [("A", 10.0, 1, 5000, 3), ("A", 11.0, 1, 5000, 2), ("A", 9.0, 1, 59999, 5),
            ("A", 8.0, 1, 59999, 4), ("A", 7.0, 1, 60000, 6)]
    first, second = as_dicts(B.ohlcv_bars(shuffled(ticks(spark, rows))), "window_start")
    assert (first["open"], first["close"], first["high"], first["low"]) == (11.0, 9.0, 11.0, 8.0)
    assert first["trade_count"] == 4 and first["volume"] == 4
    assert second["open"] == second["close"] == 7.0  # windows are closed on the left only


def test_vwap_falls_back_to_the_mean_price_without_volume(spark):
    rows = [("A", 1.0, 0, 10, 1), ("A", 2.0, 0, 20, 2), ("B", 1.0, 1, 10, 3), ("B", 2.0, 3, 20, 4)]
    got = {r["ticker"]: r["vwap"] for r in as_dicts(B.ohlcv_bars(ticks(spark, rows)))}
    assert got == {"A": 1.5, "B": 1.75}


def test_sequence_number_that_does_not_fit_fails_the_job(spark):
    frame = ticks(spark, [("A", 1.0, 1, 10, 1 << 47)])
    with pytest.raises(Exception, match="47 bits"):
        B.ohlcv_bars(frame).collect()


def test_ticks_are_folded_by_hash_aggregates_before_the_shuffle(spark):
    text = plan(B.ohlcv_bars(ticks(spark, [("A", 1.0, 1, 10, 1)])))
    assert "SortAggregate" not in text and text.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in text


def test_rolled_up_minutes_equal_direct_days(spark):
    rows = [("A", float(i % 17 + 1), i % 5, i * 400_000, i) for i in range(800)]
    frame = ticks(spark, rows)
    keep = ["ticker", "window_start", "open", "high", "low", "close", "volume", "trade_count"]
    direct = B.ohlcv_bars(frame, B.DAY_MS).select(*keep)
    rolled = B.roll_up(B.ohlcv_bars(frame)).select(*keep)
    assert as_dicts(direct, "window_start") == as_dicts(rolled, "window_start")


def test_daily_alignment_ends_at_the_next_midnight(spark):
    frame = spark.sql("select 'A' ticker, timestamp'2024-03-01 05:00:00' date, 1d open, 1d high, 1d low, 1d close, 5L volume")
    row = as_dicts(B.align_daily(frame))[0]
    assert str(row["window_start"]) == "2024-03-01 05:00:00" and str(row["window_end"]) == "2024-03-02 00:00:00"
    assert row["vwap"] is None and row["trade_count"] is None


def test_minute_and_daily_bars_stay_apart(spark):
    minute = B.with_ingest_metadata(B.ohlcv_bars(ticks(spark, [("A", 1.0, 1, 10, 1)])), "ws", "s", "1m")
    day = B.with_ingest_metadata(B.ohlcv_bars(ticks(spark, [("A", 1.0, 1, 10, 1)]), B.DAY_MS), "h", "b", "1d")
    both = B.merge_paths([minute, day])
    assert {r["bar_interval"] for r in as_dicts(both)} == {"1m", "1d"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 4)), min_size=1, max_size=40))
def test_exact_sum_does_not_depend_on_order(spark, values):
    one = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]
    two = spark.createDataFrame([(v,) for v in reversed(values)], "v double").repartition(5) \
        .agg(exact_sum(F.col("v"))).first()[0]
    assert one == two and abs(one - sum(values)) < 1e-3


def test_rounding_is_half_up_on_the_decimal_value(spark):
    frame = spark.createDataFrame([(2.00005,), (-2.00005,), (1.00004999,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in frame.select(rnd(F.col("v"), 4)).collect()] == [2.0001, -2.0001, 1.0, None, None]


def test_nothing_is_lost_between_valid_and_rejected(spark):
    nan = float("nan")
    rows = [("A", 1.0, 1, 1, 1), (None, 1.0, 1, 1, 2), ("", 1.0, 1, 1, 3), ("A", None, 1, 1, 4),
            ("A", nan, 1, 1, 5), ("A", 0.0, 1, 1, 6), ("A", 1.0, None, 1, 7), ("A", 1.0, -1, 1, 8),
            ("A", 1.0, 0, 1, 9), ("A", 1.0, 1, 0, 10), ("A", 1.0, 1, None, 11)]
    valid, rejected = V.split_ticks(ticks(spark, rows))
    assert [r["seq"] for r in as_dicts(valid, "seq")] == [1, 9]
    assert rejected.count() == 9
    counts = as_dicts(V.ingest_counts(ticks(spark, rows), V.tick_is_valid()))[0]
    assert counts == {"total_rows": 11, "valid_rows": 2, "rejected_rows": 9}


def test_daily_rules(spark):
    ok = dict(ticker="A", date="2024-01-01", open=1.0, high=2.0, low=1.0, close=1.5, volume=0)
    bad = [{"high": 0.5}, {"open": None}, {"close": float("nan")}, {"volume": None}, {"date": None},
           {"ticker": ""}, {"low": -1.0}]
    schema = "ticker string, date string, open double, high double, low double, close double, volume long"
    frame = spark.createDataFrame([ok, *[{**ok, **change} for change in bad]], schema)
    valid, rejected = V.split_daily(frame)
    assert valid.count() == 1 and rejected.count() == len(bad)


def test_candles(spark):
    frame = spark.sql("select 'A' ticker, timestamp'2024-01-01' window_start, 3d open, 4d high, 1d low, 2d close")
    row = as_dicts(B.candles(frame))[0]
    assert (row["is_up"], row["body_bottom"], row["body_height"]) == (False, 2.0, 1.0)
