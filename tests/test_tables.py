"""Cleaning, quality, star schema, upsert."""

import datetime as dt

import duckdb
import shutil

import pytest
from pyspark.sql import functions as F

from tests.helpers import DAY0, as_dicts, bars, plan, shuffled
from tickloom.operators import clean as C
from tickloom.operators import quality as Q
from tickloom.operators import star as S
from tickloom.operators import upsert as U
from tickloom.operators.indicators import add_indicators
from tickloom.schemas import FACT_COLUMNS, INDICATORS


def later(df, hours, **columns):
    stamp = F.col("ingested_at") + F.make_dt_interval(hours=F.lit(hours))
    return df.withColumns({"ingested_at": stamp, **{k: F.lit(v) for k, v in columns.items()}})


# ---- cleaning

def test_latest_copy_wins_and_ties_are_settled(spark):
    base = bars(spark, {"A": [1.0, 2.0]})
    copies = base.unionByName(later(base, 1, close=5.0)).unionByName(later(base, 1, close=7.0)) \
        .unionByName(later(base, 1, close=6.0, batch_id="a0"))
    for seed in (1, 2, 3):
        rows = as_dicts(C.latest_per_key(shuffled(copies, seed)), "window_start")
        assert [r["close"] for r in rows] == [7.0, 7.0]


def test_copies_are_limited_before_the_shuffle(spark):
    text = plan(C.latest_per_key(bars(spark, {"A": [1.0]})))
    limits = [i for i, line in enumerate(text.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    shuffle = [i for i, line in enumerate(text.splitlines()) if "Exchange" in line]
    assert limits and shuffle and limits[0] > shuffle[0]  # deeper in the plan = earlier


def test_incomplete_rows_are_dropped_and_types_enforced(spark):
    frame = bars(spark, {"A": [1.0, 2.0, 3.0]}).withColumn(
        "close", F.when(F.col("close") == 2, "x").otherwise(F.col("close").cast("string")))
    rows = as_dicts(C.clean_bars(frame), "window_start")
    assert [r["close"] for r in rows] == [1.0, 3.0]


# ---- quality

def report_of(frame):
    return {r["rule"]: r for r in as_dicts(Q.quality_report(frame))}


def test_clean_data_passes_every_rule(spark):
    silver = add_indicators(bars(spark, {"A": [float(10 + i % 5) for i in range(40)], "B": [1.0, 2.0]}),
                            ["is_outlier", *INDICATORS])
    report = report_of(silver)
    assert list(report) == [rule for rule, _ in Q.RULES]
    assert all(r["pass"] and r["total_rows"] == 42 for r in report.values())
    assert as_dicts(Q.verdict(Q.quality_report(silver)))[0]["verdict"] == "all_passed"


def test_each_rule_counts_its_violations(spark):
    silver = add_indicators(bars(spark, {"A": [float(10 + i % 5) for i in range(20)]}), ["is_outlier", *INDICATORS])
    n = F.dayofmonth("date")
    broken = silver.withColumns({
        "close": F.when(n == 1, F.lit(None)).when(n == 2, F.lit(-1.0)).otherwise(F.col("close")),
        "high": F.when(n == 3, F.col("low") - 1).otherwise(F.col("high")),
        "volume": F.when(n == 4, F.lit(-5)).otherwise(F.col("volume")),
        "sma_7": F.when(n == 15, F.lit(None)).otherwise(F.col("sma_7")),
        "rsi_14": F.when(n == 16, F.lit(101.0)).otherwise(F.col("rsi_14")),
        "is_outlier": n <= 2,
    })
    report = report_of(broken)
    assert {k: v["violations"] for k, v in report.items()} == {
        "no_null_close": 1, "no_null_ticker": 0, "close_positive": 1, "high_gte_low": 1,
        "volume_non_negative": 1, "sma_7_not_null_after_day_7": 1, "rsi_in_range": 1, "outlier_pct_below_5": 2}
    assert not report["outlier_pct_below_5"]["pass"]
    verdict = as_dicts(Q.verdict(Q.quality_report(broken)))[0]
    assert (verdict["verdict"], verdict["failed_rules"]) == ("critical_failed", 7)
    with pytest.raises(Q.CriticalQualityError, match="no_null_close"):
        Q.stop_on_critical(Q.quality_report(broken))


def test_warnings_alone_do_not_stop_a_job(spark):
    silver = add_indicators(bars(spark, {"A": [1.0] * 10}), ["sma_7", "rsi_14"]).withColumn("volume", F.lit(-1))
    report = Q.quality_report(silver)
    assert as_dicts(Q.verdict(report))[0]["verdict"] == "warnings"
    Q.stop_on_critical(report)


# ---- star schema

def test_known_and_unknown_tickers(spark):
    rows = as_dicts(S.dim_ticker(bars(spark, {"ZZZ": [1.0], "AAPL": [1.0], "V": [1.0]})), "ticker_id")
    assert [(r["ticker_id"], r["symbol"], r["company_name"], r["exchange"]) for r in rows] == [
        (1, "AAPL", "Apple Inc.", "NASDAQ"), (2, "V", "Visa Inc.", "NYSE"), (3, "ZZZ", "ZZZ Corp.", "Unknown")]


def test_ids_are_stable_when_tickers_are_added(spark):
    known = S.dim_ticker(bars(spark, {"M": [1.0], "C": [1.0]}))
    grown = S.dim_ticker(bars(spark, {"A": [1.0], "M": [1.0], "Z": [1.0]}), known)
    assert {r["symbol"]: r["ticker_id"] for r in as_dicts(grown)} == {"C": 1, "M": 2, "A": 3, "Z": 4}


def test_ids_follow_symbol_order_for_many_symbols(spark):
    symbols = spark.range(500).select(F.concat(F.lit("S"), F.hex("id"), F.lit("é")).alias("ticker"))
    rows = as_dicts(S.dim_ticker(symbols), "ticker_id")
    assert [r["ticker_id"] for r in rows] == list(range(1, 501))
    assert [r["symbol"] for r in rows] == sorted((r["symbol"] for r in rows), key=str.encode)


def test_calendar_is_continuous_and_marks_trading_days(spark):
    frame = spark.sql("select explode(array(timestamp'2024-12-27 10:00', timestamp'2025-01-02')) window_start")
    rows = as_dicts(S.dim_date(frame), "date_id")
    assert [r["date_id"] for r in rows] == [20241227, 20241228, 20241229, 20241230, 20241231, 20250101, 20250102]
    assert [r["is_trading_day"] for r in rows] == [True] + [False] * 5 + [True]
    monday = rows[3]
    assert (monday["day_of_week"], monday["iso_dow"], monday["day_name"]) == (2, 1, "Monday")
    assert (monday["week"], monday["year"], monday["iso_year"], monday["quarter"]) == (1, 2024, 2025, 4)


@pytest.mark.parametrize("utc,session", [
    ("2024-01-15 08:59", None), ("2024-01-15 09:00", "pre_market"), ("2024-01-15 14:30", "regular"),
    ("2024-01-15 20:59", "regular"), ("2024-01-15 21:00", "after_hours"), ("2024-01-16 01:00", None),
    ("2024-07-15 13:29", "pre_market"), ("2024-07-15 13:30", "regular"),  # summer time
])
def test_market_session_in_eastern_time(spark, utc, session):
    frame = spark.sql(f"select timestamp'{utc}' event_time")
    assert as_dicts(S.with_market_session(frame, S.dim_market_session(spark)))[0]["session_type"] == session


def test_fact_has_next_close_and_daily_bars_only(spark):
    daily = bars(spark, {"A": [1.0, 2.0, 3.0], "B": [5.0]})
    minute = bars(spark, {"A": [9.0] * 3}, interval="1m", step=dt.timedelta(minutes=1))
    silver = add_indicators(daily.unionByName(minute), ["is_outlier", *INDICATORS])
    fact = S.fact_prices(silver, S.dim_ticker(silver))
    assert fact.columns == FACT_COLUMNS
    rows = as_dicts(fact, "ticker_id", "date_id")
    assert [(r["ticker_id"], r["date_id"], r["target_next_close"]) for r in rows] == [
        (1, 20240101, 2.0), (1, 20240102, 3.0), (1, 20240103, None), (2, 20240101, None)]


def test_fact_keeps_the_columns_there_are(spark):
    frame = bars(spark, {"A": [1.0]}).drop("vwap")
    assert "vwap" not in S.fact_prices(frame, S.dim_ticker(frame)).columns


# ---- upsert

def table(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b string")


def test_upsert_replaces_given_columns_only_and_is_idempotent(spark):
    target = table(spark, [(1, "x", "y"), (2, "x", "y")])
    updates = table(spark, [(2, "new", "no"), (3, "new", "no")]).drop("b")
    once = U.upsert(target, updates, ["k"])
    assert [tuple(r) for r in once.orderBy("k").collect()] == [(1, "x", "y"), (2, "new", "y"), (3, "new", None)]
    assert as_dicts(U.upsert(once, updates, ["k"]), "k") == as_dicts(once, "k")


def test_upsert_may_set_a_column_to_null(spark):
    out = U.upsert(table(spark, [(1, "x", "y")]), table(spark, [(1, None, "z")]), ["k"])
    assert [tuple(r) for r in out.collect()] == [(1, None, "z")]


def test_upsert_takes_the_newest_of_repeated_keys(spark):
    updates = table(spark, [(1, "1", "old"), (1, "3", "new"), (1, "2", "mid")])
    out = U.upsert(table(spark, [(1, "0", "x")]), updates, ["k"], ["a"])
    assert [tuple(r) for r in out.collect()] == [(1, "3", "new")]


def test_nothing_but_keys_means_do_nothing(spark):
    target = table(spark, [(1, "x", "y")])
    out = U.upsert(target, spark.createDataFrame([(1,), (2,), (2,)], "k int"), ["k"])
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, "x", "y"), (2, None, None)]


def test_partition_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "x", "d1"), (2, "x", "d1"), (3, "x", "d2")], "k int, a string, d string")
    U.upsert_partitions(first, path, ["k", "d"], "d")
    files = {p.name for p in (tmp_path / "t" / "d=d2").glob("*.parquet")}
    update = spark.createDataFrame([(2, "y", "d1"), (4, "y", "d3")], "k int, a string, d string")
    for _ in range(2):
        U.upsert_partitions(update, path, ["k", "d"], "d")
    rows = spark.read.parquet(path).orderBy("k").collect()
    assert [(r["k"], r["a"], r["d"]) for r in rows] == [(1, "x", "d1"), (2, "y", "d1"), (3, "x", "d2"), (4, "y", "d3")]
    assert {p.name for p in (tmp_path / "t" / "d=d2").glob("*.parquet")} == files


def test_partition_upsert_keeps_columns_the_update_lacks_and_adds_new_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    U.upsert_partitions(spark.createDataFrame([(1, "x", "p", "d1"), (2, "x", "p", "d1"), (3, "x", "p", None)], "k int, a string, b string, d string"), path, ["k", "d"], "d")
    U.upsert_partitions(spark.createDataFrame([(2, "y", 7, "d1"), (4, "z", 8, None)], "k int, a string, c int, d string"), path, ["k", "d"], "d")
    rows = spark.read.option("mergeSchema", "true").parquet(path).select("k", "a", "b", "c", "d").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "x", "p", None, "d1"), (2, "y", "p", 7, "d1"), (3, "x", "p", None, None), (4, "z", None, 8, None)]


def test_partition_upsert_that_dies_while_replacing_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    U.upsert_partitions(spark.createDataFrame([(1, "x", "d1"), (2, "x", "d2")], "k int, a string, d string"), path, ["k", "d"], "d")
    finish, calls = U.finish_pending, []

    def dying(spark, path, partition):
        calls.append(path)
        if len(calls) == 2:  # the old folder is gone, the new one is not there yet
            shutil.rmtree(tmp_path / "t" / "d=d1")
            raise OSError("lost")
        finish(spark, path, partition)

    monkeypatch.setattr(U, "finish_pending", dying)
    update = spark.createDataFrame([(5, "n", "d1")], "k int, a string, d string")
    with pytest.raises(OSError):
        U.upsert_partitions(update, path, ["k", "d"], "d")
    monkeypatch.setattr(U, "finish_pending", finish)
    U.upsert_partitions(update, path, ["k", "d"], "d")
    rows = spark.read.parquet(path).orderBy("k").collect()
    assert [(r["k"], r["a"], r["d"]) for r in rows] == [(1, "x", "d1"), (2, "x", "d2"), (5, "n", "d1")]
    assert not (tmp_path / "t" / U.PENDING).exists()


@pytest.mark.parametrize("columns", [["k", "a", "b"], ["k"]])
def test_conflict_statement_agrees_with_the_frame_upsert(spark, columns):
    rows, new = [(1, "x", "y"), (2, "x", "y")], [(2, "n", "n"), (3, "n", "n")]
    db = duckdb.connect()  # in-process, no server
    for name, content in (("t", rows), ("s", new)):
        db.execute(f"create table {name} (k integer primary key, a varchar, b varchar)")
        db.executemany(f"insert into {name} values (?, ?, ?)", content)
    db.execute(U.on_conflict_sql("t", "s", columns, ["k"]))
    out = U.upsert(table(spark, rows), table(spark, new).select(*columns), ["k"])
    assert [tuple(r) for r in out.orderBy("k").collect()] == db.execute("select * from t order by k").fetchall()


def test_retry_waits_longer_each_time_and_raises_the_last_error():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise OSError(f"call {len(calls)}")

    with pytest.raises(OSError, match="call 3"):
        U.with_retry(fail, sleep=waits.append)
    assert waits == [2.0, 4.0]
    assert U.with_retry(lambda: "done", sleep=waits.append) == "done"
