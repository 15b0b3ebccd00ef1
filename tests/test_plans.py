"""Physical plans: what is read, what moves, what is sent to every task."""

import re

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.catalog import QUERIES
from tests.helpers import plan
from tickloom.operators import upsert as U
from tickloom.operators.bars import ohlcv_bars

SF_DIR = "/root/testdata/sf0.001"


def test_bars_read_only_the_columns_they_need(spark):
    text = plan(ohlcv_bars(views.ticks(spark, SF_DIR)), "formatted")
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "user_id" not in schema and "event_id" in schema


@pytest.mark.parametrize("name", ["bars_1min", "vwap", "bars_daily", "candles", "ingest_counts", "quality_report"])
def test_tick_and_report_aggregates_hash_and_combine_first(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "SortAggregate" not in text
    if "Exchange hashpartitioning" in text:
        assert "partial_" in text


@pytest.mark.parametrize("name", [
    "bars_1min", "dedup_latest", "ind_ema", "fact_prices", "star_join", "upsert_merge", "time_split",
    "lookback_sequences", "prediction_actuals", "forecast_metrics", "sma10_partial", "dim_date",
])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_session_lookup_sends_three_fixed_rows(spark):
    text = plan(QUERIES["session_join"](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" in text and "Scan ExistingRDD[session_id" in text


def test_small_aggregates_are_joined_by_measured_size(spark):
    text = plan(QUERIES["scale_features"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" not in plan(QUERIES["scale_features"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_reads_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).select("id", F.concat(F.lit("d"), "id").alias("d")).write.partitionBy("d").parquet(path)
    stored = spark.read.parquet(path)
    incoming = stored.filter("d in ('d1', 'd3')")
    some = U.touched_partitions(stored, incoming, "d")
    assert re.search(r"PartitionFilters: \[.*d1.*d3.*\]", plan(some)) and "LeftSemi" in plan(some)
    assert [r["id"] for r in some.orderBy("id").collect()] == [1, 3]
