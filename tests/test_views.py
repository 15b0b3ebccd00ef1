"""Daily bars of line items: exact order among ties and nulls, no sort of all items."""

import datetime as dt

from pyspark.sql import functions as F

from checks import views
from tests.helpers import as_dicts, plan
from tickloom import session

DAY = dt.datetime(1995, 3, 1)
ITEMS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"


def _tables(spark, path, items):
    spark.createDataFrame(items, ITEMS).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, "Brand#11"), (2, "brand#11"), (3, None), (4, "Brand#12")], "p_partkey long, p_brand string").write.parquet(f"{path}/part.parquet")


def test_daily_items_with_ties_and_nulls(spark, tmp_path):
    items = []
    for day in (DAY, DAY + dt.timedelta(days=1), None):
        for i in range(90):
            # few orders and lines, so that later parts of the order decide; some orders are null or the smallest number
            order = (None, -2 ** 63, 5, 2 ** 40, 7)[i % 5]
            items.append((order, i % 4 + 1, i * 7 % 11, i % 3, 1.0 + i % 6, 100.0 + i * 13 % 97, day))
    _tables(spark, tmp_path, items)
    rows = spark.createDataFrame(items, ITEMS).join(spark.read.parquet(f"{tmp_path}/part.parquet"), F.col("l_partkey") == F.col("p_partkey")) \
        .withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
    at = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    want = rows.groupBy(F.upper("p_brand").alias("ticker"), F.col("l_shipdate").alias("date")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", at).alias("close"), F.sum(F.col("l_quantity").cast("long")).alias("volume"))
    got = views.daily_li(spark, str(tmp_path))
    assert got.count() == 9
    assert as_dicts(got.drop("source", "ingested_at"), "ticker", "date") == as_dicts(want, "ticker", "date")


def test_all_items_are_hashed_and_only_edges_are_sorted(spark, tmp_path, monkeypatch):
    stored = {}

    def measured(df, name):
        stored[name] = plan(df)
        return session.measured(df, name)

    monkeypatch.setattr(views, "measured", measured, raising=False)
    _tables(spark, tmp_path, [(o, o % 3 + 1, 1, 1, 2.0, 10.0 + o, DAY) for o in range(2_000)])
    got = views.daily_li(spark, str(tmp_path))
    assert "HashAggregate" in stored["bar-bounds"] and "Sort" not in stored["bar-bounds"]
    # what is left to sort is cut by the orders of the bounds first
    assert "LeftSemi" in plan(got)
    bar, = as_dicts(got.filter("ticker = 'BRAND#11'"))
    assert (bar["open"], bar["high"], bar["low"], bar["close"]) == (5.0, 1004.5, 5.0, 1004.5)
