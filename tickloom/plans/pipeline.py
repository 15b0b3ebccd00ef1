"""Batch jobs: history -> bronze -> silver -> gold -> relational tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.bars import align_daily, with_ingest_metadata
from tickloom.operators.clean import clean_bars
from tickloom.operators.indicators import add_indicators, continue_indicators, split_late
from tickloom.operators.mlprep import nan_to_null
from tickloom.operators.quality import quality_report, stop_on_critical
from tickloom.operators.star import dim_date, dim_market_session, dim_ticker, fact_prices
from tickloom.operators.validate import daily_is_valid
from tickloom.schemas import BRONZE, DIM_TICKER, INDICATORS, SILVER
from tickloom.session import cut_lineage, use_utc
from tickloom.sources.history import read_history
from tickloom.sources import release
from tickloom.sources.lake import PARTITIONS, read_bars, write_bars, write_report, write_table

# Load order and conflict keys of the relational tables.
LOAD_ORDER = [
    ("dim_ticker", ["symbol"]),
    ("dim_date", ["date_id"]),
    ("dim_market_session", ["session_type"]),
    ("fact_stock_prices", ["ticker_id", "date_id"]),
]


@dataclass(frozen=True)
class Lake:
    """Table locations below one root folder, and the folders bars are laid out in (see ``write_bars``)."""

    root: str
    partition_by: tuple[str, ...] = PARTITIONS

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/stock_prices"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/stock_prices"

    @property
    def quality(self) -> str:
        return f"{self.root}/silver/quality_report"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


def run_id(kind: str, ticker: str = "all") -> str:
    return f"{kind}-{ticker}-{uuid.uuid4().hex[:8]}"


def ingest_history(spark: SparkSession, path: str, lake: Lake, fmt: str = "parquet",
                   source_api: str = "history", batch_id: str | None = None) -> dict[str, int]:
    """Validate daily history and append it to bronze; counts come from the write itself."""
    use_utc(spark)
    valid = daily_is_valid()
    seen = Observation("ingest")
    checked = read_history(spark, path, fmt).withColumn("_valid", valid).observe(
        seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("_valid")).alias("valid"))
    bars = with_ingest_metadata(align_daily(checked.filter("_valid")), source_api,
                                batch_id or run_id("batch"), "1d")
    write_bars(bars, lake.bronze, partition_by=lake.partition_by)
    counts = seen.get
    return {**counts, "rejected": counts["total"] - counts["valid"]}


def bronze_to_silver(spark: SparkSession, lake: Lake, ticker: str | None = None,
                     fail_on_critical: bool = False) -> DataFrame:
    """Clean, enrich, check and store; returns the quality report.

    The cleaned bars are stored once because the indicator pass reads them twice, the report and
    the final write read the stored result.  A one-ticker run replaces only that ticker's folders, so it needs a
    layout with tickers.
    """
    if ticker and "ticker" not in lake.partition_by:
        raise ValueError("these folders hold all tickers; run without one")
    use_utc(spark)
    clean = cut_lineage(clean_bars(read_bars(spark, lake.bronze, BRONZE, ticker)), "clean-bars")
    silver = cut_lineage(add_indicators(clean, ["is_outlier", *INDICATORS]), "silver")
    report = cut_lineage(quality_report(silver), "quality")
    write_report(report, lake.quality)
    if fail_on_critical:
        stop_on_critical(report)
    write_bars(silver, lake.silver, mode="overwrite", partition_by=lake.partition_by)
    return report


def silver_to_gold(spark: SparkSession, lake: Lake) -> None:
    """Star schema over all tickers.  Known tickers keep their ids from run to run."""
    use_utc(spark)
    silver = read_bars(spark, lake.silver, SILVER)
    try:
        known = cut_lineage(spark.read.schema(DIM_TICKER).parquet(lake.gold("dim_ticker")), "known-tickers")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        known = None
    tickers = cut_lineage(dim_ticker(silver, known), "dim-ticker")
    write_table(tickers, lake.gold("dim_ticker"))
    write_table(dim_date(silver.filter("bar_interval = '1d'")), lake.gold("dim_date"))
    write_table(dim_market_session(spark), lake.gold("dim_market_session"))
    write_table(fact_prices(silver, tickers), lake.gold("fact_stock_prices"), ("ticker_id", "date_id"))


def run_increment(spark: SparkSession, lake: Lake, arrived: DataFrame, name: str | None = None, stop: bool = True) -> DataFrame:
    """Newly landed bronze bars to silver and gold in one release; returns the quality report of the new rows.

    Series that only go on are continued from their stored state, so a run reads the new bars and one row per series, and silver grows
    by a part.  Tickers with corrected or late bars are computed anew from bronze, which holds the new bars too, and silver is
    then written whole.  Gold is built from silver.  All tables, the state and the report become visible together, and with
    ``stop`` only if no critical rule failed.
    """
    use_utc(spark)
    root = f"{lake.root}/releases"
    new = release.Release(spark, root, name or run_id("increment"))
    state, before = release.read(spark, root, "state"), release.read(spark, root, "silver")
    columns = SILVER.fieldNames()
    clean = cut_lineage(clean_bars(arrived), "clean-bars")
    again = None
    if state is None:
        silver, ends = continue_indicators(clean)
    else:
        later, late = split_late(clean, state)
        again = cut_lineage(late.select("ticker").distinct(), "late-tickers")
        silver, ends = continue_indicators(cut_lineage(later.join(again, "ticker", "left_anti"), "later-bars"), state)
        if again.limit(1).count():
            whole = cut_lineage(clean_bars(read_bars(spark, lake.bronze, BRONZE)).join(again, "ticker", "left_semi"), "whole-series")
            redone, fresh = continue_indicators(whole)
            silver = silver.unionByName(redone)
            ends = ends.join(again, "ticker", "left_anti").unionByName(fresh)
        else:
            again = None
    report = new.add("quality", quality_report(silver))
    new.add("state", ends)
    if again is None:
        stored = new.extend("silver", silver.select(*columns), ("ticker", "window_start"))
    else:
        kept = before.join(again, "ticker", "left_anti").select(*columns)
        stored = new.add("silver", kept.unionByName(silver.select(*columns)), ("ticker", "window_start"))
    tickers = new.add("dim_ticker", dim_ticker(stored, release.read(spark, root, "dim_ticker")))
    new.add("dim_date", dim_date(stored.filter("bar_interval = '1d'")))
    new.add("dim_market_session", dim_market_session(spark))
    new.add("fact_stock_prices", fact_prices(stored, tickers), ("ticker_id", "date_id"))
    new.publish(lambda: not stop or not report.filter("not pass and severity = 'CRITICAL'").limit(1).count())
    return report


def load_gold(spark: SparkSession, lake: Lake, upsert_table) -> dict[str, int]:
    """Upsert the gold tables in key order through ``upsert_table(df, name, keys)``; row counts."""
    counts = {}
    for name, keys in LOAD_ORDER:
        seen = Observation(name)
        rows = nan_to_null(spark.read.parquet(lake.gold(name))).observe(seen, F.count(F.lit(1)).alias("rows"))
        upsert_table(rows, name, keys)
        counts[name] = seen.get["rows"]
    return counts
