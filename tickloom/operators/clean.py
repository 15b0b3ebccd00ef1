"""Cleaning of landed bars: null and type rules, latest copy wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BAR_KEY = ("ticker", "bar_interval", "window_start")
_PRICES = ("open", "high", "low", "close", "vwap")


def enforce_types(bars: DataFrame) -> DataFrame:
    casts = {c: F.col(c).try_cast("double") for c in _PRICES if c in bars.columns}
    return bars.withColumns({**casts, "volume": F.col("volume").try_cast("long")})


def drop_incomplete(bars: DataFrame) -> DataFrame:
    return bars.dropna(subset=["ticker", "close", "volume", "window_start"])


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = BAR_KEY, newest_by: Sequence[str] = ("ingested_at", "batch_id")
) -> DataFrame:
    """One row per key: the newest, ties settled by the remaining columns.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so a key with very many
    copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    if not rest and not newest_by:
        return df.distinct()
    newest = [F.col(c).desc_nulls_last() for c in (*newest_by, *rest)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def clean_bars(bars: DataFrame) -> DataFrame:
    return latest_per_key(drop_incomplete(enforce_types(bars)))
