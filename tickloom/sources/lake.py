"""Bronze, silver and gold tables as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITIONS = ("date", "ticker")
#: Coarser folders, made from the start of a bar: a daily bar is one row a day, and folders of a day hold hardly more.
PERIODS = {"month": "yyyy-MM", "year": "yyyy"}


def write_bars(
    bars: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = PARTITIONS
) -> None:
    """Land bars.  The rebalance hint lets AQE merge small and split large output partitions, so a
    run writes few files per folder.  ``mode="overwrite"`` replaces only the folders it writes.

    With thousands of tickers use ``("date",)`` for minute bars and ``("month",)`` or ``("year",)`` for daily ones: rows are
    sorted by ticker inside the files, and Parquet statistics then prune a ticker filter.
    """
    made = {p: F.date_format("window_start", PERIODS[p]) for p in partition_by if p in PERIODS}
    (
        bars.withColumns(made).hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, "ticker", "window_start")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_bars(
    spark: SparkSession, path: str, schema: StructType, ticker: str | None = None
) -> DataFrame:
    """Bars of one ticker (a partition filter) or of all.  The schema is explicit because folder
    names would otherwise be read back as numbers for all-digit tickers."""
    bars = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return bars.filter(F.col("ticker") == ticker.upper()) if ticker else bars


def write_table(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Replace a whole gold table.  With ``order_by`` files hold ranges of these columns, so that a filter on the first
    skips files and row groups by their statistics."""
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def append_ticks(ticks: DataFrame, path: str) -> None:
    """Ticks as JSON lines."""
    ticks.write.mode("append").json(path)
