"""Daily price history files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.functions.numeric import rnd
from tickloom.operators.validate import require_columns
from tickloom.schemas import DAILY_HISTORY
from tickloom.session import cut_lineage

# Vendor column names and ours.
VENDOR_COLUMNS = {
    "Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close",
    "Volume": "volume",
}


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """History with the declared schema: no inference pass, and tickers like ``0700`` stay text."""
    reader = spark.read.schema(DAILY_HISTORY)
    if fmt == "csv":
        # column names are checked against the header, so a reordered file is an error, not a mix-up
        frame = reader.option("header", True).option("enforceSchema", False).csv(path)
    elif fmt == "parquet":
        require_columns(spark.read.parquet(path), DAILY_HISTORY.fieldNames())
        frame = reader.parquet(path)
    else:
        raise ValueError(f"unknown history format {fmt!r}")
    return require_columns(frame, DAILY_HISTORY.fieldNames())


def read_history_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """History from CSV files as (rows, rejects): together they are all lines of the files, headers and blank lines apart.

    A reject is the line's text ``raw`` and ``failed``, the columns whose text is not of their type, or ``line`` if the
    number of cells is wrong.  Lines are parsed once and stored, so both frames come from the same reading.
    """
    names = DAILY_HISTORY.fieldNames()
    reader = spark.read.schema(StructType([*DAILY_HISTORY.fields, StructField("_raw", StringType())]))
    parsed = cut_lineage(
        reader.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_raw").csv(path), "history")
    text = F.from_csv("_raw", ", ".join(f"`{n}` string" for n in names), {"mode": "PERMISSIVE"})
    bad = [F.when(F.col(n).isNull() & F.col("_text")[n].isNotNull(), F.lit(n)) for n in names]
    rejects = parsed.filter("_raw is not null").withColumn("_text", text).select(
        F.col("_raw").alias("raw"), F.coalesce(F.nullif(F.concat_ws(",", *bad), F.lit("")), F.lit("line")).alias("failed"))
    return parsed.filter("_raw is null").select(*names), rejects


def normalise_history(vendor: DataFrame, ticker: str | None, source: str, zone: str = "UTC") -> DataFrame:
    """Vendor rows -> history rows: our names, UTC time, 4 decimals, whole shares.

    ``ticker`` stamps a one-symbol download; None keeps the ``ticker`` column of the input.
    """
    frame = vendor.withColumnsRenamed(VENDOR_COLUMNS)
    symbol = F.upper(F.lit(ticker)) if ticker else F.col("ticker")
    return frame.select(
        symbol.alias("ticker"),
        F.to_utc_timestamp("date", zone).alias("date"),
        *[rnd(F.col(c), 4).alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").try_cast("long").alias("volume"),
        F.lit(source).alias("source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"),
    )


def write_history(history: DataFrame, folder: str) -> None:
    """The same rows as CSV and as Parquet."""
    history.write.mode("overwrite").option("header", True).csv(f"{folder}/csv")
    history.write.mode("overwrite").parquet(f"{folder}/parquet")
