"""Model inputs from the price fact: load, split by time, scale, look back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.numeric import finite_or_null, ratio
from tickloom.operators.ordered import block_window, into_blocks, own_rows, with_positions
from tickloom.schemas import FEATURES, TARGET
from tickloom.session import measured

# Split ratios and sequence length.
TRAIN_RATIO, VALIDATION_RATIO = 0.70, 0.15
SEQUENCE_ROWS = 30


def nan_to_null(fact: DataFrame) -> DataFrame:
    doubles = [f.name for f in fact.schema.fields if f.dataType.simpleString() == "double"]
    return fact.withColumns({c: finite_or_null(F.col(c)) for c in doubles})


def _known(name: str):
    """Neither NULL nor NaN nor infinite; NaN compares greater than every number."""
    return F.abs(F.col(name).cast("double")) < F.lit(float("inf"))


def load_training_rows(fact: DataFrame) -> DataFrame:
    """Rows with a target and all features; rows without are the series' edges.

    A plain filter on the stored columns: it reaches the scan, and rewriting the columns first
    would make the optimizer reason about twenty rewritten expressions in every later join.
    """
    rows = fact.filter(_known(TARGET))
    for name in FEATURES:
        rows = rows.filter(_known(name))
    return rows


def load_counts(fact: DataFrame) -> DataFrame:
    """How many rows each step of ``load_training_rows`` drops, in one pass."""
    no_target = ~F.coalesce(_known(TARGET), F.lit(False))
    complete = ~no_target
    for name in FEATURES:
        complete = complete & F.coalesce(_known(name), F.lit(False))
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(no_target).alias("null_target"),
        F.count_if(~no_target & ~complete).alias("null_features"),
        F.count_if(complete).alias("kept_rows"),
    )


def _year():
    return F.expr("date_id div 10000")


def time_split(
    rows: DataFrame, train: float = TRAIN_RATIO, validation: float = VALIDATION_RATIO
) -> DataFrame:
    """Label each ticker's rows train, validation or test in time order, without a shuffle of time."""
    placed = with_positions(rows, ["ticker_id"], ["date_id"], _year())
    n = F.col("series_rows")
    label = (
        F.when(F.col("pos") <= F.floor(n * train), "train")
        .when(F.col("pos") <= F.floor(n * (train + validation)), "validation")
        .otherwise("test")
    )
    return placed.withColumn("split", label).drop("pos", "series_rows")


def scale_features(split: DataFrame, features: Sequence[str] = FEATURES, with_close: bool = False) -> DataFrame:
    """Standard score with mean and population deviation of the ticker's training rows.

    A constant feature is only centred.  The statistics, one row per ticker, are computed first.  ``with_close`` adds
    ``raw_close`` and ``close_unit``, the close as it was and its deviation (1 if there is none).
    """
    stats = measured(split.filter("split = 'train'").groupBy("ticker_id").agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in features],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in features],
    ), "feature-stats")
    scaled = {
        c: ratio(F.col(c) - F.col(f"_mean_{c}"),
                 F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}")))
        for c in features
    }
    extra = {}
    if with_close:
        unit = F.col("_std_close")
        extra = {"raw_close": F.col("close"), "close_unit": F.when(unit > 0, unit).otherwise(F.lit(1.0))}
    # nulls in the key are one ticker
    joined = split.join(stats.withColumnRenamed("ticker_id", "_ticker"), F.col("ticker_id").eqNullSafe(F.col("_ticker")), "left")
    return joined.withColumns(extra).withColumns(scaled).select(*split.columns, *extra)


def lookback_sequences(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    length: int = SEQUENCE_ROWS,
    keys: Sequence[str] = ("ticker_id",),
) -> DataFrame:
    """For each row the features of the ``length`` rows before it, oldest first, and its target.

    The first ``length`` rows of a series have no full history and give no sequence.
    """
    placed = with_positions(rows, keys, ["date_id"], _year())
    before = block_window(keys).rowsBetween(-length, -1)
    step = F.array(*[F.col(c).cast("double") for c in features])
    blocks = into_blocks(placed, back=length).withColumn("sequence", F.collect_list(step).over(before))
    return own_rows(blocks).filter(F.col("pos") > length).select(*keys, "date_id", "sequence", TARGET)
