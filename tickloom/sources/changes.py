"""Upserts merged on read: a batch writes its own rows only, and readers take the newest row of each key.

A table has rows that are unique by key, and parts of later changes, one a batch.  Every batch shows its part by
a release of its own, so readers see whole batches.  Packing turns the changes into one part; once they are a fair share of the
rows it merges them into these.  It shows its result by a release too: a reader gets the table before or after it, with the same rows.

Keys are compared as values, so rows with a null in a key are rows of one key.  A batch has all columns of the table.  One
writer per root; a batch that is repeated after a death changes nothing.  Old parts stay for the cluster's retention.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.clean import latest_per_key
from tickloom.sources.release import PARTS, Release, current, last_sequence

CHANGES = "_changes"
#: Column of a change: the number of the release that brought it.
CHANGE_NO = "change_no"
#: Changes, as a share of the rows, from which packing rewrites the rows.
SHARE = 0.25


def append_changes(
    batch: DataFrame, root: str, name: str, keys: Sequence[str], newest_by: Sequence[str] = (), parts: int = PARTS
) -> None:
    """Upsert a batch by writing its newest row per key; packs once there are ``parts`` parts of changes.

    An empty batch shows nothing.
    """
    spark = batch.sparkSession
    shown = current(spark, root)
    _check_columns(spark, shown, name, batch)
    new = _release(spark, root, shown)
    number = last_sequence(spark, root) + 1
    rows = latest_per_key(batch, list(keys), newest_by).withColumn(CHANGE_NO, F.lit(number).cast("long"))
    if new.extend(name + CHANGES, rows, parts=parts + 1).filter(F.col(CHANGE_NO) == number).isEmpty():
        return
    new.publish()
    if len(new.paths[name + CHANGES]) >= parts:
        pack(spark, root, name, keys)


def read_merged(spark: SparkSession, root: str, name: str, keys: Sequence[str]) -> DataFrame | None:
    """The newest row of each key, or None if there is no table.

    The rows are not shuffled while the changes are small enough for the planner to broadcast their keys.
    """
    return _merged(spark, current(spark, root), name, list(keys))


def pack(spark: SparkSession, root: str, name: str, keys: Sequence[str], share: float = SHARE) -> None:
    """Make one part of the changes, or merge them into the rows if they are ``share`` of these."""
    keys, shown = list(keys), current(spark, root)
    if name + CHANGES not in shown:
        return
    changes = spark.read.parquet(*shown[name + CHANGES])
    new = _release(spark, root, shown)
    if name not in shown or changes.count() >= share * spark.read.parquet(*shown[name]).count():
        new.add(name, _merged(spark, shown, name, keys), keys)
        del new.paths[name + CHANGES]
    else:
        new.add(name + CHANGES, latest_per_key(changes, keys, (CHANGE_NO,)), keys)
    new.publish()


def _release(spark: SparkSession, root: str, shown: dict[str, list[str]]) -> Release:
    """A release that keeps all tables as they are; its folder is new however often a batch is repeated."""
    new = Release(spark, root, uuid.uuid4().hex)
    new.paths.update({name: list(paths) for name, paths in shown.items()})
    return new


def _merged(spark: SparkSession, shown: dict[str, list[str]], name: str, keys: list[str]) -> DataFrame | None:
    rows = spark.read.parquet(*shown[name]) if name in shown else None
    if name + CHANGES not in shown:
        return rows
    changes = spark.read.parquet(*shown[name + CHANGES])
    newest = latest_per_key(changes, keys, (CHANGE_NO,)).drop(CHANGE_NO)
    if rows is None:
        return newest
    # keys straight from the files, so that the planner knows their size
    hit = changes.select(F.struct(*keys).alias("_hit"))
    return rows.join(hit, F.struct(*[rows[k] for k in keys]) == F.col("_hit"), "left_anti").unionByName(newest)


def _check_columns(spark: SparkSession, shown: dict[str, list[str]], name: str, batch: DataFrame) -> None:
    stored = shown.get(name + CHANGES) or shown.get(name)
    if stored:
        columns = set(spark.read.parquet(stored[0]).columns) - {CHANGE_NO}
        if columns != set(batch.columns):
            raise ValueError(f"columns of {name} are {sorted(columns)}, the batch has {sorted(batch.columns)}")
