"""Idempotent upserts."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tickloom.operators.clean import latest_per_key
from tickloom.session import shared_dir

log = logging.getLogger(__name__)
Result = TypeVar("Result")


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()
) -> DataFrame:
    """Target after ``INSERT .. ON CONFLICT (keys) DO UPDATE``; applying it twice changes nothing.

    Columns missing from ``updates`` keep the target's value.  If ``updates`` has nothing but keys,
    existing rows stay (``DO NOTHING``).  Keys are unique on both sides of the join once the
    updates are reduced to one row per key, so no key is hot.
    """
    keys = list(keys)
    unique = latest_per_key(updates, keys, newest_by)
    changed = [c for c in updates.columns if c not in keys]
    if not changed:
        return insert_missing(target, unique, keys)
    new = unique.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in changed],
                        F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "full_outer")
    out = []
    for name in target.columns:
        if name in changed:
            out.append(F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return joined.select(*out)


def insert_missing(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after ``INSERT .. ON CONFLICT (keys) DO NOTHING``."""
    fresh = latest_per_key(updates, keys, ()).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


#: Hidden file in a table's folder: where the merged rows lie that are being put in place.
PENDING = "_merged_rows"


def upsert_partitions(
    updates: DataFrame, path: str, keys: Sequence[str], partition: str, newest_by: Sequence[str] = ()
) -> None:
    """Upsert into a Parquet table partitioned by ``partition``, which must depend on the keys.

    Only partitions that receive rows are read and replaced; columns the updates lack keep their values, and
    columns the table lacks are added.  The merged rows are written to the shared folder and noted beside the table
    before anything is replaced.  A run that dies while replacing is finished from that copy by the next one, so
    no partition is lost; the work folders go once the rows are in place.
    """
    spark = updates.sparkSession
    finish_pending(spark, path, partition)
    work = shared_dir(spark, "upsert")
    updates.write.parquet(f"{work}/updates")
    incoming = spark.read.schema(updates.schema).parquet(f"{work}/updates")
    stored = _stored(spark, path, incoming, partition)
    if stored is None:
        merged = latest_per_key(incoming, list(keys), newest_by)
    else:
        current = touched_partitions(stored, incoming, partition)
        new = [f for f in incoming.schema.fields if f.name not in current.columns]
        merged = upsert(current.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new}), incoming, keys, newest_by)
    merged.write.parquet(f"{work}/merged")
    _write_note(spark, path, work)
    finish_pending(spark, path, partition)


def finish_pending(spark: SparkSession, path: str, partition: str) -> None:
    """Put noted rows in place: the same however often it is done."""
    work = _read_note(spark, path)
    if work is None:
        return
    merged = spark.read.parquet(f"{work}/merged")
    (
        merged.hint("rebalance", partition).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    )
    for old in (f"{path}/{PENDING}", work):
        _file_system(spark, old).delete(_hadoop_path(spark, old), True)


def _stored(spark: SparkSession, path: str, incoming: DataFrame, partition: str) -> DataFrame | None:
    """The table with its own columns; folder names take the type the updates have.  None if there is no table yet."""
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or one without rows
            return None
        raise
    kinds = [StructField(f.name, incoming.schema[partition].dataType if f.name == partition else f.dataType) for f in schema.fields]
    return spark.read.schema(StructType(kinds)).parquet(path)


def touched_partitions(stored: DataFrame, incoming: DataFrame, partition: str) -> DataFrame:
    """Rows of ``stored`` in the partitions that ``incoming`` has rows for.

    The range of the values prunes folders before anything is read; the join with the distinct values decides.
    """
    values = incoming.select(F.col(partition).alias("_value")).distinct()
    ends = incoming.agg(F.min(partition).alias("low"), F.max(partition).alias("high")).first()
    inside = F.col(partition).isNull() | F.col(partition).between(F.lit(ends["low"]), F.lit(ends["high"]))
    return stored.filter(inside).join(values, F.col(partition).eqNullSafe(F.col("_value")), "left_semi")


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _write_note(spark: SparkSession, path: str, text: str) -> None:
    note = f"{path}/{PENDING}"
    out = _file_system(spark, note).create(_hadoop_path(spark, note), True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_note(spark: SparkSession, path: str) -> str | None:
    note = f"{path}/{PENDING}"
    files = _file_system(spark, note)
    if not files.exists(_hadoop_path(spark, note)):
        return None
    stream = files.open(_hadoop_path(spark, note))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def on_conflict_sql(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """The statement that moves a staging table into ``table`` inside the database."""
    names = ", ".join(columns)
    changed = [c for c in columns if c not in keys]
    action = "UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in changed) if changed else "NOTHING"
    return (
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO {action}"
    )


def with_retry(
    action: Callable[[], Result], attempts: int = 3, sleep: Callable[[float], None] = time.sleep
) -> Result:
    """Run a sink action, waiting 2, 4, .. seconds between attempts; the last error is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if attempt == attempts:
                raise
            log.warning("attempt %d of %d failed: %s", attempt, attempts, error)
            sleep(2.0 ** attempt)
    raise AssertionError("attempts must be positive")
