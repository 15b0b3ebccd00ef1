"""Relational sinks and reads over JDBC (the driver jar comes with the cluster)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators.clean import latest_per_key
from tickloom.operators.upsert import on_conflict_sql, with_retry


def read_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def append_rows(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Plain insert, for append-only tables."""
    with_retry(lambda: df.write.format("jdbc").mode("append")
               .options(url=url, dbtable=table, **options).save())


def upsert_rows(
    df: DataFrame, url: str, table: str, keys: Sequence[str], run_sql: Callable[[str], None],
    newest_by: Sequence[str] = (), **options: str,
) -> None:
    """Executors load a staging table in parallel; one statement then merges it.

    No row passes through the driver.  ``run_sql`` executes a statement on the database.  A failed
    attempt repeats as a whole: the staging table is overwritten and the merge is idempotent.
    """
    staging = f"{table}_staging"
    rows = latest_per_key(df, keys, newest_by)

    def attempt() -> None:
        rows.write.format("jdbc").mode("overwrite").options(url=url, dbtable=staging, **options).save()
        run_sql(on_conflict_sql(table, staging, df.columns, keys))

    with_retry(attempt)
