"""Releases: all tables of a run become visible together, by one appended file of pointers.

Tables are plain Parquet folders of their own for every run.  A run writes them aside, looks at what it wrote, and only then
appends one small file that names them; Spark moves that file into place at once.  Readers take the newest pointers.  A run
that dies before has shown nothing, and what it left is never read.  A table may have several parts, so a run can
add rows without writing the old ones again; a run that finds many parts writes them as one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTERS = "sequence long, run string, name string, path string"
#: Parts of a table beyond which ``extend`` writes it as one.
PARTS = 16


class Release:
    """Tables a run has written and not shown yet."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root, run
        self.paths: dict[str, list[str]] = {}

    def add(self, name: str, df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
        """Write a table aside and read it back; ``order_by`` makes its files ranges of these columns."""
        path = f"{self.root}/runs/{self.run}/{name}"
        if order_by:
            df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        df.write.parquet(path)
        self.paths[name] = [path]
        return self.spark.read.schema(df.schema).parquet(path)

    def extend(self, name: str, df: DataFrame, order_by: Sequence[str] = (), parts: int = PARTS) -> DataFrame:
        """Add rows to the table of the release before; returns the whole table."""
        old = current(self.spark, self.root).get(name, [])
        if len(old) >= parts:
            return self.add(name, self.spark.read.schema(df.schema).parquet(*old).unionByName(df), order_by)
        self.add(name, df, order_by)
        self.paths[name] = [*old, *self.paths[name]]
        return self.spark.read.schema(df.schema).parquet(*self.paths[name])

    def publish(self, audit: Callable[[], bool] = lambda: True) -> bool:
        """Show all tables at once if ``audit`` says so; otherwise the release before stays."""
        if not audit():
            return False
        last = last_sequence(self.spark, self.root)
        rows = [(last + 1, self.run, name, path) for name, paths in self.paths.items() for path in paths]
        self.spark.createDataFrame(rows, POINTERS).coalesce(1).write.mode("append").parquet(f"{self.root}/pointers")
        return True


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(POINTERS).parquet(f"{root}/pointers")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], POINTERS)


def last_sequence(spark: SparkSession, root: str) -> int:
    """Number of the newest release; 0 if there is none."""
    return _pointers(spark, root).agg(F.max("sequence").alias("n")).first()["n"] or 0


def current(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Paths of the newest release by table name; of two runs with one number the later name wins.  A few rows."""
    rows = _pointers(spark, root)
    newest = rows.agg(F.max(F.struct("sequence", "run")).alias("top")).first()["top"]
    paths: dict[str, list[str]] = {}
    if newest is not None:
        for r in rows.filter((F.col("sequence") == newest["sequence"]) & (F.col("run") == newest["run"])).orderBy("name", "path").collect():
            paths.setdefault(r["name"], []).append(r["path"])
    return paths


def read(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table in the newest release, or None."""
    paths = current(spark, root).get(name)
    return spark.read.parquet(*paths) if paths else None
