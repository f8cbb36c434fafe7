"""Intermediate tables in the shared folder: they cut lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import shared_folder

#: A side of a join is sent to all executors only if it was measured to have at most this many narrow rows.
BROADCAST_ROWS = 300_000


_MADE: dict[str, list[str]] = {}


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and read them back."""
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    _MADE.setdefault(frame.sparkSession.sparkContext.applicationId, []).append(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application has stored so far; returns how many.

    Results are lazy and read them: call it once what is needed has been written.
    """
    paths = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def small_or_shuffled(narrow: DataFrame) -> DataFrame:
    """Mark a stored table of a few numbers a row for broadcast if it is measured to be small."""
    return F.broadcast(narrow) if narrow.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else narrow


def partitions_for(frame: DataFrame, column: str, each: int) -> tuple[int, int]:
    """The bytes in a text column and the number of partitions that hold about ``each`` of them."""
    total = frame.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
    return total, max(8, -(-total // each))
