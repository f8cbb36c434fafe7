"""Folding a change stream into its current rows (STA5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``.

    Spark keeps one row per key and task before the shuffle
    (``WindowGroupLimit``), so a hot key moves one row per task.
    """
    latest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def fold_changes(df: DataFrame, keys: list[str], order: list[str], deleted: Column) -> DataFrame:
    """STA5: current rows: the last change per key, without deleted keys."""
    return latest_per_key(df, keys, order).where(~F.coalesce(deleted, F.lit(False)))
