"""Two-step event patterns per key (STA8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators.sizes import floor_div

# Fixed value: longest gap between the two entry pages of a jump-out.
JUMP_OUT_MS = 10 * 1000

# Time buckets are this many gaps wide, so at most one row in 60 is sent twice.
GAPS_PER_BUCKET = 60


def match_next(
    df: DataFrame,
    first: Column,
    second: Column,
    within_ms: int = JUMP_OUT_MS,
    key: str = "mid",
    ts: str = "ts",
    order: str = "seq",
    columns: list[str] | None = None,
    bucket_ms: int | None = None,
) -> DataFrame:
    """Pairs ``(first, second)`` of a key's directly adjacent events in event-time order.

    ``first`` and ``second`` are conditions on a row; the pair's time gap is
    below ``within_ms``. Ties in ``ts`` are broken by ``order``; pairs may
    overlap. Output: the key and the two rows as structs of ``columns``.

    A match lies within one gap, so the rows are grouped by (key, time bucket)
    and a bucket also gets the rows of the next bucket's first ``within_ms``.
    A hot key is thereby spread over its buckets in a single shuffle, and rows
    that meet neither condition travel without their columns.
    """
    paired = _with_next(df, first, second, within_ms, key, ts, order, columns, bucket_ms)
    hit = F.col("_is_first") & F.col("_next_is_second") & (F.col("_next_ts") - F.col("_ts") < within_ms)
    return paired.where(hit).select(key, F.col("_row").alias("first"), F.col("_next_row").alias("second"))


def match_timeouts(
    df: DataFrame,
    first: Column,
    within_ms: int = JUMP_OUT_MS,
    key: str = "mid",
    ts: str = "ts",
    order: str = "seq",
    columns: list[str] | None = None,
    bucket_ms: int | None = None,
) -> DataFrame:
    """Extension of STA8: rows that meet ``first`` and that no row of the key follows in less than ``within_ms``.

    They are the partial matches that run out of time; a row whose next one comes in time, but does not meet the second
    condition, is none. Output: the key and the row as struct ``first``. Plan as in :func:`match_next`.
    """
    paired = _with_next(df, first, F.lit(False), within_ms, key, ts, order, columns, bucket_ms)
    alone = F.col("_next_ts").isNull() | (F.col("_next_ts") - F.col("_ts") >= within_ms)
    return paired.where(F.col("_is_first") & alone).select(key, F.col("_row").alias("first"))


def _with_next(
    df: DataFrame, first: Column, second: Column, within_ms: int, key: str, ts: str, order: str, columns: list[str] | None, bucket_ms: int | None
) -> DataFrame:
    """Every row beside the next one of its key, if that comes in less than ``within_ms`` or in the same bucket."""
    columns = columns or [c for c in df.columns if c != key]
    bucket_ms = bucket_ms or within_ms * GAPS_PER_BUCKET
    if bucket_ms < within_ms:
        raise ValueError("bucket_ms must not be below within_ms")

    bucket = floor_div(F.col(ts), bucket_ms)
    early = F.pmod(F.col(ts), F.lit(bucket_ms)) < within_ms
    kept = F.coalesce(first, F.lit(False)) | F.coalesce(second, F.lit(False))
    rows = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key),
        F.col(ts).alias("_ts"),
        F.col(order).alias("_order"),
        F.coalesce(first, F.lit(False)).alias("_is_first"),
        F.coalesce(second, F.lit(False)).alias("_is_second"),
        F.when(kept, F.struct(*columns)).alias("_row"),
        bucket.alias("_own"),
        F.explode(F.when(early, F.array(bucket, bucket - 1)).otherwise(F.array(bucket))).alias("_bucket"),
    )

    ahead = W.partitionBy(key, "_bucket").orderBy("_ts", "_order")
    paired = rows.withColumns(
        {
            "_next_ts": F.lead("_ts").over(ahead),
            "_next_is_second": F.lead("_is_second").over(ahead),
            "_next_row": F.lead("_row").over(ahead),
        }
    )
    return paired.where(F.col("_bucket") == F.col("_own"))
