"""Size checks: what may be broadcast, and which keys are too large for one task."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A broadcast side must stay below both limits.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one key that a single task may sort.
GROUP_ROWS = 4_000_000

# Quantiles of a hot key's order, among which its chunks' bounds are chosen, and bounds that a look-up skips at a time.
QUANTILES = 1024
STRIDE = 32


def _column_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        return F.lit(8)
    return F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (rows and bytes) in one pass that sends two numbers per task."""
    size = reduce(operator.add, [_column_bytes(field).cast("bigint") for field in df.schema])
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def floor_div(value: Column, width: int) -> Column:
    """Exact integer floor division; ``/`` would go through a double."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width)).cast("bigint")


def hot_keys(df: DataFrame, key: str, group_rows: int = GROUP_ROWS, order: str | None = None) -> DataFrame:
    """Keys with more than ``group_rows`` rows, as ``_hot_key``.

    With ``order``, a number of any type, also the bounds (``_bounds``, and every
    ``STRIDE``-th of them as ``_top``) that cut a key's rows into chunks of about
    ``group_rows``, however its numbers lie: they are quantiles of the rows, from
    mergeable summaries of the hot keys only. The counts are combined before the
    shuffle, at most ``rows / group_rows`` keys can qualify, and all of them
    together have about ``rows / group_rows`` bounds, which bounds the broadcast.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot_key")).agg(F.count("*").alias("_hot_rows"))
    hot = counts.where(F.col("_hot_rows") > group_rows)
    if order is None:
        return hot.select("_hot_key")
    rows = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key")).select("_hot_key", "_hot_rows", F.col(order).alias("_at"))
    cuts = F.percentile_approx("_at", [i / QUANTILES for i in range(1, QUANTILES)], 8 * QUANTILES)
    found = rows.groupBy("_hot_key").agg(F.max("_hot_rows").alias("_hot_rows"), cuts.alias("_cuts"))
    chunks = F.call_function("div", F.col("_hot_rows") + F.lit(group_rows - 1), F.lit(group_rows))
    chunk_at = lambda i: F.call_function("div", i * chunks, F.lit(QUANTILES))
    found = found.withColumn("_bounds", F.array_distinct(F.filter("_cuts", lambda _, i: chunk_at(i + 1) > chunk_at(i))))
    return found.select("_hot_key", "_bounds", F.filter("_bounds", lambda _, i: (i + 1) % STRIDE == 0).alias("_top"))


def chunk_of(order: str) -> Column:
    """The chunk of a row of a hot key, the number of bounds up to it; needs ``_bounds`` and ``_top``."""
    upto = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col(order)))
    above = upto("_top") * STRIDE
    return (above + upto(F.slice("_bounds", above + 1, F.lit(STRIDE)))).cast("bigint")


def with_chunk(df: DataFrame, key: str, order: str, hot: DataFrame) -> DataFrame:
    """Add ``_chunk``, an order-contiguous chunk number that splits hot keys only.

    Cold keys keep chunk 0. ``hot`` comes from :func:`hot_keys` with ``order``.
    """
    return (
        df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_chunk", F.coalesce(chunk_of(order), F.lit(0).cast("bigint")))
        .drop(*hot.columns)
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    spread: str,
    needs: Column | None = None,
    group_rows: int = GROUP_ROWS,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join to ``lookup`` (one row per ``key``), safe for hot keys.

    A lookup of checked size is broadcast and ``df`` is not shuffled. A larger
    one is shuffled on (key, salt): rows of hot keys take their value from a
    bounded broadcast instead, and they, like the rows that do not ``need`` a
    value, get a salt from ``spread`` so that no task receives them together.
    """
    values = [c for c in lookup.columns if c != key]
    if fits_broadcast(lookup, max_rows, max_bytes):
        return df.join(F.broadcast(lookup), key, "left")

    needs = F.lit(True) if needs is None else needs
    hot = hot_keys(df.where(needs), key, group_rows)
    packed = lookup.select(F.col(key).alias("_lookup_key"), F.struct(*values).alias("_cold_value"))
    hot_values = packed.join(F.broadcast(hot), F.col("_lookup_key") == F.col("_hot_key"), "right").select(
        "_hot_key", F.col("_cold_value").alias("_hot_value")
    )
    tagged = df.join(F.broadcast(hot_values), F.col(key) == F.col("_hot_key"), "left")
    shuffled = needs & F.col("_hot_key").isNull() & F.col(key).isNotNull()
    salt = F.when(shuffled, F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.lit(1 << 20)) + 1)
    joined = tagged.withColumn("_salt", salt.cast("bigint")).join(
        packed.withColumn("_lookup_salt", F.lit(0).cast("bigint")),
        (F.col(key) == F.col("_lookup_key")) & (F.col("_salt") == F.col("_lookup_salt")),
        "left",
    )
    value = F.coalesce(F.col("_hot_value"), F.col("_cold_value"))
    return joined.select(*df.columns, *[value[c].alias(c) for c in values])
