"""Ranks and running totals of rows without sorting a large group in one task.

A radix directory has one level for every ten bits of an integer key. A level holds the total of each prefix, and what
comes before a prefix among the at most 1024 that share the next shorter one. The sum of those along a key's prefixes is
the total of all smaller keys, so no window ever sees more than 1025 rows, whatever the keys and however large the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.store import stored

FAN_BITS = 10
#: Rows of one group that a single window may sort.
WINDOW_ROWS = 20_000
_SIGN = -(1 << 63)


def _levels(counts: DataFrame, key: str) -> int:
    low, high = counts.agg(F.min(key), F.max(key)).first()
    return 1 if low is None else max(1, -(-((low ^ high) & ((1 << 64) - 1)).bit_length() // FAN_BITS))


def running_totals(counts: DataFrame, group: list[str], key: str, weight: str, out: str = "before") -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the rows of the same group that have a smaller ``key``; null keys come first.

    ``counts`` has one row for each group and key (a long, of any sign) and should be a stored table, since each level
    reads it. Columns of the group must not be null. An empty table stays empty.
    """
    order = F.col(key).bitwiseXOR(F.lit(_SIGN))
    last = _levels(counts, key) - 1

    def prefix(level: int) -> Column:
        # A shift by 64 bits or more would be taken modulo 64; nothing is left of the key then.
        shifted = F.shiftrightunsigned(order, FAN_BITS * level) if FAN_BITS * level < 64 else F.when(order.isNotNull(), F.lit(0))
        return F.coalesce(shifted if level else order, F.lit(-1)).cast("long")

    def earlier(within: list[str]) -> Column:
        rows = Window.partitionBy(*within).orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(weight).over(rows), F.lit(0)).cast("long")

    directory = None
    for level in range(last, -1, -1):
        known = F.col(key).isNotNull()
        digit = F.when(known, F.col("_prefix").bitwiseAND(F.lit((1 << FAN_BITS) - 1))).otherwise(F.lit(-1))
        rows = counts.withColumns({"_prefix": prefix(level), "_upper": prefix(level + 1)}).withColumn("_digit", digit)
        if level:
            rows = rows.groupBy(*group, "_prefix", "_upper", "_digit").agg(F.sum(weight).alias(weight))
        if directory is None:
            rows = rows.withColumn(out, earlier(group))
        else:
            above = directory.select(*group, F.col("_prefix").alias("_upper"), F.col(out).alias("_above"))
            rows = rows.withColumn("_here", earlier([*group, "_upper"])).join(above, [*group, "_upper"])
            rows = rows.withColumn(out, F.col("_above") + F.col("_here"))
        directory = rows.select(*group, "_prefix", out) if level else rows.select(*counts.columns, out)
    return directory


def tie_offsets(tied: DataFrame, group: list[str], keys: list[str], out: str = "offset") -> DataFrame:
    """Add ``out``, the number of rows of the same group that are smaller by ``keys``, compared one after the other.

    The last key must tell all rows of a group apart. Keys are longs that are not null, groups may be of any size: where
    they are counted to be small, one window numbers them, else each key is ranked by its own directory. ``tied`` should be
    a stored table.
    """
    most = tied.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if most <= WINDOW_ROWS:
        return tied.withColumn(out, (F.row_number().over(Window.partitionBy(*group).orderBy(*keys)) - 1).cast("long"))
    result = tied.withColumn(out, F.lit(0).cast("long"))
    for k, key in enumerate(keys):
        within = [*group, *keys[:k]]
        counts = stored(tied.groupBy(*within, key).agg(F.count("*").alias("_n")), "tie-counts")
        below = running_totals(counts, within, key, "_n", "_below").select(*within, key, "_below")
        result = result.join(below, [*within, key]).withColumn(out, F.col(out) + F.col("_below")).drop("_below")
    return result.select(*tied.columns, out)


def ordinals(values: DataFrame, column: str, out: str = "ordinal") -> DataFrame:
    """Add the place (from 0) of each row in the order of ``column``; the values are distinct.

    Rows are dealt by ranges and sorted there; what is summed in one task is one number for each range.
    """
    dealt = values.repartitionByRange(column).sortWithinPartitions(column)
    index = F.monotonically_increasing_id()
    dealt = stored(dealt.withColumns({"_part": F.shiftright(index, 33), "_index": index.bitwiseAND(F.lit((1 << 33) - 1))}), "ordinals")
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return dealt.join(F.broadcast(starts), "_part").select(*values.columns, (F.col("_start") + F.col("_index")).cast("long").alias(out))
