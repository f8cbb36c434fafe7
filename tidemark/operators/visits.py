"""Per-device visit operators: new-visitor repair (STA2) and daily first entry (STA3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.paths import is_missing
from tidemark.functions.time import DISPLAY_ZONE, local_date, previous_local_date
from tidemark.operators import sizes
from tidemark.session import shared_root

# Fixed values of the new-visitor flag.
NEW = "1"
RETURNING = "0"


def first_visit_dates(
    df: DataFrame,
    key: str = "mid",
    is_new: str = "is_new",
    ts: str = "ts",
    order: str = "seq",
    tz: str = DISPLAY_ZONE,
) -> DataFrame:
    """First-visit date per device, taken from its first-arriving record.

    That record's own day when it claims a new visitor, otherwise the day
    before. Also reports the range of days on which the device claimed to be
    new. All buffers are fixed width, so this is one hash aggregate that is
    combined before its shuffle; a device with a third of all rows costs one
    row per task.
    """
    claims = F.col(is_new) == NEW
    day = local_date(ts, tz)
    own = F.when(claims, day).otherwise(previous_local_date(ts, tz))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min_by(own, F.col(order)).alias("first_visit_date"),
            F.min(F.when(claims, day)).alias("first_claim"),
            F.max(F.when(claims, day)).alias("last_claim"),
        )
    )


def repair_first_visit(
    df: DataFrame,
    key: str = "mid",
    is_new: str = "is_new",
    ts: str = "ts",
    order: str = "seq",
    tz: str = DISPLAY_ZONE,
    group_rows: int = sizes.GROUP_ROWS,
    max_rows: int = sizes.BROADCAST_ROWS,
) -> DataFrame:
    """STA2/PRJ3: correct ``is_new`` of returning devices that claim to be new.

    Only devices with a claim on another day than their first one need the
    join, which normally leaves a small table; its size is checked, and then
    the log itself is not shuffled at all. The table is checkpointed because
    the check and the join both read it.
    """
    shared_root(df.sparkSession)
    first = F.col("first_visit_date")
    wrong = (
        first_visit_dates(df, key, is_new, ts, order, tz)
        .where((F.col("first_claim") != first) | (F.col("last_claim") != first))
        .select(key, first.alias("_first_visit_date"))
        .checkpoint()
    )
    claims = F.col(is_new) == NEW
    joined = sizes.lookup_join(df, wrong, key, order, claims, group_rows, max_rows)
    late = claims & (local_date(ts, tz) != F.col("_first_visit_date"))
    repaired = F.when(late, F.lit(RETURNING)).otherwise(F.col(is_new))
    return joined.withColumn(is_new, repaired).select(*df.columns)


def first_entry_per_day(
    df: DataFrame,
    key: str = "mid",
    ts: str = "ts",
    order: str = "seq",
    entry: Column | None = None,
    tz: str = DISPLAY_ZONE,
    group_rows: int | None = sizes.GROUP_ROWS,
) -> DataFrame:
    """STA3: entry pages whose day differs from the device's previous entry page.

    This is not "distinct device and day": days that arrive interleaved count
    again. Adds ``visit_date``. Hot devices are split into order-contiguous
    chunks. The first window settles every row but the first of each chunk;
    the second compares those firsts with the last day of the chunk before,
    and sees one row per chunk of a device. With ``group_rows`` of None the rows
    are known to be few, and one window does.
    """
    entry = is_missing("last_page_id") if entry is None else entry
    entries = df.where(entry & F.col(key).isNotNull()).withColumn("visit_date", local_date(ts, tz))
    day = F.col("visit_date")
    if group_rows is None:
        before = F.lag(day).over(W.partitionBy(key).orderBy(order))
        return entries.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("_before") != day)).drop("_before")
    hot = sizes.hot_keys(entries, key, group_rows, order)
    chunked = sizes.with_chunk(entries, key, order, hot)

    within = W.partitionBy(key, "_chunk").orderBy(order)
    whole = within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    marked = chunked.withColumns(
        {
            "_head": F.row_number().over(within) == 1,
            "_before": F.lag(day).over(within),
            "_tail": F.last(day).over(whole),
        }
    ).where(F.col("_head") | (F.col("_before") != day))

    across = W.partitionBy(key, F.when(~F.col("_head"), F.col("_chunk"))).orderBy("_chunk")
    carried = marked.withColumn("_carry", F.lag("_tail").over(across))
    fresh = ~F.col("_head") | F.col("_carry").isNull() | (F.col("_carry") != day)
    return carried.where(fresh).select(*df.columns, "visit_date")
