"""Routing change records by a configuration that is itself a change stream.

Covers FLT1, FLT2, FLT5, PRJ5, PRJ6, JOI1 and the configuration side of STA5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions.paths import in_list
from tidemark.operators import sizes
from tidemark.operators.changelog import fold_changes, latest_per_key
from tidemark.operators.records import mark_numbers, parse_records, unmark_numbers

# Fixed values of the change formats.
MAINTENANCE_TYPES = ("bootstrap-start", "bootstrap-complete")
DELETE_OP = "d"
CONFIG_FIELDS = ("source_table", "sink_table", "sink_columns", "sink_primary_key", "sink_extend")

CHANGE_FIELDS = {
    "database": ("database", "string"),
    "table": ("table", "string"),
    "type": ("type", "string"),
    "data": ("data", "map<string,string>"),
}

# More versions of one source than this are not compared row by row.
MAX_BROADCAST_VERSIONS = 64


def change_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse change records into ``database, table, type, data, is_dirty``.

    Values in ``data`` are text with the digits that the record has: ``10.50`` stays ``10.50``.
    """
    marked = df.withColumn("_marked", mark_numbers(F.col(value)))
    parsed = parse_records(marked, "_marked", "record", CHANGE_FIELDS).drop("record", "_marked")
    parsed = parsed.withColumns(
        {
            **{name: unmark_numbers(F.col(name)) for name in ("database", "table", "type")},
            "data": F.transform_values("data", lambda _, text: unmark_numbers(text)),
        }
    )
    named = F.col("database").isNotNull() & F.col("table").isNotNull() & F.col("type").isNotNull()
    filled = F.col("data").isNotNull() | F.col("type").isin(*MAINTENANCE_TYPES)
    return parsed.withColumn("is_dirty", ~(named & filled))


def from_database(df: DataFrame, database: str) -> DataFrame:
    """FLT1: change records of one source database."""
    return df.where(F.col("database") == database)


def without_maintenance(df: DataFrame) -> DataFrame:
    """FLT2: drop snapshot start and end marks; every other type passes."""
    return df.where(~F.col("type").isin(*MAINTENANCE_TYPES))


def _camel(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part.title() for part in tail)


def table_changes(df: DataFrame, columns: tuple[str, ...], value: str = "value", camel: bool = False) -> DataFrame:
    """SRC4: parse change log entries of any table: ``op``, ``is_deleted`` and ``columns``, as text.

    A delete is described by its ``before`` image, any other change by
    ``after``. With ``camel``, camel-case keys are read as well. Unreadable rows
    have a NULL ``op``.
    """
    fields = {"op": ("op", "string")}
    for image in ("before", "after"):
        for name in columns:
            fields[f"_{image}_{name}"] = (f"{image}.{name}", "string")
            fields[f"_{image}_{name}_camel"] = (f"{image}.{_camel(name) if camel else name}", "string")
    parsed = parse_records(df, value, "_record", fields).drop("_record")
    deleted = F.col("op") == DELETE_OP

    def setting(image: str, name: str) -> Column:
        return F.coalesce(f"_{image}_{name}", f"_{image}_{name}_camel")

    settings = [
        F.when(deleted, setting("before", name)).otherwise(setting("after", name)).alias(name)
        for name in columns
    ]
    # A barrier as in parse_records: conditions on the settings stay above the parse.
    change = F.explode(F.array(F.struct("op", deleted.alias("is_deleted"), *settings))).alias("_change")
    return parsed.select(*df.columns, change).select(*df.columns, "_change.*")


def judged_config(df: DataFrame, value: str = "value") -> DataFrame:
    """SRC3/SRC4: all configuration changes with ``problem``, which is NULL for those that count.

    A change needs an operation and a source table and, unless it is a delete,
    a sink table and a primary key among the sink columns: one without would
    fail every batch later.
    """
    parsed = table_changes(df, CONFIG_FIELDS, value, camel=True)
    keys = F.split("sink_primary_key", ",")
    keyed = F.size(F.array_except(keys, F.split("sink_columns", ","))) == 0
    problem = (
        F.when(F.col("op").isNull() | F.col("source_table").isNull(), "unreadable")
        .when(F.col("is_deleted"), None)
        .when(F.col("sink_table").isNull() | F.col("sink_columns").isNull(), "no sink")
        .when(~F.coalesce(keyed, F.lit(False)), "no primary key among the columns")
    )
    return parsed.withColumn("problem", problem)


def config_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """SRC3/SRC4: configuration changes that count: ``op``, ``is_deleted`` and the five settings.

    The others are those of :func:`judged_config` with a ``problem``.
    """
    return judged_config(df, value).where(F.col("problem").isNull()).drop("problem")


def current_config(changes: DataFrame, order: str = "seq") -> DataFrame:
    """STA5: the configuration in force, one row per source table."""
    return fold_changes(changes, ["source_table"], [order], F.col("is_deleted")).select(*CONFIG_FIELDS)


def prune_data(data: Column | str = "data", columns: Column | str = "sink_columns") -> Column:
    """PRJ5/SCA7: keep only the map keys listed in the row's ``columns``."""
    data = F.col(data) if isinstance(data, str) else data
    return F.map_filter(data, lambda name, _: in_list(name, columns))


def route_current(
    records: DataFrame,
    config: DataFrame,
    table: str = "table",
    spread: str = "seq",
    group_rows: int = sizes.GROUP_ROWS,
    max_rows: int = sizes.BROADCAST_ROWS,
) -> DataFrame:
    """JOI1(a)/FLT5: inner join to the configuration in force (one row per source table)."""
    lookup = config.withColumnRenamed("source_table", table).withColumn("_routed", F.lit(True))
    joined = sizes.lookup_join(records, lookup, table, spread, None, group_rows, max_rows)
    return joined.where(F.col("_routed")).drop("_routed")


def _broadcastable(changes: DataFrame, source: str, max_rows: int) -> bool:
    if not sizes.fits_broadcast(changes, max_rows):
        return False
    most = changes.groupBy(source).count().agg(F.max("count")).first()[0]
    return most is None or most <= MAX_BROADCAST_VERSIONS


def route_as_of(
    records: DataFrame,
    changes: DataFrame,
    table: str = "table",
    source: str = "source_table",
    order: str = "seq",
    deleted: str = "is_deleted",
    settings: tuple[str, ...] = CONFIG_FIELDS[1:],
    group_rows: int = sizes.GROUP_ROWS,
    max_rows: int = sizes.BROADCAST_ROWS,
) -> DataFrame:
    """JOI1(b): join each record to the configuration version known when it arrived.

    ``order`` is the arrival number shared by both sides: the last change at or
    before the record counts, and a record whose last change is a delete, or
    that precedes every change, is dropped.

    A small change log is turned into validity ranges and broadcast. A large
    one is merged with the records and carried forward by one window, so no
    record meets more than one version of its table.
    """
    if _broadcastable(changes, source, max_rows):
        versions = W.partitionBy(source).orderBy(order)
        ranges = changes.select(
            F.col(source).alias("_source"),
            F.col(order).alias("_from"),
            F.lead(order).over(versions).alias("_until"),
            F.col(deleted).alias("_deleted"),
            *settings,
        ).where(~F.col("_deleted"))
        known = (
            (F.col(table) == F.col("_source"))
            & (F.col(order) >= F.col("_from"))
            & (F.col("_until").isNull() | (F.col(order) < F.col("_until")))
        )
        return records.join(F.broadcast(ranges), known).select(*records.columns, *settings)

    version = F.struct(F.col(deleted).alias("_deleted"), *settings).alias("_version")
    log = changes.where(F.col(source).isNotNull()).select(
        F.col(source).alias(table), F.col(order), F.lit(0).alias("_kind"), version
    )
    rows = records.where(F.col(table).isNotNull()).withColumn("_kind", F.lit(1))
    both = rows.unionByName(log, allowMissingColumns=True)
    hot = sizes.hot_keys(both, table, group_rows, order)
    carried = _carry_versions(both, log, hot, table, order)
    chunked = sizes.with_chunk(both, table, order, hot).unionByName(carried, allowMissingColumns=True)

    so_far = W.partitionBy(table, "_chunk").orderBy(order, "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = chunked.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
    live = (F.col("_kind") == 1) & F.col("_version").isNotNull() & ~F.col("_version._deleted")
    return filled.where(live).select(*records.columns, *[F.col(f"_version.{c}").alias(c) for c in settings])


def _carry_versions(
    both: DataFrame, log: DataFrame, hot: DataFrame, table: str, order: str
) -> DataFrame:
    """For hot tables: the version in force at the start of each chunk that has rows."""

    def in_chunks(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), F.col(table) == F.col("_hot_key")).withColumn("_chunk", sizes.chunk_of(order))

    chunks = in_chunks(both.select(table, order)).groupBy(table, "_chunk").agg(F.min(order).alias("_first"))
    last = latest_per_key(in_chunks(log), [table, "_chunk"], [order]).select(table, "_chunk", "_version")
    before = W.partitionBy(table).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.join(last, [table, "_chunk"], "left").withColumn(
        "_version", F.last("_version", ignorenulls=True).over(before)
    )
    return carried.where(F.col("_version").isNotNull()).select(
        table,
        F.col("_first").alias(order),
        F.lit(-1).alias("_kind"),
        "_version",
        "_chunk",
    )
