"""Dimension tables that a stream keeps current (SNK4, SNK5).

All dimensions share one store, a folder of Parquet files by sink table and key bucket. A batch of changes reads and
rewrites only the buckets of its own rows, in one job for all tables. A row holds, for each column, its last value and the
arrival number of the change that set it, so changes may come late, or twice, and the result is the same as that of
folding the whole history. Columns are entries of a map: a table that gains a column needs no rewrite. Readers see views with
one text column for each configured column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark.session import no_rows, path_exists
from tidemark.sinks.dimensions import DELETE_TYPE, PRIMARY_KEY_PROPERTY, _quoted, keyed, read_changes

BUCKETS = 16
STORE_SCHEMA = (
    "row_key string, data map<string,string>, set_at map<string,bigint>, written_at bigint, removed_at bigint, sink_table string, bucket int"
)
ROW = ["sink_table", "bucket", "row_key"]

# Kinds of entries that a row is folded from.
COLUMN, WRITTEN, REMOVED = 0, 1, 2


def _entry(kind: int, name: Column | str, at: Column, value: Column) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(F.lit(kind).alias("kind"), name.alias("name"), at.cast("bigint").alias("at"), value.cast("string").alias("value"))


def _change_entries(order: str, on_delete: str) -> Column:
    """What a change sets: its columns and that the row was written, or that it was removed."""
    at, none = F.col(order), F.lit(None)
    columns = F.transform(F.map_entries("data"), lambda e: _entry(COLUMN, e["key"], at, e["value"]))
    written = F.concat(columns, F.array(_entry(WRITTEN, "", at, none)))
    if on_delete == "upsert":
        return written
    return F.when(F.col("type") == DELETE_TYPE, F.array(_entry(REMOVED, "", at, none))).otherwise(written)


def _stored_entries() -> Column:
    none = F.lit(None)
    columns = F.transform(F.map_entries("data"), lambda e: _entry(COLUMN, e["key"], F.col("set_at")[e["key"]], e["value"]))
    marks = F.array(_entry(WRITTEN, "", F.col("written_at"), none), _entry(REMOVED, "", F.col("removed_at"), none))
    return F.concat(columns, F.filter(marks, lambda e: e["at"].isNotNull()))


def fold_entries(entries: DataFrame) -> DataFrame:
    """Rows of the store from ``ROW`` and ``e``, an entry. The last value of each column counts, unless a removal came later.

    A row of many changes is combined before the shuffle: each task sends one entry for each of its columns.
    """
    last = entries.groupBy(*ROW, "e.kind", "e.name").agg(F.max(F.struct("e.at", "e.value")).alias("v"))
    removed = F.max(F.when(F.col("kind") == REMOVED, F.col("v.at")))
    rows = last.groupBy(*ROW).agg(
        F.collect_list(F.when(F.col("kind") == COLUMN, F.struct("name", "v"))).alias("columns"),
        F.max(F.when(F.col("kind") == WRITTEN, F.col("v.at"))).alias("written_at"),
        removed.alias("removed_at"),
    )
    alive = F.filter("columns", lambda c: F.col("removed_at").isNull() | (c["v"]["at"] > F.col("removed_at")))
    value = F.map_from_entries(F.transform(alive, lambda c: F.struct(c["name"], c["v"]["value"])))
    at = F.map_from_entries(F.transform(alive, lambda c: F.struct(c["name"], c["v"]["at"])))
    return rows.select("row_key", value.alias("data"), at.alias("set_at"), "written_at", "removed_at", "sink_table", "bucket")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """All rows, removed ones included; none before the first batch."""
    if not path_exists(spark, store):
        return no_rows(spark, STORE_SCHEMA)
    return spark.read.schema(STORE_SCHEMA).parquet(store)


def live(rows: DataFrame) -> DataFrame:
    """Rows of the store that are not removed."""
    return rows.where("written_at > coalesce(removed_at, written_at - 1)")


def _is_touched(touched: list[Row]) -> Column:
    by_table: dict[str, list[int]] = {}
    for row in touched:
        by_table.setdefault(row["sink_table"], []).append(row["bucket"])
    return reduce(lambda a, b: a | b, [(F.col("sink_table") == t) & F.col("bucket").isin(own) for t, own in by_table.items()])


def upsert_changes(routed: DataFrame, store: str, order: str = "seq", on_delete: str = "upsert", buckets: int = BUCKETS) -> list[Row]:
    """SNK4: bring the store up to date with a batch of routed changes; returns the ``sink_table, bucket`` rewritten.

    Only the buckets of the batch's rows are read and rewritten, by one job with dynamic partition overwrite. Running a
    batch again changes nothing. ``routed`` is read twice; a caller who computes it keeps it meanwhile. Changes without a
    key value are left out (``dimensions.keyless`` gives them). ``buckets`` belongs to the store: choose it so that a bucket
    of the largest table is a file of some hundred megabytes. A driver that is lost while files are moved into place may
    leave a bucket without its rows; ``append_changes`` keeps the log from which :func:`rebuild_store` makes the store anew.
    """
    if on_delete not in ("upsert", "delete"):
        raise ValueError("on_delete is 'upsert' or 'delete'")
    spark = routed.sparkSession
    bucket = F.pmod(F.xxhash64("row_key"), F.lit(buckets)).cast("int")
    changes = keyed(routed).withColumn("bucket", bucket)
    touched = changes.select("sink_table", "bucket").distinct().collect()
    if touched:
        there = read_store(spark, store).where(_is_touched(touched))
        entries = changes.select(*ROW, F.explode(_change_entries(order, on_delete)).alias("e"))
        entries = entries.union(there.select(*ROW, F.explode(_stored_entries()).alias("e")))
        rows = fold_entries(entries).hint("rebalance", "sink_table", "bucket")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sink_table", "bucket").parquet(store)
    return touched


def rebuild_store(spark: SparkSession, log: str, store: str, on_delete: str = "upsert", buckets: int = BUCKETS) -> None:
    """Make a store anew, in a folder of its own, from a log that ``dimensions.append_changes`` wrote."""
    bucket = F.pmod(F.xxhash64("row_key"), F.lit(buckets)).cast("int")
    changes = read_changes(spark, log).withColumn("bucket", bucket)
    rows = fold_entries(changes.select(*ROW, F.explode(_change_entries("seq", on_delete)).alias("e")))
    rows.hint("rebalance", "sink_table", "bucket").write.partitionBy("sink_table", "bucket").parquet(store)


def publish_view(spark: SparkSession, schema: str, sink_table: str, columns: list[str], lost: list[str], primary_key: str | None, store: str) -> str:
    """SNK5: make or replace the view of one dimension: all columns are text, the key is a property.

    ``lost`` are columns that it had before; they stay and are NULL. Until the store has its first rows the view is empty;
    publish it again then.
    """
    name = _quoted(schema, sink_table)
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    properties = f" TBLPROPERTIES ('{PRIMARY_KEY_PROPERTY}' = {text(primary_key)})" if primary_key else ""
    stored = path_exists(spark, store)
    values = [f"{f'data[{text(c)}]' if stored else 'CAST(NULL AS STRING)'} AS {_quoted(c)}" for c in columns]
    values += [f"CAST(NULL AS STRING) AS {_quoted(c)}" for c in lost]
    rows = f"FROM parquet.{_quoted(store)} WHERE sink_table = {text(sink_table)} AND written_at > coalesce(removed_at, written_at - 1)"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")
    spark.sql(f"CREATE OR REPLACE VIEW {name}{properties} AS SELECT {', '.join(values)} {rows if stored else 'WHERE false'}")
    return name
