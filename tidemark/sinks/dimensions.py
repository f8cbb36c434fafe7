"""Dimension tables fed by routed change records (SNK4, SNK5).

Routed changes are appended to a change folder, one sub-folder per micro-batch;
a batch that runs again replaces its own folder. A dimension is the fold of its
changes, so a batch costs its own size and never rewrites a dimension.
``publish_dimension`` writes the folded rows to the catalog table. A stream that
keeps dimensions current uses ``sinks.upserts`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.changelog import latest_per_key
from tidemark.session import no_rows, path_exists

# Fixed value: the change type of a removed source row.
DELETE_TYPE = "delete"
PRIMARY_KEY_PROPERTY = "primary_key"

# Type of rows written by compaction, and an arrival number below all others.
SNAPSHOT_TYPE = "snapshot"
NEVER = -(1 << 62)


def _quoted(*names: str) -> str:
    return ".".join("`" + name.replace("`", "``") + "`" for name in names)


def dimension_schema(sink_columns: str) -> T.StructType:
    """All columns of a dimension are text, in configured order; empty names at the end are left out."""
    return T.StructType([T.StructField(c, T.StringType()) for c in sink_columns.rstrip(",").split(",")])


def create_dimension(
    spark: SparkSession, schema: str, sink_table: str, sink_columns: str, primary_key: str | None = None
) -> str:
    """SNK5: create ``schema.sink_table`` if it is missing; returns its quoted name."""
    name = _quoted(schema, sink_table)
    columns = ", ".join(f"{_quoted(f.name)} STRING" for f in dimension_schema(sink_columns))
    properties = ""
    if primary_key:
        text = primary_key.replace("\\", "\\\\").replace("'", "\\'")
        properties = f" TBLPROPERTIES ('{PRIMARY_KEY_PROPERTY}' = '{text}')"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(schema)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{properties}")
    return name


def create_dimensions(spark: SparkSession, schema: str, config: DataFrame) -> list[str]:
    """SNK5 for every row of the configuration in force, one row at a time on the driver."""
    rows = config.select("sink_table", "sink_columns", "sink_primary_key").toLocalIterator()
    return [create_dimension(spark, schema, *row) for row in rows]


def row_key(data: Column | str = "data", primary_key: Column | str = "sink_primary_key") -> Column:
    """Primary-key value of a row, NULL if a part has no value; ``primary_key`` may list several columns."""
    data = F.col(data) if isinstance(data, str) else data
    primary_key = F.col(primary_key) if isinstance(primary_key, str) else primary_key
    parts = F.transform(F.split(primary_key, ","), lambda name: data[name])
    complete = F.coalesce(~F.exists(parts, lambda part: part.isNull()), F.lit(False))
    return F.when(complete, F.to_json(parts))


def keyed(routed: DataFrame) -> DataFrame:
    """Routed changes that a dimension can take, with their ``row_key``."""
    return routed.withColumn("row_key", row_key()).where(F.col("row_key").isNotNull())


def keyless(routed: DataFrame) -> DataFrame:
    """Routed changes that no dimension can take: a part of their primary key has no value."""
    return routed.where(row_key().isNull())


def append_changes(routed: DataFrame, batch_id: int, path: str, order: str = "seq") -> None:
    """SNK4, write side: store one batch of routed changes, replacing an earlier run of it.

    Changes without a key value are left out; :func:`keyless` gives them. The rows are rebalanced by table: small tables share tasks and a table that
    holds most of the batch is split into several files.
    """
    rows = keyed(routed).select("sink_table", "row_key", "type", "data", F.col(order).alias("seq"))
    rows.hint("rebalance", "sink_table").write.mode("overwrite").partitionBy("sink_table").parquet(
        f"{path.rstrip('/')}/batch_id={batch_id}"
    )


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All stored changes: ``sink_table, row_key, type, data, seq, batch_id``; none before the first batch."""
    schema = (
        "row_key string, type string, data map<string,string>, seq bigint, batch_id bigint, sink_table string"
    )
    if not path_exists(spark, path):
        return no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _is_removal(on_delete: str) -> Column:
    if on_delete not in ("upsert", "delete"):
        raise ValueError("on_delete is 'upsert' or 'delete'")
    return (F.col("type") == DELETE_TYPE) if on_delete == "delete" else F.lit(False)


def fold_rows(
    changes: DataFrame,
    columns: list[str],
    keys: tuple[str, ...] = ("row_key",),
    order: str = "seq",
    on_delete: str = "upsert",
) -> DataFrame:
    """SNK4, read side: the rows of one dimension, as text columns.

    An upsert sets only the columns it carries, so every column takes its last
    carried value, which may be NULL. ``on_delete="upsert"`` treats deletes like
    any other change; ``"delete"`` removes what came before them. Combined
    before its shuffle, so a hot row moves one record per task.
    """
    removed = _is_removal(on_delete)
    last = [
        F.max(
            F.when(
                ~removed & F.map_contains_key("data", c),
                F.struct(F.col(order).alias("at"), F.col("data")[c].alias("value")),
            )
        ).alias(f"_{i}")
        for i, c in enumerate(columns)
    ]
    folded = changes.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(removed, F.col(order))), F.lit(NEVER)).alias("_removed_at"),
        F.max(F.when(~removed, F.col(order))).alias("_written_at"),
        *last,
    )
    alive = [
        F.when(F.col(f"_{i}.at") > F.col("_removed_at"), F.col(f"_{i}.value")).alias(c)
        for i, c in enumerate(columns)
    ]
    return folded.where(F.col("_written_at") > F.col("_removed_at")).select(*keys, *alive)


def read_dimension(
    spark: SparkSession, path: str, sink_table: str, sink_columns: str, on_delete: str = "upsert"
) -> DataFrame:
    """Current rows of one dimension; only its own folders are read."""
    changes = read_changes(spark, path).where(F.col("sink_table") == sink_table)
    columns = dimension_schema(sink_columns).names
    return fold_rows(changes, columns, on_delete=on_delete).select(*columns)


def publish_dimension(
    spark: SparkSession,
    path: str,
    schema: str,
    sink_table: str,
    sink_columns: str,
    primary_key: str | None = None,
    on_delete: str = "upsert",
) -> str:
    """Write a dimension's current rows to its catalog table; running it again changes nothing.

    Columns that the configuration gained since the table was made are added to
    it; those that it lost stay and become NULL.
    """
    name = create_dimension(spark, schema, sink_table, sink_columns, primary_key)
    rows = read_dimension(spark, path, sink_table, sink_columns, on_delete)
    there = spark.table(name).columns
    new = [c for c in rows.columns if c not in there]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{_quoted(c)} STRING' for c in new)})")
    values = [F.col(_quoted(c)) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in there + new]
    rows.select(*values).write.mode("overwrite").insertInto(name)
    return name


def compact_changes(spark: SparkSession, path: str, new_path: str) -> None:
    """Fold a change folder into a new one that holds each row once or twice, as batch -1.

    A row's last delete is kept, with the values that columns had by then, so
    that both readings of deletes give the same as before; what was carried
    later follows as a snapshot. Works on all tables together: the entries of
    ``data`` are folded one by one, so a row's group holds two entries per
    column at most. Continue with ``new_path`` afterwards.
    """
    row = ["sink_table", "row_key"]
    changes = read_changes(spark, path)
    removed = changes.where(F.col("type") == DELETE_TYPE).groupBy(*row).agg(F.max("seq").alias("_removed_at"))
    entries = changes.select(*row, "seq", F.explode(F.map_entries("data")).alias("_e")).select(*row, "seq", "_e.*")
    marked = entries.join(removed, row, "left").withColumn("_later", F.coalesce(F.col("seq") > F.col("_removed_at"), F.lit(True)))
    latest = latest_per_key(marked, [*row, "_later", "key"], ["seq"])
    folded = latest.groupBy(*row, "_later").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("data"),
        F.max("seq").alias("_written_at"),
        F.first("_removed_at").alias("_removed_at"),
    )
    rows = folded.select(
        *row,
        F.when(F.col("_later"), SNAPSHOT_TYPE).otherwise(DELETE_TYPE).alias("type"),
        "data",
        F.when(F.col("_later"), F.col("_written_at")).otherwise(F.col("_removed_at")).alias("seq"),
    )
    rows.hint("rebalance", "sink_table").write.mode("overwrite").partitionBy("sink_table").parquet(
        f"{new_path.rstrip('/')}/batch_id=-1"
    )
