"""Dimension routing as a stream that maintains its own configuration and tables (STA5, JOI1(c), SNK4, SNK5).

Changes and configuration arrive as one stream. A configuration row is parsed once, in the batch that brings it, and
stays as a version in a state table. A batch of changes is routed by the versions known by its end, upserted into the store of
dimensions, and new or widened dimensions are published. Every step finds what earlier batches left and replaces what
an earlier run of the same batch wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import sizes
from tidemark.operators.changelog import latest_per_key
from tidemark.operators.routing import (
    CONFIG_FIELDS,
    change_records,
    config_changes,
    current_config,
    from_database,
    judged_config,
    prune_data,
    route_as_of,
    route_current,
    without_maintenance,
)
from tidemark.session import path_exists
from tidemark.sinks import upserts
from tidemark.sinks.dimensions import append_changes, dimension_schema, keyless
from tidemark.streaming.state import Sink, StateTable

VERSIONS = "source_table string, is_deleted boolean, sink_table string, sink_columns string, sink_primary_key string, sink_extend string"
RECORDS = "table string, database string, type string, data map<string,string>"
SHAPES = "sink_table string, columns array<string>, lost array<string>, primary_key string"


class ConfigVersions:
    """STA5 on a stream: all versions of the configuration by source table, or only the last of each, delete marks included."""

    def __init__(self, spark: SparkSession, checkpoint: str, order: str = "seq", keep_all: bool = True):
        columns = [f.split()[0] for f in VERSIONS.split(", ")]
        last = lambda rows: latest_per_key(rows, ["source_table"], [order])
        self.table = StateTable(spark, checkpoint, "config-versions", f"{VERSIONS}, {order} bigint", None if keep_all else last)
        self.columns = [*columns, order]

    def add(self, text: DataFrame, batch_id: int) -> DataFrame:
        """Parse a batch of configuration text and keep it; returns its versions."""
        return self.table.write(batch_id, config_changes(text).select(*self.columns))

    def known(self, batch_id: int) -> DataFrame:
        """The versions that all batches up to this one brought."""
        return self.table.before(batch_id).select(*self.columns).union(self.table.of(batch_id))


class ParkedChanges:
    """JOI1(c): changes whose table no configuration names yet, kept for some batches and routed when one does.

    ``limit`` is the number of batches that a change may wait; 0 parks nothing, and a change without a configuration is lost
    as in a join with what is known on arrival.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, limit: int, order: str = "seq"):
        self.table = StateTable(spark, checkpoint, "parked-changes", f"{RECORDS}, {order} bigint, waited int")
        self.limit, self.order = limit, order

    def waiting(self, batch_id: int) -> DataFrame:
        return self.table.of(batch_id - 1)

    def park(self, records: DataFrame, versions: DataFrame, as_of: bool, batch_id: int, untried: DataFrame | None) -> None:
        """Keep those of ``records`` (with ``waited``) that no version covers. ``untried`` wait on without a look."""
        first = versions.groupBy(F.col("source_table").alias("table")).agg(F.min(self.order).alias("_first"))
        looked = sizes.lookup_join(records, first, "table", self.order)
        missing = F.col("_first").isNull() | ((F.col("_first") > F.col(self.order)) if as_of else F.lit(False))
        left = looked.where(missing).select(*records.columns)
        left = left if untried is None else left.unionByName(untried)
        self.table.write(batch_id, left.where(F.col("waited") < self.limit).withColumn("waited", F.col("waited") + 1))


class DimensionShapes:
    """SNK5 on a stream: the columns of every dimension, by the batch that changed them."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        fields = [f.split()[0] for f in SHAPES.split(", ")][1:]
        last = lambda rows: rows.groupBy("sink_table").agg(*[F.max_by(c, "version").alias(c) for c in fields], F.max("version").alias("version"))
        self.table = StateTable(spark, checkpoint, "dimension-shapes", SHAPES, last)

    def follow(self, versions: DataFrame, batch_id: int, order: str) -> DataFrame:
        """Take over a batch's versions, one after the other; returns the shapes that they changed.

        A dimension gains columns that a version adds; those that a version drops stay, as lost ones.
        """
        named = versions.where(~F.col("is_deleted"))
        before = {r["sink_table"]: r for r in self.table.before(batch_id, named).join(named.select("sink_table").distinct(), "sink_table").collect()}
        shapes = {name: (r["columns"], r["lost"], r["primary_key"]) for name, r in before.items()}
        for row in named.orderBy(order).select("sink_table", "sink_columns", "sink_primary_key").toLocalIterator():
            columns = dimension_schema(row["sink_columns"]).names
            had, lost, _ = shapes.get(row["sink_table"], ([], [], None))
            shapes[row["sink_table"]] = (columns, [c for c in [*had, *lost] if c not in columns], row["sink_primary_key"])
        rows = [(name, *shape) for name, shape in shapes.items()]
        return self.table.write(batch_id, self.table.spark.createDataFrame(rows, SHAPES))

    def known(self, batch_id: int) -> DataFrame:
        return self.table.before(batch_id + 1)


class DimensionTables:
    """The whole job: configuration, routing, parked changes, upserts and views, batch by batch."""

    def __init__(
        self,
        spark: SparkSession,
        checkpoint: str,
        database: str,
        store: str,
        order: str = "seq",
        as_of: bool = False,
        on_delete: str = "upsert",
        park_batches: int = 0,
        schema: str | None = None,
        log: str | None = None,
        dirty: Sink | None = None,
        buckets: int = upserts.BUCKETS,
    ):
        self.spark, self.database, self.store, self.order, self.as_of = spark, database, store, order, as_of
        self.on_delete, self.schema, self.log, self.dirty, self.buckets = on_delete, schema, log, dirty, buckets
        self.versions = ConfigVersions(spark, checkpoint, order, keep_all=as_of)
        self.parked = ParkedChanges(spark, checkpoint, park_batches, order)
        self.shapes = DimensionShapes(spark, checkpoint)
        self.published = False

    def run(self, batch: DataFrame, batch_id: int) -> None:
        """``batch``: ``value``, the order and ``is_config``."""
        batch.persist()
        try:
            text = batch.where("is_config").drop("is_config")
            new = self.versions.add(text, batch_id)
            changed = not new.isEmpty()
            parsed = change_records(batch.where("NOT is_config").drop("is_config"))
            routed = self._route(parsed, batch_id, changed).persist()
            try:
                if self.log:
                    append_changes(routed, batch_id, self.log, self.order)
                if self.dirty:
                    self.dirty(self._rejected(parsed, text, routed), batch_id)
                empty = not path_exists(self.spark, self.store)
                upserts.upsert_changes(routed, self.store, self.order, self.on_delete, self.buckets)
            finally:
                routed.unpersist()
            if self.schema:
                self._publish(new, batch_id, empty)
        finally:
            batch.unpersist()

    def _route(self, parsed: DataFrame, batch_id: int, changed: bool) -> DataFrame:
        wanted = without_maintenance(from_database(parsed.where("NOT is_dirty"), self.database))
        records = wanted.select("table", "database", "type", "data", self.order, F.lit(0).alias("waited"))
        versions = self.versions.known(batch_id)
        if self.parked.limit:
            # Only a new version can release a parked change.
            waiting = self.parked.waiting(batch_id)
            records = records.unionByName(waiting) if changed else records
            self.parked.park(records, versions, self.as_of, batch_id, None if changed else waiting)
        if self.as_of:
            routed = route_as_of(records, versions, order=self.order)
        else:
            routed = route_current(records, current_config(versions, self.order), spread=self.order)
        return routed.drop("waited").withColumn("data", prune_data())

    def _rejected(self, parsed: DataFrame, text: DataFrame, routed: DataFrame) -> DataFrame:
        unreadable = parsed.where("is_dirty").select(F.lit("change").alias("kind"), self.order, F.lit("unreadable").alias("problem"), "value")
        config = judged_config(text).where("problem IS NOT NULL").select(F.lit("config"), self.order, "problem", "value")
        without = keyless(routed).select(F.lit("change"), self.order, F.lit("no primary key value"), F.to_json("data"))
        return unreadable.union(config).union(without)

    def _publish(self, new: DataFrame, batch_id: int, empty: bool) -> None:
        shapes = self.shapes.follow(new, batch_id, self.order)
        if not self.published or empty:
            # A session that starts anew has no views yet, and a store that did not exist had no rows to show.
            shapes = self.shapes.known(batch_id)
        for row in shapes.toLocalIterator():
            upserts.publish_view(self.spark, self.schema, row["sink_table"], row["columns"], row["lost"], row["primary_key"], self.store)
        self.published = True


def dimension_source(changes: DataFrame, config: DataFrame, order: str = "seq") -> DataFrame:
    """Change text and configuration text as one stream."""
    rows = lambda df, is_config: df.select("value", F.col(order).cast("bigint").alias(order), F.lit(is_config).alias("is_config"))
    return rows(changes, False).union(rows(config, True))
