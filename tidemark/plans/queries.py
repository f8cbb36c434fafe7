"""One query per operator over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import time as t
from tidemark.functions.paths import is_blank, is_missing, read_array, read_long, read_object, read_string
from tidemark.operators.changelog import fold_changes
from tidemark.operators.counts import daily_visitors
from tidemark.operators.patterns import match_next, match_timeouts
from tidemark.operators.records import log_records, parse_records, to_text
from tidemark.operators.routing import (
    change_records,
    config_changes,
    current_config,
    from_database,
    prune_data,
    route_as_of,
    route_current,
    table_changes,
    without_maintenance,
)
from tidemark.operators.split import CHANNEL_TOPICS, route_channels
from tidemark.operators.visits import first_entry_per_day, repair_first_visit
from tidemark.plans import inputs
from tidemark.plans.jobs import (
    daily_unique_visitors,
    jump_outs,
    rejected_changes,
    rejected_config,
    rejected_pages,
    route_dimensions,
    split_traffic,
)
from tidemark.session import shared_folder
from tidemark.sinks import channels, dimensions as dims, upserts
from tidemark.sources.text import arrival_order, landed_text, read_log
from tidemark.streaming import jobs, operators as streams
from tidemark.streaming.state import file_sink, read_sink

# The driver events are sparse: one hour gives the pattern enough pairs.
HOUR_MS = 60 * 60 * 1000

# A dimension whose configuration has all columns.
WIDE_DIMENSION = "dim_nation_1"

# Small limits, so that the branches for large sides and hot keys run on these tables.
FEW_ROWS = 40

# These dimensions are of a few thousand rows each.
FEW_BUCKETS = 2


def first_visit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_first_visit(inputs.log_view(spark, sf_dir)).select("seq", "mid", "ts", "is_new")


def daily_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_entry_per_day(inputs.log_view(spark, sf_dir)).select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def jump_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = is_blank("last_page_id")
    pairs = match_next(inputs.log_view(spark, sf_dir), entry, entry, HOUR_MS, columns=["seq", "ts"])
    return pairs.select(
        "mid",
        F.col("first.seq").alias("seq"),
        F.col("second.seq").alias("s2"),
        F.col("first.ts").alias("ts"),
        F.col("second.ts").alias("t2"),
    )


def changelog_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    folded = fold_changes(orders, ["o_custkey"], ["o_orderkey"], F.col("o_orderstatus") == "F")
    return folded.select("o_custkey", "o_orderkey", "o_orderpriority")


def config_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir)


def _asof(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    records = inputs.table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("table"))
    changes = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.col("o_custkey").alias("source_table"),
        (F.col("o_orderstatus") == "F").alias("is_deleted"),
        F.col("o_orderkey").alias("k"),
    )
    return route_as_of(records, changes, settings=("k",), **limits).select(F.col("seq").alias("event_id"), "k")


def config_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = from_database(change_records(inputs.raw_changes(spark, sf_dir)), "shop")
    config = current_config(config_changes(inputs.raw_config(spark, sf_dir)))
    return route_current(records.select("seq", "table"), config).select("seq", "table", "sink_table", "sink_columns")


def prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = change_records(inputs.raw_changes(spark, sf_dir)).select("seq", "table", "data")
    config = current_config(config_changes(inputs.raw_config(spark, sf_dir)))
    pruned = route_current(records, config).withColumn("data", prune_data())
    return pruned.select(
        "seq",
        F.size("data").cast("bigint").alias("n_columns"),
        F.col("data")["id"].cast("bigint").alias("id"),
        F.col("data")["last_order"].cast("bigint").alias("last_order"),
        F.col("data")["price"].cast("double").alias("price"),
    )


def filter_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = change_records(inputs.raw_changes(spark, sf_dir))
    return without_maintenance(from_database(records, "shop")).select("seq", "table", "type")


def config_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration in force per source table, counted over the orders it applies to."""
    config = current_config(config_changes(inputs.raw_config(spark, sf_dir)))
    records = change_records(inputs.raw_changes(spark, sf_dir)).select("seq", "table")
    return (
        route_current(records, config)
        .groupBy("table", "sink_table", "sink_columns", "sink_primary_key", "sink_extend")
        .agg(F.count("*").alias("n_records"))
    )


def _routed(df: DataFrame) -> DataFrame:
    return df.select(
        "seq",
        "sink_table",
        "type",
        F.col("data")["id"].cast("bigint").alias("id"),
        F.col("data")["last_order"].cast("bigint").alias("last_order"),
        F.col("data")["price"].cast("double").alias("price"),
    )


def dimension_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(route_dimensions(inputs.raw_changes(spark, sf_dir), inputs.raw_config(spark, sf_dir), "shop"))


def dimension_routing_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, config = inputs.raw_changes(spark, sf_dir), inputs.raw_config(spark, sf_dir)
    return _routed(route_dimensions(changes, config, "shop", as_of=True))


def parse_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = log_records(inputs.raw_log(spark, sf_dir))
    return records.select("seq", "is_dirty", "mid", F.when(~F.col("is_dirty"), F.col("is_new")).alias("is_new"), F.when(~F.col("is_dirty"), F.col("ts")).alias("ts"))


def route_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_channels(log_records(inputs.raw_log(spark, sf_dir)))
    return routed.where(~F.col("channel").isin("action", "display")).select("seq", "channel")


def explode_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route_channels(log_records(inputs.raw_log(spark, sf_dir)))
    item = F.coalesce(F.get_json_object("value", "$.action.action_id"), F.get_json_object("value", "$.display.item"))
    return routed.where(F.col("channel").isin("action", "display")).select(
        "seq", "channel", "position", item.alias("item"), F.get_json_object("value", "$.ts").cast("bigint").alias("ts")
    )


def field_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page records after their arrays were dropped; what remains is read back from the text."""
    pages = route_channels(log_records(inputs.raw_log(spark, sf_dir))).where(F.col("channel") == "page")
    record = parse_records(pages.select("seq", "value"))
    return record.select(
        "seq",
        read_array("record", "actions").isNull().alias("no_actions"),
        read_array("record", "displays").isNull().alias("no_displays"),
        read_string("record", "page.page_id").alias("page_id"),
        read_string("record", "page.last_page_id").alias("last_page_id"),
        read_long("record", "ts").alias("ts"),
    )


def _channel_fields(routed: DataFrame) -> DataFrame:
    def path(name: str):
        return F.get_json_object("value", f"$.{name}")

    clean = F.col("channel") != "dirty"
    return routed.select(
        "seq",
        "channel",
        "position",
        F.when(clean, path("common.is_new")).alias("is_new"),
        F.when(clean, path("page.page_id")).alias("page_id"),
        F.when(clean, F.coalesce(path("action.action_id"), path("display.item"), path("entry"))).alias("item"),
        F.when(clean, path("err.code")).cast("bigint").alias("code"),
        F.when(clean, path("ts")).cast("bigint").alias("ts"),
    )


def traffic_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _channel_fields(split_traffic(inputs.raw_log(spark, sf_dir)))


def page_log_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily unique visitors from the page channel of the split log."""
    pages = split_traffic(inputs.raw_log(spark, sf_dir)).where(F.col("channel") == "page")
    return daily_unique_visitors(pages).select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def page_log_jump_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jump-outs from the page channel of the split log."""
    pages = split_traffic(inputs.raw_log(spark, sf_dir)).where(F.col("channel") == "page")
    pairs = jump_outs(pages, within_ms=HOUR_MS)
    return pairs.select("mid", F.col("first.seq").alias("seq"), F.col("second.seq").alias("s2"))


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page channel as the file sink wrote it."""
    path = shared_folder(spark, "channels")
    channels.write_channels(split_traffic(inputs.raw_log(spark, sf_dir)), path)
    return spark.read.parquet(path).where("channel = 'page'")


def page_files_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = daily_unique_visitors(_page_files(spark, sf_dir))
    return found.select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def page_files_jump_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = jump_outs(_page_files(spark, sf_dir), within_ms=HOUR_MS)
    return pairs.select("mid", F.col("first.seq").alias("seq"), F.col("second.seq").alias("s2"))


def uv_topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily unique visitors as rows for their topic."""
    pages = split_traffic(inputs.raw_log(spark, sf_dir)).where(F.col("channel") == "page")
    rows = channels.uv_topic_rows(daily_unique_visitors(pages))
    page = F.get_json_object("value", "$.page.page_id")
    return rows.select("topic", F.col("key").alias("mid"), page.alias("page_id"), F.get_json_object("value", "$.ts").cast("bigint").alias("ts"))


def traffic_split_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split with actions and displays read from their elements alone, and start rows with their context."""
    routed = split_traffic(inputs.raw_log(spark, sf_dir), context="element", keep_start_context=True)
    path = lambda name: F.get_json_object("value", f"$.{name}")
    return routed.where("channel IN ('action', 'display', 'start')").select(
        "seq",
        "channel",
        "position",
        path("common.mid").alias("common_mid"),
        path("page.page_id").alias("page_id"),
        F.coalesce(path("action_id"), path("item"), path("action.action_id"), path("display.item"), path("start.entry")).alias("item"),
        path("ts").cast("bigint").alias("ts"),
    )


def parse_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with all kinds of JSON white space around them."""
    pad = F.element_at(F.array(*[F.lit(p) for p in ("\n", "\r\n", "\t", " \t\r\n ")]), (F.col("seq") % 4 + 1).cast("int"))
    raw = inputs.raw_log(spark, sf_dir).withColumn("value", F.concat(pad, "value", pad))
    parsed = log_records(raw)
    clean = lambda c: F.when(~F.col("is_dirty"), F.col(c)).alias(c)
    return parsed.select("seq", "is_dirty", "mid", clean("is_new"), clean("ts"))


def page_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records that the page jobs leave out."""
    return rejected_pages(inputs.raw_log(spark, sf_dir)).select("seq", F.length("value").cast("bigint").alias("n_chars"))


def _broken_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every eleventh change is cut off, every thirteenth has no table."""
    cut = F.substring("value", F.lit(1), F.length("value") - 1)
    unnamed = F.replace("value", F.lit('"table"'), F.lit('"tables"'))
    value = F.when(F.col("seq") % 11 == 0, cut).when(F.col("seq") % 13 == 0, unnamed).otherwise(F.col("value"))
    return inputs.raw_changes(spark, sf_dir).withColumn("value", value)


def _broken_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd configuration rows of ``raw_config``: cut off, without a key, with a key outside the columns."""
    n = (F.col("seq") / 500).cast("int")
    text = F.col("value")
    broken = (
        F.when(n % 9 == 1, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(n % 9 == 3, F.replace(text, F.lit(',"sink_primary_key":"id"'), F.lit("")))
        .when(n % 9 == 5, F.replace(text, F.lit('"sink_primary_key":"id"'), F.lit('"sink_primary_key":"id,uid"')))
    )
    return inputs.raw_config(spark, sf_dir).withColumn("value", F.coalesce(broken, text))


def dimension_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that dimension routing leaves out as unreadable, and why."""
    changes = rejected_changes(_broken_changes(spark, sf_dir)).select(F.lit("change").alias("kind"), "seq", F.lit("unreadable").alias("problem"))
    return changes.union(rejected_config(_broken_config(spark, sf_dir)).select(F.lit("config"), "seq", "problem"))

def time_fns(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = inputs.log_view(spark, sf_dir)
    day, moment = t.to_date_text("ts"), t.to_datetime_text("ts")
    return logs.select(
        "seq",
        day.alias("day"),
        moment.alias("moment"),
        t.to_epoch_ms(day).alias("day_ms"),
        t.to_epoch_ms(moment, full=True).alias("moment_ms"),
        t.previous_local_date("ts").cast("string").alias("day_before"),
    )


def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_records(inputs.raw_log(spark, sf_dir))
    return records.select(
        "seq",
        read_string("record", "common.mid").alias("mid"),
        read_long("record", "ts").alias("ts"),
        read_object("record", "err").isNotNull().alias("has_err"),
        F.array_size(read_array("record", "actions")).cast("bigint").alias("n_actions"),
        is_missing(read_string("record", "page.last_page_id")).alias("no_last_page"),
        is_blank(read_string("record", "page.last_page_id")).alias("blank_last_page"),
    )


def to_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = parse_records(inputs.raw_log(spark, sf_dir))
    pages = records.where(read_object("record", "page").isNotNull())
    return pages.select("seq", to_text(read_object("record", "page")).alias("page"))


def _event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_type").alias("sink_table"),
        F.col("user_id").alias("row_key"),
        F.lit("update").alias("type"),
        F.create_map(F.lit("event"), F.col("event_id").cast("string"), F.lit("k"), k).alias("data"),
        F.col("event_id").alias("seq"),
    )


def upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dims.fold_rows(_event_changes(spark, sf_dir), ["event", "k"], ("sink_table", "row_key"))
    return rows.select(
        F.col("sink_table").alias("event_type"),
        F.col("row_key").alias("user_id"),
        F.col("event").cast("bigint").alias("event_id"),
        F.col("k").cast("bigint").alias("k"),
    )


def _dimension_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("id").cast("bigint").alias("id"), F.col("price").cast("double").alias("price"))


def _stored_changes(spark: SparkSession, sf_dir: str) -> str:
    path = shared_folder(spark, "changes")
    routed = route_dimensions(inputs.raw_changes(spark, sf_dir), inputs.raw_config(spark, sf_dir), "shop", as_of=True)
    dims.append_changes(routed, 0, path)
    return path


def dimension_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed changes stored as one batch, then the current rows of all dimensions, deletes applied."""
    return _folded_rows(dims.read_changes(spark, _stored_changes(spark, sf_dir)), "delete")


def dimension_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``dimension_upsert``, read after the change folder was compacted; deletes are upserts."""
    return _folded_rows(_compacted(spark, sf_dir), "upsert")


def dimension_compacted_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder read with deletes applied: compaction keeps both readings."""
    return _folded_rows(_compacted(spark, sf_dir), "delete")


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = shared_folder(spark, "folded")
    dims.compact_changes(spark, _stored_changes(spark, sf_dir), folded)
    return dims.read_changes(spark, folded)


def _folded_rows(changes: DataFrame, on_delete: str) -> DataFrame:
    rows = dims.fold_rows(changes, ["id", "last_order", "price"], ("sink_table", "row_key"), on_delete=on_delete)
    return rows.select(
        "sink_table",
        F.col("id").cast("bigint").alias("id"),
        F.col("last_order").cast("bigint").alias("last_order"),
        F.col("price").cast("double").alias("price"),
    )


def dimension_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published with two columns, then again after its configuration gained one."""
    schema = f"dims_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_folder(spark, 'dimensions')}'")
    path = _stored_changes(spark, sf_dir)
    for columns in ("id,price", "id,last_order,price"):
        name = dims.publish_dimension(spark, path, schema, WIDE_DIMENSION, columns, "id")
    return spark.table(name).select(
        F.col("id").cast("bigint").alias("id"), F.col("last_order").cast("bigint").alias("last_order"), F.col("price").cast("double").alias("price")
    )


def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog table made from its configuration and filled with the dimension's current rows."""
    schema = f"dims_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{shared_folder(spark, 'dimensions')}'")
    path = _stored_changes(spark, sf_dir)
    name = dims.publish_dimension(spark, path, schema, "dim_nation_0", "id,price", "id")
    return _dimension_rows(spark.table(name))


def channel_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split log written by channel and counted from its files."""
    path = shared_folder(spark, "channels")
    channels.write_channels(split_traffic(inputs.raw_log(spark, sf_dir)), path)
    return spark.read.parquet(path).groupBy("channel").agg(F.count("*").alias("n"))


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows handed to the topic sink, counted by topic and device."""
    rows = channels.to_topics(split_traffic(inputs.raw_log(spark, sf_dir)), CHANNEL_TOPICS)
    return rows.groupBy("topic", F.col("key").alias("mid")).agg(F.count("*").alias("n"))


def first_visit_repair_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair_first_visit(inputs.log_view(spark, sf_dir), group_rows=FEW_ROWS, max_rows=0)
    return found.select("seq", "mid", "ts", "is_new")


def daily_uv_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = first_entry_per_day(inputs.log_view(spark, sf_dir), group_rows=FEW_ROWS)
    return found.select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def daily_uv_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival numbers a million apart still give about ``rows / group_rows`` chunks."""
    logs = inputs.log_view(spark, sf_dir).withColumn("seq", F.col("seq") * 1_000_000)
    found = first_entry_per_day(logs, group_rows=FEW_ROWS)
    return found.select((F.col("seq") / 1_000_000).cast("bigint").alias("seq"), "mid", F.col("visit_date").cast("string").alias("d"))


def daily_uv_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival numbers in two far clusters and one between still give chunks of about the same rows."""
    seq = F.col("seq")
    far = F.when(seq % 3 == 0, seq).when(seq == 1, seq + 10**12).otherwise(seq + 10**15)
    logs = inputs.log_view(spark, sf_dir).withColumn("at", far)
    found = first_entry_per_day(logs, order="at", group_rows=FEW_ROWS)
    return found.select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def _two_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs whose devices write to two partitions in turn, with the broker's time by the second."""
    seq = F.col("seq")
    seconds = (F.col("ts") / 1000).cast("bigint") * 1000
    arrival = arrival_order(seconds, seq % 2, F.call_function("div", seq, F.lit(2)))
    return inputs.log_view(spark, sf_dir).withColumn("arrival", arrival)


def daily_uv_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry pages in the order of time, partition and offset, hot devices in chunks."""
    logs = _two_partitions(spark, sf_dir).withColumn("ts", F.col("ts") - (F.col("seq") % 2) * 30_000_000)
    found = first_entry_per_day(logs, order="arrival", group_rows=FEW_ROWS)
    return found.select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def first_visit_repair_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first record of a device by time, partition and offset sets its first visit."""
    return repair_first_visit(_two_partitions(spark, sf_dir), order="arrival").select("seq", "mid", "ts", "is_new")


def daily_uv_partitions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same order on a stream of four batches."""
    out, checkpoint = _folders(spark)
    source = _landed_stream(spark, _two_partitions(spark, sf_dir))
    jobs.run_to_end(streams.first_entry_per_day_stream(source, file_sink(out), checkpoint, order="arrival"))
    return read_sink(spark, out).select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def jump_out_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry pages that nothing follows within the hour (an extension)."""
    found = match_timeouts(inputs.log_view(spark, sf_dir), is_blank("last_page_id"), HOUR_MS, columns=["seq", "ts"])
    return found.select("mid", F.col("first.seq").alias("seq"), F.col("first.ts").alias("ts"))


def jump_out_timeouts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs and time-outs of a stream that ended."""
    out, checkpoint = _folders(spark)
    entry = is_blank("last_page_id")
    source = _landed_stream(spark, inputs.log_view(spark, sf_dir))
    jobs.run_to_end(streams.match_next_stream(source, entry, entry, file_sink(out), checkpoint, HOUR_MS, row="is_new", timeouts=True))
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    matches = streams.NextMatches(spark, checkpoint, "bigint", HOUR_MS, timeouts=True)
    found = read_sink(spark, out).unionByName(matches.rest(last))
    return found.select("mid", F.col("first_seq").alias("seq"), F.col("second_seq").alias("s2"))


def daily_visitor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Devices and daily entries of every day, from the daily-unique-visitor log (an extension)."""
    visits = first_entry_per_day(inputs.log_view(spark, sf_dir))
    return daily_visitors(visits).select(F.col("visit_date").cast("string").alias("d"), "n_visitors", "n_visits")


def daily_uv_distinct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STA3's approximate form beside the exact one, on logs whose days arrive interleaved: devices and days, and how
    often the exact form emits them."""
    out, checkpoint = _folders(spark)
    logs = inputs.log_view(spark, sf_dir).withColumn("ts", F.col("ts") - F.when(F.col("seq") % 5 == 0, 86_400_000).otherwise(0))
    jobs.run_to_end(streams.distinct_entries_stream(_landed_stream(spark, logs), file_sink(out), checkpoint))
    exact = first_entry_per_day(logs).groupBy("mid", "visit_date").agg(F.count("*").alias("n_exact"))
    found = read_sink(spark, out).join(exact, ["mid", "visit_date"], "full")
    return found.select("mid", F.col("visit_date").cast("string").alias("d"), F.col("seq").isNotNull().alias("emitted"), "n_exact")


def config_asof_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asof(spark, sf_dir, group_rows=FEW_ROWS, max_rows=0)


def config_join_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = from_database(change_records(inputs.raw_changes(spark, sf_dir)), "shop")
    config = current_config(config_changes(inputs.raw_config(spark, sf_dir)))
    joined = route_current(records.select("seq", "table"), config, group_rows=FEW_ROWS, max_rows=0)
    return joined.select("seq", "table", "sink_table", "sink_columns")


#: Rows of one landed file: every trigger takes the same number of files, all of them far from empty.
FILE_ROWS = 250_000
#: A trigger has a file for each core, if they hold this many rows: a file is one task of everything that the batch does.
CORE_ROWS = 10_000


def _landed(spark: SparkSession, df: DataFrame, parts: int = 4, before: int = 0) -> tuple[str, str, int]:
    """Write rows in arrival order, ``parts`` triggers after ``before`` empty ones; the folder, the schema and the files of a trigger.

    Counting and cutting read the arrival numbers only, and each part writes its own rows, so text is made once.
    """
    path = shared_folder(spark, "landed")
    rows = df.count() // parts
    files = max(1, min(spark.sparkContext.defaultParallelism, rows // CORE_ROWS), rows // FILE_ROWS)
    cuts = df.select("seq").stat.approxQuantile("seq", [i / parts for i in range(1, parts)], 0.001) if parts > 1 else []
    for _ in range(before * files):
        df.limit(0).write.mode("append").parquet(path)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df.where((F.lit(True) if low is None else F.col("seq") > low) & (F.lit(True) if high is None else F.col("seq") <= high))
        part.repartition(files).write.mode("append").parquet(path)
    return path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), files


def _landed_stream(spark: SparkSession, df: DataFrame) -> DataFrame:
    path, schema, files = _landed(spark, df)
    return landed_text(spark, path, True, schema, files_per_trigger=files)


def _landed_log(spark: SparkSession, df: DataFrame, parts: int = 4, before: int = 0) -> DataFrame:
    """Raw text through the general reader."""
    path, _, files = _landed(spark, df.select("value", "seq"), parts, before)
    return read_log(spark, {"kind": "landed", "path": path, "files_per_trigger": files})


def _folders(spark: SparkSession) -> tuple[str, str]:
    return shared_folder(spark, "stream"), shared_folder(spark, "stream-checkpoint")


def first_visit_repair_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _folders(spark)
    jobs.run_to_end(streams.repair_first_visit_stream(_landed_stream(spark, inputs.log_view(spark, sf_dir)), file_sink(out), checkpoint))
    return read_sink(spark, out).select("seq", "mid", "ts", "is_new")


def daily_uv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _folders(spark)
    jobs.run_to_end(streams.first_entry_per_day_stream(_landed_stream(spark, inputs.log_view(spark, sf_dir)), file_sink(out), checkpoint))
    return read_sink(spark, out).select("seq", "mid", F.col("visit_date").cast("string").alias("d"))


def jump_out_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a stream that ended, with those that were open at its end."""
    out, checkpoint = _folders(spark)
    entry = is_blank("last_page_id")
    source = _landed_stream(spark, inputs.log_view(spark, sf_dir))
    jobs.run_to_end(streams.match_next_stream(source, entry, entry, file_sink(out), checkpoint, HOUR_MS, row="is_new"))
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    matches = streams.NextMatches(spark, checkpoint, "bigint", HOUR_MS)
    return read_sink(spark, out).unionByName(matches.rest(last)).select(
        "mid",
        F.col("first_seq").alias("seq"),
        F.col("second_seq").alias("s2"),
        F.col("first_ts").alias("ts"),
        F.col("second_ts").alias("t2"),
    )


def traffic_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _folders(spark)
    jobs.run_to_end(jobs.split_traffic_stream(_landed_log(spark, inputs.raw_log(spark, sf_dir)), file_sink(out, "channel"), checkpoint))
    return _channel_fields(read_sink(spark, out))


def _dimension_stream(spark: SparkSession, sf_dir: str, config: DataFrame, before: int = 0, **options) -> str:
    """The store of dimensions after four batches of changes; the configuration comes as one file, ``before`` empty ones ahead of it."""
    store, checkpoint = shared_folder(spark, "store"), shared_folder(spark, "store-checkpoint")
    changes = _landed_log(spark, inputs.raw_changes(spark, sf_dir))
    settings = _landed_log(spark, config, 1, before)
    jobs.run_to_end(jobs.route_dimensions_stream(changes, settings, "shop", store, checkpoint, as_of=True, buckets=FEW_BUCKETS, **options))
    return store


def _stored_dimensions(spark: SparkSession, store: str) -> DataFrame:
    rows = upserts.live(upserts.read_store(spark, store))
    column = lambda c, kind: F.col("data")[c].cast(kind).alias(c)
    return rows.select("sink_table", column("id", "bigint"), column("last_order", "bigint"), column("price", "double"))


def dimension_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions after four batches of changes, kept current by the stream."""
    return _stored_dimensions(spark, _dimension_stream(spark, sf_dir, inputs.raw_config(spark, sf_dir)))


def dimension_stream_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with deletes applied."""
    return _stored_dimensions(spark, _dimension_stream(spark, sf_dir, inputs.raw_config(spark, sf_dir), on_delete="delete"))


def dimension_late_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configuration arrives with the third batch; changes wait for it, and the result is that of the batch form."""
    return _stored_dimensions(spark, _dimension_stream(spark, sf_dir, inputs.raw_config(spark, sf_dir), before=2, park_batches=4))


def dimension_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dimensions read from the views that the stream published; every one gained a column on the way."""
    schema = f"dims_{uuid.uuid4().hex}"
    config = inputs.raw_config(spark, sf_dir)
    wider = config.where(F.get_json_object("value", "$.op") != "d").select(
        F.col("seq") + 250, F.replace("value", F.lit('"id,price"'), F.lit('"id,last_order,price"'))
    )
    _dimension_stream(spark, sf_dir, config.union(wider.toDF("seq", "value")), schema=schema)
    rows = [
        spark.table(f"{schema}.{t.name}").select(
            F.lit(t.name).alias("sink_table"), F.col("id").cast("bigint"), F.col("last_order").cast("bigint"), F.col("price").cast("double")
        )
        for t in spark.catalog.listTables(schema)
    ]
    return reduce(DataFrame.union, rows)


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of one table (SRC4): customers read, updated or deleted, in camel-case text."""
    key = F.col("c_custkey")
    image = F.struct(key.alias("cCustkey"), F.col("c_name").alias("cName"), F.col("c_mktsegment").alias("c_mktsegment"))
    op = F.when(key % 5 == 0, "d").when(key % 3 == 0, "u").otherwise("r")
    record = F.struct(op.alias("op"), F.when(op != "r", image).alias("before"), F.when(op != "d", image).alias("after"))
    text = F.to_json(record)
    text = F.when(key % 17 == 0, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    raw = inputs.table(spark, sf_dir, "customer").select(key.alias("seq"), text.alias("value"))
    found = table_changes(raw, ("c_custkey", "c_name", "c_mktsegment"), camel=True)
    return found.select("seq", "op", "is_deleted", F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_mktsegment")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        first_visit_repair,
        daily_uv,
        jump_out,
        changelog_fold,
        config_fold,
        config_join,
        config_asof_join,
        prune_columns,
        filter_db,
        dimension_routing,
        dimension_routing_asof,
        parse_dirty,
        json_paths,
        to_json_round_trip,
        route_split,
        explode_actions,
        field_drop,
        traffic_split,
        page_log_uv,
        page_log_jump_out,
        time_fns,
        upsert_last,
        dimension_upsert,
        dimension_compacted,
        create_table,
        channel_files,
        topic_rows,
        page_files_uv,
        page_files_jump_out,
        uv_topic_rows,
        traffic_split_element,
        parse_padded,
        page_rejected,
        dimension_dirty,
        dimension_compacted_delete,
        dimension_widened,
        first_visit_repair_large,
        daily_uv_large,
        daily_uv_sparse,
        config_asof_join_large,
        config_join_large,
        first_visit_repair_stream,
        daily_uv_stream,
        jump_out_stream,
        traffic_split_stream,
        dimension_stream,
        dimension_stream_delete,
        dimension_late_config,
        dimension_published,
        customer_log,
        daily_uv_clustered,
        daily_uv_partitions,
        first_visit_repair_partitions,
        daily_uv_partitions_stream,
        jump_out_timeouts,
        jump_out_timeouts_stream,
        daily_visitor_counts,
        daily_uv_distinct_stream,
    )
}
