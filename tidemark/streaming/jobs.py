"""The four warehouse jobs as Structured Streaming queries.

Each returns a writer; the caller picks source, sink and trigger. Writers always carry a checkpoint location, and keyed
state lies beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.functions.paths import is_blank, is_missing
from tidemark.functions.time import DISPLAY_ZONE
from tidemark.operators.patterns import JUMP_OUT_MS
from tidemark.operators.records import log_records
from tidemark.operators.split import route_channels
from tidemark.plans.jobs import page_records
from tidemark.streaming.dimensions import DimensionTables, dimension_source
from tidemark.streaming.operators import (
    LATENESS_MS,
    VISIT_TTL_MS,
    FirstVisits,
    first_entry_per_day_stream,
    match_next_stream,
)
from tidemark.streaming.state import Sink, batch_writer


def split_traffic_stream(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    order: str = "seq",
    tz: str = DISPLAY_ZONE,
    context: str = "record",
    keep_start_context: bool = False,
) -> DataStreamWriter:
    """Traffic split on a stream of ``value`` and ``order``: channel rows as in the batch plan.

    Records are parsed once; dirty rows have no device and leave no state.
    """
    visits = FirstVisits(raw.sparkSession, checkpoint, "string", order=order, tz=tz)

    def handle(records: DataFrame, batch_id: int) -> DataFrame:
        return route_channels(visits.repair(records, batch_id), context, keep_start_context)

    return batch_writer(log_records(raw), checkpoint, handle, sink)


def daily_unique_visitors_stream(
    pages: DataFrame, sink: Sink, checkpoint: str, order: str = "seq", tz: str = DISPLAY_ZONE, ttl_ms: int | None = VISIT_TTL_MS
) -> DataStreamWriter:
    """Daily unique visitor on a page-log stream."""
    return first_entry_per_day_stream(
        page_records(pages), sink, checkpoint, order=order, entry=is_missing("last_page_id"), tz=tz, ttl_ms=ttl_ms
    )


def jump_outs_stream(
    pages: DataFrame,
    sink: Sink,
    checkpoint: str,
    order: str = "seq",
    within_ms: int = JUMP_OUT_MS,
    last_page: str = "page.last_page_id",
    lateness_ms: int = LATENESS_MS,
    timeouts: bool = False,
) -> DataStreamWriter:
    """Jump-out on a page-log stream; a pair appears once the watermark has passed it. ``timeouts`` adds entry pages that
    nothing follows in time."""
    entry = is_blank("last_page_id")
    return match_next_stream(page_records(pages, last_page), entry, entry, sink, checkpoint, within_ms, order=order, lateness_ms=lateness_ms, timeouts=timeouts)


def route_dimensions_stream(
    changes: DataFrame, config: DataFrame, database: str, store: str, checkpoint: str, order: str = "seq", as_of: bool = False, **options
) -> DataStreamWriter:
    """Dimension routing on streams of change text and configuration text; keeps the dimensions in ``store`` current.

    A batch is routed by the configuration known at its end: the versions in force, or with ``as_of`` those at each
    record's arrival number. ``options`` are those of :class:`~tidemark.streaming.dimensions.DimensionTables`: reading of
    deletes, batches that a change may wait for its configuration, the schema in which dimensions are published, a folder
    for the change log, and a sink for rows left out.
    """
    tables = DimensionTables(changes.sparkSession, checkpoint, database, store, order, as_of, **options)
    source = dimension_source(changes, config, order)
    return source.writeStream.foreachBatch(tables.run).option("checkpointLocation", checkpoint).outputMode("append")


def run_to_end(writer: DataStreamWriter, timeout_s: int = 600) -> None:
    """Process everything available now and stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query did not finish within {timeout_s} s")
