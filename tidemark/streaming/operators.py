"""Streaming forms of the keyed operators: each micro-batch meets the state that earlier ones left.

Every form returns a writer. What it emits goes to ``sink(rows, batch_id)``, for instance ``state.file_sink``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.functions.paths import is_missing
from tidemark.functions.time import DAY_MS, DISPLAY_ZONE, local_date
from tidemark.operators import sizes
from tidemark.operators.patterns import JUMP_OUT_MS, match_next, match_timeouts
from tidemark.operators.visits import NEW, RETURNING, first_entry_per_day, first_visit_dates
from tidemark.streaming.state import Notes, Sink, Span, StateTable, batch_writer

# Fixed value: how long a device's last visit is remembered after it was written.
VISIT_TTL_MS = DAY_MS

# How far a row's time may lie behind the newest one seen: partitions of a topic are read at different speeds.
LATENESS_MS = 60 * 1000

BEFORE_ALL = -(1 << 62)


class FirstVisits:
    """STA2: the first-visit date of every device seen so far, written once and never changed."""

    def __init__(self, spark: SparkSession, checkpoint: str, key_type: str, key: str = "mid", is_new: str = "is_new", ts: str = "ts", order: str = "seq", tz: str = DISPLAY_ZONE):
        columns = f"key {key_type}, day date, first_claim date, last_claim date, known boolean"
        self.table = StateTable(spark, checkpoint, "first-visits", columns, lambda rows: rows.where("NOT known"))
        self.key, self.is_new, self.ts, self.order, self.tz = key, is_new, ts, order, tz

    def repair(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch with ``is_new`` corrected. Rows without a key or a time stay as they are and leave no state."""
        dated = batch.where(F.col(self.ts).isNotNull())
        own = first_visit_dates(dated, self.key, self.is_new, self.ts, self.order, self.tz).withColumnRenamed(self.key, "key").persist()
        seen = self.table.before(batch_id, own).select("key", F.col("day").alias("_day"))
        joined = own.join(seen, "key", "left").select(
            "key", F.coalesce("_day", "first_visit_date").alias("day"), "first_claim", "last_claim", F.col("_day").isNotNull().alias("known")
        )
        stored = self.table.write(batch_id, joined)
        own.unpersist()
        wrong = stored.where("first_claim <> day OR last_claim <> day").select(F.col("key").alias(self.key), F.col("day").alias("_first_day"))
        claims = (F.col(self.is_new) == NEW) & F.col(self.ts).isNotNull()
        looked = sizes.lookup_join(batch, wrong, self.key, self.order, claims)
        late = F.coalesce(claims & (local_date(self.ts, self.tz) != F.col("_first_day")), F.lit(False))
        return looked.withColumn(self.is_new, F.when(late, F.lit(RETURNING)).otherwise(F.col(self.is_new))).select(*batch.columns)


class DailyVisits:
    """STA3/STA4: the day of every device's last emitted entry page; forgotten ``ttl_ms`` after it was written.

    Rows are filed by the period of ``ttl_ms`` (a day, unless set otherwise) in which they were written, so what a batch
    can still need lies in two periods. A period before those is dropped as a whole when a new one begins. Each
    batch's clock is noted before anything else, and a batch that runs again takes the same.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, key_type: str, key: str = "mid", ts: str = "ts", order: str = "seq", entry: Column | None = None, tz: str = DISPLAY_ZONE, ttl_ms: int | None = VISIT_TTL_MS, clock: Callable[[], int] | None = None):
        latest = lambda rows: rows.groupBy("key").agg(
            *[F.max_by(c, "version").alias(c) for c in ("day", "written_at")], F.max("version").alias("version")
        )
        self.table = StateTable(spark, checkpoint, "daily-visits", f"key {key_type}, day date, written_at bigint", latest)
        self.marks = Notes(spark, checkpoint, "daily-visit-marks")
        self.key, self.ts, self.order, self.tz, self.ttl_ms = key, ts, order, tz, ttl_ms
        self.entry = is_missing("last_page_id") if entry is None else entry
        self.clock = clock or (lambda: int(time.time() * 1000))

    def _mark(self, batch_id: int) -> dict:
        """The batch's clock and periods; noted at its first run."""
        if (mark := self.marks.of(batch_id)) is not None:
            return mark
        last = self.marks.of(batch_id - 1)
        now = max(self.clock(), last["now"]) if last else self.clock()
        period = now // self.ttl_ms if self.ttl_ms else 0
        if last and last["period"] == period:
            return self.marks.write(batch_id, last | {"now": now})
        old = (last["period"], last["first"]) if last else (None, None)
        mark = self.marks.write(batch_id, {"now": now, "period": period, "first": batch_id, "old_period": old[0], "old_first": old[1]})
        if last and last["old_period"] is not None:
            self.table.forget(last["old_period"])
        return mark

    def fresh(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Entry pages whose day differs from the device's previous one; adds ``visit_date``."""
        mark = self._mark(batch_id)
        spans = [Span(mark["period"], mark["first"], batch_id)]
        if mark["old_period"] is not None and mark["old_period"] >= mark["period"] - 1:
            spans.append(Span(mark["old_period"], mark["old_first"], mark["first"]))
        # No device of a batch that one task could sort needs to be split.
        group_rows = None if batch.count() <= sizes.GROUP_ROWS else sizes.GROUP_ROWS
        found = first_entry_per_day(batch, self.key, self.ts, self.order, self.entry, self.tz, group_rows)
        # A device's first entry page of the batch is always among those found.
        entries = batch.where(self.entry & F.col(self.key).isNotNull()).groupBy(F.col(self.key).alias("key"))
        heads = entries.agg(F.min_by(local_date(self.ts, self.tz), self.order).alias("_day"), F.min(self.order).alias("_head"))
        known = self.table.before(batch_id, heads, spans)
        if self.ttl_ms is not None:
            known = known.where(F.col("written_at") > mark["now"] - self.ttl_ms)
        again = known.join(heads, "key").where("day = _day").select(F.col("key").alias(self.key), F.col("_head").alias(self.order))
        kept = found.join(again, [self.key, self.order], "left_anti").persist()
        last = kept.groupBy(F.col(self.key).alias("key")).agg(F.max_by("visit_date", self.order).alias("day"))
        self.table.write(batch_id, last.withColumn("written_at", F.lit(mark["now"]).cast("bigint")), mark["period"], mark["first"])
        return kept


class NextMatches:
    """STA6/STA8: pairs of adjacent rows of a key in event-time order, decided once the watermark has passed them.

    The watermark is the newest time seen less ``lateness_ms``. Rows behind that of the batch before come too late: they
    are left out and counted. State holds only rows that a later pair can need, so it ends with the traffic.

    With ``timeouts`` also first rows that nothing follows in time (an extension): the second half is NULL. One comes out
    once the watermark is ``within_ms`` past it.
    """

    FIELDS = "ts bigint, seq {order_type}, is_first boolean, is_second boolean, row string"

    def __init__(self, spark: SparkSession, checkpoint: str, key_type: str, within_ms: int = JUMP_OUT_MS, key: str = "mid", lateness_ms: int = LATENESS_MS, timeouts: bool = False, order_type: str = "bigint"):
        self.fields = self.FIELDS.format(order_type=order_type)
        self.rows = StateTable(spark, checkpoint, "match-rows", f"key {key_type}, {self.fields}")
        self.marks = Notes(spark, checkpoint, "match-marks")
        self.within_ms, self.key, self.lateness_ms, self.timeouts = within_ms, key, lateness_ms, timeouts

    def _watermark(self, batch_id: int) -> int:
        mark = self.marks.of(batch_id)
        return mark["watermark"] if mark else BEFORE_ALL

    def step(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """``batch`` holds ``key`` and ``FIELDS``."""
        mark = self.marks.of(batch_id - 1)
        passed, late = (mark["watermark"], mark["late"]) if mark else (BEFORE_ALL, 0)
        seen = batch.agg(F.max("ts").alias("newest"), F.count_if(F.col("ts") < passed).alias("late")).first()
        newest = BEFORE_ALL if seen["newest"] is None else seen["newest"] - self.lateness_ms
        watermark = max(passed, newest)
        rows = self.rows.of(batch_id - 1).union(batch.where(F.col("ts") >= passed).select("key", "ts", "seq", "is_first", "is_second", "row"))
        self.marks.write(batch_id, {"watermark": watermark, "late": late + seen["late"]})
        kept = rows.where(F.col("ts") >= watermark - self.within_ms)
        self.rows.write(batch_id, kept)
        return self._pairs(rows, passed, watermark)

    def rest(self, last_batch_id: int) -> DataFrame:
        """The pairs that are still open, for a stream that has ended."""
        return self._pairs(self.rows.of(last_batch_id), self._watermark(last_batch_id), None)

    def late_rows(self, last_batch_id: int) -> int:
        """How many rows came too late in all batches so far."""
        mark = self.marks.of(last_batch_id)
        return mark["late"] if mark else 0

    def _pairs(self, rows: DataFrame, start: int, end: int | None) -> DataFrame:
        pairs = match_next(rows, F.col("is_first"), F.col("is_second"), self.within_ms, "key", columns=["ts", "seq", "row"])
        at = F.col("second.ts")
        pairs = pairs.where((at >= start) & (at < end if end is not None else F.lit(True)))
        half = lambda name: [F.col(f"{name}.{c}").alias(f"{name}_{c}") for c in ("ts", "seq", "row")]
        out = pairs.select(F.col("key").alias(self.key), *half("first"), *half("second"))
        if not self.timeouts:
            return out
        alone = match_timeouts(rows, F.col("is_first"), self.within_ms, "key", columns=["ts", "seq", "row"])
        over = F.col("first.ts") + self.within_ms
        alone = alone.where((over > start) & (over <= end if end is not None else F.lit(True)))
        return out.unionByName(alone.select(F.col("key").alias(self.key), *half("first")), allowMissingColumns=True)


def key_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def repair_first_visit_stream(
    df: DataFrame, sink: Sink, checkpoint: str, key: str = "mid", is_new: str = "is_new", ts: str = "ts", order: str = "seq", tz: str = DISPLAY_ZONE
) -> DataStreamWriter:
    """STA2 on a stream: same columns, ``is_new`` corrected."""
    visits = FirstVisits(df.sparkSession, checkpoint, key_type(df, key), key, is_new, ts, order, tz)
    return batch_writer(df, checkpoint, visits.repair, sink)


def first_entry_per_day_stream(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    key: str = "mid",
    ts: str = "ts",
    order: str = "seq",
    entry: Column | None = None,
    tz: str = DISPLAY_ZONE,
    ttl_ms: int | None = VISIT_TTL_MS,
) -> DataStreamWriter:
    """STA3/STA4 on a stream; adds ``visit_date``. Works with every trigger."""
    visits = DailyVisits(df.sparkSession, checkpoint, key_type(df, key), key, ts, order, entry, tz, ttl_ms)
    return batch_writer(df, checkpoint, visits.fresh, sink)


def match_rows(df: DataFrame, first: Column, second: Column, key: str = "mid", ts: str = "ts", order: str = "seq", row: Column | str = "value") -> DataFrame:
    """Rows as :class:`NextMatches` takes them; only rows that can be part of a pair keep their text."""
    row = F.col(row) if isinstance(row, str) else row
    first, second = F.coalesce(first, F.lit(False)), F.coalesce(second, F.lit(False))
    return df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("key"),
        F.col(ts).alias("ts"),
        F.col(order).alias("seq"),
        first.alias("is_first"),
        second.alias("is_second"),
        F.when(first | second, row).cast("string").alias("row"),
    )


def match_next_stream(
    df: DataFrame,
    first: Column,
    second: Column,
    sink: Sink,
    checkpoint: str,
    within_ms: int = JUMP_OUT_MS,
    key: str = "mid",
    ts: str = "ts",
    order: str = "seq",
    row: Column | str = "value",
    lateness_ms: int = LATENESS_MS,
    timeouts: bool = False,
) -> DataStreamWriter:
    """STA6/STA8 on a stream: pairs with ``first_*`` and ``second_*`` time, arrival number and text.

    ``timeouts`` adds first rows that nothing follows in time. A pair appears once the watermark has passed it; ``NextMatches.rest`` gives those that are open when a stream ends.
    """
    matches = NextMatches(df.sparkSession, checkpoint, key_type(df, key), within_ms, key, lateness_ms, timeouts, key_type(df, order))
    return batch_writer(match_rows(df, first, second, key, ts, order, row), checkpoint, matches.step, sink)


def distinct_entries_stream(
    df: DataFrame, sink: Sink, checkpoint: str, key: str = "mid", ts: str = "ts", entry: Column | None = None, tz: str = DISPLAY_ZONE, lateness: str = "2 days"
) -> DataStreamWriter:
    """STA3, approximate form: one entry page of each device and day, by Spark's own state of recent pairs.

    It differs from :func:`first_entry_per_day_stream` where days of a device arrive interleaved: there every change of day
    counts again, here each day counts once. Which page of the day comes out is not fixed. ``lateness`` is how far
    event times may lie behind the newest one; later rows are lost, and state is kept for as long.
    """
    entry = is_missing("last_page_id") if entry is None else entry
    rows = df.where(entry & F.col(key).isNotNull() & F.col(ts).isNotNull())
    timed = rows.withColumn("visit_date", local_date(ts, tz)).withColumn("_at", F.timestamp_millis(F.col(ts)))
    once = timed.withWatermark("_at", lateness).dropDuplicatesWithinWatermark([key, "visit_date"]).drop("_at")
    return once.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
