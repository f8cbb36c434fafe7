"""Keyed state of a stream as tables beside its checkpoint.

Every micro-batch writes one folder, named by its number, and reads only folders of earlier batches, so a batch that runs
again finds the same state and replaces what it wrote. Every ``FOLD_EVERY`` folders of one level are folded into one of the
next, so a state of many batches is read from few folders, and a row is rewritten a few times in all.

Rows are filed by hash blocks of their key, sorted, in short pages. A batch that touches few blocks asks for those only,
and the Parquet reader skips all other pages: a batch of 1,000 keys reads about a hundredth of 10 million rows. A batch that
touches very many blocks reads the whole table, which is then not much larger than the batch. Either way the work is
joins and aggregates in the JVM, and a key of many rows is combined before it is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.session import no_rows, read_note, write_note

FOLD_EVERY = 20

#: Keys are hashed into 2**this blocks, and pages hold this many rows (writers look at sizes every 100 rows).
BLOCK_BITS = 18
PAGE_ROWS = 100
#: A folder has at most 2**this files.
FILE_BITS = 10
#: A batch that touches more blocks than this reads the whole state.
MAX_BLOCKS = 1024

Fold = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Span:
    """Batches ``first`` up to, not including, ``end``, filed under one ``period``."""

    period: int
    first: int
    end: int


def block_of(key: Column | str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BLOCK_BITS).cast("int")


class StateTable:
    """``schema`` names the columns, the first of which is the key.

    ``fold`` brings rows of several batches (``version``) down to what still counts.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, name: str, schema: str, fold: Fold | None = None):
        self.spark, self.root, self.schema = spark, f"{checkpoint.rstrip('/')}-state/{name}", schema
        self.key = schema.split()[0]
        self.fold = fold or (lambda rows: rows)
        # Longer lists of values reach the Parquet reader as a range, which skips nothing.
        threshold = "spark.sql.parquet.pushdown.inFilterThreshold"
        if int(spark.conf.get(threshold)) < MAX_BLOCKS:
            spark.conf.set(threshold, str(MAX_BLOCKS))

    def _folder(self, level: int, start: int, period: int = 0) -> str:
        return f"{self.root}/period={period}/{level}-{start}"

    def _read(self, paths: list[str], keys: DataFrame | None = None) -> DataFrame:
        schema = f"{self.schema}, version bigint, block int"
        if not paths:
            return no_rows(self.spark, schema).drop("block")
        rows = self.spark.read.schema(schema).parquet(*paths)
        if keys is not None:
            touched = keys.select(block_of(self.key).alias("block")).distinct().limit(MAX_BLOCKS + 1).collect()
            if len(touched) <= MAX_BLOCKS:
                rows = rows.where(F.col("block").isin([r["block"] for r in touched]))
        return rows.drop("block")

    def _store(self, rows: DataFrame, path: str) -> None:
        # Neighbouring blocks go to one file, so that a block is looked for in one page or two.
        filed = rows.withColumn("block", block_of(self.key)).repartition(F.shiftright("block", BLOCK_BITS - FILE_BITS)).sortWithinPartitions("block")
        filed.write.mode("overwrite").option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path)

    @staticmethod
    def _covering(count: int) -> list[tuple[int, int]]:
        """The fewest folders, as level and start, that hold ``count`` batches."""
        level, out, at = 0, [], 0
        while FOLD_EVERY ** (level + 1) <= count:
            level += 1
        while level >= 0:
            while at + FOLD_EVERY**level <= count:
                out.append((level, at))
                at += FOLD_EVERY**level
            level -= 1
        return out

    def before(self, batch_id: int, keys: DataFrame | None = None, spans: list[Span] | None = None) -> DataFrame:
        """What the batches before ``batch_id`` left, folded; with the ``version`` column.

        With ``keys`` (a frame with the key's column) only blocks of those keys are read; others may be among the rows.
        """
        spans = [Span(0, 0, batch_id)] if spans is None else spans
        for span in spans:
            self._raise(span)
        paths = [self._folder(level, start, span.period) for span in spans for level, start in self._covering(span.end - span.first)]
        return self.fold(self._read(paths, keys))

    def _raise(self, span: Span) -> None:
        """Fold the folders that the last batch of the span has completed, level by level."""
        count, level = span.end - span.first, 1
        while count and count % FOLD_EVERY**level == 0:
            start, width = count - FOLD_EVERY**level, FOLD_EVERY ** (level - 1)
            parts = [self._folder(level - 1, start + k * width, span.period) for k in range(FOLD_EVERY)]
            self._store(self.fold(self._read(parts)), self._folder(level, start, span.period))
            level += 1

    def write(self, batch_id: int, rows: DataFrame, period: int = 0, first: int = 0) -> DataFrame:
        """Store the batch's rows and read them back."""
        self._store(rows.selectExpr("*", f"CAST({batch_id} AS bigint) AS version"), self._folder(0, batch_id - first, period))
        return self.of(batch_id, period, first)

    def of(self, batch_id: int, period: int = 0, first: int = 0) -> DataFrame:
        """The rows that one batch left; none before the first."""
        return self._read([self._folder(0, batch_id - first, period)] if batch_id >= first else []).drop("version")

    def forget(self, period: int) -> None:
        """Drop all rows filed under a period."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/period={period}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


class Notes:
    """What each batch notes beside its state, a few numbers: a batch that runs again finds its own note."""

    def __init__(self, spark: SparkSession, checkpoint: str, name: str):
        self.spark, self.root = spark, f"{checkpoint.rstrip('/')}-state/{name}"

    def write(self, batch_id: int, note: dict) -> dict:
        write_note(self.spark, f"{self.root}/{batch_id}.json", json.dumps(note))
        return note

    def of(self, batch_id: int) -> dict | None:
        text = read_note(self.spark, f"{self.root}/{batch_id}.json") if batch_id >= 0 else None
        return None if text is None else json.loads(text)


def file_sink(path: str, *partitions: str) -> Sink:
    """Each batch's rows in a folder of its own, which a batch that runs again replaces."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`file_sink` wrote."""
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


def batch_writer(source: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], DataFrame], sink: Sink) -> DataStreamWriter:
    """A stream whose batches go through ``handle`` to ``sink``. Batch and result are kept until the sink has them."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        rows = None
        try:
            rows = handle(batch, batch_id)
            sink(rows, batch_id)
        finally:
            batch.unpersist()
            if rows is not None:
                rows.unpersist()

    return source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).outputMode("append")
