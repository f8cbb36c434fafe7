"""Raw text sources, batch and streaming (SRC1-SRC4).

Every reader returns ``value STRING`` and an arrival number ``seq BIGINT``. A
topic keyed by device (or by primary key) keeps that key's records in one
partition, so the offset orders them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Upper bounds on what one micro-batch takes in. A keyed operator gets all rows
# that one key has in a batch in one task, so this bounds a hot key's share too.
# History is loaded with the batch plans, which split hot keys.
OFFSETS_PER_TRIGGER = 2_000_000
FILES_PER_TRIGGER = 32

LANDED_SCHEMA = "value string, seq bigint"


def kafka_text(
    spark: SparkSession,
    servers: str,
    topic: str,
    stream: bool = True,
    offsets_per_trigger: int = OFFSETS_PER_TRIGGER,
    **options: str,
) -> DataFrame:
    """SRC1: a Kafka topic as text; a missing value stays NULL.

    Needs Spark's Kafka connector on the class path. ``options`` pass through,
    for example ``startingOffsets`` or ``kafka.group.id``.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if stream:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_trigger)
    return kafka_columns(reader.options(**options).load())


def kafka_columns(df: DataFrame) -> DataFrame:
    """Text, partition and offset of Kafka rows; key and headers are dropped, the broker's time only orders.

    ``seq`` orders the records of one partition, ``arrival`` those of all partitions.
    """
    arrival = arrival_order(F.unix_millis("timestamp"), F.col("partition"), F.col("offset")).alias("arrival")
    return df.select(F.col("value").cast("string").alias("value"), "partition", F.col("offset").alias("seq"), arrival)


def arrival_order(time_ms: Column, partition: Column, offset: Column) -> Column:
    """One number for the order (broker time, partition, offset), as every operator's ``order`` takes it.

    Needed where a key's records lie in several partitions, whose offsets do not compare. Within a partition brokers
    that set the time on arrival never step back, so each partition keeps its own order. 38 digits: 14 for the time, 5
    for the partition, 19 for the offset.
    """
    digits = lambda c, width: F.lpad(c.cast("string"), width, "0")
    return F.concat(digits(time_ms, 14), digits(partition, 5), digits(offset, 19)).cast("decimal(38,0)")


def landed_text(
    spark: SparkSession,
    path: str,
    stream: bool = True,
    schema: str = LANDED_SCHEMA,
    format: str = "parquet",
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """SRC1/SRC3: a topic already landed as files that keep its arrival numbers."""
    if not stream:
        return spark.read.schema(schema).format(format).load(path)
    return (
        spark.readStream.schema(schema)
        .format(format)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )


def read_log(spark: SparkSession, source: dict[str, object], stream: bool = True) -> DataFrame:
    """SRC2: one entry for every job: ``{"kind": "kafka", ...}`` or ``{"kind": "landed", ...}``."""
    options = dict(source)
    kind = options.pop("kind")
    if kind == "kafka":
        return kafka_text(spark, stream=stream, **options)
    if kind == "landed":
        return landed_text(spark, stream=stream, **options)
    raise ValueError(f"unknown source kind {kind!r}")
