"""Writing routed records: files by channel, or Kafka topics (SNK1-SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidemark.operators.split import CHANNEL_TOPICS

# Fixed value: 15 minutes.
TRANSACTION_TIMEOUT_MS = 15 * 60 * 1000


def write_channels(routed: DataFrame, path: str, mode: str = "append") -> None:
    """SNK2: all channels in one pass, one folder per channel."""
    routed.write.mode(mode).partitionBy("channel").parquet(path)


def stream_channels(routed: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """SNK2 for a stream: Spark's file sink, which writes each record exactly once."""
    return (
        routed.writeStream.format("parquet")
        .partitionBy("channel")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


# Fixed value: the topic of daily unique visitors.
UV_TOPIC = "dwd_traffic_uv_log"


def uv_topic_rows(visitors: DataFrame, topic: str = UV_TOPIC, key: str = "mid") -> DataFrame:
    """SNK3: ``topic, key, value`` rows of daily unique visitors; the value is the page record as it came in."""
    return visitors.select(F.lit(topic).alias("topic"), F.col(key).alias("key"), "value")


def to_topics(routed: DataFrame, topics: dict[str, str] = CHANNEL_TOPICS, key: str = "mid") -> DataFrame:
    """``topic, key, value`` rows for the Kafka sink; channels without a topic are left out.

    The device is the record key, so its records stay in order in one partition.
    """
    pairs = [F.lit(part) for pair in topics.items() for part in pair]
    topic = F.create_map(*pairs)[F.col("channel")]
    return routed.where(F.col("channel").isin(*topics)).select(
        topic.alias("topic"), F.col(key).alias("key"), F.col("value")
    )


def _kafka_options(servers: str, options: dict[str, str]) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.transaction.timeout.ms": str(TRANSACTION_TIMEOUT_MS),
        **options,
    }


def write_kafka(rows: DataFrame, servers: str, topic: str | None = None, **options: str) -> None:
    """SNK1/SNK3: batch write of ``[topic,] key, value`` rows."""
    writer = rows.write.format("kafka").options(**_kafka_options(servers, options))
    (writer.option("topic", topic) if topic else writer).save()


def stream_kafka(
    rows: DataFrame, servers: str, checkpoint: str, topic: str | None = None, **options: str
) -> DataStreamWriter:
    """SNK1/SNK3 for a stream. Spark's Kafka sink writes a record at least once."""
    writer = (
        rows.writeStream.format("kafka")
        .options(**_kafka_options(servers, options))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return writer.option("topic", topic) if topic else writer
