"""Streams of messages in the layout of the Kafka source: ``key``, ``value``, ``timestamp``.

The Kafka reader and writer need the connector package on the session's class path. Files
of messages have the same layout, so everything behind the source is the same for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MESSAGE = "key binary, value binary, timestamp timestamp"

# Defaults of the message source.
TOPIC = "transactions"
ALERT_TOPIC = "fraud-alerts"
MESSAGES_PER_BATCH = 5000


def kafka_options(
    servers: str, topic: str = TOPIC, per_batch: int = MESSAGES_PER_BATCH, starting: str = "latest"
) -> dict[str, str]:
    """What the reader is told: the topic, where to begin without a checkpoint, and the messages of a micro-batch."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "maxOffsetsPerTrigger": str(per_batch),
        "failOnDataLoss": "false",
    }


def kafka_messages(spark: SparkSession, servers: str, **options) -> DataFrame:
    """New messages of one topic; ``options`` as ``kafka_options`` takes them."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, **options))
    return reader.load().select("key", "value", "timestamp")


def file_messages(
    spark: SparkSession, path: str, files_per_batch: int | None = 1, bytes_per_batch: int | None = None
) -> DataFrame:
    """Messages from parquet files as they appear in a folder, at most so many files or bytes (one file at least) in a
    micro-batch.
    """
    reader = spark.readStream.schema(MESSAGE)
    if bytes_per_batch is not None:
        return reader.option("maxBytesPerTrigger", bytes_per_batch).parquet(path)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(path)


def source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """The message stream of the given kind, ``kafka`` or ``files``."""
    readers = {"kafka": kafka_messages, "files": file_messages}
    return readers[kind](spark, **options)


def publish(messages: DataFrame, servers: str, topic: str = ALERT_TOPIC) -> None:
    """Write a batch of ``key`` and ``value`` to a topic."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
