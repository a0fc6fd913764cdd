"""Message topics as streaming sources and as sinks.

The Kafka connector must be on the class path to open these; without it, ``file_messages`` reads
the same messages from files, one per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from adlumen.schemas import IMPRESSION_TOPIC

# Microseconds are kept: the default text form of a timestamp stops at milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def kafka_messages(spark: SparkSession, servers: str, topic: str = IMPRESSION_TOPIC,
                   max_per_batch: int | None = None, **options: str) -> DataFrame:
    """The topic as a stream, from its beginning unless the query's checkpoint knows better."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.options(**options).load()


def file_messages(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Files of JSON lines, whatever their suffix, as a stream with the same ``value`` column."""
    reader = spark.readStream.format("text")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def topic_messages(rows: DataFrame, key: str = "advertiser_id") -> DataFrame:
    """Rows as topic messages; one key's messages stay in one topic partition, in order."""
    return rows.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*rows.columns), JSON_OPTIONS).alias("value"),
    )


def publish(rows: DataFrame, servers: str, topic: str = IMPRESSION_TOPIC, key: str = "advertiser_id") -> None:
    """Send a batch of rows; failed tasks are retried, hence at least once."""
    (
        topic_messages(rows, key).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        .option("topic", topic).save()
    )


def publish_stream(rows: DataFrame, servers: str, checkpoint: str,
                   topic: str = IMPRESSION_TOPIC, key: str = "advertiser_id") -> DataStreamWriter:
    """The streaming form of ``publish``, to be started by the caller."""
    return (
        topic_messages(rows, key).writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
        .option("topic", topic).option("checkpointLocation", checkpoint)
    )
