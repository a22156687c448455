"""Keyed JSON messages out: a Kafka topic, or files that can be replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelflow.settings import Settings
from parcelflow.sinks.landing import BatchSink

#: Bytes of a row group of a replay folder, as stored.  A scan divides a file only between row groups, and zstd
#: puts some hundred thousand messages into the usual 128 MB, all of them then parsed by one task.
ROW_GROUP = 4 << 20


def kafka_sink_options(settings: Settings) -> dict[str, str]:
    # Delivery settings of the feed.
    return {
        "kafka.bootstrap.servers": settings.brokers,
        "topic": settings.topic,
        "kafka.acks": "all",
        "kafka.retries": "10",
        "kafka.linger.ms": "50",
        "kafka.batch.size": "16384",
        "kafka.compression.type": "snappy",
        "kafka.max.in.flight.requests.per.connection": "5",
    }


def send(messages: DataFrame, settings: Settings) -> None:
    messages.write.format("kafka").options(**kafka_sink_options(settings)).save()


def sender(settings: Settings) -> BatchSink:
    """The callback that sends a stream's messages; a retried batch is sent again, as the
    topic's delivery is at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        send(batch, settings)

    return write


def store(messages: DataFrame, path: str) -> None:
    """Add the messages to a replay folder.  Texts of one kind are mostly alike, so zstd makes less than
    half of them that the default codec does.  Row groups are small, so that all tasks have a share of a batch
    of few files."""
    writer = messages.write.mode("append").option("compression", "zstd")
    writer.option("parquet.block.size", ROW_GROUP).parquet(path)
