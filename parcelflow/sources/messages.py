"""Message feeds: Kafka topics, and files that replay one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow.schema import ENVELOPE
from parcelflow.settings import Settings


def kafka_options(settings: Settings) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.brokers,
        "subscribe": settings.topic,
        "startingOffsets": settings.starting_offsets,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }
    if settings.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(settings.max_offsets_per_trigger)
    if settings.min_partitions:
        # Splits long offset ranges, so a hot topic partition feeds many tasks.
        options["minPartitions"] = str(settings.min_partitions)
    return options


def kafka_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(settings)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str = ENVELOPE,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Replay of Parquet files, oldest first; the envelope unless told otherwise."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def file_messages(spark: SparkSession, path: str, schema: str = ENVELOPE) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
