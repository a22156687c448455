"""Replays of the base tables as streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelflow.sinks.messages import store
from parcelflow.sources.tables import table
from parcelflow.streaming.runner import run_to_end

EVENTS = """
    event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING,
    value DOUBLE, props STRING
"""
CUTS = ("2024-01-11", "2024-01-21")


def zoned(events: DataFrame) -> DataFrame:
    """``ts`` as a time with zone, which watermarks require."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoned(table(spark, sf_dir, "events"))


def time_cuts(
    events: DataFrame, column: str = "ts", bounds: Sequence[str] = CUTS
) -> list[DataFrame]:
    """Consecutive pieces by a zone-free time; the first and last are open-ended.

    Cut before any cast, so the bounds reach the scan.
    """
    time = F.col(column)
    edges = [F.lit(bound).cast("timestamp_ntz") for bound in bounds]
    after = [F.lit(True), *[time >= edge for edge in edges]]
    before = [*[time < edge for edge in edges], F.lit(True)]
    return [events.filter(low & high) for low, high in zip(after, before)]


def event_cuts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [zoned(cut) for cut in time_cuts(table(spark, sf_dir, "events"))]


def replay(
    cuts: Sequence[DataFrame], path: str, start: Callable[[], StreamingQuery]
) -> list[StreamingQuery]:
    """Store each cut, then run the query over what is new.

    Every run resumes from the query's checkpoint.  So the order of the cuts
    does not hang on file times, and a cut may be many files.
    """
    runs = []
    for cut in cuts:
        store(cut, path)
        runs.append(run_to_end(start()))
    return runs

