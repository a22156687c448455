"""Starting named queries and waiting for them."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from parcelflow.sinks.landing import BatchSink


def _named(df: DataFrame, name: str, mode: str, checkpoint_root: str) -> DataStreamWriter:
    return (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
    )


def _timed(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Every ``interval``; without one, all that is available now, then stop."""
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)


_starting = threading.Lock()


@contextmanager
def _state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """A stateful query takes its partition count when it first starts and keeps it
    in its checkpoint, so the session's setting can be put back right after.  Starts
    with a count of their own wait for each other."""
    if not count:
        yield
        return
    name = "spark.sql.shuffle.partitions"
    with _starting:
        before = spark.conf.get(name)
        spark.conf.set(name, count)
        try:
            yield
        finally:
            spark.conf.set(name, before)


def start_to_sink(
    df: DataFrame,
    sink: BatchSink,
    name: str,
    checkpoint_root: str,
    mode: str = "append",
    interval: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """``partitions`` is the number of state partitions; by default the session's."""
    writer = _named(df, name, mode, checkpoint_root).foreachBatch(sink)
    with _state_partitions(df.sparkSession, partitions):
        return _timed(writer, interval).start()


def console_sink(rows: int = 20, finish: Callable[[DataFrame], DataFrame] | None = None) -> BatchSink:
    """Prints each batch, untruncated, after a last step if one is given."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"Batch {batch_id}")
        (finish(batch) if finish else batch).show(rows, truncate=False)

    return write


def start_to_console(
    df: DataFrame,
    name: str,
    checkpoint_root: str,
    mode: str = "update",
    interval: str | None = None,
    partitions: int | None = None,
    rows: int = 20,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    return start_to_sink(df, console_sink(rows, finish), name, checkpoint_root, mode, interval, partitions)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()
    return query


def await_any(spark: SparkSession, queries: Iterable[StreamingQuery]) -> None:
    """Block until some query of the session ends, raise its failure, and stop the
    given ones."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
