"""Messages that reach their readers once, though a batch may be sent twice.

A batch is first stored in the outbox, each message with an identifier of its own in its headers, then sent from
there, then marked as sent.  What is not marked is sent again, from the same stored rows and so with
the same identifiers, by which a reader drops what it has had.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.sinks.landing import BatchSink, query_id
from parcelflow.sinks.snapshots import SnapshotLog

#: The header that tells messages apart.
MESSAGE_ID = "message-id"
HEADERS = "headers ARRAY<STRUCT<key: STRING, value: BINARY>>"
STORED = f"key BINARY, value BINARY, topic STRING, partition INT, {HEADERS}"

Send = Callable[[DataFrame], None]


def _named(messages: DataFrame, run: str, batch_id: int) -> DataFrame:
    name = F.concat_ws("-", F.lit(run), F.lit(batch_id), F.monotonically_increasing_id())
    header = F.array(F.struct(F.lit(MESSAGE_ID).alias("key"), name.cast("binary").alias("value")))
    return messages.withColumn("headers", header)


def _waiting(spark: SparkSession, path: str) -> list[dict]:
    return SnapshotLog(spark, path).read()[1].get("waiting", [])


def _store(messages: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Put a batch into the outbox, but for one that is there or has been sent: it is the same."""
    spark = messages.sparkSession
    _, state = SnapshotLog(spark, path).read()
    known = any((e["run"], e["batch"]) == (run, batch_id) for e in state.get("waiting", []))
    if known or batch_id <= state.get("sent", {}).get(run, -1):
        return
    folder = f"data/{run}-{batch_id}"
    named = _named(messages, run, batch_id)
    named.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{folder}")

    def change(now: dict) -> tuple[dict, list[str]]:
        entry = {"run": run, "batch": batch_id, "folder": folder}
        return {**now, "waiting": [*now.get("waiting", []), entry]}, []

    SnapshotLog(spark, path).commit(change)


def send_waiting(spark: SparkSession, path: str, send: Send) -> int:
    """Send what is in the outbox and not marked, batch by batch; returns the number of batches."""
    due = _waiting(spark, path)
    for entry in due:
        rows = spark.read.parquet(f"{path}/{entry['folder']}")
        send(rows)

        def change(now: dict, entry: dict = entry) -> tuple[dict, list[str]]:
            sent = now.get("sent", {})
            sent[entry["run"]] = max(sent.get(entry["run"], -1), entry["batch"])
            left = [e for e in now.get("waiting", []) if e != entry]
            return {**now, "waiting": left, "sent": sent}, [entry["folder"]]

        SnapshotLog(spark, path).commit(change)
    return len(due)


def outbox_sink(path: str, send: Send, run: str | None = None) -> BatchSink:
    """The callback that sends a stream's messages by way of the outbox at ``path``.  What an earlier
    run left there unmarked goes first."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(batch, path, run or query_id(batch), batch_id)
        send_waiting(batch.sparkSession, path, send)

    return write


def message_id() -> Column:
    """A message's identifier, from its headers; null for one that was not sent by an outbox."""
    found = F.filter("headers", lambda header: header["key"] == MESSAGE_ID)
    return F.get(found, F.lit(0))["value"].cast("string")


def read_once(messages: DataFrame) -> DataFrame:
    """Each message once; on a stream, of those within the delay of its watermark.  A message
    without an identifier is told from others by a random one."""
    named = messages.withColumn("_message_id", F.coalesce(message_id(), F.uuid()))
    drop = named.dropDuplicatesWithinWatermark if messages.isStreaming else named.dropDuplicates
    return drop(["_message_id"]).drop("_message_id")
