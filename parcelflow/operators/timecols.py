"""Which clock a row is counted under.

A watermark follows the greatest event time seen, so one wrong time in the future
makes every later row late.  Rows on their own clock are therefore told apart before
the watermark: ``trusted`` ones lead it, the others are counted by themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.times import parse_record_time

PROCESSING_TIME = "processing_timestamp"
EVENT_TIME = "event_time"
DELAY = "10 minutes"


def stamp_processing_time(df: DataFrame) -> DataFrame:
    """The time of the micro-batch; one value per batch, kept when it is retried."""
    return df.withColumn(PROCESSING_TIME, F.current_timestamp())


def stamp_record_time(
    df: DataFrame, text: str = "timestamp", fallback: str | None = None
) -> DataFrame:
    """The record's own time.

    Damaged records carry none.  They take the ``fallback`` column (such as the
    message's time) or else the processing time, so every row falls into a
    window.  The column is therefore never null, which also spares the plan a
    null filter: pushed below the decoding, it would parse each message twice.

    For tables, not for watermarks: there a fallback would pass for an event time.
    A stream takes ``split_by_trust``.
    """
    times = [parse_record_time(F.col(text)), F.current_timestamp()]
    if fallback:
        times.insert(1, F.col(fallback))
    return df.withColumn(EVENT_TIME, F.coalesce(*times))


AHEAD = "1 hour"
TRUSTED = "_trusted"


def mark_trusted(
    df: DataFrame, message_time: str, text: str = "timestamp", ahead: str = AHEAD
) -> DataFrame:
    """The record's own time, and whether it may lead a watermark: it can be read, and
    is at most ``ahead`` of the time of its message (or, without one, of now)."""
    record = parse_record_time(F.col(text))
    sent = F.coalesce(F.col(message_time), F.current_timestamp())
    sound = record <= sent + F.expr(f"INTERVAL {ahead}")
    return df.withColumns({EVENT_TIME: record, TRUSTED: F.coalesce(sound, F.lit(False))})


def split_by_trust(
    df: DataFrame, message_time: str, text: str = "timestamp", ahead: str = AHEAD
) -> tuple[DataFrame, DataFrame]:
    """Rows whose event time may lead a watermark, and the rest: damaged records and
    implausible times, under the time of their message."""
    marked = mark_trusted(df, message_time, text, ahead)
    trusted = marked.filter(TRUSTED).drop(TRUSTED)
    rest = marked.filter(~F.col(TRUSTED)).drop(TRUSTED)
    return trusted, rest.withColumn(EVENT_TIME, F.col(message_time))


def watermarked(df: DataFrame, column: str = PROCESSING_TIME, delay: str = DELAY) -> DataFrame:
    return df.withWatermark(column, delay)
