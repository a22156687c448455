"""Window summaries that hand on the rows they came too late for.

A plain streaming aggregate drops rows behind the watermark without a trace.  Here one stateful operator
decides for each row, and gives out both kinds: when the watermark passes the end of a window, a
timer closes it with its count and mean, once, as in append mode; a row whose window is
closed comes out as it went in.  So closed and open windows and late rows together hold every row,
whatever the batches.

A group's state is its count, its exact sum and a timer, and goes when the window closes.  A row is late if
the watermark has passed the end of its window and the group holds no state.  Needs the
RocksDB state store (``SESSION_CONF`` sets it).  The state is kept in Python, so this costs more a row than
``windowed_summary``; it is for feeds whose late rows must be accounted for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LATE = "late"
#: Every finite double is a whole number of these.
_UNIT = 1 << 1074
_STATE = "row_count BIGINT, value_count BIGINT, total STRING, odd DOUBLE"


class _Windows(StatefulProcessor):
    """Keyed by the window's start and end, in microseconds, and the group's keys."""

    def __init__(self, keys: Sequence[str], carried: Sequence[str]) -> None:
        self._keys, self._carried = list(keys), list(carried)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("window", _STATE)

    def _line(self, key: tuple, **values: Any) -> Row:
        start, end, *rest = key
        given = dict(zip(self._keys, rest, strict=True))
        whole = {"start": start, "end": end, **given, "row_count": None, "mean": None, LATE: None, **values}
        return Row(**whole)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        end = key[1] // 1000
        known = self._state.exists()
        if not known and end <= timerValues.getCurrentWatermarkInMs():
            for row in rows:
                yield self._line(key, **{LATE: Row(**{name: row[name] for name in self._carried})})
            return
        count, values, total, odd = self._state.get() if known else (0, 0, "0", 0.0)
        units = int(total)
        for row in rows:
            count += 1
            value = row["_value"]
            if value is None:
                continue
            values += 1
            if value - value != 0:  # infinite, or no number
                odd += value
            else:
                top, bottom = value.as_integer_ratio()
                units += top * (_UNIT // bottom)
        self._state.update((count, values, str(units), odd))
        if not known:
            self._handle.registerTimer(end)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        count, values, total, odd = self._state.get()
        self._state.clear()
        mean = None
        if values:
            mean = odd if odd else _mean(int(total), values)
        yield self._line(key, row_count=count, mean=mean)

    def close(self) -> None:
        pass


def _mean(units: int, values: int) -> float:
    """The sum, rounded once, over the number of values; as ``operators.exact`` has it."""
    if not units:
        return 0.0
    shift = abs(units).bit_length() - _UNIT.bit_length()
    head = float(Fraction(units, _UNIT) / Fraction(2) ** shift) / values
    return head * 2.0 ** (shift // 2) * 2.0 ** (shift - shift // 2)


def summary_with_late_rows(
    df: DataFrame, time_col: str, keys: Sequence[str], value: str, carried: Sequence[str], width: str
) -> DataFrame:
    """Of a stream with a watermark on ``time_col``: ``window_start``, ``window_end``, the ``keys``, and either
    ``row_count`` and the ``mean`` of ``value`` for a window that has closed, or ``late``, the ``carried``
    columns of a row that came after.  For append mode."""
    bucket = F.window(time_col, width)
    # In plain numbers: a column that has the watermark would be filtered by it before the operator.
    start, end = (F.unix_micros(part.cast("timestamp")) for part in (bucket["start"], bucket["end"]))
    moved = {time_col: F.timestamp_micros(F.unix_micros(F.col(time_col)))}
    held = [moved.get(name, F.col(name)).alias(name) for name in carried]
    rows = df.select(
        start.alias("_start"), end.alias("_end"), *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(value).cast("double").alias("_value"), *held,
    )
    late = T.StructType([rows.schema[name] for name in carried])
    out = T.StructType(
        [
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            *[T.StructField(k, rows.schema[f"_key_{k}"].dataType) for k in keys],
            T.StructField("row_count", T.LongType()),
            T.StructField("mean", T.DoubleType()),
            T.StructField(LATE, late),
        ]
    )
    found = rows.groupBy("_start", "_end", *[f"_key_{k}" for k in keys]).transformWithState(
        statefulProcessor=_Windows(keys, carried), outputStructType=out, outputMode="append", timeMode="eventTime"
    )
    return found.select(
        *[
            F.timestamp_micros(part).cast("timestamp_ntz").alias(f"window_{part}") for part in ("start", "end")
        ],
        *keys, "row_count", "mean", LATE,
    )
