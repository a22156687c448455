"""Day-partitioned landing of micro-batches, safe to retry."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelflow.operators.timecols import PROCESSING_TIME
from parcelflow.schema import DAY_KEYS, LEAF_KEY
from parcelflow.sinks import manifest
from parcelflow.sinks.files import delete

BatchSink = Callable[[DataFrame, int], None]
#: Folder of a landed table for batches on their way into it; no reader looks there.
STAGED = "_staged"


def land(
    batch: DataFrame,
    path: str,
    run: str,
    batch_id: int,
    time_col: str = PROCESSING_TIME,
    gather: bool | None = None,
    compression: str = "snappy",
    max_records_per_file: int | None = None,
    files: int | None = None,
    apart: Sequence[str] = (),
) -> list[str]:
    """Write one batch under ``year=/month=/day=/leaf=<run>-<batch>``, then make it live.

    The day comes from the rows and the leaf from the batch, so a retry meets
    its own directories and replaces them.  ``run`` keeps a query that starts
    over at batch 0 from replacing what an earlier one landed.  The manifest gets the
    leaves with their least and greatest time; until then no reader sees them.

    A batch stamped with its processing time holds one day and is written as it
    is, without a shuffle.  Under any other clock a batch can touch many days, and
    every task would write a file per day.  So it is first put down as it is, in columns; if its
    files hold many days each, the rows are gathered by day, where AQE
    divides a day too big for one task and merges small ones.  Otherwise they are not moved, since a shuffle
    writes several times what the columns take.  ``gather`` says which, and nothing is put down.  ``files`` is the most files to write for a batch: the many small
    tasks of a wide topic are then run together, without a shuffle.  ``apart`` names columns whose
    values get folders of their own within the leaf.  Returns the leaves, for a look at what was written.
    """
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run is named by letters, digits, dots and dashes, not {run!r}")
    moment = F.col(time_col)
    leaf = f"{run}-{batch_id}"
    if gather is None and time_col != PROCESSING_TIME:
        staged = f"{path}/{STAGED}/{leaf}"
        batch.write.mode("overwrite").option("compression", compression).parquet(staged)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(staged)
        given = (path, run, batch_id, time_col, _scattered(rows, moment))
        leaves = land(rows, *given, compression, max_records_per_file, files, apart)
        delete(batch.sparkSession, staged)
        return leaves
    keyed = batch.withColumns(
        {
            "year": F.year(moment),
            "month": F.month(moment),
            "day": F.dayofmonth(moment),
            "run": F.lit(run),
            "batch_id": F.lit(batch_id).cast("bigint"),
            LEAF_KEY: F.lit(leaf),
        }
    )
    if files:
        keyed = keyed.coalesce(files)
    if gather:
        keyed = keyed.hint("rebalance", *DAY_KEYS)
    seen = Observation(f"landed-{leaf}")
    writer = (
        keyed.observe(seen, F.collect_set(F.struct(*DAY_KEYS)).alias("days"), *_extent(time_col))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*DAY_KEYS, LEAF_KEY, *apart)
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)
    found = seen.get
    days = [tuple(day) for day in found["days"] or []]
    if not days:
        return []
    folders = {day: f"{manifest.day_folder(*day)}/{LEAF_KEY}={leaf}" for day in days}
    if len(days) == 1:
        extents = {days[0]: (found["rows"], found["first"], found["last"])}
    else:  # one more look, at the time alone
        kind = batch.schema[time_col].dataType.simpleString()
        written = batch.sparkSession.read.schema(
            f"`{time_col}` {kind}, year INT, month INT, day INT, {LEAF_KEY} STRING"
        ).option("basePath", path).parquet(*[f"{path}/{folder}" for folder in folders.values()])
        per_day = written.groupBy(*DAY_KEYS).agg(*_extent(time_col)).collect()
        extents = {tuple(row[:3]): tuple(row[3:]) for row in per_day}
    entries = [
        dict(zip(manifest.NAMES, (folders[day], *day, run, batch_id, *extents[day]), strict=True)) for day in days
    ]
    manifest.add(batch.sparkSession, path, run, batch_id, entries)
    return list(folders.values())


def _scattered(rows: DataFrame, moment: Column) -> bool:
    """Whether the days lie so that about each file holds rows of several of them."""
    where = rows.select(F.input_file_name().alias("file"), F.to_date(moment).alias("day")).distinct()
    day = F.coalesce(F.col("day").cast("string"), F.lit(""))
    met = where.agg(F.count(F.lit(1)), F.count_distinct("file"), F.count_distinct(day)).first()
    return met[0] > met[1] + met[2]


def _extent(time_col: str) -> list:
    moment = F.unix_micros(F.col(time_col).cast("timestamp"))
    return [F.count(F.lit(1)).alias("rows"), F.min(moment).alias("first"), F.max(moment).alias("last")]


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that runs this batch; it outlives restarts
    from the same checkpoint and changes with a new one."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("no streaming query runs here: name the run")
    return found


def landing_sink(
    path: str, time_col: str = PROCESSING_TIME, run: str | None = None, **options
) -> BatchSink:
    """The callback for ``foreachBatch``; the run is the query's id unless named."""

    def write(batch: DataFrame, batch_id: int) -> None:
        land(batch, path, run or query_id(batch), batch_id, time_col, **options)

    return write
