"""Parquet targets for streaming results, one callback per output mode.

Executors write; nothing passes through the driver but the names of folders.  Each callback gives the
same table when a batch is retried, and a reader never meets half a result.

A result belongs to a run, the id of the query that made it, which comes with its checkpoint.  The first
commit of a run opens an epoch above all others, and readers read the newest epoch.  So a
query that starts over with a fresh checkpoint, whose batches are numbered from 0 again, starts a
new result: it neither hides behind the old one nor mixes with it.  Earlier epochs stay readable by
number until ``forget`` drops them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.operators.quality import side
from parcelflow.sinks.landing import BatchSink, query_id
from parcelflow.sinks.snapshots import SnapshotLog

BATCH = "batch_id"
ENTRY = "entry"
#: Emissions of update mode that may wait to be folded, where the sink folds.
FOLD_AFTER = 64

Finish = Callable[[DataFrame], DataFrame]


def _fresh_folder() -> str:
    return f"data/{ENTRY}={uuid.uuid4().hex}"


def _as_given(rows: DataFrame) -> DataFrame:
    return rows


def _store(
    rows: DataFrame, path: str, run: str, batch_id: int, whole: bool, by: Sequence[str] = ()
) -> None:
    """Write one batch of a run, then commit it: as the whole result, or as an addition.
    A batch that is run again takes the place of its first attempt."""
    folder = _fresh_folder()
    writer = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/{folder}")

    def change(state: dict) -> tuple[dict, list[str]] | None:
        epochs, entries = state.get("epochs", {}), state.get("entries", [])
        epoch = epochs.setdefault(run, max(epochs.values(), default=0) + 1)
        mine = [e for e in entries if e["epoch"] == epoch]
        if whole:
            done, gone = any(batch_id < e["last"] for e in mine), mine
        else:  # a folded entry holds several batches
            done = any(e["first"] < e["last"] and batch_id <= e["last"] for e in mine)
            gone = [e for e in mine if e["last"] == batch_id]
        if done:
            return {**state, "epochs": epochs, "entries": entries}, [folder]
        entry = {"epoch": epoch, "run": run, "first": batch_id, "last": batch_id, "folder": folder}
        left = [e for e in entries if e not in gone]
        return {**state, "epochs": epochs, "entries": [*left, entry]}, [e["folder"] for e in gone]

    SnapshotLog(rows.sparkSession, path).commit(change)


def replace_table(path: str, finish: Finish = _as_given, run: str | None = None) -> BatchSink:
    """Complete mode: every batch is the whole result, read by ``published_table``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(finish(batch), path, run or query_id(batch), batch_id, whole=True)

    return write


def add_batch(
    path: str, finish: Finish = _as_given, run: str | None = None, by: Sequence[str] = ()
) -> BatchSink:
    """Append mode, or a log of emissions: every batch adds to those before, read by
    ``published_table`` or, with its batch numbers, ``stored_rows``.  Values of the columns ``by`` lie
    in folders of their own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(finish(batch), path, run or query_id(batch), batch_id, whole=False, by=by)

    return write


def upsert(
    path: str, keys: Sequence[str] = (), run: str | None = None, fold_after: int = FOLD_AFTER
) -> BatchSink:
    """Update mode: emissions that ``upserted`` reads.  With ``keys`` the sink folds them
    itself, whenever more than ``fold_after`` wait, so neither their number nor a reader's plan grows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(batch, path, run or query_id(batch), batch_id, whole=False)
        if keys and len(_newest_entries(batch.sparkSession, path)) > fold_after:
            compact(batch.sparkSession, path, keys, batch.schema)

    return write


def accumulate(
    path: str, keys: Sequence[str], run: str | None = None, fold_after: int = FOLD_AFTER
) -> BatchSink:
    """Batches of rows that add up: ``accumulated`` gives their sums by ``keys``.  The sink folds
    them whenever more than ``fold_after`` wait."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _store(batch, path, run or query_id(batch), batch_id, whole=False)
        if len(_newest_entries(batch.sparkSession, path)) > fold_after:
            compact(batch.sparkSession, path, keys, batch.schema, fold=summed)

    return write


def split_sink(path: str, run: str | None = None) -> BatchSink:
    """Rule-checked rows of a stream, stored by ``side`` in one pass."""

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("side", side())
        _store(marked, path, run or query_id(batch), batch_id, whole=False, by=["side"])

    return write


def _newest_entries(spark: SparkSession, path: str, epoch: int | None = None) -> list[dict]:
    entries = SnapshotLog(spark, path).read()[1].get("entries", [])
    if epoch is None:
        epoch = max((e["epoch"] for e in entries), default=0)
    return [e for e in entries if e["epoch"] == epoch]


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _read(spark: SparkSession, path: str, schema: T.StructType | str, entries: list[dict]) -> DataFrame:
    """The rows of some entries, with their batch numbers, in one scan however many they are."""
    numbered = T.StructType([*_schema(schema).fields, T.StructField(BATCH, T.LongType())])
    if not entries:
        return spark.createDataFrame([], numbered)
    reader = spark.read.schema(numbered).option("basePath", f"{path}/data")
    return reader.parquet(*[f"{path}/{e['folder']}" for e in entries]).select(*numbered.names)


def stored_rows(
    spark: SparkSession, path: str, schema: T.StructType | str, epoch: int | None = None
) -> DataFrame:
    """All rows of the newest epoch, or of the one asked for, with their ``batch_id``."""
    return _read(spark, path, schema, _newest_entries(spark, path, epoch))


def published_table(
    spark: SparkSession, path: str, schema: T.StructType | str, epoch: int | None = None
) -> DataFrame:
    """The result of complete or append mode; no rows before the first."""
    return stored_rows(spark, path, schema, epoch).drop(BATCH)


def result_epochs(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """Epoch, run and last batch of every result that can be read, the oldest first."""
    last: dict[tuple[int, str], int] = {}
    for e in SnapshotLog(spark, path).read()[1].get("entries", []):
        key = e["epoch"], e["run"]
        last[key] = max(last.get(key, -1), e["last"])
    return sorted((epoch, run, batch) for (epoch, run), batch in last.items())


def drop_batches(spark: SparkSession, path: str, before: int) -> None:
    """Drop the newest epoch's batches before a number."""
    newest = max((epoch for epoch, _, _ in result_epochs(spark, path)), default=0)

    def change(state: dict) -> tuple[dict, list[str]] | None:
        entries = state.get("entries", [])
        old = [e for e in entries if e["epoch"] == newest and e["last"] < before]
        if not old:
            return None
        return {**state, "entries": [e for e in entries if e not in old]}, [e["folder"] for e in old]

    SnapshotLog(spark, path).commit(change)


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Drop the results of all epochs before a number."""

    def change(state: dict) -> tuple[dict, list[str]] | None:
        entries = state.get("entries", [])
        old = [e for e in entries if e["epoch"] < before]
        if not old:
            return None
        return {**state, "entries": [e for e in entries if e not in old]}, [e["folder"] for e in old]

    SnapshotLog(spark, path).commit(change)


# Types whose values an aggregate can change in place, which lets it hash.
_IN_PLACE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _newest(schema: T.StructType, values: Sequence[str], version: str) -> tuple[list[Column], list[Column]]:
    """Aggregates that take the values of the newest version, and what to select after."""
    plain = [c for c in values if isinstance(schema[c].dataType, _IN_PLACE)]
    rest = [c for c in values if c not in plain]
    made = [F.max_by(c, version).alias(c) for c in plain]
    chosen = [F.col(c) for c in plain]
    if rest:
        made.append(F.max_by(F.struct(*rest), F.col(version)).alias("_rest"))
        chosen += [F.col(f"_rest.{c}").alias(c) for c in rest]
    return made, chosen


def latest_per_key(
    emissions: DataFrame, keys: Sequence[str], version: str = BATCH, keep_version: bool = False
) -> DataFrame:
    """The upsert view of update mode: the last emission of every key.

    ``max_by`` combines before the shuffle, so a key that changed in every
    batch still moves one row per task; over numbers and times it aggregates by hash.
    """
    values = [name for name in emissions.columns if name not in (*keys, version)]
    if not values and not keep_version:
        return emissions.select(*keys).distinct()
    made, chosen = _newest(emissions.schema, values, version)
    made += [F.max(version).alias(version)] * keep_version
    latest = emissions.groupBy(*keys).agg(*made)
    latest = latest.select(*keys, *chosen, *[version] * keep_version)
    return latest.select(*[c for c in emissions.columns if c != version or keep_version])


def summed(rows: DataFrame, keys: Sequence[str], version: str = BATCH, keep_version: bool = False) -> DataFrame:
    """Rows with the same keys added up, in all their other columns."""
    added = [F.sum(c).alias(c) for c in rows.columns if c not in (*keys, version)]
    added += [F.max(version).alias(version)] * keep_version
    return rows.groupBy(*keys).agg(*added)


def accumulated(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: T.StructType | str,
    epoch: int | None = None,
) -> DataFrame:
    """The sums of all batches that ``accumulate`` stored, folded ones among them."""
    rows = stored_rows(spark, path, schema, epoch)
    return summed(rows, keys).select(*[c for c in rows.columns if c != BATCH])


def upserted(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: T.StructType | str,
    epoch: int | None = None,
) -> DataFrame:
    """Update mode's table: the newest emission of every key, folded ones among them."""
    return latest_per_key(stored_rows(spark, path, schema, epoch), keys)


def compact(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    schema: T.StructType | str,
    upto: int | None = None,
    fold: Callable[..., DataFrame] | None = None,
) -> None:
    """Fold the newest epoch's emissions, up to a batch or all, into one row a key: the latest, or
    by another ``fold``.

    The commit is the switch.  A crash before it leaves the emissions as they were; batches that
    arrive meanwhile stay beside what is folded, and one that is run again after it is passed over.
    """
    due = [e for e in _newest_entries(spark, path) if upto is None or e["last"] <= upto]
    if len(due) < 2:
        return
    folder = _fresh_folder()
    rows = _read(spark, path, schema, due)
    (fold or latest_per_key)(rows, keys, keep_version=True).write.parquet(f"{path}/{folder}")
    folded = {
        "epoch": due[0]["epoch"], "run": due[0]["run"], "folder": folder,
        "first": min(e["first"] for e in due), "last": max(e["last"] for e in due),
    }

    def change(state: dict) -> tuple[dict, list[str]] | None:
        entries = state["entries"]
        if any(e not in entries for e in due):  # folded by another, or a batch was run again
            return {**state}, [folder]
        left = [e for e in entries if e not in due]
        return {**state, "entries": [*left, folded]}, [e["folder"] for e in due]

    SnapshotLog(spark, path).commit(change)


def store_split(marked: DataFrame, path: str) -> None:
    """Rule-checked rows under ``side=valid/`` and ``side=quarantined/``, in one pass."""
    marked.withColumn("side", side()).write.partitionBy("side").parquet(path)
