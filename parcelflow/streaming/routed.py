"""Routing of a stream whose hot keys change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.routing import hot_keys_of, key_sketch, with_even_key
from parcelflow.sinks.landing import BatchSink
from parcelflow.sinks.tables import BATCH, add_batch, drop_batches, stored_rows

#: Batches whose sketches say which keys are hot.
RECENT = 16


def evenly_keyed(
    sink: BatchSink,
    path: str,
    partitions: int,
    key: str,
    spread_by: str,
    recent: int = RECENT,
    run: str | None = None,
) -> BatchSink:
    """A sink that gets each batch with ``_even_key``: its key, or a sub-key where the key is hot in the
    batch, or in it and the few before it together.

    Of every batch a sketch of its keys is kept at ``path``, one row, so a hot key is known without
    counting all that has passed, and is forgotten again.  A batch that is run again finds the same
    sketches and is routed the same way.
    """
    store = add_batch(path, run=run)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sketch = key_sketch(batch, key, partitions)
        store(sketch, batch_id)
        seen = stored_rows(spark, path, sketch.schema)
        lately = seen.filter(F.col(BATCH).between(batch_id - recent + 1, batch_id))
        now = seen.filter(F.col(BATCH) == batch_id)
        either = hot_keys_of(lately, partitions).unionByName(hot_keys_of(now, partitions))
        hot = either.groupBy("key").agg(F.max("ways").alias("ways"))
        sink(with_even_key(batch, partitions, key, spread_by, hot), batch_id)
        if batch_id % recent == 0:
            drop_batches(spark, path, batch_id - 2 * recent)

    return write
