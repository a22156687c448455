"""Replay folders."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from parcelflow.sinks.messages import store
from parcelflow.sources.messages import file_messages


def test_a_stored_file_is_the_work_of_several_tasks(spark, tmp_path):
    """A scan divides a file between its row groups only."""
    body = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f"-{n}")), 512) for n in range(8)])
    sent = spark.range(0, 30_000, 1, 1).select(
        F.lit(b"k").alias("key"), body.cast("binary").alias("value"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit("2024-01-01").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    store(sent, str(tmp_path))
    (file,) = tmp_path.glob("*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 2
    found = file_messages(spark, str(tmp_path))
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 2 and max(t["count"] for t in tasks) < 20_000
    assert found.count() == 30_000 and found.exceptAll(sent).count() == 0
