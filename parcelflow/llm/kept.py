"""Tables written once to the shared folder and read back: lineage ends there, so a
lost executor never costs more than the step that wrote them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelflow.workspace import fresh_dir


def kept(frame: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.option("compression", codec).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
