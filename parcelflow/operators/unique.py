"""Identifiers that should be unique and are not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATS = "repeats"


def repeated_ids(df: DataFrame, column: str = "property_id") -> DataFrame:
    """``column`` and ``repeats``, the rows that share it, for every identifier of more than one row.

    The count combines before the shuffle, so an identifier that a third of all rows have costs a row a task.
    Rows without one repeat nothing.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(REPEATS))
    return counts.filter(F.col(REPEATS) > 1)


def with_repeats(df: DataFrame, column: str = "property_id") -> DataFrame:
    """The rows with ``repeats``, how many have their identifier: null if no other has.

    A second pass joins the repeated ones only; AQE divides a hot one and broadcasts few.
    """
    found = repeated_ids(df, column).withColumnRenamed(column, "_repeated")
    return df.join(found, F.col(column) == F.col("_repeated"), "left").select(*df.columns, REPEATS)


def first_of_each(stream: DataFrame, column: str = "property_id") -> DataFrame:
    """Of a stream with a watermark, the rows whose identifier has not come within its delay, and all rows
    without one.  State holds an identifier no longer than that."""
    named = stream.withColumn("_identifier", F.coalesce(F.col(column), F.uuid()))
    return named.dropDuplicatesWithinWatermark(["_identifier"]).drop("_identifier")
