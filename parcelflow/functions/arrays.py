"""Amenity lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import vocabulary as V


def first_names(names: Column, n: int = 3) -> Column:
    return F.slice(names, 1, n)


def unknown_names(names: Column, known: Sequence[str] = tuple(V.AMENITIES)) -> Column:
    return F.array_except(names, F.array(*[F.lit(name) for name in known]))


def is_distinct(names: Column) -> Column:
    return F.size(F.array_distinct(names)) == F.size(names)


def name_counts(df: DataFrame, names: str, alias: str = "amenity") -> DataFrame:
    """Listings per array element.  Counts combine before the shuffle, so a
    name that most rows share costs one row per task."""
    return (
        df.select(F.explode(names).alias(alias))
        .groupBy(alias)
        .agg(F.count(F.lit(1)).alias("listing_count"))
    )
