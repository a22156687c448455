"""Listings to nested records, and records to keyed JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.schema import LISTING


def assemble(
    flat: DataFrame,
    sources: Mapping[str, str] | None = None,
    keep: tuple[str, ...] = (),
    schema: str = LISTING,
) -> DataFrame:
    """Gather flat columns into the nested record.

    A field takes the flat column of its own name; ``sources`` maps dotted
    paths to other column names (``{"agent.id": "agent_id"}``).
    """
    named = dict(sources or {})

    def build(struct: T.StructType, prefix: str) -> list[Column]:
        parts = []
        for field in struct:
            path = f"{prefix}{field.name}"
            if isinstance(field.dataType, T.StructType):
                part = F.struct(*build(field.dataType, f"{path}."))
            else:
                part = F.col(named.get(path, field.name))
            parts.append(part.alias(field.name))
        return parts

    return flat.select(*keep, *build(T.StructType.fromDDL(schema), ""))


def record_json(*columns: str) -> Column:
    """One JSON object, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def encode(
    listings: DataFrame,
    key: Column,
    topic: str,
    columns: list[str] | None = None,
    partition: Column | None = None,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """Keyed JSON messages in the layout Spark's Kafka sink writes."""
    fields = columns or listings.columns
    out = [
        key.cast("string").cast("binary").alias("key"),
        record_json(*fields).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    ]
    if partition is not None:
        out.append(partition.cast("int").alias("partition"))
    return listings.select(*out, *keep)
