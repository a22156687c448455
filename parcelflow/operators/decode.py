"""Messages to typed listings.

No row is ever dropped: a value that cannot be read becomes an all-null row,
and a wrongly typed field becomes null on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.schema import LISTING, SUMMARY_FIELDS

# Naming the mode also tells Catalyst not to narrow the schema by itself, which
# would change what is kept of a truncated message.
PERMISSIVE = {"mode": "PERMISSIVE"}
DAMAGED = "_damaged"


def decode(
    messages: DataFrame,
    schema: str = LISTING,
    keep: Sequence[Column] = (),
    damaged_column: str | None = None,
) -> DataFrame:
    """Parse ``value`` and expand the record's fields to columns.

    ``keep`` carries envelope columns along (alias them: the record has a
    ``timestamp`` of its own).  ``damaged_column`` adds the text of messages
    that are broken or mistyped; null and empty values never appear there.
    """
    options = dict(PERMISSIVE)
    if damaged_column:
        schema = f"{schema}, {damaged_column} STRING"
        options["columnNameOfCorruptRecord"] = damaged_column
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, options).alias("_record")
    kept = list(keep)
    return messages.select(parsed, *kept).select("_record.*", *_names(messages, kept))


def _names(messages: DataFrame, kept: Sequence[Column]) -> list[str]:
    return messages.select(*kept).columns if kept else []


def _narrowed(schema: T.StructType, fields: Sequence[str]) -> T.StructType:
    """The part of ``schema`` that the dotted ``fields`` name, in schema order."""
    wanted = [path.split(".") for path in fields]
    kept = []
    for field in schema:
        inner = [".".join(path[1:]) for path in wanted if path[0] == field.name]
        if not inner:
            continue
        if all(inner):
            field = T.StructField(field.name, _narrowed(field.dataType, inner))
        kept.append(field)
    return T.StructType(kept)


def _picked(record: Column, schema: T.StructType) -> Column:
    """``record`` cut down to ``schema``."""
    parts = []
    for field in schema:
        part = record[field.name]
        if isinstance(field.dataType, T.StructType):
            part = _picked(part, field.dataType)
        parts.append(part.alias(field.name))
    return F.struct(*parts)


def decode_fields(
    messages: DataFrame,
    fields: Sequence[str] = SUMMARY_FIELDS,
    schema: str = LISTING,
    keep: Sequence[Column] = (),
) -> DataFrame:
    """Like ``decode`` followed by a selection of ``fields``, but cheaper.

    Only the named fields are built.  A message the narrow parse finds damaged
    is parsed again with the whole schema, since the two keep different parts
    of a truncated record; so the values are those of ``decode`` on every row.
    """
    whole = T.StructType.fromDDL(schema)
    narrow = _narrowed(whole, fields)
    marked = T.StructType([*narrow, T.StructField(DAMAGED, T.StringType())])
    kept = list(keep)
    quick = F.from_json(
        F.col("value").cast("string"), marked, {**PERMISSIVE, "columnNameOfCorruptRecord": DAMAGED}
    )
    quick_part = _picked(F.col("_quick"), narrow)
    # The marker of a damaged message is its text; the text of the others is not carried along.
    damaged = F.col(f"_quick.{DAMAGED}")
    # Inside a one-element array, so that the record is parsed once for all fields.
    careful = F.array(F.from_json(damaged, whole, PERMISSIVE))
    careful_part = F.get(F.transform(careful, lambda record: _picked(record, narrow)), F.lit(0))
    names = _names(messages, kept)
    return (
        messages.select(quick.alias("_quick"), *kept)
        .select(F.when(damaged.isNull(), quick_part).otherwise(careful_part).alias("_record"), *names)
        .select("_record.*", *names)
    )
