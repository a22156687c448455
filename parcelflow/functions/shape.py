"""Fields that only land, or only buildings, carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.vocabulary import LAND


def is_land(property_type: Column) -> Column:
    return property_type == LAND


def only_land(property_type: Column, value: Column) -> Column:
    return F.when(is_land(property_type), value)


def only_building(property_type: Column, value: Column) -> Column:
    return F.when(property_type != LAND, value)


def zero_on_land(property_type: Column, value: Column) -> Column:
    return F.when(is_land(property_type), F.lit(0)).otherwise(value)
