"""Left joins to the city and property-type lookups, batch or stream-static.

The built-in lookups are local relations of 10 and 6 rows.  Catalyst sees their
size and broadcasts them; a caller's own lookup is joined by whatever strategy
its size allows, with AQE splitting hot keys.  A lookup has one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.vocabulary import city_dim, type_dim

CITY = "address.city"
TYPE = "property_details.type"


def _left_join(df: DataFrame, column: str, dim: DataFrame, key: str, prefix: str) -> DataFrame:
    renamed = dim.select(*[F.col(name).alias(f"{prefix}{name}") for name in dim.columns])
    joined = df.join(renamed, F.col(column) == F.col(f"{prefix}{key}"), "left")
    return joined.drop(f"{prefix}{key}")


def city_lookup(df: DataFrame, column: str = CITY, dim: DataFrame | None = None) -> DataFrame:
    """Adds ``city_state``, ``city_zip_prefix``, ``city_price_multiplier``."""
    dim = city_dim(df.sparkSession) if dim is None else dim
    return _left_join(df, column, dim, "city", "city_")


def type_lookup(df: DataFrame, column: str = TYPE, dim: DataFrame | None = None) -> DataFrame:
    """Adds ``type_sqft_min`` … ``type_bath_max``, ``type_base_price_per_sqft``."""
    dim = type_dim(df.sparkSession) if dim is None else dim
    return _left_join(df, column, dim, "type", "type_")
