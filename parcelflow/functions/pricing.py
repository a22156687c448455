"""Price arithmetic.  Results are not rounded; rounding is for display."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow import vocabulary as V


def unit_price(price: Column, sqft: Column) -> Column:
    """Price per square foot, null where there is no area."""
    return F.when(sqft > 0, price / sqft)


def bedroom_factor(bedrooms: Column) -> Column:
    grown = 1 + (bedrooms - 1) * V.BEDROOM_STEP
    return F.when(bedrooms > 0, grown).when(bedrooms.isNotNull(), F.lit(1.0))


def age_factor(age: Column) -> Column:
    """New builds gain, builds past the old-build age lose; one old-build band."""
    return (
        F.when(age < V.NEW_BUILD_YEARS, F.lit(V.NEW_BUILD_FACTOR))
        .when(age > V.OLD_BUILD_YEARS, F.lit(V.OLD_BUILD_FACTOR))
        .when(age.isNotNull(), F.lit(1.0))
    )


def age_band(age: Column) -> Column:
    return (
        F.when(age < V.NEW_BUILD_YEARS, F.lit("new"))
        .when(age > V.OLD_BUILD_YEARS, F.lit("old"))
        .when(age.isNotNull(), F.lit("standard"))
    )


def class_factor(neighborhood_class: Column) -> Column:
    pairs = [F.lit(part) for pair in V.CLASS_FACTORS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), neighborhood_class)


def price_estimate(
    sqft: Column,
    base_price_per_sqft: Column,
    price_multiplier: Column,
    bedrooms: Column,
    age: Column,
    neighborhood_class: Column,
) -> Column:
    """Noise-free price; null where any factor is unknown."""
    factors = [
        sqft,
        price_multiplier,
        bedroom_factor(bedrooms),
        age_factor(age),
        class_factor(neighborhood_class),
    ]
    return reduce(lambda product, factor: product * factor, factors, base_price_per_sqft)
