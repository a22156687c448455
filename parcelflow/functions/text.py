"""Description text and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow.functions.arrays import first_names
from parcelflow.vocabulary import AGENT_ID_FORMAT


def capitalised(text: Column) -> Column:
    """First letter upper, all the rest lower (not title case)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))


def counted(number: Column, noun: str) -> Column:
    """``2 bedrooms`` / ``1 bedroom``."""
    plural = F.when(number > 1, F.lit("s")).otherwise(F.lit(""))
    return F.concat(number.cast("string"), F.lit(f" {noun}"), plural)


def description(
    lead: Column,
    bedrooms: Column,
    bathrooms: Column,
    property_type: Column,
    amenities: Column,
    tail: Column,
) -> Column:
    """One capitalised sentence on the property, then ``tail``.

    Room counts that are zero or missing, and empty amenity lists, are left out.
    """
    nothing = F.lit("")
    beds = F.when(bedrooms > 0, F.concat(F.lit(" "), counted(bedrooms, "bedroom")))
    baths = F.when(bathrooms > 0, F.concat(F.lit(", "), counted(bathrooms, "bathroom")))
    more = F.when(F.size(amenities) > 3, F.lit(" and more")).otherwise(nothing)
    extras = F.when(
        F.size(amenities) > 0,
        F.concat(F.lit(" featuring "), F.array_join(first_names(amenities), ", "), more),
    )
    return capitalised(
        F.concat(
            lead,
            F.coalesce(beds, nothing),
            F.coalesce(baths, nothing),
            F.lit(" "),
            F.lower(property_type),
            F.coalesce(extras, nothing),
            F.lit(". "),
            tail,
        )
    )


def agent_id(number: Column) -> Column:
    return F.format_string(AGENT_ID_FORMAT, number)


def property_id(body: Column) -> Column:
    return F.concat(F.lit("PRP-"), F.upper(body))


def zip_code(prefix: Column, number: Column) -> Column:
    """City prefix and three digits; stays text, since zeros may lead."""
    return F.concat(prefix, F.lpad(F.pmod(number, F.lit(1000)).cast("string"), 3, "0"))


def school_district(number: Column) -> Column:
    return F.concat(F.lit("District "), number.cast("string"))
