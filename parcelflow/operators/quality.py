"""Domain rules as row checks, and the split into valid and quarantined rows.

Every rule is a column expression, so a check is one pass without a shuffle.
A rule whose input is missing counts as violated, unless null is a valid value.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import vocabulary as V
from parcelflow.functions.arrays import is_distinct, unknown_names
from parcelflow.functions.pricing import price_estimate, unit_price
from parcelflow.functions.shape import is_land
from parcelflow.functions.times import days_on_market, parse_date, years_since
from parcelflow.operators.lookup import city_lookup, type_lookup

VIOLATIONS = "violations"
VALID, QUARANTINED = "valid", "quarantined"
CENT = 0.01
HALF_CENT = 0.005
EPSILON = 1e-9


def _share(value: Column, price: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return value.between(price * low - CENT, price * high + CENT)


def listing_rules(as_of: Column) -> dict[str, Column]:
    """Rule name to the condition a valid row meets.

    The conditions read a nested listing with both lookups joined.
    """
    col = F.col
    kind = col("property_details.type")
    land = is_land(kind)
    area = col("property_details.living_area")
    lot = col("property_details.lot_size")
    beds = col("property_details.bedrooms")
    baths = col("property_details.bathrooms")
    floors = col("property_details.floors")
    amenities = col("property_details.amenities")
    price = col("financials.price")
    hoa_fee = col("financials.hoa_fee")
    zip_code = col("address.zip_code")
    agent = col("agent.id")
    listing_date = col("listing_details.listing_date")
    on_market = days_on_market(listing_date, as_of)
    since_sale = F.datediff(as_of, parse_date(col("financials.last_sale_date")))
    estimate = price_estimate(
        area,
        col("type_base_price_per_sqft"),
        col("city_price_multiplier"),
        beds,
        years_since(col("property_details.year_built"), as_of),
        col("property_details.neighborhood_class"),
    )
    lot_low, lot_high = V.LOT_PER_SQFT
    sale_low, sale_high = V.LAST_SALE_YEARS
    known_types = [row[0] for row in V.PROPERTY_TYPES]
    return {
        "type_known": kind.isin(known_types),
        "transaction_known": col("property_details.transaction_type").isin(V.TRANSACTION_TYPES),
        "construction_known": col("property_details.construction_type").isin(V.CONSTRUCTION_TYPES),
        "class_known": col("property_details.neighborhood_class").isin(V.NEIGHBORHOOD_CLASSES),
        "status_known": col("listing_details.listing_status").isin(V.LISTING_STATUSES),
        "city_known": col("city_state").isNotNull(),
        "state_of_city": col("address.state") == col("city_state"),
        "zip_of_city": zip_code.startswith(col("city_zip_prefix")) & (F.length(zip_code) == 5),
        "country": col("address.country") == V.COUNTRY,
        # Rows of the other kind pass a shape rule; rows of no kind fail both.
        "land_shape": ~land
        | (
            (floors == 0)
            & area.isNull()
            & lot.between(
                col("type_sqft_min") * lot_low, col("type_sqft_max") * lot_high)
            & (beds == 0)
            & (baths == 0)
        ),
        "building_shape": land
        | (
            lot.isNull()
            & floors.between(*V.FLOORS)
            & area.between(col("type_sqft_min"), col("type_sqft_max"))
            & beds.between(col("type_bed_min"), col("type_bed_max"))
            & baths.between(col("type_bath_min"), col("type_bath_max"))
        ),
        "amenities": F.size(amenities).between(*V.AMENITY_COUNT)
        & (F.size(unknown_names(amenities)) == 0)
        & is_distinct(amenities),
        "year_built": col("property_details.year_built").between(
            V.FIRST_YEAR_BUILT, F.year(as_of)),
        # A land message carries no area, so neither price rule can test it.
        "unit_price": land
        | (
            F.abs(unit_price(price, area) - col("financials.price_per_sqft"))
            <= HALF_CENT + EPSILON
        ),
        "price_near_estimate": land | _share(price, estimate, V.PRICE_NOISE),
        "tax_assessment": _share(col("financials.tax_assessment"), price, V.TAX_SHARE),
        "last_sale_price": _share(col("financials.last_sale_price"), price, V.LAST_SALE_SHARE),
        "hoa_fee": hoa_fee.isNull() | hoa_fee.between(*V.HOA_FEE),
        "scores": col("location.walk_score").between(*V.SCORES)
        & col("location.transit_score").between(*V.SCORES),
        "parking": col("property_details.parking_spaces").between(*V.PARKING_SPACES),
        "school_district": F.regexp_extract(
            col("location.school_district"), r"^District (\d{1,2})$", 1
        ).try_cast("int").between(1, V.SCHOOL_DISTRICTS),
        "property_id": col("property_id").rlike(V.PROPERTY_ID_PATTERN),
        "agent_id": agent.rlike(V.AGENT_ID_PATTERN)
        & F.substring(agent, 5, 5).try_cast("int").between(1, V.AGENTS),
        "listing_date": on_market.between(0, V.LISTING_AGE_DAYS),
        "days_on_market": col("listing_details.days_on_market") == on_market,
        # Years of 365.24 days, in whole days.
        "last_sale_date": since_sale.between(
            int(sale_low * 365.24), int(sale_high * 365.24) + 1),
    }


RULES = tuple(
    "type_known transaction_known construction_known class_known status_known city_known "
    "state_of_city zip_of_city country land_shape building_shape amenities year_built "
    "unit_price price_near_estimate tax_assessment last_sale_price hoa_fee scores parking "
    "school_district property_id agent_id listing_date days_on_market last_sale_date".split()
)


def _broken(as_of: Column, rules: Collection[str]) -> dict[str, Column]:
    unknown = set(rules) - set(RULES)
    if unknown:
        raise ValueError(f"unknown rules: {sorted(unknown)}")
    checks = listing_rules(as_of)
    return {
        name: ~F.coalesce(checks[name], F.lit(False)) for name in RULES if name in rules
    }


def _looked_up(listings: DataFrame) -> DataFrame:
    return type_lookup(city_lookup(listings))


def with_violations(
    listings: DataFrame, as_of: Column, rules: Collection[str] = RULES
) -> DataFrame:
    """The listings plus ``violations``, the names of the rules a row breaks."""
    names = [F.when(broken, F.lit(name)).otherwise(F.lit("")) for name, broken in _broken(as_of, rules).items()]
    # Not array_compact: what is below a function of higher order is not compiled but interpreted.
    found = F.array_remove(F.array(*names), "") if names else F.array().cast("array<string>")
    marked = _looked_up(listings).withColumn(VIOLATIONS, found)
    return marked.select(*listings.columns, VIOLATIONS)


def is_valid() -> Column:
    return F.size(VIOLATIONS) == 0


def side() -> Column:
    return F.when(is_valid(), F.lit(VALID)).otherwise(F.lit(QUARANTINED)).alias("side")


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the rule column, and quarantined rows with it.

    Two plans over one input: each checks the rules again.  To check once, store
    the marked rows by ``side`` (``store_split``).
    """
    return marked.filter(is_valid()).drop(VIOLATIONS), marked.filter(~is_valid())


def violation_counts(
    listings: DataFrame, as_of: Column, rules: Collection[str] = RULES
) -> DataFrame:
    """Rows per broken rule.

    One counter per rule in a single aggregate, so a task sends one row, and
    the counters become lines only at the end.
    """
    counters = [
        F.count_if(broken).alias(name) for name, broken in _broken(as_of, rules).items()
    ]
    counts = _looked_up(listings).agg(*counters)
    lines = counts.unpivot([], counts.columns, "rule", "row_count")
    return lines.filter(F.col("row_count") > 0)
