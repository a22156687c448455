"""Schemas of the listing feed, as DDL text (usable without a live session)."""

from __future__ import annotations

# Field names and types of the listing message.
LISTING = """
    property_id STRING,
    address STRUCT<
        street: STRING, city: STRING, state: STRING, zip_code: STRING, country: STRING>,
    property_details STRUCT<
        type: STRING, transaction_type: STRING, year_built: INT,
        construction_type: STRING, floors: INT, lot_size: DOUBLE, living_area: INT,
        bedrooms: INT, bathrooms: DOUBLE, amenities: ARRAY<STRING>,
        has_garage: BOOLEAN, parking_spaces: INT, neighborhood_class: STRING>,
    financials STRUCT<
        price: DOUBLE, price_per_sqft: DOUBLE, tax_assessment: DOUBLE,
        hoa_fee: DOUBLE, last_sale_price: DOUBLE, last_sale_date: STRING>,
    listing_details STRUCT<
        listing_date: STRING, days_on_market: INT, listing_status: STRING,
        description: STRING>,
    agent STRUCT<id: STRING, name: STRING, company: STRING>,
    location STRUCT<
        latitude: DOUBLE, longitude: DOUBLE, school_district: STRING,
        walk_score: INT, transit_score: INT>,
    timestamp STRING
"""

# The columns Spark's Kafka source delivers.
ENVELOPE = """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT,
    timestamp TIMESTAMP, timestampType INT
"""

# Fields the windowed price summary reads; everything else can stay unparsed.
SUMMARY_FIELDS = (
    "address.city",
    "property_details.type",
    "financials.price",
    "financials.price_per_sqft",
    "timestamp",
)

# Path keys of the landed table, outermost first: the day, and the leaf, a batch or a fold.
DAY_KEYS = ("year", "month", "day")
LEAF_KEY = "leaf"
# The day, and which batch of which run landed a row.
LANDED_KEYS = "year INT, month INT, day INT, run STRING, batch_id BIGINT"
LANDED = f"{LISTING}, processing_timestamp TIMESTAMP, {LANDED_KEYS}"
# The job's landed table: beside the record, damaged messages whole and unknown fields.
LANDED_MESSAGES = f"""{LISTING}, processing_timestamp TIMESTAMP, extra VARIANT,
    message STRUCT<
        topic: STRING, partition: INT, offset: BIGINT, sent: TIMESTAMP, key: BINARY, value: BINARY,
        fault: STRING>,
    {LANDED_KEYS}, dead BOOLEAN
"""
