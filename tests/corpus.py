"""A whole listing message and damaged ones made from it."""

import json

RECORD = {
    "property_id": "PRP-ABCD-1234",
    "address": {
        "street": "12 Elm St", "city": "Dallas", "state": "TX", "zip_code": "75012",
        "country": "USA",
    },
    "property_details": {
        "type": "House", "transaction_type": "Sale", "year_built": 1999,
        "construction_type": "Brick", "floors": 2, "lot_size": None, "living_area": 2000,
        "bedrooms": 3, "bathrooms": 2.5, "amenities": ["Pool", "Gym"], "has_garage": True,
        "parking_spaces": 2, "neighborhood_class": "B",
    },
    "financials": {
        "price": 566280.0, "price_per_sqft": 283.14, "tax_assessment": 453024.0,
        "hoa_fee": None, "last_sale_price": 400000.0, "last_sale_date": "2015-06-01",
    },
    "listing_details": {
        "listing_date": "2019-12-02", "days_on_market": 30, "listing_status": "Active",
        "description": "Charming 3 bedrooms, 2.5 bathrooms house featuring pool, gym. Ok.",
    },
    "agent": {"id": "AGT-00007", "name": "A B", "company": "C"},
    "location": {
        "latitude": 1.5, "longitude": -2.5, "school_district": "District 3",
        "walk_score": 50, "transit_score": 60,
    },
    "timestamp": "2020-01-01 10:00:00.000001",
}


def text(**changes) -> str:
    """The record as JSON; ``changes`` are dotted paths with ``__`` for the dot."""
    record = json.loads(json.dumps(RECORD))
    for path, value in changes.items():
        *outer, last = path.split("__")
        part = record
        for name in outer:
            part = part[name]
        part[last] = value
    return json.dumps(record, separators=(",", ":"))


def envelope(spark, values):
    """Messages in the layout of the Kafka source."""
    rows = [
        (bytearray(b"k"), None if v is None else bytearray(v.encode()), "t", 0, i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows, "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT"
    ).selectExpr("*", "timestamp'2020-01-01 00:00:00' AS timestamp", "0 AS timestampType")
