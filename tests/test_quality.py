from datetime import date

import pytest
from corpus import envelope, text
from pyspark.sql import functions as F

from parcelflow.operators import quality
from parcelflow.operators.decode import decode
from parcelflow.sinks.tables import store_split

AS_OF = date(2020, 1, 1)

# What breaks each rule, and only it, in the corpus record.
BREAKS = {
    "transaction_known": {"property_details__transaction_type": "Gift"},
    "construction_known": {"property_details__construction_type": "Straw"},
    "status_known": {"listing_details__listing_status": "Lost"},
    "state_of_city": {"address__state": "NY"},
    "zip_of_city": {"address__zip_code": "99012"},
    "country": {"address__country": "France"},
    "building_shape": {"property_details__floors": 4},
    "amenities": {"property_details__amenities": ["Pool", "Pool"]},
    "unit_price": {"financials__price_per_sqft": 283.2},
    "tax_assessment": {"financials__tax_assessment": 1.0},
    "last_sale_price": {"financials__last_sale_price": 1.0},
    "hoa_fee": {"financials__hoa_fee": 99.0},
    "scores": {"location__walk_score": 101},
    "parking": {"property_details__parking_spaces": 4},
    "school_district": {"location__school_district": "District 21"},
    "property_id": {"property_id": "PRP-abcd-1234"},
    "agent_id": {"agent__id": "AGT-01001"},
    "days_on_market": {"listing_details__days_on_market": 31},
    "last_sale_date": {"financials__last_sale_date": "2019-06-01"},
}

# Changes that touch several rules at once.
MORE = [
    ({"address__city": "Oslo"},
     {"city_known", "state_of_city", "zip_of_city", "price_near_estimate"}),
    ({"property_details__neighborhood_class": "D"}, {"class_known", "price_near_estimate"}),
    ({"property_details__neighborhood_class": "A"}, {"price_near_estimate"}),
    ({"property_details__year_built": 1899}, {"year_built", "price_near_estimate"}),
    ({"property_details__year_built": 2021}, {"year_built", "price_near_estimate"}),
    ({"property_details__lot_size": 9000}, {"building_shape"}),
    ({"property_details__amenities": None}, {"amenities"}),
    ({"property_details__amenities": ["Pool", "Sauna"]}, {"amenities"}),
    ({"property_details__amenities": ["Pool"]}, {"amenities"}),
    ({"listing_details__listing_date": "2020-01-02"}, {"listing_date", "days_on_market"}),
    ({"listing_details__listing_date": "someday"}, {"listing_date", "days_on_market"}),
    ({"property_details__type": "Hut"},
     {"type_known", "building_shape", "price_near_estimate"}),
]

LAND = dict(
    property_details__type="Land", property_details__floors=0, property_details__lot_size=6000,
    property_details__living_area=None, property_details__bedrooms=0,
    property_details__bathrooms=0,
)


def violations(spark, *changes, rules=quality.RULES):
    rows = decode(envelope(spark, [text(**c) for c in changes]), keep=[F.col("offset")])
    marked = quality.with_violations(rows, F.lit(AS_OF), rules).orderBy("offset")
    return [set(row.violations) for row in marked.collect()]


def test_a_whole_record_is_valid(spark):
    assert violations(spark, {}) == [set()]


def test_each_rule_is_broken_alone(spark):
    assert violations(spark, *BREAKS.values()) == [{name} for name in BREAKS]


def test_rules_broken_together(spark):
    assert violations(spark, *[c for c, _ in MORE]) == [found for _, found in MORE]


def test_land(spark):
    got = violations(
        spark,
        LAND,
        dict(LAND, property_details__lot_size=5999),
        dict(LAND, property_details__lot_size=250_001),
        dict(LAND, property_details__living_area=2000),
        dict(LAND, property_details__floors=1),
        dict(LAND, financials__price_per_sqft=1.0),
    )
    assert got == [set(), *[{"land_shape"}] * 4, set()]


def test_every_rule_has_a_breaking_case():
    covered = set(BREAKS) | {"land_shape"} | {name for _, found in MORE for name in found}
    assert covered == set(quality.RULES)


def test_a_null_row_breaks_every_rule_but_the_optional_fee(spark):
    rows = decode(envelope(spark, ["not json"]))
    found = quality.with_violations(rows, F.lit(AS_OF)).collect()[0].violations
    assert set(found) == set(quality.RULES) - {"hoa_fee"}


def test_rules_can_be_chosen_and_unknown_ones_are_refused(spark):
    assert violations(spark, BREAKS["country"], rules=["parking"]) == [set()]
    with pytest.raises(ValueError, match="no_such"):
        violations(spark, {}, rules=["no_such"])


def test_split_and_counts_keep_every_row(spark, tmp_path):
    values = [text(), text(address__country="France"), "not json", None]
    rows = decode(envelope(spark, values))
    marked = quality.with_violations(rows, F.lit(AS_OF))
    valid, quarantined = quality.split(marked)
    assert (valid.count(), quarantined.count()) == (1, 3)
    assert valid.columns == rows.columns
    store_split(marked, str(tmp_path / "split"))
    stored = spark.read.parquet(str(tmp_path / "split")).groupBy("side").count()
    assert {r.side: r["count"] for r in stored.collect()} == {"valid": 1, "quarantined": 3}
    counts = quality.violation_counts(rows, F.lit(AS_OF)).collect()
    assert {r.rule: r.row_count for r in counts} == {
        name: 3 if name == "country" else 2 for name in quality.RULES if name != "hoa_fee"
    }


def test_the_rules_are_compiled(spark):
    rows = decode(envelope(spark, [text()]))
    marked = quality.with_violations(rows, F.lit(AS_OF))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    assert not marked.schema["violations"].dataType.containsNull
    assert quality.with_violations(rows, F.lit(AS_OF), rules=[]).first().violations == []
