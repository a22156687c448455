from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelflow import vocabulary as V
from parcelflow.functions import arrays, pricing, shape, text, times
from parcelflow.operators.lookup import city_lookup, type_lookup


def one(spark, column, **values):
    """``column`` over a row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_"))
    return row.select(column).collect()[0][0]


@pytest.mark.parametrize(
    "age, factor, band",
    [(0, 1.1, "new"), (4, 1.1, "new"), (5, 1.0, "standard"), (30, 1.0, "standard"),
     (31, 0.8, "old"), (51, 0.8, "old"), (120, 0.8, "old"), (None, None, None)],
)
def test_age_bands(spark, age, factor, band):
    column = F.lit(age).cast("int")
    assert one(spark, pricing.age_factor(column)) == factor
    assert one(spark, pricing.age_band(column)) == band


def test_unit_price_is_guarded_and_unrounded(spark):
    ratio = pricing.unit_price(F.col("p"), F.col("s"))
    assert one(spark, ratio, p=100.0, s=3) == 100.0 / 3
    assert one(spark, ratio, p=100.0, s=0) is None
    assert one(spark, ratio, p=100.0, s=-5) is None


@pytest.mark.parametrize("kind", [row[0] for row in V.PROPERTY_TYPES])
@pytest.mark.parametrize("year, grade, beds", [(2019, "A", 1), (1999, "B", 3), (1900, "C", 0)])
def test_price_estimate(spark, kind, year, grade, beds):
    rows = spark.createDataFrame(
        [("Dallas", kind, 1500, beds, year, grade)],
        "city STRING, type STRING, sqft INT, bedrooms INT, year INT, grade STRING",
    )
    rows = type_lookup(city_lookup(rows, "city"), "type")
    estimate = pricing.price_estimate(
        F.col("sqft"), F.col("type_base_price_per_sqft"), F.col("city_price_multiplier"),
        F.col("bedrooms"), times.years_since(F.col("year"), F.lit(date(2020, 5, 1))), F.col("grade"),
    )
    base = {row[0]: row[-1] for row in V.PROPERTY_TYPES}[kind]
    expected = base * 1500 * 1.1
    expected *= 1 + (beds - 1) * 0.15 if beds else 1
    expected *= 1.1 if 2020 - year < 5 else 0.8 if 2020 - year > 30 else 1
    expected *= {"A": 1.5, "B": 1.1, "C": 0.8}[grade]
    assert rows.select(estimate).collect()[0][0] == pytest.approx(expected, rel=1e-12)


def test_unknown_factors_give_no_estimate(spark):
    args = [F.lit(1000), F.lit(200.0), F.lit(1.0), F.lit(2), F.lit(10), F.lit("Z")]
    assert one(spark, pricing.price_estimate(*args)) is None


@pytest.mark.parametrize(
    "beds, baths, names, expected",
    [
        (2, 1.5, ["Pool"], "Cozy 2 bedrooms, 1.5 bathrooms condo featuring pool. See it."),
        (1, 1.0, ["A", "B", "C"], "Cozy 1 bedroom, 1.0 bathroom condo featuring a, b, c. See it."),
        (0, 0.0, ["A", "B", "C", "D"], "Cozy condo featuring a, b, c and more. See it."),
        (None, None, None, "Cozy condo. See it."),
        (3, 0.0, [], "Cozy 3 bedrooms condo. See it."),
    ],
)
def test_description(spark, beds, baths, names, expected):
    rows = spark.createDataFrame([(beds, baths, names)], "b INT, t DOUBLE, a ARRAY<STRING>")
    column = text.description(
        F.lit("cozy"), F.col("b"), F.col("t"), F.lit("Condo"), F.col("a"), F.lit("SEE it.")
    )
    assert rows.select(column).collect()[0][0] == expected.replace("See", "see")


def test_identifiers(spark):
    assert one(spark, text.agent_id(F.lit(7))) == "AGT-00007"
    assert one(spark, text.agent_id(F.lit(123456))) == "AGT-123456"
    assert one(spark, text.property_id(F.lit("abcd-0001"))) == "PRP-ABCD-0001"
    assert one(spark, text.zip_code(F.lit("10"), F.lit(7))) == "10007"
    assert one(spark, text.school_district(F.lit(12))) == "District 12"


@pytest.mark.parametrize(
    "given, expected",
    [("2020-02-29", date(2020, 2, 29)), ("2019-02-29", None), ("2020-13-01", None),
     ("", None), ("soon", None), (None, None)],
)
def test_dates(spark, given, expected):
    column = F.lit(given).cast("string")
    assert one(spark, times.parse_date(column)) == expected
    days = one(spark, times.days_on_market(column, F.lit(date(2020, 3, 1))))
    assert days == (None if expected is None else (date(2020, 3, 1) - expected).days)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_record_time_is_utc_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        parsed = times.parse_record_time(F.lit("2024-03-10 02:30:00.123456"))
        micros = one(spark, F.unix_micros(parsed))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    moment = datetime(2024, 3, 10, 2, 30, 0, 123456) - datetime(1970, 1, 1)
    assert micros == (moment.days * 86400 + moment.seconds) * 1_000_000 + moment.microseconds


def test_record_time_round_trip_and_damage(spark):
    whole = "2024-01-01 23:59:59.999999"
    assert one(spark, times.format_record_time(times.parse_record_time(F.lit(whole)))) == whole
    assert one(spark, times.parse_record_time(F.lit("2024-01-01 23:59:59"))) is None


def test_amenities(spark):
    rows = spark.createDataFrame(
        [(["Pool", "Gym", "Pool"],), (["Sauna"],), ([],), (None,)], "a ARRAY<STRING>"
    )
    got = rows.select(
        arrays.first_names(F.col("a"), 2), arrays.unknown_names(F.col("a")), arrays.is_distinct(F.col("a"))
    ).collect()
    assert [tuple(row) for row in got] == [
        (["Pool", "Gym"], [], False), (["Sauna"], ["Sauna"], True), ([], [], True), (None, None, None)
    ]
    counts = {r.amenity: r.listing_count for r in arrays.name_counts(rows, "a").collect()}
    assert counts == {"Pool": 2, "Gym": 1, "Sauna": 1}


def test_shape(spark):
    for kind, lot, area, floors in [("Land", 9, None, 0), ("House", None, 9, 2), (None, None, None, 2)]:
        k = F.lit(kind).cast("string")
        assert one(spark, shape.only_land(k, F.lit(9))) == lot
        assert one(spark, shape.only_building(k, F.lit(9))) == area
        assert one(spark, shape.zero_on_land(k, F.lit(2))) == floors


def test_lookups_keep_unknown_and_null_keys(spark):
    rows = spark.createDataFrame(
        [("Houston", "Villa"), ("Oslo", "Hut"), (None, None)], "city STRING, type STRING"
    )
    got = type_lookup(city_lookup(rows, "city"), "type").collect()
    found = {r.city: (r.city_state, r.city_price_multiplier, r.type_sqft_max) for r in got}
    assert found == {"Houston": ("TX", 1.1, 8000), "Oslo": (None, None, None), None: (None, None, None)}
