"""Listings and messages that Spark derives from the base tables.

One listing per ``lineitem`` row.  With ``mapped`` the cities and property types
come from the domain's own lists; without, from the nation and part tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import vocabulary as V
from parcelflow.functions import pricing, shape, text, times
from parcelflow.operators.encode import assemble, encode
from parcelflow.operators.lookup import city_lookup, type_lookup
from parcelflow.sources.tables import table

AS_OF = "2002-01-01"
FIRST_MINUTE = "2024-01-01 00:00:00"
TOPIC = "listings"
LEAD, TAIL = "charming", "Call today."

# Part types in alphabetical order stand for these property types.
PART_TYPES = {
    "ECONOMY": "Apartment",
    "LARGE": "Condo",
    "MEDIUM": "House",
    "PROMO": "Land",
    "SMALL": "Townhouse",
    "STANDARD": "Villa",
}
BY_FLAG = {
    "transaction_type": {"A": "Sale", "N": "Rent", "R": "Lease"},
    "neighborhood_class": {"A": "A", "N": "B", "R": "C"},
}

# What befalls a message of fault 2 and up: a pattern in its text and what takes its place.
DAMAGE = (
    (r'"bedrooms":(\d+)', '"bedrooms":"$1"'),  # 2: a wrong type in a nested field
    (r"^.*$", ""),  # 3: an empty value
    (r"^(.*)$", "[$1]"),  # 4: an array at the root
    (r'"city":.*$', '"city":'),  # 5: cut off inside the first struct
    (r'"property_id":"[^"]*"', '"property_id":17'),  # 6: a number in a string field
    (r'"property_id":"[^"]*"', '"property_id":["a"]'),  # 7: an array in a string field
    (r'"property_id":', '"unknown":1,"property_id":'),  # 8: a field not known
)
#: The least fault that is none, and the one whose first lines are dated ahead.
SOUND = 14
AHEAD_FAULT = 50

_WHOLE = r'"(year_built|floors|living_area|bedrooms|parking_spaces|days_on_market|walk_score|transit_score)":-?[0-9]+'
_BROKEN = r'"(tax_assessment|last_sale_price|latitude|longitude)":[^,}]+'
# Faults 9 and up: values at the end of their type's range, a vast price (2^996), and none that is a number.
EXTREMES = (
    ((r'"price":[^,}]+', '"price":6.696928794914171E299'),),
    ((r'"price":[^,}]+', '"price":NaN'),),
    ((r'"price_per_sqft":[^,}]+', '"price_per_sqft":-Infinity'),),
    ((_WHOLE, '"$1":-2147483648'), (_BROKEN, '"$1":-1.7976931348623157E308')),
    ((_WHOLE, '"$1":2147483647'), (_BROKEN, '"$1":1.7976931348623157E308')),
)
FIRST_EXTREME = SOUND - len(EXTREMES)

# By rule: a field, and the value (SQL over the sound row) that breaks the rule.
BREAKS = {
    "type_known": ("type", "'Castle'"),
    "transaction_known": ("transaction_type", "'Swap'"),
    "construction_known": ("construction_type", "'Straw'"),
    "class_known": ("neighborhood_class", "'Z'"),
    "status_known": ("listing_status", "'Lost'"),
    "city_known": ("city", "'Nowhere'"),
    "state_of_city": ("state", "'ZZ'"),
    "zip_of_city": ("zip_code", "'123'"),
    "country": ("country", "'Mars'"),
    "land_shape": ("floors", "9"),
    "building_shape": ("bathrooms", "99"),
    "amenities": ("amenities", "array('Pool')"),
    "year_built": ("year_built", "1800"),
    "unit_price": ("price_per_sqft", "1"),
    "price_near_estimate": ("price", "price * 2"),
    "tax_assessment": ("tax_assessment", "price * 2"),
    "last_sale_price": ("last_sale_price", "price * 3"),
    "hoa_fee": ("hoa_fee", "900"),
    "scores": ("walk_score", "101"),
    "parking": ("parking_spaces", "9"),
    "school_district": ("school_district", "'District 99'"),
    "property_id": ("property_id", "'X'"),
    "agent_id": ("agent_id", "'AGT-1'"),
    "listing_date": ("listing_date", "'1999-01-01'"),
    "days_on_market": ("days_on_market", "-5"),
    "last_sale_date": ("last_sale_date", "'2001-12-20'"),
}
# Values at the end of a type's range, or none that is a number, by turns after those.
EXTREME_VALUES = (
    ("year_built", "-2147483648"), ("year_built", "2147483647"), ("bedrooms", "-2147483648"),
    ("bedrooms", "2147483647"), ("living_area", "2147483647"), ("living_area", "-2147483648"),
    ("walk_score", "-2147483648"), ("days_on_market", "2147483647"), ("tax_assessment", "'NaN'"),
    ("last_sale_price", "'Infinity'"), ("hoa_fee", "'-Infinity'"), ("price_per_sqft", "'NaN'"),
    ("tax_assessment", "-1.7976931348623157E308"), ("bathrooms", "1.7976931348623157E308"),
    ("price", "1e15"), ("lot_size", "9223372036854775807"),
)
BREAK_EVERY = 53

RECORD_COLUMNS = [
    "property_id", "address", "property_details", "financials", "listing_details",
    "agent", "location", "timestamp",
]
SOURCES = {
    "agent.id": "agent_id",
    "agent.name": "agent_name",
    "agent.company": "agent_company",
}


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def _pick(values: Sequence, index: Column) -> Column:
    """``values[index % len(values)]``"""
    items = F.array(*[F.lit(value) for value in values])
    return F.get(items, F.pmod(index, F.lit(len(values))).cast("int"))


def _mapped(column: Column, pairs: dict[str, str]) -> Column:
    entries = [F.lit(part) for pair in pairs.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), column)


# A session's setting: deal the lines to so many tasks.  For tables of one row group, which
# a scan cannot divide; without it, the scan's own splits are the tasks.
DEALT = "spark.parcelflow.dealtTasks"


def _dealt(lines: DataFrame) -> DataFrame:
    tasks = lines.sparkSession.conf.get(DEALT, None)
    return lines.repartition(int(tasks)) if tasks else lines


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its part, supplier, nation and region.

    No hints: Catalyst broadcasts the sides whose size allows it and sort-merges
    the rest, where AQE splits a hot part or supplier.  Each table joins by
    itself, since the size Catalyst guesses for a join of two is far too high.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (
        _dealt(lines).join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    )


def flat_listings(spark: SparkSession, sf_dir: str, mapped: bool = False) -> DataFrame:
    """Every field of the record as a column of its own, plus the line's keys."""
    col = F.col
    cities = {name: [row[i] for row in V.CITIES] for i, name in enumerate(("city", "state", "zip"))}
    kind = _mapped(col("p_type"), PART_TYPES) if mapped else col("p_type")
    seller = col("l_suppkey")
    price = col("l_extendedprice")
    cents = F.round(price * 100).cast("bigint")
    first = F.lit(FIRST_MINUTE).cast("timestamp_ntz")
    minutes = F.pmod("l_orderkey", F.lit(1440))
    rows = base_rows(spark, sf_dir).withColumns(
        {
            "type": kind,
            "sqft": (col("l_quantity") * 100).cast("int"),
            "amenities": F.slice(
                F.array(*[F.lit(name) for name in V.AMENITIES]),
                1 + F.pmod("p_size", F.lit(4)),
                2 + F.pmod("p_size", F.lit(4)),
            ),
            "listing_date": times.format_date(col("l_shipdate")),
        }
    )
    kind, sqft = col("type"), col("sqft")
    bedrooms = shape.zero_on_land(kind, 1 + F.pmod("p_size", F.lit(5)))
    bathrooms = shape.zero_on_land(kind, 1 + F.pmod("p_size", F.lit(6)) * 0.5)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "n_name",
        "sqft",
        text.property_id(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("property_id"),
        col("p_name").alias("street"),
        (_pick(cities["city"], seller) if mapped else col("n_name")).alias("city"),
        (_pick(cities["state"], seller) if mapped else col("r_name")).alias("state"),
        text.zip_code(_pick(cities["zip"], seller), col("l_partkey")).alias("zip_code"),
        F.lit(V.COUNTRY).alias("country"),
        "type",
        *[_mapped(col("l_returnflag"), pairs).alias(name) for name, pairs in BY_FLAG.items()],
        (V.FIRST_YEAR_BUILT + F.pmod("l_partkey", F.lit(126))).cast("int").alias("year_built"),
        _pick(V.CONSTRUCTION_TYPES, col("l_partkey")).alias("construction_type"),
        shape.zero_on_land(kind, 1 + F.pmod("p_size", F.lit(3))).alias("floors"),
        shape.only_land(kind, sqft * 2).cast("bigint").alias("lot_size"),
        shape.only_building(kind, sqft).alias("living_area"),
        bedrooms.alias("bedrooms"),
        bathrooms.cast("double").alias("bathrooms"),
        "amenities",
        (col("l_linestatus") == "F").alias("has_garage"),
        F.pmod("l_partkey", F.lit(4)).cast("int").alias("parking_spaces"),
        price.alias("price"),
        # To the cent, halves up, reckoned in whole cents.
        F.when(sqft > 0, F.floor((2 * cents + sqft) / (2 * sqft)) / 100).alias("price_per_sqft"),
        (price * 0.8).alias("tax_assessment"),
        F.when(
            F.pmod("l_partkey", F.lit(10)) >= 3,
            (100 + F.pmod("l_partkey", F.lit(400))).cast("double"),
        ).alias("hoa_fee"),
        (price * 0.9).alias("last_sale_price"),
        times.format_date(F.add_months("l_shipdate", -24)).alias("last_sale_date"),
        "listing_date",
        times.days_on_market(col("listing_date"), as_of()).alias("days_on_market"),
        _pick(V.LISTING_STATUSES, col("l_orderkey")).alias("listing_status"),
        text.description(
            F.lit(LEAD), bedrooms, bathrooms.cast("double"), kind, col("amenities"), F.lit(TAIL)
        ).alias("description"),
        text.agent_id(seller).alias("agent_id"),
        col("s_name").alias("agent_name"),
        col("s_name").alias("agent_company"),
        col("n_nationkey").cast("double").alias("latitude"),
        (-col("n_nationkey")).cast("double").alias("longitude"),
        text.school_district(1 + F.pmod(seller, F.lit(20))).alias("school_district"),
        (col("p_size") * 2).alias("walk_score"),
        (100 - col("p_size") * 2).alias("transit_score"),
        times.format_record_time(
            first + F.make_dt_interval(mins=minutes.cast("int"))
        ).alias("timestamp"),
    )


def ruled_listings(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested listings that meet every domain rule, but for the ones ``BREAKS`` names:
    of every ``BREAK_EVERY`` order keys one breaks each rule, and one has each of ``EXTREME_VALUES``."""
    col = F.col
    rows = type_lookup(city_lookup(flat_listings(spark, sf_dir, mapped=True), "city"), "type")
    order, kind = col("l_orderkey"), col("type")
    part, days = col("l_partkey"), F.pmod("l_orderkey", F.lit(731)).cast("int")
    area = col("type_sqft_min") + F.pmod(
        col("sqft"), col("type_sqft_max") - col("type_sqft_min") + 1
    )
    beds = col("type_bed_min") + F.pmod(part, col("type_bed_max") - col("type_bed_min") + 1)
    letters = F.translate(
        F.lpad(F.pmod(order, F.lit(10_000)).cast("string"), 4, "0"), "0123456789", "ABCDEFGHIJ"
    )
    number = F.lpad(col("l_linenumber").cast("string"), 4, "0")
    sound = rows.withColumns(
        {
            "property_id": F.concat(F.lit("PRP-"), letters, F.lit("-"), number),
            "year_built": (V.FIRST_YEAR_BUILT + F.pmod(part, F.lit(103))).cast("int"),
            "bedrooms": beds.cast("int"),
            "bathrooms": col("type_bath_min"),
            "living_area": shape.only_building(kind, area).cast("int"),
            "lot_size": shape.only_land(kind, 20_000 + col("sqft")).cast("bigint"),
            "listing_date": times.format_date(F.date_sub(as_of(), days)),
            "days_on_market": days,
            "last_sale_date": times.format_date(
                F.date_sub(as_of(), 400 + F.pmod(order, F.lit(3000)).cast("int"))
            ),
            "agent_id": text.agent_id(1 + F.pmod("l_suppkey", F.lit(V.AGENTS))),
        }
    )
    estimate = pricing.price_estimate(
        col("living_area"), col("type_base_price_per_sqft"), col("city_price_multiplier"),
        col("bedrooms"), times.years_since(col("year_built"), as_of()), col("neighborhood_class"),
    )
    sound = sound.withColumn(
        "price", F.when(kind == V.LAND, col("price")).otherwise(F.floor(estimate)).cast("double")
    ).withColumns(
        {
            "price_per_sqft": pricing.unit_price(col("price"), col("living_area")),
            "tax_assessment": col("price") * 0.8,
            "last_sale_price": col("price") * 0.9,
        }
    )
    due = F.pmod(order, F.lit(BREAK_EVERY))
    broken: dict[str, Column] = {}
    for turn, (name, value) in enumerate([*BREAKS.values(), *EXTREME_VALUES]):
        kind_of = sound.schema[name].dataType
        broken[name] = F.when(due == turn, F.expr(value).cast(kind_of)).otherwise(
            broken.get(name, col(name))
        )
    return assemble(sound.withColumns(broken), SOURCES, keep)


def listings(
    spark: SparkSession, sf_dir: str, mapped: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The nested records (``lot_size`` still whole, as it is on the wire)."""
    return assemble(flat_listings(spark, sf_dir, mapped), SOURCES, keep)


def messages(
    spark: SparkSession,
    sf_dir: str,
    mapped: bool = False,
    damaged: bool = False,
    delayed: bool = False,
    ruled: bool = False,
    extreme: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The listings as keyed JSON messages with the envelope of a topic.

    ``damaged`` breaks some by rule: of every 97 order keys one turns into text
    that is not JSON, one into null, one gets its bedrooms as text, and each other kind
    of ``DAMAGE`` befalls one, and of ``EXTREMES`` if they are ``extreme``.  ``delayed`` messages are sent three days after their
    record's time, and of those the first lines of one order key in 97 are dated far ahead.
    ``keep`` are keys of the line to keep beside the envelope.
    """
    line = ("l_orderkey", "l_linenumber", "n_name")
    nested = ruled_listings(spark, sf_dir, line) if ruled else listings(spark, sf_dir, mapped, line)
    order = F.col("l_orderkey")
    offset = F.make_dt_interval(mins=F.pmod(order, F.lit(1440)).cast("int"))
    envelope = (
        F.pmod(order, F.lit(6)).cast("int").alias("partition"),
        F.col("l_linenumber").cast("bigint").alias("offset"),
        (F.lit(FIRST_MINUTE).cast("timestamp") + offset).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    if damaged:
        nested = nested.withColumn("_fault", F.pmod(order, F.lit(97)))
        envelope += (F.col("_fault"),)
    if delayed:
        envelope += (order.alias("_order"),)
    envelope += tuple(F.col(name) for name in keep)
    out = encode(nested, F.col("n_name"), TOPIC, RECORD_COLUMNS, keep=envelope)
    if damaged:
        # Most messages are sound: one test tells them, and their bytes stay as they are.
        sound = (F.col("_fault") >= SOUND) | F.col("_fault").isNull()
        whole = F.col("value").cast("string")
        value = F.when(F.col("_fault") == 0, F.lit("not json")).when(
            F.col("_fault") == 1, F.lit(None)
        )
        for number, (pattern, put) in enumerate(DAMAGE, start=2):
            value = value.when(F.col("_fault") == number, F.regexp_replace(whole, pattern, put))
        for number, changes in enumerate(EXTREMES if extreme else (), start=FIRST_EXTREME):
            text_of = whole
            for pattern, put in changes:
                text_of = F.regexp_replace(text_of, pattern, put)
            value = value.when(F.col("_fault") == number, text_of)
        damage = value.otherwise(whole).cast("binary")
        out = out.withColumn("value", F.when(sound, F.col("value")).otherwise(damage))
    if delayed:
        ahead = (F.col("_order") % 97 == AHEAD_FAULT) & (F.col("offset") == 1)
        dated = F.regexp_replace(F.col("value").cast("string"), '"timestamp":"2024', '"timestamp":"2999')
        out = out.withColumns(
            {
                "value": F.when(ahead, dated.cast("binary")).otherwise(F.col("value")),
                "timestamp": F.col("timestamp") + F.expr("INTERVAL 3 DAYS"),
            }
        )
    return out.select(
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType",
        *(["_fault"] if damaged else []), *(["_order"] if delayed else []), *keep,
    )
