"""The SQL each registered query must agree with, over the base tables.

Columns and rows are stated independently of the Spark code; values are never
rounded, since engines break ties differently.
"""

from __future__ import annotations

# Stated here once more, in SQL, and not taken from the code under test.
CITY_DIM = """city_dim(city, state, zip_prefix, price_multiplier) AS (VALUES
    ('New York', 'NY', '10', CAST(1.8 AS DOUBLE)), ('Los Angeles', 'CA', '90', 1.6),
    ('Chicago', 'IL', '60', 1.2), ('Houston', 'TX', '77', 1.1), ('Phoenix', 'AZ', '85', 1.0),
    ('Philadelphia', 'PA', '19', 1.3), ('San Antonio', 'TX', '78', 0.9),
    ('San Diego', 'CA', '92', 1.5), ('Dallas', 'TX', '75', 1.1), ('San Jose', 'CA', '95', 1.7))"""
TYPE_DIM = """type_dim(type, sqft_min, sqft_max, bed_min, bed_max, bath_min, bath_max,
    base_price_per_sqft) AS (VALUES
    ('Apartment', 500, 2000, 1, 3, CAST(1 AS DOUBLE), CAST(2.5 AS DOUBLE), CAST(200 AS DOUBLE)),
    ('House', 1000, 5000, 2, 5, 1.5, 4, 180), ('Villa', 2000, 8000, 3, 6, 2, 5, 250),
    ('Condo', 600, 2500, 1, 3, 1, 3, 220), ('Townhouse', 1200, 3000, 2, 4, 1.5, 3.5, 190),
    ('Land', 5000, 50000, 0, 0, 0, 0, 50))"""
CITY_AT = {
    0: """(['New York', 'Los Angeles', 'Chicago', 'Houston', 'Phoenix', 'Philadelphia',
        'San Antonio', 'San Diego', 'Dallas', 'San Jose'])[1 + l_suppkey % 10]""",
    1: "(['NY', 'CA', 'IL', 'TX', 'AZ', 'PA', 'TX', 'CA', 'TX', 'CA'])[1 + l_suppkey % 10]",
    2: "(['10', '90', '60', '77', '85', '19', '78', '92', '75', '95'])[1 + l_suppkey % 10]",
}
AMENITIES = """['Pool', 'Gym', 'Parking', 'Garden', 'Fireplace', 'Balcony', 'Elevator',
    'Security']"""
CONSTRUCTIONS = "['Brick', 'Wood', 'Concrete', 'Steel', 'Mixed']"
STATUSES = "['Active', 'Pending', 'Sold', 'Withdrawn']"

MAPPED_TYPE = """CASE p_type WHEN 'ECONOMY' THEN 'Apartment' WHEN 'LARGE' THEN 'Condo'
    WHEN 'MEDIUM' THEN 'House' WHEN 'PROMO' THEN 'Land' WHEN 'SMALL' THEN 'Townhouse'
    WHEN 'STANDARD' THEN 'Villa' END"""


def _listing(mapped: bool) -> str:
    """CTEs ending in ``listing``: one row per line, all fields flat."""
    return f"""
base AS (
    SELECT *,
        {MAPPED_TYPE if mapped else "p_type"} AS type,
        CAST(l_quantity * 100 AS INTEGER) AS sqft,
        l_extendedprice AS price,
        ({AMENITIES})[1 + p_size % 4 : 2 + 2 * (p_size % 4)] AS amenities
    FROM lineitem
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey
),
rooms AS (
    SELECT *,
        CASE WHEN type = 'Land' THEN 0 ELSE 1 + p_size % 5 END AS bedrooms,
        CASE WHEN type = 'Land' THEN CAST(0 AS DOUBLE)
             ELSE CAST(1 AS DOUBLE) + (p_size % 6) * CAST(0.5 AS DOUBLE) END AS bathrooms
    FROM base
),
listing AS (
    SELECT
        l_orderkey, l_linenumber, l_partkey, l_suppkey, n_name, sqft,
        'PRP-' || l_orderkey || '-' || l_linenumber AS property_id,
        p_name AS street,
        {CITY_AT[0] if mapped else "n_name"} AS city,
        {CITY_AT[1] if mapped else "r_name"} AS state,
        {CITY_AT[2]} || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS zip_code,
        'USA' AS country,
        type,
        CASE l_returnflag WHEN 'A' THEN 'Sale' WHEN 'N' THEN 'Rent' WHEN 'R' THEN 'Lease' END
            AS transaction_type,
        CAST(1900 + l_partkey % 126 AS INTEGER) AS year_built,
        ({CONSTRUCTIONS})[1 + l_partkey % 5] AS construction_type,
        CASE WHEN type = 'Land' THEN 0 ELSE 1 + p_size % 3 END AS floors,
        CASE WHEN type = 'Land' THEN CAST(sqft * 2 AS DOUBLE) END AS lot_size,
        CASE WHEN type <> 'Land' THEN sqft END AS living_area,
        bedrooms, bathrooms, amenities,
        l_linestatus = 'F' AS has_garage,
        CAST(l_partkey % 4 AS INTEGER) AS parking_spaces,
        CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'N' THEN 'B' WHEN 'R' THEN 'C' END
            AS neighborhood_class,
        price,
        CASE WHEN sqft > 0 THEN floor((2 * CAST(round(price * 100) AS BIGINT) + sqft) / (2 * sqft)) / 100
            END AS price_per_sqft,
        price * CAST(0.8 AS DOUBLE) AS tax_assessment,
        CASE WHEN l_partkey % 10 >= 3 THEN CAST(100 + l_partkey % 400 AS DOUBLE) END AS hoa_fee,
        price * CAST(0.9 AS DOUBLE) AS last_sale_price,
        strftime(l_shipdate - INTERVAL 2 YEAR, '%Y-%m-%d') AS last_sale_date,
        strftime(l_shipdate, '%Y-%m-%d') AS listing_date,
        CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS INTEGER)
            AS days_on_market,
        ({STATUSES})[1 + l_orderkey % 4] AS listing_status,
        'Charming'
            || CASE WHEN bedrooms > 0 THEN ' ' || bedrooms || ' bedroom'
                    || CASE WHEN bedrooms > 1 THEN 's' ELSE '' END ELSE '' END
            || CASE WHEN bathrooms > 0 THEN ', ' || bathrooms || ' bathroom'
                    || CASE WHEN bathrooms > 1 THEN 's' ELSE '' END ELSE '' END
            || ' ' || lower(type) || ' featuring '
            || lower(array_to_string(amenities[1:3], ', '))
            || CASE WHEN len(amenities) > 3 THEN ' and more' ELSE '' END
            || '. call today.' AS description,
        'AGT-' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS agent_id,
        s_name AS agent_name, s_name AS agent_company,
        CAST(n_nationkey AS DOUBLE) AS latitude,
        CAST(-n_nationkey AS DOUBLE) AS longitude,
        'District ' || (1 + l_suppkey % 20) AS school_district,
        p_size * 2 AS walk_score,
        100 - p_size * 2 AS transit_score,
        TIMESTAMP '2024-01-01' + to_minutes(l_orderkey % 1440) AS event_time
    FROM rooms
)"""


PLAIN = _listing(mapped=False)
MAPPED = _listing(mapped=True)
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
DAY = """CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month,
    CAST(day({0}) AS INTEGER) AS day"""


def _exact_sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def _window(time: str) -> str:
    return (
        f"time_bucket(INTERVAL 15 MINUTE, {time}) AS window_start, "
        f"time_bucket(INTERVAL 15 MINUTE, {time}) + INTERVAL 15 MINUTE AS window_end"
    )


def _exact_mean(value: str) -> str:
    """The exact sum of the doubles, in units of 2^-60, rounded once; values above 1e100 are all 2^996."""
    vast, inf = f"abs({value}) > 1e100 AND isfinite({value})", "CAST('Infinity' AS DOUBLE)"
    return f"""CASE
        WHEN count({value}) = 0 THEN NULL
        WHEN count(*) FILTER (isnan({value})) > 0 THEN CAST('NaN' AS DOUBLE)
        WHEN count(*) FILTER ({value} = {inf}) > 0 THEN {inf}
        WHEN count(*) FILTER ({value} = -{inf}) > 0 THEN -{inf}
        WHEN count(*) FILTER ({vast}) > 0 THEN count(*) FILTER ({vast}) * pow(2, 996) / count({value})
        ELSE CAST(CAST(sum(TRY_CAST({value} * pow(2, 60) AS HUGEINT)) AS VARCHAR) AS DOUBLE)
            / pow(2, 60) / count({value}) END"""


LISTING_SUMMARY = f"""
SELECT {_window("event_time")}, city, type,
    {_exact_mean("price")} AS avg_price, count(*) AS listing_count,
    {_exact_mean("price_per_sqft")} AS avg_price_per_sqft
FROM listing GROUP BY ALL"""

EVENT_MEAN = f"{_exact_sum('value')} / count(*) AS avg_value"
EVENT_SUMMARY = f"""
SELECT {_window("ts")}, event_type, count(*) AS event_count, {EVENT_MEAN}
FROM events GROUP BY ALL"""

EVENT_DAYS = f"""
SELECT {DAY.format("ts")}, count(*) AS row_count, {_exact_sum("value")} AS sum_value"""

AGE = "2002 - CAST(year_built AS BIGINT)"
AGE_FACTOR = (
    f"CASE WHEN {AGE} < 5 THEN CAST(1.1 AS DOUBLE) "
    f"WHEN {AGE} > 30 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END"
)
ESTIMATE = f"""t.base_price_per_sqft * sqft * c.price_multiplier
    * CASE WHEN bedrooms > 0
           THEN CAST(1 AS DOUBLE) + (bedrooms - 1) * CAST(0.15 AS DOUBLE)
           ELSE CAST(1 AS DOUBLE) END
    * {AGE_FACTOR}
    * CASE neighborhood_class WHEN 'A' THEN CAST(1.5 AS DOUBLE)
          WHEN 'B' THEN CAST(1.1 AS DOUBLE) WHEN 'C' THEN CAST(0.8 AS DOUBLE) END"""


def _d(number: float) -> str:
    return f"CAST({number} AS DOUBLE)"


def _within(value: str, of: str, low: float, high: float) -> str:
    return f"{value} BETWEEN {of} * {_d(low)} - {_d(0.01)} AND {of} * {_d(high)} + {_d(0.01)}"


# What a valid row meets, in the order violations are named.
CONDITIONS = {
    "type_known": "type IN ('Apartment', 'House', 'Villa', 'Condo', 'Townhouse', 'Land')",
    "transaction_known": "transaction_type IN ('Sale', 'Rent', 'Lease')",
    "construction_known": f"list_contains({CONSTRUCTIONS}, construction_type)",
    "class_known": "neighborhood_class IN ('A', 'B', 'C')",
    "status_known": f"list_contains({STATUSES}, listing_status)",
    "city_known": "c_state IS NOT NULL",
    "state_of_city": "state = c_state",
    "zip_of_city": "starts_with(zip_code, c_zip) AND length(zip_code) = 5",
    "country": "country = 'USA'",
    "land_shape": f"""type <> 'Land' OR (floors = 0 AND living_area IS NULL
        AND lot_size BETWEEN sqft_min * {_d(1.2)} AND sqft_max * {_d(5.0)}
        AND bedrooms = 0 AND bathrooms = 0)""",
    "building_shape": """type = 'Land' OR (lot_size IS NULL AND floors BETWEEN 1 AND 3
        AND living_area BETWEEN sqft_min AND sqft_max
        AND bedrooms BETWEEN bed_min AND bed_max
        AND bathrooms BETWEEN bath_min AND bath_max)""",
    "amenities": f"""len(amenities) BETWEEN 2 AND 5
        AND len(list_intersect(amenities, {AMENITIES})) = len(amenities)
        AND len(list_distinct(amenities)) = len(amenities)""",
    "year_built": "year_built BETWEEN 1900 AND 2002",
    "unit_price": f"""type = 'Land'
        OR abs(price / living_area - price_per_sqft) <= {_d(0.005)} + {_d(1e-9)}""",
    "price_near_estimate": f"type = 'Land' OR {_within('price', 'estimate', 0.95, 1.05)}",
    "tax_assessment": _within("tax_assessment", "price", 0.7, 0.9),
    "last_sale_price": _within("last_sale_price", "price", 0.5, 1.2),
    "hoa_fee": "hoa_fee IS NULL OR hoa_fee BETWEEN 100 AND 500",
    "scores": "walk_score BETWEEN 0 AND 100 AND transit_score BETWEEN 0 AND 100",
    "parking": "parking_spaces BETWEEN 0 AND 3",
    "school_district": """regexp_full_match(school_district, 'District [0-9]{1,2}')
        AND CAST(split_part(school_district, ' ', 2) AS INTEGER) BETWEEN 1 AND 20""",
    "property_id": "regexp_full_match(property_id, 'PRP-[A-Z]{4}-[0-9]{4}')",
    "agent_id": """regexp_full_match(agent_id, 'AGT-[0-9]{5}')
        AND CAST(agent_id[5:] AS INTEGER) BETWEEN 1 AND 1000""",
    "listing_date": "date_diff('day', CAST(listing_date AS DATE), DATE '2002-01-01') "
                    "BETWEEN 0 AND 730",
    "days_on_market": "days_on_market = "
                      "date_diff('day', CAST(listing_date AS DATE), DATE '2002-01-01')",
    "last_sale_date": "date_diff('day', CAST(last_sale_date AS DATE), DATE '2002-01-01') "
                      "BETWEEN 365 AND 3653",
}

BREAKS = (
    ("type", "'Castle'"), ("transaction_type", "'Swap'"), ("construction_type", "'Straw'"),
    ("neighborhood_class", "'Z'"), ("listing_status", "'Lost'"), ("city", "'Nowhere'"),
    ("state", "'ZZ'"), ("zip_code", "'123'"), ("country", "'Mars'"), ("floors", "9"),
    ("bathrooms", "99"), ("amenities", "['Pool']"), ("year_built", "1800"),
    ("price_per_sqft", "1"), ("price", "price * 2"), ("tax_assessment", "price * 2"),
    ("last_sale_price", "price * 3"), ("hoa_fee", "900"), ("walk_score", "101"),
    ("parking_spaces", "9"), ("school_district", "'District 99'"), ("property_id", "'X'"),
    ("agent_id", "'AGT-1'"), ("listing_date", "'1999-01-01'"), ("days_on_market", "-5"),
    ("last_sale_date", "'2001-12-20'"),
    ("year_built", "-2147483648"), ("year_built", "2147483647"), ("bedrooms", "-2147483648"),
    ("bedrooms", "2147483647"), ("living_area", "2147483647"), ("living_area", "-2147483648"),
    ("walk_score", "-2147483648"), ("days_on_market", "2147483647"),
    ("tax_assessment", "CAST('NaN' AS DOUBLE)"), ("last_sale_price", "CAST('Infinity' AS DOUBLE)"),
    ("hoa_fee", "CAST('-Infinity' AS DOUBLE)"), ("price_per_sqft", "CAST('NaN' AS DOUBLE)"),
    ("tax_assessment", "CAST(-1.7976931348623157E308 AS DOUBLE)"),
    ("bathrooms", "CAST(1.7976931348623157E308 AS DOUBLE)"), ("price", "CAST(1e15 AS DOUBLE)"),
    ("lot_size", "CAST(9223372036854775807 AS DOUBLE)"),
)


def _ruled() -> str:
    """``sound``: listings that meet every rule; ``ruled``: one rule broken by turns."""
    turns: dict[str, str] = {}
    for turn, (name, value) in enumerate(BREAKS):
        turns[name] = turns.get(name, "") + f" WHEN l_orderkey % 53 = {turn} THEN {value}"
    broken = ",\n        ".join(f"CASE{cases} ELSE {name} END AS {name}" for name, cases in turns.items())
    return f"""
dims AS (
    SELECT listing.*, c.price_multiplier, t.* EXCLUDE (type),
        t.sqft_min + sqft % (t.sqft_max - t.sqft_min + 1) AS area
    FROM listing
    JOIN city_dim c ON c.city = listing.city JOIN type_dim t ON t.type = listing.type
),
shaped AS (
    SELECT * REPLACE (
        'PRP-' || translate(lpad(CAST(l_orderkey % 10000 AS VARCHAR), 4, '0'), '0123456789',
            'ABCDEFGHIJ') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') AS property_id,
        CAST(1900 + l_partkey % 103 AS INTEGER) AS year_built,
        bed_min + l_partkey % (bed_max - bed_min + 1) AS bedrooms,
        bath_min AS bathrooms,
        CASE WHEN type <> 'Land' THEN area END AS living_area,
        CASE WHEN type = 'Land' THEN CAST(20000 + sqft AS DOUBLE) END AS lot_size,
        strftime(DATE '2002-01-01' - CAST(l_orderkey % 731 AS INTEGER), '%Y-%m-%d') AS listing_date,
        CAST(l_orderkey % 731 AS INTEGER) AS days_on_market,
        strftime(DATE '2002-01-01' - CAST(400 + l_orderkey % 3000 AS INTEGER), '%Y-%m-%d')
            AS last_sale_date,
        'AGT-' || lpad(CAST(1 + l_suppkey % 1000 AS VARCHAR), 5, '0') AS agent_id)
    FROM dims
),
priced AS (
    SELECT t.* REPLACE (CASE WHEN type = 'Land' THEN price ELSE floor(
        {ESTIMATE.replace("sqft * c.", "living_area * t.")}) END AS price)
    FROM shaped t
),
sound AS (
    SELECT * EXCLUDE (price_multiplier, sqft_min, sqft_max, bed_min, bed_max, bath_min, bath_max,
            base_price_per_sqft, area)
        REPLACE (CASE WHEN living_area > 0 THEN price / living_area END AS price_per_sqft,
            price * CAST(0.8 AS DOUBLE) AS tax_assessment,
            price * CAST(0.9 AS DOUBLE) AS last_sale_price)
    FROM priced
),
ruled AS (
    SELECT * REPLACE ({broken}) FROM sound
)"""


def _checked(rows: str) -> str:
    return f"""
looked_up AS (
    SELECT listing.*, c.state AS c_state, c.zip_prefix AS c_zip, t.* EXCLUDE (type),
        {ESTIMATE.replace("sqft * c.", "living_area * c.")} AS estimate
    FROM {rows} AS listing
    LEFT JOIN city_dim c ON c.city = listing.city
    LEFT JOIN type_dim t ON t.type = listing.type
)"""


LOOKED_UP = f"WITH {CITY_DIM}, {TYPE_DIM}, {MAPPED}, {_checked('listing')}"
CHECKED = f"WITH {CITY_DIM}, {TYPE_DIM}, {MAPPED}, {_ruled()}, {_checked('ruled')}"


def _broken() -> str:
    """One entry per rule: its name where a row of ``looked_up`` breaks it, else null."""
    return ",\n    ".join(
        f"CASE WHEN NOT coalesce({condition}, false) THEN '{name}' END"
        for name, condition in CONDITIONS.items()
    )


QUALITY_SPLIT = f"""{CHECKED}
SELECT CASE WHEN concat_ws(',', {_broken()}) = '' THEN 'valid' ELSE 'quarantined' END AS side,
    type, count(*) AS row_count, {_exact_sum("price")} AS sum_price
FROM looked_up GROUP BY ALL"""

ARRIVALS = """arrivals AS (
    SELECT *, cut + CASE WHEN event_id % 20 = 0 AND cut < 2 THEN 1 ELSE 0 END AS arrival,
        time_bucket(INTERVAL 15 MINUTE, ts) AS window_start
    FROM (
        SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0
                       WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS cut
        FROM events
    )
),
reached AS (
    SELECT a.arrival, max(b.ts) - INTERVAL 10 MINUTE AS watermark
    FROM (SELECT DISTINCT arrival FROM arrivals) a
    JOIN (SELECT arrival, max(ts) AS ts FROM arrivals GROUP BY arrival) b
      ON b.arrival < a.arrival
    GROUP BY a.arrival
)"""

LATE = f"""
WITH {ARRIVALS}
SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, event_type,
    count(*) AS event_count, {EVENT_MEAN}
FROM arrivals LEFT JOIN reached USING (arrival)
WHERE (watermark IS NULL OR window_start + INTERVAL 15 MINUTE > watermark)
  AND window_start + INTERVAL 15 MINUTE
      <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
GROUP BY ALL"""

FAULT = "least(l_orderkey % 97, 14)"
LATE_EXACT = LATE.replace(EVENT_MEAN, f"{_exact_mean('value')} AS avg_value")
# The prices of messages whose faults are extreme values.
FAR_PRICE = """CASE l_orderkey % 97 WHEN 9 THEN pow(2, 996) WHEN 10 THEN CAST('NaN' AS DOUBLE)
    ELSE price END"""
FAR_UNIT = "CASE l_orderkey % 97 WHEN 11 THEN CAST('-Infinity' AS DOUBLE) ELSE price_per_sqft END"
# Messages that are not JSON, null, empty, arrays or cut off leave nothing.
LOST = "l_orderkey % 97 IN (0, 1, 3, 4, 5)"
NOT_LOST = f"CASE WHEN NOT {LOST} THEN {{}} END"
OVER_WINDOWS = f"""count(*) AS listing_count, {_exact_sum("{price}")} AS sum_price,
    {_exact_sum("{unit}")} AS sum_price_per_sqft"""


def _damaged(closed: str) -> str:
    """Sound rows by window, and the others on a line of their own."""
    return f"""WITH {MAPPED},
sound AS (
    SELECT * REPLACE ({FAR_PRICE} AS price, {FAR_UNIT} AS price_per_sqft) FROM listing
    WHERE NOT {LOST} AND NOT (l_orderkey % 97 = 50 AND l_linenumber = 1)
),
summed AS (
    SELECT {_window("event_time")}, city, type, {_exact_mean("price")} AS avg_price,
        count(*) AS listing_count, {_exact_mean("price_per_sqft")} AS avg_price_per_sqft
    FROM sound GROUP BY ALL
)
SELECT * FROM summed WHERE {closed}
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, (SELECT count(*) FROM listing) - count(*), NULL FROM sound"""

ROUTE_PARTITION = (
    "CAST(CAST('0x' || substr(md5(city), 1, 8) AS BIGINT) % 6 AS INTEGER)"
)

ORACLES: dict[str, str] = {
    "listing_decode": f"""WITH {MAPPED}
SELECT property_id, street, city, state, zip_code, country, type, transaction_type,
    year_built, construction_type, floors, lot_size,
    CAST(living_area AS DOUBLE) AS living_area, bedrooms, bathrooms,
    array_to_string(amenities, '|') AS amenities, has_garage, parking_spaces,
    neighborhood_class, price, price_per_sqft, tax_assessment, hoa_fee, last_sale_price,
    last_sale_date, listing_date, days_on_market, listing_status, description,
    latitude, longitude, school_district, walk_score, transit_score,
    agent_id, agent_name, agent_company,
    strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') AS record_time
FROM listing""",
    "listing_decode_malformed": f"""WITH {PLAIN}
SELECT {FAULT} AS fault, count(*) AS row_count,
    count(*) FILTER (l_orderkey % 97 NOT IN (0, 1, 3, 4)) AS ids,
    count(*) FILTER (NOT {LOST}) AS cities,
    count(*) FILTER (NOT {LOST} AND l_orderkey % 97 <> 2) AS bedrooms,
    count(*) FILTER (NOT {LOST}) AS bathrooms,
    count(*) FILTER (NOT {LOST}) AS prices,
    count(*) FILTER (l_orderkey % 97 IN (0, 2, 4, 5)) AS damaged_texts,
    count(*) FILTER (l_orderkey % 97 = 10) AS nan_prices,
    count(*) FILTER (l_orderkey % 97 = 9) AS vast_prices,
    count(*) FILTER (l_orderkey % 97 = 11) AS infinite_unit_prices,
    min(CASE l_orderkey % 97 WHEN 12 THEN -2147483648 WHEN 13 THEN 2147483647
        ELSE {NOT_LOST.format("year_built")} END)::DOUBLE AS first_year,
    max(CASE l_orderkey % 97 WHEN 12 THEN -2147483648 WHEN 13 THEN 2147483647
        ELSE {NOT_LOST.format("walk_score")} END)::DOUBLE AS top_walk_score,
    max(CASE l_orderkey % 97 WHEN 12 THEN CAST(-1.7976931348623157E308 AS DOUBLE)
        WHEN 13 THEN CAST(1.7976931348623157E308 AS DOUBLE)
        ELSE {NOT_LOST.format("tax_assessment")} END) AS top_tax
FROM listing GROUP BY ALL""",
    "message_envelope": f"""WITH {MAPPED}
SELECT n_name AS key, 'listings' AS topic, CAST(l_orderkey % 6 AS INTEGER) AS partition,
    count(*) AS row_count,
    count(*) FILTER (hoa_fee IS NULL) AS null_hoa_fees,
    count(*) FILTER (lot_size IS NULL) AS null_lot_sizes,
    CAST(sum(days_on_market) AS BIGINT) AS days_on_market
FROM listing GROUP BY ALL""",
    "listing_window_summary": f"WITH {PLAIN} {LISTING_SUMMARY}",
    "listing_window_summary_malformed": f"""WITH {PLAIN}
SELECT {_window("event_time")},
    {NOT_LOST.format("city")} AS city, {NOT_LOST.format("type")} AS type,
    {_exact_mean(NOT_LOST.format(FAR_PRICE))} AS avg_price, count(*) AS listing_count,
    {_exact_mean(NOT_LOST.format(FAR_UNIT))} AS avg_price_per_sqft
FROM listing GROUP BY ALL""",
    "exact_means": """
WITH small AS (
    SELECT l_orderkey % 211 AS g, l_extendedprice * pow(2, -996) AS value,
        CAST(l_extendedprice * pow(2, 60) AS HUGEINT) AS units,
        CASE WHEN l_orderkey % 211 IN (7, 8, 9) AND l_linenumber = 1 THEN 1 ELSE 0 END AS odd
    FROM lineitem
)
SELECT g AS "group", 3 * count(*) AS row_count,
    CASE WHEN g <> 10 AND sum(odd) = 0 THEN CAST(CAST(sum(units) AS VARCHAR) AS DOUBLE) / pow(2, 60)
        / (3 * count(*)) * pow(2, -996) END AS mean,
    CASE WHEN sum(odd) > 0 THEN CASE g WHEN 7 THEN 'NaN' WHEN 8 THEN 'Infinity' ELSE '-Infinity' END END AS no_number
FROM small GROUP BY g""",
    "events_window_summary": f"""
SELECT {_window("ts")}, event_type, count(*) AS event_count, {EVENT_MEAN},
    avg(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS avg_k
FROM events GROUP BY ALL""",
    "processing_time_summary": f"""WITH {PLAIN}
SELECT city, type, {OVER_WINDOWS.format(price="price", unit="price_per_sqft")}
FROM listing GROUP BY ALL""",
    "stream_complete_equals_batch": f"WITH {PLAIN} {LISTING_SUMMARY}",
    "stream_append_closed_windows": f"""
SELECT * FROM ({EVENT_SUMMARY})
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
    "stream_update_upsert": EVENT_SUMMARY,
    "stream_late_rows": LATE,
    "stream_late_side": f"""
SELECT window_start, window_end, event_type, false AS is_late, event_count AS row_count, avg_value AS mean,
    CAST(-1 AS BIGINT) AS events
FROM ({LATE_EXACT})
UNION ALL
SELECT window_start, window_start + INTERVAL 15 MINUTE, event_type, true, count(*),
    {_exact_sum("value")}, CAST(sum(event_id) AS BIGINT)
FROM (WITH {ARRIVALS} SELECT * FROM arrivals JOIN reached USING (arrival))
WHERE window_start + INTERVAL 15 MINUTE <= watermark GROUP BY ALL""",
    "stream_processing_time_summary": f"""WITH {MAPPED}
SELECT {NOT_LOST.format("city")} AS city, {NOT_LOST.format("type")} AS type,
    {OVER_WINDOWS.format(price=NOT_LOST.format("price"), unit=NOT_LOST.format("price_per_sqft"))}
FROM listing GROUP BY ALL""",
    "stream_damaged_append": _damaged(
        "window_end <= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM sound)"
    ),
    "stream_damaged_update": _damaged("true"),
    "job_two_queries": f"""WITH {MAPPED}
SELECT {NOT_LOST.format("city")} AS city, {NOT_LOST.format("type")} AS type,
    count(*) AS landed_rows, count(*) AS listing_count,
    {_exact_sum(NOT_LOST.format("price"))} AS sum_price, true AS stopped_together
FROM listing GROUP BY ALL""",
    "job_fresh_checkpoint": """
SELECT mode, 2::INTEGER AS epochs, CASE WHEN mode <> 'append' THEN all_rows ELSE 0 END AS summed_rows,
    CASE WHEN mode <> 'append' THEN half ELSE 0 END AS epoch_1_rows,
    CASE WHEN mode = 'update' THEN half + all_rows ELSE 0 END AS landed_rows,
    concat_ws(',', half, all_rows) || CASE WHEN mode = 'update' THEN concat_ws(',', '', half, all_rows)
        ELSE '' END AS read
FROM (SELECT unnest(['update', 'complete', 'append']) AS mode),
    (SELECT count(*) AS all_rows, count(*) FILTER (l_orderkey % 2 = 0) AS half FROM lineitem)""",
    "job_one_scan": f"""WITH {MAPPED}
SELECT {NOT_LOST.format("city")} AS city, {NOT_LOST.format("type")} AS type, count(*) AS landed_rows,
    {OVER_WINDOWS.format(price=NOT_LOST.format("price"), unit=NOT_LOST.format("price_per_sqft"))}
FROM listing GROUP BY ALL""",
    "stream_routed": f"""WITH {MAPPED},
routed AS (
    SELECT CAST(l_orderkey % 4 AS BIGINT) AS batch_id,
        CASE WHEN l_orderkey % 4 >= 2 AND l_partkey % 3 <> 0 THEN 'Phoenix' ELSE city END AS city
    FROM listing
),
seen AS (
    SELECT batch_id, count(*) AS row_count, count(*) FILTER (city = 'Phoenix') AS phoenix_rows
    FROM routed GROUP BY ALL
)
SELECT *, (sum(phoenix_rows) OVER upto * 6 > sum(row_count) OVER upto OR phoenix_rows * 6 > row_count) AS divided, true AS even
FROM seen WINDOW upto AS (ORDER BY batch_id)""",
    "stream_unique": """
SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS first_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS ids,
    count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS repeats
FROM lineitem""",
    "quality_repeats": f"""WITH {MAPPED}
SELECT property_id, count(*) AS repeats, {_exact_sum("price")} AS sum_price
FROM listing GROUP BY property_id HAVING count(*) > 1""",
    "messages_sent_once": f"""WITH {MAPPED}
SELECT n_name AS key, count(*) AS row_count, {_exact_sum("price")} AS sum_price, true AS sent_again
FROM listing GROUP BY ALL""",
    "stream_price_estimate": f"""{LOOKED_UP}
SELECT property_id, city, c_state AS city_state, type, estimate AS price_estimate
FROM looked_up""",
    "stream_quality_split": QUALITY_SPLIT,
    "landing_partitions": f"""{EVENT_DAYS},
    min(event_id) AS first_event, max(event_id) AS last_event
FROM events GROUP BY ALL""",
    "landing_compacted": f"{EVENT_DAYS}, CAST(1 AS BIGINT) AS files FROM events GROUP BY ALL",
    "landing_folded_while_landing": f"""{EVENT_DAYS}, count(DISTINCT event_id) AS events,
    count(DISTINCT event_id % 8) AS batches, true AS few_folders
FROM events GROUP BY ALL""",
    "landing_by_time": f"""{EVENT_DAYS}, CAST(7 AS INTEGER) AS folders_read FROM events
WHERE ts >= TIMESTAMP '2024-01-09 03:00:00' AND ts < TIMESTAMP '2024-01-12 03:00:00' GROUP BY ALL""",
    "landing_dead_letters": """
SELECT CASE l_orderkey % 97 WHEN 1 THEN 'null' WHEN 2 THEN 'mistyped' WHEN 3 THEN 'empty'
        WHEN 4 THEN 'not an object' ELSE 'not json' END AS fault,
    count(*) AS row_count, count(*) AS as_sent, count(*) FILTER (l_orderkey % 97 <> 1) AS with_bytes
FROM lineitem WHERE l_orderkey % 97 <= 5 GROUP BY ALL""",
    "landing_unknown_fields": f"""WITH {MAPPED}
SELECT type, count(*) AS row_count, count(*) AS ids, count(*) FILTER (l_orderkey % 5 < 2) AS with_more,
    CAST(0 AS BIGINT) AS dead,
    CAST(sum(l_linenumber) FILTER (l_orderkey % 5 = 0) AS BIGINT) AS grades,
    3 * count(*) FILTER (l_orderkey % 5 = 1) AS levels
FROM listing GROUP BY ALL""",
    "landing_retry": f"{EVENT_DAYS} FROM events GROUP BY ALL",
    "landing_listings": f"""WITH {MAPPED}
SELECT {DAY.format("event_time")}, city, type, count(*) AS row_count,
    {_exact_sum("price")} AS sum_price, CAST(sum(len(amenities)) AS BIGINT) AS amenities,
    count(living_area) AS living_areas, count(*) AS stamped
FROM listing GROUP BY ALL""",
    "landing_processing_time": f"""WITH {MAPPED}
SELECT {NOT_LOST.format("city")} AS city, {NOT_LOST.format("type")} AS type,
    count(*) AS row_count, count(*) AS on_their_day
FROM listing GROUP BY ALL""",
    "city_lookup": f"""WITH {CITY_DIM}, {MAPPED},
half AS (
    SELECT * REPLACE (CASE WHEN l_orderkey % 2 = 0 THEN city ELSE n_name END AS city)
    FROM listing
)
SELECT {LINE}, half.city, c.state AS city_state, c.zip_prefix AS city_zip_prefix,
    c.price_multiplier AS city_price_multiplier
FROM half LEFT JOIN city_dim c ON c.city = half.city""",
    "type_lookup": f"""WITH {TYPE_DIM}, {MAPPED}
SELECT {LINE}, listing.type,
    CAST(t.sqft_min AS BIGINT) AS type_sqft_min, CAST(t.sqft_max AS BIGINT) AS type_sqft_max,
    CAST(t.bed_min AS BIGINT) AS type_bed_min, CAST(t.bed_max AS BIGINT) AS type_bed_max,
    t.bath_min AS type_bath_min, t.bath_max AS type_bath_max,
    t.base_price_per_sqft AS type_base_price_per_sqft
FROM listing LEFT JOIN type_dim t ON t.type = listing.type""",
    "price_estimate": f"""WITH {CITY_DIM}, {TYPE_DIM}, {MAPPED}
SELECT {LINE}, {ESTIMATE} AS price_estimate
FROM listing
LEFT JOIN city_dim c ON c.city = listing.city
LEFT JOIN type_dim t ON t.type = listing.type""",
    "age_band": f"""WITH {MAPPED}
SELECT CASE WHEN {AGE} < 5 THEN 'new' WHEN {AGE} > 30 THEN 'old' ELSE 'standard' END AS age_band,
    {AGE_FACTOR} AS age_factor, count(*) AS row_count, {_exact_sum("price")} AS sum_price
FROM listing GROUP BY ALL""",
    "unit_price": f"""WITH {MAPPED}
SELECT {LINE}, CASE WHEN living_area > 0 THEN price / living_area END AS unit_price
FROM listing""",
    "listing_description": f"WITH {MAPPED} SELECT {LINE}, description FROM listing",
    "identifiers": f"""WITH {MAPPED}
SELECT {LINE}, property_id, agent_id, zip_code, school_district FROM listing""",
    "days_on_market": f"WITH {MAPPED} SELECT {LINE}, listing_date, days_on_market FROM listing",
    "record_time_parse": f"""WITH {MAPPED},
parsed AS (
    SELECT {LINE}, CASE WHEN l_orderkey % 2 = 1 THEN event_time END AS record_time,
        CAST(strptime(last_sale_date, '%Y-%m-%d') AS TIMESTAMP) AS last_sale_day
    FROM listing
)
SELECT {LINE}, record_time,
    strftime(record_time, '%Y-%m-%d %H:%M:%S.%f') AS record_text, last_sale_day,
    strftime(last_sale_day, '%Y-%m-%d') AS last_sale_text
FROM parsed""",
    "amenity_counts": f"""WITH {MAPPED}
SELECT amenity, count(*) AS listing_count
FROM (SELECT unnest(amenities) AS amenity FROM listing) GROUP BY ALL""",
    "amenity_lists": f"""WITH {MAPPED}
SELECT {LINE}, array_to_string(amenities[1:3], ', ') AS first_three,
    CAST(len(amenities) AS INTEGER) AS amenity_count,
    len(list_distinct(amenities)) = len(amenities) AS all_distinct,
    CAST(len(amenities)
        - len(list_intersect(amenities, ['Pool', 'Gym', 'Parking', 'Garden']))
        AS INTEGER) AS beyond_four
FROM listing""",
    "land_shape": f"""WITH {MAPPED}
SELECT type, count(*) AS row_count, count(lot_size) AS lots,
    CAST(coalesce(sum(lot_size), 0) AS BIGINT) AS lot_sqft, count(living_area) AS areas,
    CAST(coalesce(sum(living_area), 0) AS BIGINT) AS living_sqft, CAST(sum(floors) AS BIGINT) AS floors
FROM listing GROUP BY ALL""",
    "quality_violations": f"""{CHECKED}
SELECT rule, count(*) AS row_count
FROM (SELECT unnest([{_broken()}]) AS rule FROM looked_up)
WHERE rule IS NOT NULL GROUP BY ALL""",
    "quality_rows": f"""{CHECKED}
SELECT {LINE}, concat_ws(',', {_broken()}) AS violations FROM looked_up""",
    "quality_split": QUALITY_SPLIT,
    "route_by_key": f"""WITH {MAPPED}
SELECT city AS key, count(*) AS row_count, {ROUTE_PARTITION} AS partition
FROM listing GROUP BY ALL""",
    "routing_report": f"""WITH {MAPPED},
loads AS (
    SELECT {ROUTE_PARTITION} AS partition, count(*) AS row_count,
        count(DISTINCT city) AS key_count
    FROM listing GROUP BY ALL
)
SELECT partition, CAST(row_count AS BIGINT) AS row_count, key_count,
    CAST(row_count * 6 AS DOUBLE) / (SELECT sum(row_count) FROM loads) AS skew
FROM loads""",
    "hot_keys": f"""WITH {MAPPED},
counts AS (
    SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'Phoenix' ELSE city END AS key,
        count(*) AS row_count
    FROM listing GROUP BY ALL
),
shares AS (
    SELECT *, CAST(row_count * 6 AS DOUBLE) / (SELECT sum(row_count) FROM counts) AS share
    FROM counts
)
SELECT key, row_count, CAST(ceil(share * 4) AS BIGINT) AS ways FROM shares WHERE share > 1""",
    "routed_messages": """
SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS as_reported, CAST(6 AS BIGINT) AS in_place,
    true AS hot_key_divided
FROM lineitem""",
    "query_progress": f"""
WITH {ARRIVALS}
SELECT 'feed' AS query, arrival AS turn, count(*) AS input_rows,
    count(*) FILTER (window_start + INTERVAL 15 MINUTE <= watermark) AS late_rows,
    true AS has_rate, true AS has_watermark
FROM arrivals LEFT JOIN reached USING (arrival) GROUP BY ALL""",
}
