"""Value sets, lookup rows and price constants of the listing domain."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed values -----------------------------------------------------------------

# city, state, zip prefix, price multiplier
CITIES = [
    ("New York", "NY", "10", 1.8),
    ("Los Angeles", "CA", "90", 1.6),
    ("Chicago", "IL", "60", 1.2),
    ("Houston", "TX", "77", 1.1),
    ("Phoenix", "AZ", "85", 1.0),
    ("Philadelphia", "PA", "19", 1.3),
    ("San Antonio", "TX", "78", 0.9),
    ("San Diego", "CA", "92", 1.5),
    ("Dallas", "TX", "75", 1.1),
    ("San Jose", "CA", "95", 1.7),
]

# type, sqft min/max, bedrooms min/max, bathrooms min/max, base price per sqft
PROPERTY_TYPES = [
    ("Apartment", 500, 2000, 1, 3, 1.0, 2.5, 200.0),
    ("House", 1000, 5000, 2, 5, 1.5, 4.0, 180.0),
    ("Villa", 2000, 8000, 3, 6, 2.0, 5.0, 250.0),
    ("Condo", 600, 2500, 1, 3, 1.0, 3.0, 220.0),
    ("Townhouse", 1200, 3000, 2, 4, 1.5, 3.5, 190.0),
    ("Land", 5000, 50000, 0, 0, 0.0, 0.0, 50.0),
]
LAND = "Land"

TRANSACTION_TYPES = ["Sale", "Rent", "Lease"]
AMENITIES = [
    "Pool", "Gym", "Parking", "Garden", "Fireplace", "Balcony", "Elevator", "Security",
]
CONSTRUCTION_TYPES = ["Brick", "Wood", "Concrete", "Steel", "Mixed"]
NEIGHBORHOOD_CLASSES = ["A", "B", "C"]
LISTING_STATUSES = ["Active", "Pending", "Sold", "Withdrawn"]
COUNTRY = "USA"

# Price estimate: class factors, per-bedroom step, age bands, noise band.
CLASS_FACTORS = {"A": 1.5, "B": 1.1, "C": 0.8}
BEDROOM_STEP = 0.15
NEW_BUILD_YEARS, NEW_BUILD_FACTOR = 5, 1.1
OLD_BUILD_YEARS, OLD_BUILD_FACTOR = 30, 0.8
PRICE_NOISE = (0.95, 1.05)

# Ranges of the remaining fields.
LOT_PER_SQFT = (1.2, 5.0)
FLOORS = (1, 3)
AMENITY_COUNT = (2, 5)
FIRST_YEAR_BUILT = 1900
TAX_SHARE = (0.7, 0.9)
LAST_SALE_SHARE = (0.5, 1.2)
HOA_FEE = (100, 500)
PARKING_SPACES = (0, 3)
SCORES = (0, 100)
LISTING_AGE_DAYS = 730
LAST_SALE_YEARS = (1, 10)
AGENTS = 1000
SCHOOL_DISTRICTS = 20

# Identifier and time formats.
PROPERTY_ID_PATTERN = r"^PRP-[A-Z]{4}-\d{4}$"
AGENT_ID_FORMAT = "AGT-%05d"
AGENT_ID_PATTERN = r"^AGT-\d{5}$"
DATE_FORMAT = "yyyy-MM-dd"
RECORD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# End of fixed values ----------------------------------------------------------


def _lookup(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A lookup of constants.  An Arrow table becomes a local relation, whose
    exact size Catalyst knows, so the join strategy follows a checked size."""
    columns = [list(values) for values in zip(*rows)]
    return spark.createDataFrame(pa.table(dict(zip(names, columns))))


def city_dim(spark: SparkSession) -> DataFrame:
    return _lookup(spark, ["city", "state", "zip_prefix", "price_multiplier"], CITIES)


def type_dim(spark: SparkSession) -> DataFrame:
    names = ["type", "sqft_min", "sqft_max", "bed_min", "bed_max",
             "bath_min", "bath_max", "base_price_per_sqft"]
    return _lookup(spark, names, PROPERTY_TYPES)
