"""Every registered query against its SQL, bit for bit."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from parcelflow.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    assert len(mine) > 0
    assert differences(mine, db.execute(entry.oracle_sql()[name]).df()) == []


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns == [
        "window_start", "window_end", "city", "type", "avg_price", "listing_count",
        "avg_price_per_sqft",
    ]
