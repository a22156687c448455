import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelflow.operators.routing import (
    hot_keys,
    route,
    route_evenly,
    routing_report,
    rows_per_key,
    topic_partition,
)

N = 3000


@pytest.fixture
def rows(spark):
    """A third of all rows have one key."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(N).select("id", key.alias("key"))


def placement(df):
    return df.select("key", F.spark_partition_id().alias("p")).distinct().collect()


def test_equal_keys_meet(rows):
    assert max(Counter(r.key for r in placement(route(rows, 6, "key"))).values()) == 1


def test_a_hot_key_can_be_spread(rows):
    spread = route(rows, 6, "key", spread_by="id", ways=8)
    assert Counter(r.key for r in placement(spread))["hot"] > 2
    assert spread.count() == N
    assert spread.exceptAll(rows).count() == 0


def test_hot_keys_are_found_and_divided(rows):
    hot = hot_keys(rows, 6, "key").collect()
    assert [(r.key, r.row_count, r.ways) for r in hot] == [("hot", N // 3, 8)]
    even = route_evenly(rows, 6, "key", "id")
    found = Counter(r.key for r in placement(even))
    assert found.pop("hot") > 2 and set(found.values()) == {1}
    assert even.exceptAll(rows).count() == 0 and even.count() == N

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    assert largest(even) < largest(route(rows, 6, "key"))


def test_rows_without_a_key_can_be_the_hot_ones(rows):
    bare = rows.withColumn("key", F.when(F.col("key") != "hot", F.col("key")))
    assert [(r.key, r.ways) for r in hot_keys(bare, 6, "key").collect()] == [(None, 8)]
    even = route_evenly(bare, 6, "key", "id")
    assert Counter(r.key for r in placement(even))[None] > 2
    assert even.count() == N
    report = {r.partition: r.row_count for r in routing_report(bare, 6, "key").collect()}
    assert report[None] == N // 3 and sum(report.values()) == N


def test_topic_partition_is_the_same_in_any_engine(spark):
    keys = ["", "Dallas", "San José", "k1"]
    df = spark.createDataFrame([(k,) for k in keys], "key STRING")
    got = [r[0] for r in df.select(topic_partition(F.col("key"), 6)).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 6 for k in keys]


def test_report(rows):
    expected = Counter()
    for row in rows_per_key(rows, "key").collect():
        expected[int(hashlib.md5(row.key.encode()).hexdigest()[:8], 16) % 6] += row.row_count
    report = {r.partition: r for r in routing_report(rows, 6, "key").collect()}
    assert {p: r.row_count for p, r in report.items()} == dict(expected)
    assert sum(r.row_count for r in report.values()) == N
    assert max(r.skew for r in report.values()) >= 2.0
    for r in report.values():
        assert r.skew == pytest.approx(r.row_count / (N / 6))
