"""What the plans must look like at scale, and that results survive its strategies."""

import contextlib
import io
import re
from datetime import datetime

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelflow.operators.lookup import city_lookup
from parcelflow.plans import listings as fixture
from parcelflow.plans import queries
from parcelflow.plans.queries import QUERIES
from parcelflow.plans.replay import event_cuts
from parcelflow.sinks.landing import land
from parcelflow.sources.landed import landed_table
from parcelflow.schema import LANDED_KEYS
from parcelflow.sources.tables import SCHEMAS

SF = "/root/testdata/sf0.001"
BATCH = [
    name for name in QUERIES
    if not name.startswith(("stream_", "landing_", "job_")) and name != "query_progress"
]


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def final_plan(df):
    """The plan AQE ended with."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **changes):
    names = {name.replace("__", "."): value for name, value in changes.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                "ExistingRDD"):
        assert bad not in text


def test_flagship_parses_each_message_once_and_combines_before_the_shuffle(spark):
    text = plan(entry.queries()["listing_window_summary"](spark, SF), "simple")
    lines = text.splitlines()
    # Once narrow; the whole schema only in the branch for damaged messages.
    assert sum("columnNameOfCorruptRecord" in line for line in lines) == 1
    assert not any("Filter" in line and "from_json" in line for line in lines)
    assert not any("Join" in line and "from_json" in line for line in lines)
    last, regroup, gather, final, exchange, partial = [
        i for i, line in enumerate(lines)
        if "Aggregate" in line or "Exchange hashpartitioning(window" in line
    ]
    assert "partial_sum" in lines[partial] and final < exchange < partial
    assert "collect_list" in lines[last] and last < regroup < gather < final


def test_scans_read_only_what_a_query_uses(spark):
    text = plan(entry.queries()["days_on_market"](spark, SF))
    read = re.search(r"ReadSchema: struct<(l_[^>]*)>", text).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == {
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
    }


def test_time_cuts_reach_the_scan(spark):
    _, middle, _ = event_cuts(spark, SF)
    text = plan(middle)
    assert "GreaterThanOrEqual(ts,2024-01-11T00:00)" in text
    assert "LessThan(ts,2024-01-21T00:00)" in text


def test_landed_days_prune_partitions(spark, tmp_path):
    rows = spark.range(100).select(
        "id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("id") % 5).cast("int"))).alias("ts")
    )
    land(rows, str(tmp_path), "r", 0, "ts")
    landed = landed_table(spark, str(tmp_path), f"id BIGINT, ts TIMESTAMP, {LANDED_KEYS}")
    text = plan(landed.filter("year = 2024 AND month = 1 AND day = 3"))
    assert re.search(r"PartitionFilters: \[.*day#\d+ = 3", text)
    assert landed.filter("day = 3").count() == 20


def test_lookup_strategy_follows_the_size(spark):
    rows = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("city"))
    assert "BroadcastHashJoin" in plan(city_lookup(rows, "city"))
    large = spark.range(5_000_000).select(
        F.concat(F.lit("c"), "id").alias("city"), F.lit("TX").alias("state")
    )
    assert "SortMergeJoin" in plan(city_lookup(rows, "city", large))


SHUFFLED = dict(spark__sql__autoBroadcastJoinThreshold="-1")
SKEWED = dict(
    SHUFFLED,
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1k",
    spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="8k",
    spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
)


def test_a_hot_lookup_key_is_divided(spark):
    """A third of all rows share one key of a lookup too large to broadcast."""
    with conf(spark, **SKEWED):
        rows = spark.range(0, 60_000, 1, 8).select(
            "id",
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("city"),
        )
        dim = spark.range(50_000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("city"),
            F.lit("TX").alias("state"),
        )
        joined = city_lookup(rows, "city", dim)
        text = final_plan(joined)
        assert "SortMergeJoin(skew=true)" in text
        assert joined.count() == 60_000
        assert joined.filter("city = 'hot' AND city_state = 'TX'").count() == 20_000


@pytest.mark.parametrize(
    "name", ["listing_window_summary", "quality_rows", "price_estimate", "routing_report"]
)
def test_results_hold_when_nothing_fits_a_broadcast(spark, name):
    expected = connect(SF).execute(entry.oracle_sql()[name]).df()
    with conf(spark, **SKEWED):
        df = entry.queries()[name](spark, SF)
        assert "SortMergeJoin" in plan(df)
        assert differences(df.toPandas(), expected) == []


@pytest.mark.parametrize("partitions", ["1", "3", "64"])
def test_results_do_not_hang_on_partition_counts(spark, partitions):
    name = "listing_window_summary_malformed"
    expected = connect(SF).execute(entry.oracle_sql()[name]).df()
    with conf(spark, spark__sql__shuffle__partitions=partitions,
              spark__sql__adaptive__coalescePartitions__enabled="false"):
        assert differences(entry.queries()[name](spark, SF).toPandas(), expected) == []


def test_messages_keep_hot_keys_apart_from_the_data(spark):
    """Messages are built row by row: no shuffle but the spread of a small input."""
    text = plan(fixture.messages(spark, SF), "simple")
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_sound_messages_pass_the_damage_by_one_test_as_they_are(spark, monkeypatch):
    day = datetime(1998, 3, 4)
    rows = {
        "lineitem": [(n, 1, 1, 1, 17.0, 900.5, 0.0, 0.0, "A", "F", day) for n in (None, 0, 1, 2, 13, 14, 50, 111)],
        "part": [(1, 'a "quoted" \u2028 é', "b", "PROMO", 5, 1.0)],
        "supplier": [(1, "s", 1, 1.0)],
        "nation": [(1, "n", 1)],
        "region": [(1, "r")],
    }
    monkeypatch.setattr(fixture, "table", lambda spark, _, name: spark.createDataFrame(rows[name], SCHEMAS[name]))
    sent = fixture.messages(spark, "", damaged=True, extreme=True, keep=["l_orderkey"])
    tested = sent._jdf.queryExecution().analyzed().toString()
    assert re.search(r"CASE WHEN \(\(_fault#\d+L? >= .*?14.*?THEN value#\d+ ELSE cast\(CASE WHEN", tested)
    whole = {r.l_orderkey: r.value for r in fixture.messages(spark, "", keep=["l_orderkey"]).collect()}
    found = {r.l_orderkey: r.value for r in sent.collect()}
    assert {n for n in whole if found[n] == whole[n]} == {None, 14, 50, 111}
    assert bytes(found[0]) == b"not json" and found[1] is None and b"2147483647" in found[13]


def test_a_larger_feed_has_larger_batches_not_more(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "file_stream", lambda *given: given[3])
    spark.range(0, 20, 1, 20).write.parquet(str(tmp_path / "many"))
    spark.range(0, 3, 1, 3).write.parquet(str(tmp_path / "few"))
    assert queries._replayed(spark, str(tmp_path / "many")) == -(-20 // queries.BATCHES)
    assert queries._replayed(spark, str(tmp_path / "few")) == queries.FILES_A_TRIGGER


def test_messages_are_parted_without_moving_them(spark, tmp_path, monkeypatch):
    sent = spark.createDataFrame(
        [(n, f"v{n}".encode()) for n in (None, None, 0, 1, 5, 6, -1)], "l_orderkey BIGINT, value BINARY"
    )
    monkeypatch.setattr(fixture, "messages", lambda *_, **__: sent)
    monkeypatch.setattr(type(sent), "repartition", lambda *_: pytest.fail("moved"))
    queries._store_parts(spark, "", str(tmp_path), 4)
    stored = [f.name for f in tmp_path.glob("*.parquet")]
    assert len(stored) >= 4 and all(".zstd." in name for name in stored)
    values = sorted(bytes(r.value).decode() for r in spark.read.parquet(str(tmp_path)).collect())
    assert values == sorted(["vNone", "vNone", "v0", "v1", "v5", "v6", "v-1"])


def test_a_topic_partition_is_the_work_of_several_tasks(spark, monkeypatch):
    seen, frame = [], type(spark.range(0))
    by_id = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, n, at: seen.append(n) or by_id(self, n, at))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        found = queries.QUERIES["routed_messages"](spark, "/root/testdata/sf0.001").first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen == [18] and found.as_reported == found.in_place
