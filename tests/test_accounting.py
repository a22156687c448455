"""Late rows, one scan for two tables, hot keys of streams, repeats, and messages sent once."""

from fractions import Fraction

import pytest
from corpus import envelope, text
from pyspark.sql import functions as F

from parcelflow.operators import routing
from parcelflow.operators.late import LATE, _mean, summary_with_late_rows
from parcelflow.operators.timecols import watermarked
from parcelflow.operators.unique import first_of_each, repeated_ids, with_repeats
from parcelflow.schema import LANDED_MESSAGES
from parcelflow.settings import SESSION_CONF, Settings
from parcelflow.sinks import outbox
from parcelflow.sinks.compaction import compact_days
from parcelflow.sinks.messages import store
from parcelflow.sinks.outbox import STORED, outbox_sink, read_once, send_waiting
from parcelflow.sinks.tables import accumulated, accumulate, add_batch, published_table, stored_rows, upserted
from parcelflow.sources.messages import file_stream
from parcelflow.streaming import job
from parcelflow.streaming.routed import evenly_keyed
from parcelflow.streaming.runner import run_to_end, start_to_sink

EVENT = "id INT, ts TIMESTAMP, kind STRING, value DOUBLE"


@pytest.fixture
def rocksdb(spark):
    names = [name for name in SESSION_CONF if ".stateStore." in name]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, SESSION_CONF[name])
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_windows_and_late_rows_hold_every_row(spark, tmp_path, rocksdb):
    batches = [
        [(1, "10:01", "a", 1.0), (2, "10:02", "a", None), (3, "10:03", "b", float("inf"))],
        [(4, "12:00", "a", 0.1)],
        [(5, "10:04", "a", 2.0), (6, "12:01", "a", 0.2), (7, "12:02", None, 0.3)],  # 5 comes too late
        [(8, "10:05", "c", 9.0), (9, "15:00", "a", 1e300)],
    ]

    def start():
        feed = watermarked(file_stream(spark, str(tmp_path / "in"), EVENT), "ts")
        rows = summary_with_late_rows(feed, "ts", ["kind"], "value", ["id", "ts"], "15 minutes")
        start.schema = rows.schema
        return start_to_sink(rows, add_batch(str(tmp_path / "out")), "late", str(tmp_path / "cp"))

    for batch in batches:
        rows = [(i, f"2024-01-01 {clock}:00", kind, value) for i, clock, kind, value in batch]
        frame = spark.createDataFrame(rows, "id INT, ts STRING, kind STRING, value DOUBLE")
        store(frame.withColumn("ts", F.col("ts").cast("timestamp")), str(tmp_path / "in"))
        run_to_end(start())
    found = published_table(spark, str(tmp_path / "out"), start.schema).collect()
    late = sorted(row[LATE].id for row in found if row[LATE])
    closed = sorted(
        ((r.window_start.strftime("%H:%M"), r.kind, r.row_count, r["mean"]) for r in found if not r[LATE]), key=repr
    )
    assert late == [5, 8]
    assert closed == sorted(
        [("10:00", "a", 2, 1.0), ("10:00", "b", 1, float("inf")), ("12:00", "a", 2, float(Fraction(0.1) + Fraction(0.2)) / 2),
         ("12:00", None, 1, 0.3)], key=repr
    )  # the window of 15:00 is open
    row = next(r for r in found if r[LATE])
    assert (row.row_count, row["mean"]) == (None, None) and row.window_end.strftime("%H:%M") == "10:15"


def test_the_operator_s_means_are_exact():
    unit = 1 << 1074
    for values in ([0.1] * 10, [1e300, -1e300, 1e-300], [5e-324], [1.7976931348623157e308] * 3, [0.0]):
        units = sum(int(Fraction(v) * unit) for v in values)
        total = sum(map(Fraction, values))
        try:
            want = float(total) / len(values)
        except OverflowError:
            want = values[0]
        assert _mean(units, len(values)) == want


def shared(spark, tmp_path, falls=()):
    settings = Settings(base_path=str(tmp_path), analytics_interval=None, one_scan=True)
    values = [text(), text(address__city="Houston"), None, "not json", text(financials__price=1e30), text()[:200]]
    store(envelope(spark, values).repartition(3), str(tmp_path / "in"))
    return settings, file_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)


def test_one_scan_lands_and_sums_up(spark, tmp_path):
    settings, feed = shared(spark, tmp_path)
    run_to_end(job.start_shared(feed, settings))
    rows = {(r.city, r.type): r for r in job.shared_summary(spark, settings).collect()}
    assert {key: r.listing_count for key, r in rows.items()} == {
        ("Dallas", "House"): 2, ("Houston", "House"): 1, (None, None): 3
    }
    assert rows["Dallas", "House"].avg_price == float(Fraction(566280.0) + Fraction(1e30)) / 2
    assert job.landed(spark, settings).count() == 6 and job.dead_letter_table(spark, settings).count() == 3


@pytest.mark.parametrize("fall", ["after landing", "after both"])
def test_one_scan_that_dies_counts_nothing_twice(spark, tmp_path, fall, monkeypatch):
    settings, feed = shared(spark, tmp_path)
    write = job.shared_sink(settings)

    def fail(*_):
        raise RuntimeError("died")

    def dying(batch, batch_id):
        if batch_id == 1 and fall == "after landing":
            monkeypatch.setattr(job, "batch_partials", fail)
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("died")

    start = dict(name=job.SHARED, checkpoint_root=settings.checkpoint_root)
    with pytest.raises(Exception, match="died"):
        run_to_end(start_to_sink(job.landing_rows(feed), dying, **start))
    monkeypatch.undo()
    day = job.landed(spark, settings).select(F.to_date("processing_timestamp")).first()[0]
    compact_days(spark, settings.landing_path, [day], LANDED_MESSAGES, ["dead"])  # and folded meanwhile
    run_to_end(start_to_sink(job.landing_rows(feed), write, **start))
    assert job.landed(spark, settings).count() == 6
    assert job.shared_summary(spark, settings).agg(F.sum("listing_count")).first()[0] == 6


def test_the_summary_of_one_scan_parses_nothing(spark, tmp_path):
    settings, feed = shared(spark, tmp_path)
    run_to_end(job.start_shared(feed, settings))
    (leaf, *_) = [f"{p.parent.relative_to(settings.landing_path)}" for p in (tmp_path / "data").rglob("dead=false")]
    plan = job.batch_partials(spark, settings.landing_path, [leaf])._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "description" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_folded_sums_are_the_same(spark, tmp_path):
    schema = "k STRING, n BIGINT"
    sink = accumulate(str(tmp_path), ["k"], run="r", fold_after=3)
    for batch in range(10):
        sink(spark.createDataFrame([("a", 1), ("b", batch)], schema), batch)
    sink(spark.createDataFrame([("a", 1), ("b", 9)], schema), 9)  # run again
    assert {r.k: r.n for r in accumulated(spark, str(tmp_path), ["k"], schema).collect()} == {"a": 10, "b": 45}
    assert upserted(spark, str(tmp_path), ["k"], schema).count() == 2


def skewed(spark, hot, rows=20_000):
    key = F.when(F.col("id") % 10 < hot, "hot").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 4999))
    return spark.range(0, rows, 1, 8).select("id", key.alias("key"))


@pytest.mark.parametrize("partitions", [2, 6, 40])
def test_sketches_are_within_their_bound(spark, partitions):
    parts = [skewed(spark, hot) for hot in (0, 2, 5)]
    sketches = [routing.key_sketch(part, "key", partitions) for part in parts]
    found = routing.hot_keys_of(sketches[0].union(sketches[1]).union(sketches[2]), partitions)
    estimated = {r.key: r.row_count for r in found.collect()}
    whole = parts[0].union(parts[1]).union(parts[2])
    exact = {r.key: r.row_count for r in routing.rows_per_key(whole, "key").collect()}
    total = whole.count()
    slack = 3.5 * total / (routing.PIECES * routing.MARGIN * partitions)
    assert all(abs(n - exact[key]) <= slack for key, n in estimated.items())
    sure = {key for key, n in exact.items() if n - slack > total / partitions}
    assert sure <= set(estimated) and ("hot" in estimated) == (exact["hot"] * partitions > total)


def test_a_key_that_turns_hot_is_divided_from_then_on(spark, tmp_path):
    sink = evenly_keyed(add_batch(str(tmp_path / "o"), run="r"), str(tmp_path / "k"), 6, "key", "id", recent=2, run="r")
    for batch, hot in enumerate((0, 6, 6, 0, 0, 0)):
        sink(skewed(spark, hot, 3000), batch)
    rows = stored_rows(spark, str(tmp_path / "o"), "id BIGINT, key STRING, _even_key STRING")
    pieces = rows.filter("key = 'hot'").groupBy("batch_id").agg(F.count_distinct("_even_key").alias("n"))
    assert {r.batch_id: r.n > 6 for r in pieces.collect()} == {1: True, 2: True}
    assert rows.count() == 18_000
    again = rows.filter("batch_id = 1").select("id", "_even_key").collect()
    sink(skewed(spark, 6, 3000), 1)
    assert sorted(again) == sorted(rows.sparkSession.createDataFrame(again).collect())


def test_rows_without_a_key_are_dealt_over_all_partitions(spark):
    rows = spark.range(0, 6000, 1, 4).select("id", F.lit(None).cast("string").alias("key"))
    placed = routing.placed(rows, 6, F.col("key"))
    loads = placed.groupBy(F.spark_partition_id()).count().collect()
    assert len(loads) == 6 and max(r["count"] for r in loads) < 1300
    assert placed.filter("partition IS NOT NULL").count() == 0


def test_repeats_in_a_table(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("b", 2), ("a", 3), (None, 4), (None, 5), ("c", 6), ("a", 3)], "property_id STRING, n INT"
    )
    assert [tuple(r) for r in repeated_ids(rows).collect()] == [("a", 3)]
    assert sorted((r.n, r.repeats) for r in with_repeats(rows).collect() if r.repeats) == [(1, 3), (3, 3), (3, 3)]
    assert with_repeats(rows).count() == 7 and with_repeats(rows.limit(0)).count() == 0


def test_repeats_in_a_stream(spark, tmp_path):
    rows = [("a", 0), ("b", 1), ("a", 2), (None, 3), (None, 3), ("a", 50)]
    frame = spark.createDataFrame(rows, "property_id STRING, minute INT").select(
        "property_id", (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins="minute")).alias("ts")
    )
    for n in range(3):
        store(frame.limit(3) if n < 2 else frame, str(tmp_path / "in"))
        feed = file_stream(spark, str(tmp_path / "in"), "property_id STRING, ts TIMESTAMP").withWatermark("ts", "1 hour")
        sink = add_batch(str(tmp_path / "out"))
        run_to_end(start_to_sink(first_of_each(feed).select("property_id"), sink, "u", str(tmp_path / "cp")))
    found = published_table(spark, str(tmp_path / "out"), "property_id STRING")
    assert sorted((r.property_id or "" for r in found.collect())) == ["", "", "a", "b"]


def messages(spark, *bodies):
    rows = [(b"k", body.encode(), "t", None) for body in bodies]
    return spark.createDataFrame(rows, "key BINARY, value BINARY, topic STRING, partition INT")


def bodies(frame):
    return sorted(bytes(r.value).decode() for r in frame.collect())


def test_each_message_is_read_once(spark, tmp_path):
    topic, box = str(tmp_path / "topic"), str(tmp_path / "box")
    turns = iter(["before", "sent", "after", "sent", "sent", "sent"])

    def send(rows):
        turn = next(turns)
        if turn == "before":
            raise RuntimeError("died before it sent")
        store(rows, topic)
        if turn == "after":
            raise RuntimeError("died after it sent")

    sink = outbox_sink(box, send, run="r")
    with pytest.raises(RuntimeError, match="before"):
        sink(messages(spark, "a", "b", "a"), 0)
    sink(messages(spark, "a", "b", "a"), 0)  # the batch is run again
    with pytest.raises(RuntimeError, match="after"):
        sink(messages(spark, "c"), 1)
    assert send_waiting(spark, box, send) == 1 and send_waiting(spark, box, send) == 0
    sink(messages(spark, "c"), 1)  # marked already: nothing is sent
    sink(messages(spark, "d"), 2)
    arrived = spark.read.schema(STORED).parquet(topic)
    assert bodies(arrived) == ["a", "a", "b", "c", "c", "d"]
    assert bodies(read_once(arrived)) == ["a", "a", "b", "c", "d"]
    plain = messages(spark, "x", "x").withColumn("headers", F.lit(None).cast("array<struct<key: string, value: binary>>"))
    assert bodies(read_once(plain)) == ["x", "x"] and outbox._waiting(spark, box) == []
