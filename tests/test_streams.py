import os
from collections import Counter
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from corpus import envelope, text
from pyspark.sql import functions as F

from parcelflow.operators.summary import SUMMARY, finished_summary, flat_window, windowed_summary
from parcelflow.operators.timecols import (
    EVENT_TIME,
    split_by_trust,
    stamp_record_time,
    watermarked,
)
from parcelflow.settings import SESSION_CONF, Settings
from parcelflow.sinks.landing import landing_sink
from parcelflow.sinks.messages import store
from parcelflow.sinks import messages
from parcelflow.sinks.tables import (
    add_batch,
    latest_per_key,
    published_table,
    replace_table,
    stored_rows,
)
from parcelflow.sources.landed import landed_table
from parcelflow.sources.messages import file_stream
from parcelflow.streaming import job
from parcelflow.streaming.progress import progress_log, progress_table, watch
from parcelflow.streaming.runner import await_any, run_to_end, start_to_console, start_to_sink

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def at(clock: str) -> datetime:
    hours, minutes = map(int, clock.split(":"))
    return DAY + timedelta(hours=hours, minutes=minutes)


def write_files(folder, batches):
    """One file per batch, with file times that pin the order."""
    folder.mkdir()
    for n, clocks in enumerate(batches):
        path = folder / f"{n}.parquet"
        times = pa.array([at(c) for c in clocks], pa.timestamp("us", "UTC"))
        pq.write_table(pa.table({"ts": times}), path)
        os.utime(path, (1_700_000_000 + 10 * n,) * 2)


def emissions(spark, home, mode):
    feed = file_stream(spark, str(home / "in"), "ts TIMESTAMP", 1)
    summary = flat_window(
        windowed_summary(watermarked(feed, "ts"), "ts", {}, [F.count(F.lit(1)).alias("n")])
    )
    out = str(home / mode)
    sink = replace_table(out) if mode == "complete" else add_batch(out)
    run_to_end(start_to_sink(summary, sink, mode, str(home / f"checkpoint-{mode}"), mode))
    if mode == "complete":
        return published_table(spark, out, summary.schema)
    return stored_rows(spark, out, summary.schema)


def by_window(rows):
    return sorted((r.window_start.strftime("%H:%M"), r.n) for r in rows.collect())


D1 = [["10:01"], ["12:00"], ["10:02", "12:01"], ["15:00"]]
D2 = [["10:01"], ["12:00"], ["12:01"], ["10:02", "12:02"], ["15:00"], ["15:01"]]


CASES = [
    (D1, "complete", [("10:00", 2), ("12:00", 2), ("15:00", 1)]),
    (D1, "append", [("10:00", 2), ("12:00", 2)]),
    (D1, "update", [("10:00", 1), ("10:00", 2), ("12:00", 1), ("12:00", 2), ("15:00", 1)]),
    (D2, "complete", [("10:00", 2), ("12:00", 3), ("15:00", 2)]),
    (D2, "append", [("10:00", 1), ("12:00", 3)]),
    (D2, "update", [("10:00", 1), ("12:00", 1), ("12:00", 2), ("12:00", 3),
                    ("15:00", 1), ("15:00", 2)]),
]


@pytest.fixture
def rocksdb(spark):
    spark.conf.set(PROVIDER, SESSION_CONF[PROVIDER])
    yield
    spark.conf.unset(PROVIDER)


@pytest.mark.parametrize("batches, mode, expected", CASES)
def test_late_rows(spark, tmp_path, batches, mode, expected):
    """The row right behind a watermark move still counts; one batch later it is late."""
    write_files(tmp_path / "in", batches)
    assert by_window(emissions(spark, tmp_path, mode)) == expected


@pytest.mark.parametrize("batches, mode, expected", CASES[3:])
def test_late_rows_in_the_job_s_state_store(spark, tmp_path, rocksdb, batches, mode, expected):
    write_files(tmp_path / "in", batches)
    assert by_window(emissions(spark, tmp_path, mode)) == expected


def test_upsert_view_of_update_mode(spark, tmp_path):
    write_files(tmp_path / "in", D1)
    latest = latest_per_key(emissions(spark, tmp_path, "update"), ["window_start", "window_end"])
    assert by_window(latest) == [("10:00", 2), ("12:00", 2), ("15:00", 1)]


def test_restart_resumes_from_the_named_checkpoint(spark, tmp_path):
    write_files(tmp_path / "in", D1[:2])
    emissions(spark, tmp_path, "append")
    path = tmp_path / "in" / "late.parquet"
    times = pa.array([at("12:05"), at("15:00")], pa.timestamp("us", "UTC"))
    pq.write_table(pa.table({"ts": times}), path)
    assert by_window(emissions(spark, tmp_path, "append")) == [("10:00", 1), ("12:00", 2)]


def test_rows_without_any_time_still_reach_a_window(spark):
    rows = stamp_record_time(spark.createDataFrame([(None,), ("x",)], "timestamp STRING"))
    counts = windowed_summary(rows, EVENT_TIME, {}, [F.count(F.lit(1)).alias("n")])
    assert counts.agg(F.sum("n")).collect()[0][0] == 2


def test_window_offset(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:20:00' AS ts")
    summary = windowed_summary(rows, "ts", {}, [F.count(F.lit(1)).alias("n")], offset="10 minutes")
    assert by_window(flat_window(summary)) == [("00:10", 1)]


def test_state_partitions_are_the_query_s_own(spark, tmp_path):
    """Set for the query alone, and kept by its checkpoint."""
    write_files(tmp_path / "in", D1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    feed = file_stream(spark, str(tmp_path / "in"), "ts TIMESTAMP")
    summary = windowed_summary(feed, "ts", {}, [F.count(F.lit(1)).alias("n")])
    sink = replace_table(str(tmp_path / "out"))
    query = start_to_sink(
        flat_window(summary), sink, "s", str(tmp_path / "cp"), "complete", partitions=3
    )
    run_to_end(query)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state = query.lastProgress.stateOperators[0]
    assert state.numShufflePartitions == 3


# The two queries of the job ----------------------------------------------------------


def feed(spark, home):
    values = [text(), text(address__city="Houston"), None, "not json", text(), text()[:200]]
    store(envelope(spark, values).repartition(3), str(home / "in"))
    return file_stream(spark, str(home / "in"), max_files_per_trigger=1)


def local_settings(home, **changes):
    return Settings(
        base_path=str(home), landing_interval=None, analytics_interval=None, **changes
    )


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_job_lands_everything_and_summarises(spark, tmp_path, mode):
    settings = local_settings(tmp_path, analytics_mode=mode)
    landing, analytics = job.start(feed(spark, tmp_path), settings)
    assert (landing.name, analytics.name) == (job.LANDING, job.ANALYTICS)
    run_to_end(landing)
    run_to_end(analytics)
    landed = job.landed(spark, settings)
    assert landed.count() == 6
    assert landed.filter("property_id IS NULL").count() == 3
    assert landed.filter("processing_timestamp IS NULL").count() == 0
    assert landed.filter(
        "year = year(processing_timestamp) AND day = day(processing_timestamp)"
    ).count() == 6
    assert sum(p.numInputRows for p in analytics.recentProgress) == 6
    stored = job.summary_table(spark, settings)
    assert stored.agg(F.sum("listing_count")).first()[0] == 6
    dead = job.dead_letter_table(spark, settings).collect()
    assert sorted((row.offset, row.fault) for row in dead) == [(2, "null"), (3, "not json"), (5, "not json")]
    # Started again, there is nothing left to do.
    for query in job.start(file_stream(spark, str(tmp_path / "in")), settings):
        run_to_end(query)
    assert job.landed(spark, settings).count() == 6


def test_processing_time_summary_counts_damaged_rows_apart(spark, tmp_path):
    partials = job.analytics_rows(feed(spark, tmp_path))
    out = str(tmp_path / "out")
    sink = replace_table(out, finished_summary)
    run_to_end(start_to_sink(partials, sink, "s", str(tmp_path / "cp"), "complete"))
    counts = Counter()
    for row in published_table(spark, out, SUMMARY).collect():
        counts[row.city, row.type] += row.listing_count
        assert (row.avg_price is None) == (row.city is None)
    assert counts == {("Dallas", "House"): 2, ("Houston", "House"): 1, (None, None): 3}


def test_console_output(spark, tmp_path, capsys):
    rows = job.analytics_rows(feed(spark, tmp_path))
    query = run_to_end(
        start_to_console(rows, "shown", str(tmp_path / "cp"), "complete", finish=finished_summary)
    )
    assert query.exception() is None
    shown = capsys.readouterr().out
    assert "Batch 2" in shown and "avg_price_per_sqft" in shown and "566280.0" in shown


def test_the_job_s_console_is_a_query_of_its_own(spark, tmp_path, capsys):
    settings = local_settings(tmp_path, console_rows=5)
    for query in job.start_analytics(feed(spark, tmp_path), settings):
        run_to_end(query)
    assert "avg_price" in capsys.readouterr().out


def test_failure_of_either_query_surfaces(spark, tmp_path):
    rows = feed(spark, tmp_path)

    def broken(batch, batch_id):
        raise ValueError("no disk")

    spark.streams.resetTerminated()
    idle = start_to_sink(
        rows, lambda b, i: None, "idle", str(tmp_path / "cp"), interval="1 hour"
    )
    failing = start_to_sink(rows, broken, "broken", str(tmp_path / "cp"), interval="1 hour")
    with pytest.raises(Exception, match="no disk"):
        await_any(spark, [idle, failing])
    assert not idle.isActive
    spark.streams.resetTerminated()


def test_bad_times_do_not_lead(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES
            (1, '2024-01-01 10:00:00.000000', timestamp'2024-01-05 00:00:00'),
            (2, '2024-01-05 00:59:00.000000', timestamp'2024-01-05 00:00:00'),
            (3, '2024-01-05 01:01:00.000000', timestamp'2024-01-05 00:00:00'),
            (4, '2999-01-01 00:00:00.000000', timestamp'2024-01-05 00:00:00'),
            (5, 'x', timestamp'2024-01-05 00:00:00'), (6, NULL, NULL),
            (7, '2024-01-01 10:00:00.000000', NULL)
        AS t(id, timestamp, sent)""")
    trusted, rest = split_by_trust(rows, "sent")
    assert sorted(r.id for r in trusted.collect()) == [1, 2, 7]
    assert sorted(r.id for r in rest.collect()) == [3, 4, 5, 6]
    assert {r.id: r[EVENT_TIME] == r.sent for r in rest.collect()} == {3: True, 4: True, 5: True, 6: True}


def test_numbers_are_upserted_by_hash(spark):
    rows = spark.sql("SELECT 'k' AS k, 1.5D AS n, 1L AS batch_id")
    plan = latest_per_key(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_progress_outlives_spark_s_own_record(spark, tmp_path):
    rows = feed(spark, tmp_path)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    log = watch(spark, str(tmp_path / "progress"), every=2)
    try:
        runs = []
        for turn in range(2):  # the second with a fresh checkpoint
            sink = add_batch(str(tmp_path / "o"))
            runs.append(run_to_end(start_to_sink(rows, sink, "p", str(tmp_path / f"cp{turn}"))))
            log.settled(runs[-1])
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
        spark.streams.removeListener(log)
    assert len(runs[0].recentProgress) < 3
    lines = progress_log(spark, str(tmp_path / "progress")).collect()
    assert sorted(line.batch_id for line in lines) == [0, 0, 1, 1, 2, 2]
    assert {line.run for line in lines} == {str(run.id) for run in runs}
    assert sum(line.input_rows for line in lines) == 12 and all(line.rows_per_second > 0 for line in lines)
    assert len(list((tmp_path / "progress").rglob("*.json"))) == 4  # two files a run of three batches


def test_of_a_batch_run_again_the_later_line_counts(spark, tmp_path):
    folder = tmp_path / "progress" / "r"
    folder.mkdir(parents=True)
    for n in range(2):
        (folder / f"{n}.json").write_text(
            f'{{"run":"r","batch_id":7,"started":"2024-01-01T00:00:0{n}.000Z","input_rows":{n + 4},"duration_ms":0}}'
        )
    (line,) = progress_log(spark, str(tmp_path / "progress")).collect()
    assert line.input_rows == 5 and line.rows_per_second is None
    assert progress_log(spark, str(tmp_path / "none")).count() == 0


def test_progress(spark, tmp_path):
    query = run_to_end(
        start_to_sink(feed(spark, tmp_path), add_batch(str(tmp_path / "o")), "p", str(tmp_path / "cp"))
    )
    rows = progress_table(spark, query).collect()
    assert [row.batch_id for row in rows] == [0, 1, 2]
    assert sum(row.input_rows for row in rows) == 6
    assert all(row.query == "p" and row.duration_ms > 0 for row in rows)


def test_a_stream_of_messages_is_sent_batch_by_batch(spark, tmp_path, monkeypatch):
    sent = []
    monkeypatch.setattr(
        messages, "send", lambda batch, settings: sent.append((settings.topic, batch.count()))
    )
    rows = feed(spark, tmp_path).select("key", "value", "topic", "partition")
    sink = messages.sender(Settings(topic="t"))
    run_to_end(start_to_sink(rows, sink, "send", str(tmp_path / "cp")))
    assert {topic for topic, _ in sent} == {"t"} and sum(n for _, n in sent) == 6


# Landing ------------------------------------------------------------------------------


def test_retry_after_a_failed_commit_lands_nothing_twice(spark, tmp_path):
    """Processing time too: a retried batch keeps its time, so it meets its own folder."""
    rows = job.landing_rows(feed(spark, tmp_path))
    land = landing_sink(str(tmp_path / "data"))

    def land_and_die(batch, batch_id):
        land(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("died after the write")

    start = dict(name="landing", checkpoint_root=str(tmp_path / "cp"))
    with pytest.raises(Exception, match="died after the write"):
        run_to_end(start_to_sink(rows, land_and_die, **start))
    landed = landed_table(spark, str(tmp_path / "data"))
    before = landed.filter("batch_id = 1").select("processing_timestamp").distinct().collect()
    run_to_end(start_to_sink(rows, land, **start))
    landed = landed_table(spark, str(tmp_path / "data"))
    assert landed.count() == 6
    after = landed.filter("batch_id = 1").select("processing_timestamp").distinct().collect()
    assert before == after


def test_the_run_must_be_named_outside_a_query(spark, tmp_path):
    rows = spark.sql("SELECT 1 AS n, current_timestamp() AS processing_timestamp")
    with pytest.raises(ValueError, match="name the run"):
        landing_sink(str(tmp_path / "data"))(rows, 0)
    landing_sink(str(tmp_path / "data"), run="backfill")(rows, 0)
    assert spark.read.parquet(str(tmp_path / "data")).first().run == "backfill"


def test_a_fresh_checkpoint_does_not_replace_what_was_landed(spark, tmp_path):
    rows = job.landing_rows(feed(spark, tmp_path))
    for n in range(2):
        sink = landing_sink(str(tmp_path / "data"))
        run_to_end(start_to_sink(rows, sink, "landing", str(tmp_path / f"cp{n}")))
    landed = landed_table(spark, str(tmp_path / "data"))
    assert landed.count() == 12
    assert landed.select("run").distinct().count() == 2
