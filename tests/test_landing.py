from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from parcelflow.sinks import compaction, manifest
from parcelflow.sinks.landing import land
from parcelflow.sources.landed import landed_table
from parcelflow.schema import LANDED_KEYS

SCHEMA = f"n BIGINT, ts TIMESTAMP, {LANDED_KEYS}"


def days(spark, rows=1000, count=4):
    """``rows`` rows; the first day holds most of them, some have no time."""
    day = F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % count).cast("int")
    start = F.lit("2024-02-27 12:00:00").cast("timestamp")
    ts = F.when(F.col("id") % 50 != 49, start + F.make_dt_interval(days=day))
    return spark.range(0, rows, 1, 8).select(F.col("id").alias("n"), ts.alias("ts"))


def files(path):
    return [f for f in path.rglob("*.parquet")]


def test_layout_and_read_back(spark, tmp_path):
    land(days(spark), str(tmp_path), "run-a", 3, "ts")
    assert (tmp_path / "year=2024/month=2/day=27/leaf=run-a-3").is_dir()
    landed = landed_table(spark, str(tmp_path), SCHEMA)
    wrong = landed.filter("year != year(ts) OR month != month(ts) OR day != day(ts)")
    assert landed.count() == 1000 and wrong.count() == 0
    assert landed.filter("year IS NULL").count() == landed.filter("ts IS NULL").count() == 20
    assert all(".snappy." in f.name for f in files(tmp_path))


def test_a_batch_replaces_only_itself(spark, tmp_path):
    for batch_id in (0, 1, 1):
        land(days(spark), str(tmp_path), "run-a", batch_id, "ts")
    landed = landed_table(spark, str(tmp_path), SCHEMA)
    counts = {r.batch_id: r["count"] for r in landed.groupBy("batch_id").count().collect()}
    assert counts == {0: 1000, 1: 1000}


def test_gathering_writes_few_files(spark, tmp_path):
    land(days(spark), str(tmp_path / "gathered"), "r", 0, "ts")
    land(days(spark), str(tmp_path / "loose"), "r", 0, "ts", gather=False)
    assert len(files(tmp_path / "gathered")) == 5 < len(files(tmp_path / "loose"))


def test_a_hot_day_is_divided(spark, tmp_path):
    """Most rows on one day: AQE cuts that day into several tasks."""
    wide = days(spark, 40_000).withColumn("pad", F.sha2(F.col("n").cast("string"), 512))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        land(wide, str(tmp_path), "r", 0, "ts")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(tmp_path / "year=2024/month=2/day=27")) > 3
    assert landed_table(spark, str(tmp_path), SCHEMA).count() == 40_000


def test_file_size_limit(spark, tmp_path):
    land(days(spark).coalesce(1), str(tmp_path), "r", 0, gather=False, time_col="ts",
         max_records_per_file=100)
    assert len(files(tmp_path / "year=2024/month=2/day=27")) > 6


def test_days_are_the_only_folders_listed(spark, tmp_path):
    land(days(spark), str(tmp_path), "r", 0, "ts")
    wanted = [date(2024, 2, 28), date(2024, 2, 29), date(2031, 1, 1)]
    some = landed_table(spark, str(tmp_path), SCHEMA, wanted)
    assert {r.day for r in some.select("day").distinct().collect()} == {28, 29}
    assert all("day=28" in f or "day=29" in f for f in some.inputFiles())
    whole = landed_table(spark, str(tmp_path), SCHEMA).filter("day IN (28, 29)")
    assert sorted(some.collect()) == sorted(whole.collect())


def folding_days(spark, path, batches=3):
    """Rows of three days in some batches of run ``r``."""
    schema = f"id BIGINT, ts TIMESTAMP, {LANDED_KEYS}"
    day = F.make_dt_interval(days=(F.col("id") % 3).cast("int"))
    rows = spark.range(90).select("id", (F.lit("2024-01-01").cast("timestamp") + day).alias("ts"))

    def piece(batch):
        land(rows.filter(F.floor(F.col("id") % 9 / 3) == batch), path, "r", batch, "ts")

    for batch in range(batches):
        piece(batch)

    def ids(**kwargs):
        return sorted(r.id for r in landed_table(spark, path, schema, **kwargs).collect())

    return schema, rows, piece, ids


FIRST = date(2024, 1, 1)


def test_a_crash_while_a_day_is_folded_shows_every_row_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    schema, rows, _, ids = folding_days(spark, path)

    def fail(*_):
        raise RuntimeError("died")

    monkeypatch.setattr(manifest, "exchange", fail)
    with pytest.raises(RuntimeError):
        compaction.compact_days(spark, path, [FIRST], schema)
    assert ids() == list(range(90))
    monkeypatch.undo()
    assert [f.split("/leaf=")[1][:5] for f in compaction.strays(spark, path, [FIRST])] == ["fold-"]
    for n in (1, 1, 2):
        compaction.compact_days(spark, path, [date(2024, 1, n)], schema)
        assert ids() == list(range(90))
    compaction.compact_days(spark, path, [date(2024, 1, n) for n in range(1, 6)], schema)
    assert ids() == list(range(90))
    assert ids(days=[date(2024, 1, 2)]) == list(range(1, 90, 3))
    batches = landed_table(spark, path, schema).select("run", "batch_id").distinct().count()
    assert batches == 3
    land(rows.filter("id = 0"), path, "late", 7, "ts")  # after it was closed, all the same
    assert ids() == [0, *range(90)]
    compaction.compact_days(spark, path, [FIRST], schema)
    assert ids() == [0, *range(90)]


def test_what_lands_while_a_day_is_folded_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    schema, _, piece, ids = folding_days(spark, path, batches=2)
    exchange = manifest.exchange

    def late(*given):
        piece(2)
        return exchange(*given)

    monkeypatch.setattr(manifest, "exchange", late)
    compaction.compact_days(spark, path, [FIRST], schema)
    monkeypatch.undo()
    assert ids() == list(range(90))
    assert len(manifest.live(spark, path, [FIRST])) == 2


def test_a_folded_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path)
    schema, _, piece, ids = folding_days(spark, path)
    compaction.compact_days(spark, path, [FIRST], schema)
    piece(2)
    assert ids() == list(range(90))
    with pytest.raises(ValueError, match="later batches"):
        piece(1)
    assert ids() == list(range(90))


def test_two_folds_of_one_day_leave_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    schema, _, _, ids = folding_days(spark, path)
    exchange = manifest.exchange

    def overtaken(*given):
        monkeypatch.undo()
        compaction.compact_days(spark, path, [FIRST], schema)
        assert not exchange(*given)

    monkeypatch.setattr(manifest, "exchange", overtaken)
    compaction.compact_days(spark, path, [FIRST], schema)
    assert ids() == list(range(90))
    assert len(manifest.live(spark, path, [FIRST])) == 1


def test_a_hundred_folds_leave_a_plan_of_one_scan(spark, tmp_path, monkeypatch):
    """Folders, snapshots and the plan stay few, and folded leaves go when readers are done."""
    monkeypatch.setattr(manifest, "ROLL_AFTER", 40)
    path, schema = str(tmp_path), f"id BIGINT, ts TIMESTAMP, {LANDED_KEYS}"
    rows = spark.range(1).select("id", F.lit("2024-01-01").cast("timestamp").alias("ts"))
    for n in range(100):
        land(rows, path, "r", n, "ts", gather=False)
        compaction.compact_days(spark, path, [FIRST], schema)
    landed = landed_table(spark, path, schema)
    assert landed.count() == 100 and landed.select("batch_id").distinct().count() == 100
    assert len(manifest.live(spark, path)) < 12
    text = landed._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") == 1 and "Union" not in text and "Join" not in text
    assert len(list((tmp_path / "year=2024/month=1/day=1").iterdir())) < 20
    assert len([f for f in (tmp_path / "_snapshots").iterdir() if f.suffix == ".json"]) <= 16
    state = manifest.log(spark, path).read()[1]
    assert state["base"] and len(state["tail"]) + len(state["gone"]) <= 40


def test_times_of_the_manifest_choose_folders(spark, tmp_path):
    path, schema = str(tmp_path), f"id BIGINT, ts TIMESTAMP, {LANDED_KEYS}"
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for n in range(4):
        rows = spark.range(n * 6, n * 6 + 6).select(
            "id", (start + F.make_dt_interval(hours=F.col("id").cast("int") * 3)).alias("ts")
        )
        land(rows, path, "r", n, "ts")
    land(spark.sql("SELECT 99L AS id, CAST(NULL AS TIMESTAMP) AS ts"), path, "none", 0, "ts")

    def ids(**wanted):
        return sorted(r.id for r in landed_table(spark, path, schema, **wanted).collect())

    hour = datetime(2024, 1, 2, 0, tzinfo=timezone.utc)
    assert ids() == [*range(24), 99]
    assert ids(since=hour) == list(range(8, 24))  # batches 0 and 1 each touch two days
    assert ids(until=hour) == list(range(8))
    assert ids(since=datetime(2030, 1, 1)) == []
    manifest.roll(spark, path)
    assert ids(since=hour) == list(range(8, 24)) and ids(days=[FIRST]) == list(range(8))
    assert ids() == [*range(24), 99]


def test_an_empty_batch_lands_nothing(spark, tmp_path):
    land(days(spark).filter("n < 0"), str(tmp_path), "r", 0, "ts")
    assert landed_table(spark, str(tmp_path), SCHEMA).count() == 0
    with pytest.raises(ValueError, match="letters"):
        land(days(spark), str(tmp_path), "a/b", 0, "ts")


def test_files_of_a_batch_are_bounded(spark, tmp_path):
    rows = spark.range(1000, numPartitions=40).select("id", F.lit("2024-01-01").cast("timestamp").alias("processing_timestamp"))
    land(rows, str(tmp_path), "r", 0, files=3)
    assert len(list(tmp_path.rglob("*.parquet"))) <= 3
    assert spark.read.parquet(str(tmp_path)).count() == 1000


def shuffles(spark, monkeypatch, write):
    """The hints by which all that is written meanwhile is moved."""
    given, frame = [], type(spark.range(0))
    hint = frame.hint
    with monkeypatch.context() as patch:
        patch.setattr(frame, "hint", lambda self, name, *keys: given.append(name) or hint(self, name, *keys))
        write()
    return given


def test_a_batch_of_few_days_is_not_moved(spark, tmp_path, monkeypatch):
    one = spark.range(0, 100, 1, 8).selectExpr("id AS n", "timestamp'2024-03-01 10:00:00' AS ts")
    assert shuffles(spark, monkeypatch, lambda: land(one, str(tmp_path / "one"), "r", 0, "ts")) == []
    assert shuffles(spark, monkeypatch, lambda: land(days(spark), str(tmp_path / "many"), "r", 0, "ts")) == ["rebalance"]
    assert landed_table(spark, str(tmp_path / "one"), SCHEMA).count() == 100
    assert not files(tmp_path / "one" / "_staged") and not files(tmp_path / "many" / "_staged")


def test_a_large_day_is_folded_without_moving_its_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    for batch in (0, 1):
        land(days(spark), path, "r", batch, "ts")
    monkeypatch.setattr(compaction, "FILE_ROWS", 500)
    found = [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29)]
    hints = shuffles(spark, monkeypatch, lambda: compaction.compact_days(spark, path, found, SCHEMA))
    landed = landed_table(spark, path, SCHEMA)
    assert landed.count() == 2000 and landed.select("n").distinct().count() == 1000
    assert hints == ["rebalance"]
    folds = [f for f in files(tmp_path) if "leaf=fold" in str(f)]
    assert 1 < len([f for f in folds if "day=27" in str(f)]) <= 3
    assert len([f for f in folds if "day=28" in str(f)]) == 1
    seen = landed.filter("day = 27").select(F.input_file_name().alias("f")).distinct()
    assert all("leaf=fold" in r.f for r in seen.collect())
