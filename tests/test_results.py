"""Result tables: snapshots, epochs of runs, folded emissions."""

import threading

import pytest

from parcelflow.sinks import snapshots, tables
from parcelflow.sinks.snapshots import SnapshotLog
from parcelflow.sinks.tables import (
    add_batch,
    compact,
    forget,
    published_table,
    replace_table,
    result_epochs,
    stored_rows,
    upsert,
    upserted,
)

ROW = "n INT"


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], ROW)


def numbers(frame):
    return sorted(r.n for r in frame.collect())


def test_snapshots_are_numbered_and_cleared(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    assert log.read() == (0, {})
    for n in range(40):
        log.commit(lambda state: ({"n": state.get("n", 0) + 1}, []))
    assert log.read() == (40, {"n": 40, "dropped": []})
    assert log.commit(lambda state: None)["n"] == 40
    assert len([f for f in (tmp_path / "_snapshots").iterdir() if f.suffix == ".json"]) == snapshots.KEPT_SNAPSHOTS


def test_writers_at_once_lose_no_commit(spark, tmp_path):
    def add(name):
        log = SnapshotLog(spark, str(tmp_path))
        for n in range(8):
            log.commit(lambda state: ({"all": [*state.get("all", []), f"{name}{n}"]}, []))

    threads = [threading.Thread(target=add, args=(name,)) for name in "abcd"]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    version, state = SnapshotLog(spark, str(tmp_path)).read()
    assert version == 32 and sorted(state["all"]) == sorted(f"{a}{n}" for a in "abcd" for n in range(8))


def test_readers_see_the_last_whole_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sink = replace_table(path, run="r")
    assert published_table(spark, path, ROW).count() == 0
    for batch in range(8):
        sink(rows(spark, batch), batch)
    assert numbers(published_table(spark, path, ROW)) == [7]
    assert len(list((tmp_path / "t" / "data").iterdir())) <= snapshots.GRACE + 1

    def fail(*_):
        raise RuntimeError("died before the commit")

    monkeypatch.setattr(SnapshotLog, "commit", fail)
    with pytest.raises(RuntimeError, match="died"):
        sink(rows(spark, 9), 8)
    monkeypatch.undo()
    assert numbers(published_table(spark, path, ROW)) == [7]
    sink(rows(spark, 8), 8)  # the batch is run again
    sink(rows(spark, 8), 8)
    sink(rows(spark, 3), 3)  # and one that has been overtaken
    assert numbers(published_table(spark, path, ROW)) == [8]


def test_a_reader_keeps_the_state_it_began_with(spark, tmp_path):
    sink = replace_table(str(tmp_path), run="r")
    sink(rows(spark, 1, 2), 0)
    before = published_table(spark, str(tmp_path), ROW)
    sink(rows(spark, 3), 1)
    assert numbers(before) == [1, 2] and numbers(published_table(spark, str(tmp_path), ROW)) == [3]


def test_added_batches_replace_only_themselves(spark, tmp_path):
    sink = add_batch(str(tmp_path), run="r")
    for batch, value in ((0, 1), (1, 2), (1, 3)):
        sink(rows(spark, value), batch)
    assert sorted(map(tuple, stored_rows(spark, str(tmp_path), ROW).collect())) == [(1, 0), (3, 1)]


@pytest.mark.parametrize("kind", [replace_table, add_batch, upsert])
def test_a_fresh_run_starts_a_new_result(spark, tmp_path, kind):
    path = str(tmp_path)
    for batch in range(3):
        kind(path, run="old")(rows(spark, batch), batch)
    if kind is upsert:
        compact(spark, path, ["n"], rows(spark, 0).schema)
    kind(path, run="new")(rows(spark, 9), 0)
    assert numbers(published_table(spark, path, ROW)) == [9]
    kind(path, run="old")(rows(spark, 7), 3)  # the old query is still about
    assert numbers(published_table(spark, path, ROW)) == [9]
    assert result_epochs(spark, path) == [(1, "old", 3), (2, "new", 0)]
    assert 7 in numbers(published_table(spark, path, ROW, epoch=1))
    forget(spark, path, before=2)
    assert result_epochs(spark, path) == [(2, "new", 0)]
    assert numbers(published_table(spark, path, ROW)) == [9]


def test_folded_emissions_read_the_same(spark, tmp_path):
    path = str(tmp_path)
    sink = upsert(path, run="r")
    schema = spark.sql("SELECT 'k' AS k, 1 AS n, 'x' AS s").schema
    want = {}
    for batch in range(5):
        made = [(f"k{i}", batch, f"s{batch}") for i in range(batch, 5)]
        want |= {k: (n, s) for k, n, s in made}
        sink(spark.createDataFrame(made, schema), batch)
        if batch in (1, 3):
            compact(spark, path, ["k"], schema, batch)
            compact(spark, path, ["k"], schema, batch)
            sink(spark.createDataFrame(made, schema), batch)  # run again after it was folded
        got = upserted(spark, path, ["k"], schema).collect()
        assert {r.k: (r.n, r.s) for r in got} == want and len(got) == len(want)
    assert len(tables._newest_entries(spark, path)) == 2


def test_what_arrives_while_emissions_are_folded_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    schema = spark.sql("SELECT 'k' AS k, 1 AS n").schema
    sink = upsert(path, run="r")
    for batch in range(2):
        sink(spark.createDataFrame([("a", batch)], schema), batch)
    commit = SnapshotLog.commit

    def late(self, change):
        monkeypatch.undo()
        sink(spark.createDataFrame([("a", 5), ("b", 5)], schema), 2)
        return commit(self, change)

    monkeypatch.setattr(SnapshotLog, "commit", late)
    compact(spark, path, ["k"], schema)
    assert {r.k: r.n for r in upserted(spark, path, ["k"], schema).collect()} == {"a": 5, "b": 5}


def test_a_sink_with_keys_folds_by_itself(spark, tmp_path):
    sink = upsert(str(tmp_path), ["n"], run="r", fold_after=4)
    schema = rows(spark, 0).schema
    for batch in range(20):
        sink(rows(spark, batch % 3), batch)
        assert len(tables._newest_entries(spark, str(tmp_path))) <= 5
    found = upserted(spark, str(tmp_path), ["n"], schema)
    assert numbers(found) == [0, 1, 2]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_sides_of_several_batches_are_one_table(spark, tmp_path):
    schema = "n INT, violations ARRAY<STRING>"
    sink = tables.split_sink(str(tmp_path), run="r")
    for batch in range(3):
        sink(spark.createDataFrame([(batch, []), (batch + 10, ["city_known"])], schema), batch)
    found = published_table(spark, str(tmp_path), f"{schema}, side STRING")
    assert {r.side: sorted(x.n for x in found.filter(found.side == r.side).collect()) for r in found.collect()} == {
        "valid": [0, 1, 2], "quarantined": [10, 11, 12]
    }
