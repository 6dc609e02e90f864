"""Several writers, replays, instances cleared in place, touched cells and retention in one store."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from wiretext import dump_file, record, rows, session

from test_tables import at
from tidewatch.plans import warehouse
from tidewatch.sources import dump
from tidewatch.streaming import ingest
from tidewatch.streaming.store import Conflict, Store, on_days

DAY = 86400


def check(second, service="s", state=0):
    return record(206, (1, 701), at(second), (53, "h"), (114, service), (117, f"{1700000000 + second}.0"), (118, state))


def status(second, service, state, host="h"):
    return record(213, at(second), (53, host), (114, service), (27, state))


def drain(spark, source, root, checkpoint, **more):
    ingest.start(spark, str(source), str(root), str(checkpoint), available_now=True, **more).awaitTermination()
    return Store(spark, str(root))


def files(store, table):
    """Data files of a table's cells, with their sizes."""
    out = {}
    for folder, _, names in os.walk(f"{store.root}/current/{table}"):
        out.update({os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n)) for n in names if n.endswith(".parquet")})
    return out


def test_two_writers_share_a_store(spark, tmp_path):
    dump_file(tmp_path / "a", "1.dump", session(check(1), check(2), check(3), status(3, "s", 1), name="east"))
    dump_file(tmp_path / "b", "1.dump", session(check(1, "z"), check(2, "z"), status(2, "z", 2), name="west"))
    root = tmp_path / "out"
    drain(spark, tmp_path / "a", root, tmp_path / "cp_a")
    store = drain(spark, tmp_path / "b", root, tmp_path / "cp_b")
    assert ingest.read_table(store, "servicechecks").count() == 5
    assert sorted(store.state().done.values()) == [0, 0] and store.commits() == [1, 2]
    assert rows(ingest.read_table(store, "instances"), "instance_id", "instance_name") == [(1, "east"), (2, "west")]
    assert rows(ingest.read_table(store, "servicestatus"), "instance_id", "current_state") == [(1, 1), (2, 2)]
    # a new checkpoint reads everything again: no row is lost, and none comes twice
    store = drain(spark, tmp_path / "a", root, tmp_path / "cp_new")
    assert ingest.read_table(store, "servicechecks").count() == 5
    assert len(store.state().done) == 3
    assert ingest.read_table(store, "conninfo").count() == 3  # three connections, all the same


def test_conflicts(spark, tmp_path):
    one, two = (Store(spark, str(tmp_path / "s"), writer=w) for w in ("wa", "wb"))
    table = spark.createDataFrame([(1, 5, "x"), (2, 6, "y")], "instance_id short, k int, v string")
    first = one.state()
    cells = one.save_cells("t", table, 0, ("k",), set())
    one.commit(first, 0, {"t": cells}, [1, 2])
    base = two.state()
    # both start from the same commit; other instances go through, the same ones have to be computed anew
    mine = one.save_cells("t", table.where("instance_id = 1").withColumn("v", F.lit("new")), 1, ("k",), set())
    one.commit(base, 1, {"t": mine}, [1])
    yours = two.save_cells("t", table.where("instance_id = 2").withColumn("v", F.lit("other")), 0, ("k",), set())
    two.commit(base, 0, {"t": yours}, [2])
    assert rows(one.snapshot("t"), "instance_id", "v") == [(1, "new"), (2, "other")]
    with pytest.raises(Conflict):
        two.commit(base, 1, {"t": yours}, [1])
    with pytest.raises(Conflict):
        two.commit(first, 1, {"t": yours}, [9], shared=("t",))
    one.drop_old(keep=1)
    with pytest.raises(Conflict):
        two.commit(first, 1, {}, [9])  # what happened since is forgotten
    assert rows(one.snapshot("t"), "instance_id", "v") == [(1, "new"), (2, "other")]
    assert not two._publish(two._commit_path(3), "taken")


def test_uncommitted_work_does_not_count(spark, tmp_path, monkeypatch):
    path = dump_file(tmp_path / "in", "1.dump", session(check(1), status(1, "s", 1)))
    store = Store(spark, str(tmp_path / "out"), writer="wa")
    commit = Store.commit
    monkeypatch.setattr(Store, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest.process_batch(store, dump.read_frames(spark, path), 0)
    assert store.history("servicechecks") is None and store.snapshot("servicestatus") is None
    monkeypatch.setattr(Store, "commit", commit)
    ingest.process_batch(store, dump.read_frames(spark, path), 0)
    assert store.history("servicechecks").count() == 1 and store.snapshot("servicestatus").count() == 1


def test_replays_are_stored_once(spark, tmp_path):
    twice = session(check(1), check(1), check(2), record(223, (1, 1801), at(2), (53, "h")))
    # sent again whole, sent again after a reconnect with more of the same, and something new that looks alike
    dump_file(tmp_path / "in", "1.dump", twice)
    root = tmp_path / "out"
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    want = ingest.read_table(store, "servicechecks").count()
    assert want == 3
    dump_file(tmp_path / "in", "2.dump", twice)
    dump_file(tmp_path / "in", "3.dump", twice)
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    assert ingest.read_table(store, "servicechecks").count() == 3
    assert ingest.read_table(store, "statehistory").count() == 1
    dump_file(tmp_path / "in", "4.dump", session(check(2), check(1), check(1), check(1), check(3), start=1700000005))
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    assert ingest.read_table(store, "servicechecks").count() == 5  # a third check(1) and check(3)
    plan = store.history("record_keys", days=[datetime(2023, 11, 14).date()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2023-11-14" in plan.split("PartitionFilters")[1]


def test_only_touched_cells_are_written(spark, tmp_path):
    many = session(*(status(1, f"s{i}", 0) for i in range(60)), record(402, at(0), (174, "h"), (210, "s")), name="east")
    dump_file(tmp_path / "in", "1.dump", many, session(status(1, "w", 0, "v"), record(402, at(0), (174, "v"), (210, "w")), name="west"))
    root = tmp_path / "out"
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    before, cells = files(store, "servicestatus"), store.cells("servicestatus")
    assert len(cells) > 10 and ingest.read_table(store, "servicestatus").count() == 61
    dump_file(tmp_path / "in", "2.dump", session(status(2, "s7", 2), name="east"))
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    moved = {c for c, f in store.cells("servicestatus").items() if f != cells.get(c)}
    after = files(store, "servicestatus")
    assert len(moved) == 1 and all(after[f] == t for f, t in before.items())
    assert rows(ingest.read_table(store, "servicestatus").where("current_state = 2"), "output") == [("",)]
    # a restart of one instance empties its cells and no other file
    hosts = files(store, "services")
    dump_file(tmp_path / "in", "3.dump", session(record(200, (1, 104), at(5)), status(6, "new", 1), name="east"))
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    assert rows(ingest.read_table(store, "servicestatus"), "instance_id", "current_state") == [(1, 1), (2, 0)]
    assert rows(ingest.read_table(store, "services"), "instance_id") == [(2,)]
    assert files(store, "services") == hosts
    assert {c.split("/")[0] for c in store.cells("services")} == {"2"}
    active = ingest.read_table(store, "objects").where("is_active = 1")
    assert rows(active, "instance_id", "name1", "name2") == [(2, "v", "w")]


def test_clear_one_instance(spark, tmp_path):
    dump_file(tmp_path / "in", "1.dump", *(session(status(1, "s", n), record(402, at(0), (174, "h"), (210, "s")), name=f"i{n}") for n in range(3)))
    store = drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    before = {t: files(store, t) for t in ("servicestatus", "services")}
    store.writer = "wmaint"
    store.clear_instance(2)
    assert rows(ingest.read_table(store, "servicestatus"), "instance_id") == [(1,), (3,)]
    assert rows(ingest.read_table(store, "services"), "instance_id") == [(1,), (3,)]
    assert {t: files(store, t) for t in before} == before
    active = ingest.read_table(store, "objects").where("is_active = 1").select("instance_id").distinct()
    assert rows(active, "instance_id") == [(1,), (3,)]
    assert ingest.read_table(store, "instances").count() == 3
    store.clear_instance(2)
    assert ingest.read_table(store, "servicestatus").count() == 2


def test_retention_in_the_ingest(spark, tmp_path):
    start = 1700000000  # 2023-11-14 22:13:20
    seconds = [0, 3000, 3 * DAY, 3 * DAY + 9000, 5 * DAY]
    dump_file(tmp_path / "in", "1.dump", session(*(check(s) for s in seconds), record(223, (1, 1801), at(0), (53, "h"))))
    as_of = datetime.fromtimestamp(start + 5 * DAY, timezone.utc)
    clock = lambda: as_of
    ages = {"servicechecks": 2 * 1440 - 60}  # between the two checks of the fourth day
    store = drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp", ages=ages, clock=clock)
    kept = lambda: sorted(r.start_time.timestamp() - start for r in ingest.read_table(store, "servicechecks").collect())
    assert kept() == [3 * DAY + 9000, 5 * DAY]
    assert ingest.read_table(store, "statehistory").count() == 1
    assert ingest.read_trimmed(store, "servicechecks", as_of, ages["servicechecks"]).count() == 2
    # the old day's folder goes as soon as no kept commit reads it
    store.drop_old(keep=1)
    gone = ingest.maintain(store, as_of, ages)["servicechecks"]
    assert any("event_date=2023-11-14" in g for g in gone) and kept() == [3 * DAY + 9000, 5 * DAY]
    # a late batch adds to a day that was made anew
    dump_file(tmp_path / "in", "2.dump", session(check(3 * DAY + 9001), check(1)))
    drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    assert kept() == [3 * DAY + 9000, 3 * DAY + 9001, 5 * DAY]
    assert ingest.maintain(store, as_of, {"servicechecks": 0}) is not None
    assert kept() == [3 * DAY + 9000, 3 * DAY + 9001, 5 * DAY]


def test_closed_days_become_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "DAY_FILES", 2)
    store = Store(spark, str(tmp_path / "out"), writer="wa")
    table = warehouse.TABLES["servicechecks"]
    for batch in range(4):
        path = dump_file(tmp_path / "in", f"{batch}.dump", session(check(batch)))
        ingest.process_batch(store, dump.read_frames(spark, path), batch)
    want = rows(ingest.read_table(store, table.name), *table.column_names)
    assert len(store.stored_days(table.name)["2023-11-14"]) == 4
    as_of = datetime(2023, 11, 18, tzinfo=timezone.utc)
    ingest.maintain(store, as_of)
    assert [w for w, _ in store.stored_days(table.name)["2023-11-14"]] == ["_day"]
    assert rows(ingest.read_table(store, table.name), *table.column_names) == want and len(want) == 4


def test_day_filters(spark):
    days = [datetime(2024, 1, 1).date(), datetime(2024, 3, 1).date()]
    frame = spark.sql("SELECT explode(sequence(DATE'2023-12-30', DATE'2024-03-05')) AS event_date")
    assert frame.where(on_days(days)).count() == 2 and frame.where(on_days([])).count() == 0
    assert frame.where(on_days([d.event_date for d in frame.collect()] * 10)).count() == frame.count()
