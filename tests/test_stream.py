"""The stream ends where the batch build ends, one file per micro-batch."""

import os

from wiretext import dump_file, events_of, record, rows, session

from test_tables import at, comment, downtime, timed
from tidewatch.plans import reports, warehouse
from tidewatch.sources import dump
from tidewatch.streaming import ingest
from tidewatch.streaming.store import Store

FILES = [
    session(
        record(200, (1, 104), at(0)), record(900, (245, "RETAINED"), at(0)), record(402, at(0), (174, "h"), (210, "s")),
        record(213, at(1), (53, "h"), (114, "s"), (27, 1)), record(213, at(1), (53, "h"), (114, "z"), (27, 1)),
        comment(900, 2, 1), comment(900, 3, 2), downtime(1100, 4), downtime(1103, 5), timed(200, 6, 50), timed(200, 7, 60, 5),
        record(205, (1, 600), at(8), (53, "h"), (117, "1700000001.1")), record(220, at(8), (134, "joe"), (117, "1700000001.2")),
        record(211, at(8), (102, 5)), record(206, (1, 701), at(8), (53, "h"), (114, "s"), (117, "1700000001.1")),
    ),
    session(
        record(213, at(9), (53, "h"), (114, "s"), (27, 2)), comment(901, 10, 1), comment(902, 11, 2, text="later"),
        downtime(1100, 12, 2, 200), timed(201, 13, 60, 5), timed(200, 14, 70), record(205, (1, 601), at(8), (53, "h"), (117, "1700000001.1"), (24, 3)),
        record(200, (1, 103), at(15)),
    ),
    session(
        record(213, at(16), (53, "h"), (114, "n"), (27, 3)), downtime(1104, 17), comment(900, 18, 3), record(211, at(19), (102, 6)),
        record(206, (1, 701), at(20), (53, "h"), (114, "s"), (117, "1700000002.1")),
    ),
]
COMPARED = [
    "servicestatus", "comments", "commenthistory", "scheduleddowntime", "downtimehistory", "timedeventqueue", "notifications",
    "contactnotifications", "programstatus", "servicechecks", "services", "processevents",
]


def write(folder, numbers):
    for n in numbers:
        path = dump_file(folder, f"f{n}.dump", FILES[n])
        os.utime(path, (1600000000 + n, 1600000000 + n))


def drain(spark, tmp_path):
    run = ingest.start(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), max_files=1, available_now=True)
    run.awaitTermination()
    return Store(spark, str(tmp_path / "out"))


def test_stream_equals_batch(spark, tmp_path):
    write(tmp_path / "in", [0, 1, 2])
    store = drain(spark, tmp_path)
    # each file opens with a session, whose first timed event purges; batch sees the same sessions
    events = events_of(spark, str(tmp_path / "in")).cache()
    batch = warehouse.build_tables(events, only=COMPARED + ["objects"])
    for name in COMPARED:
        columns = warehouse.TABLES[name].column_names
        assert rows(ingest.read_table(store, name), *columns) == rows(batch[name], *columns), name
    assert rows(ingest.read_table(store, "objects"), "object_id", "is_active") == rows(batch["objects"], "object_id", "is_active")
    assert ingest.read_table(store, "conninfo").count() == 3
    tables = ingest.read_tables(store, ["servicestatus", "services", "objects", "instances"])
    assert rows(reports.report("service_status", tables), "host_name", "service_description", "current_state") == [("h", "s", 2)]

    # running a committed batch again changes nothing
    before = {n: rows(ingest.read_table(store, n), *warehouse.TABLES[n].column_names) for n in COMPARED}
    from tidewatch.sources import dump

    store.writer = store.writer_of(str(tmp_path / "cp"))
    last = store.state()
    ingest.process_batch(store, dump.read_frames(spark, str(tmp_path / "in" / "f2.dump")), 2)
    assert store.state() == last and last.done == {store.writer: 2}
    assert {n: rows(ingest.read_table(store, n), *warehouse.TABLES[n].column_names) for n in COMPARED} == before

    # a new query reads the cutoff once; older status records are dropped, histories are not
    cutoff = ingest.stored_cutoff(store)
    assert cutoff.first().cutoff == 1700000019
    late = session(record(213, at(3), (53, "h"), (114, "s"), (27, 9)), record(213, at(19), (53, "h"), (114, "n"), (27, 7)),
                   record(223, (1, 1801), at(3), (53, "h")))
    dump_file(tmp_path / "in", "f3.dump", late)
    drain(spark, tmp_path)
    assert rows(ingest.read_table(store, "servicestatus"), "current_state") == [(1,), (2,), (7,)]
    assert ingest.read_table(store, "statehistory").count() == 1
    store.drop_old(keep=1)
    assert store.commits() == [4]
    assert rows(ingest.read_table(store, "servicestatus"), "current_state") == [(1,), (2,), (7,)]
    assert ingest.read_table(store, "servicechecks", since="2023-11-15").count() == 0


def status(second, state):
    return record(213, at(second), (53, "h"), (114, "s"), (27, state))


def test_order_of_rotated_files(spark, tmp_path):
    """Numbers in names count as numbers, or the time a file was last written does; ids depend on neither."""
    definition = record(402, at(0), (174, "h"), (210, "s"))
    for name, state, time in (("f2", 1, 30), ("f10", 2, 10), ("f1", 3, 20)):
        path = dump_file(tmp_path / "in", f"{name}.dump", session(definition, status(5, state)))
        os.utime(path, (1600000000 + time, 1600000000 + time))
    found = {}
    for by_time, last in ((False, 2), (True, 1)):
        out = tmp_path / f"out{by_time}"
        run = ingest.start(spark, str(tmp_path / "in"), str(out), f"{out}-cp", available_now=True, by_time=by_time)
        run.awaitTermination()
        status_rows = ingest.read_table(Store(spark, str(out)), "servicestatus")
        assert rows(status_rows, "current_state") == [(last,)]
        decoded = dump.records(dump.read_dump(spark, str(tmp_path / "in"), by_time=by_time)).where("rec_type = 213")
        order = [os.path.basename(r.file) for r in decoded.orderBy("arrival").select("arrival.file").collect()]
        assert order == [f"{n}.dump" for n in (("f10", "f1", "f2") if by_time else ("f1", "f2", "f10"))]
        found[by_time] = rows(decoded, "arrival.file", "arrival.offset")
    assert found[False] == found[True]


def test_file_ranks(spark):
    names = ["a/f1", "a/f1.gz", "a/f02", "a/f2", "a/f2b", "a/f10", "a/f10/x", "a/f9999999999", "a/g", "a1", "a01"]
    ranked = spark.createDataFrame([(n,) for n in names], "file string").withColumn("rank", dump.file_rank("file"))
    got = [r.file for r in ranked.orderBy("rank").collect()]
    assert got == ["a/f1", "a/f1.gz", "a/f02", "a/f2", "a/f2b", "a/f10", "a/f10/x", "a/f9999999999", "a/g", "a01", "a1"]
    assert ranked.select("rank").distinct().count() == len(names)
