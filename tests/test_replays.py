"""Replays are told by session, and only sessions that repeat some records and bring others are looked at one by one."""

from test_store import check, drain, status
from wiretext import dump_file, rows, session

from tidewatch.streaming import ingest


def test_sessions_that_bring_nothing_new_are_left_out_whole(spark, tmp_path):
    whole = session(check(1), check(1), check(2), status(3, "s", 1))
    dump_file(tmp_path / "in", "1.dump", whole)
    root = tmp_path / "out"
    drain(spark, tmp_path / "in", root, tmp_path / "cp")
    # the same session, one with a later status and known checks, one with known and new checks, and a new one
    mixed = session(check(2), check(1), check(4), check(1), check(1), status(6, "s", 2), start=1700000005)
    dump_file(tmp_path / "in", "2.dump", whole, mixed, session(check(5), start=1700000006))
    store = drain(spark, tmp_path / "in", root, tmp_path / "cp")
    got = rows(ingest.read_table(store, "servicechecks").selectExpr("unix_timestamp(start_time) - 1700000000 AS s"), "s")
    assert got == [(1,), (1,), (1,), (2,), (4,), (5,)]
    assert rows(ingest.read_table(store, "servicestatus"), "current_state") == [(2,)]
    folder = f"{store.root}/decoded/writer={next(iter(store.state().done))}"
    assert rows(spark.read.parquet(f"{folder}/replayed=1"), "session.number", "_mixed") == [(1, False), (2, True)]
    # what the mixed session brings is written once, for all tables
    assert rows(spark.read.parquet(f"{folder}/fresh=1").selectExpr("count(*) AS n"), "n") == [(2,)]


def test_counts_hold_numbers_in_place_of_file_names(spark, tmp_path):
    dump_file(tmp_path / "in", "1.dump", session(check(1), check(2)))
    store = drain(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    stored = store.history(ingest.KEYS)
    assert dict(stored.dtypes) == {"key": "binary", "file_no": "int", "session_no": "bigint", "n": "bigint", "first": "bigint", "instant": "timestamp"}
