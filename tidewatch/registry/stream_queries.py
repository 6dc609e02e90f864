"""Streaming ingest over dump files written from the driver data, drained and compared with batch SQL."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..plans import warehouse
from ..session import ensure_checkpoint_dir
from ..sources import dump
from ..streaming import ingest
from ..streaming.store import Store
from .entries import query
from .feeds import Feed, in_parts, object_sql, source_sql, stamp_sql, union
from .report_queries import _QUEUE_ROWS, _T_MATCH, SERVICE_STATUS, TIMED, latest_sql
from .table_queries import SERVICE_CHECK

EV, EV1 = source_sql("ev"), source_sql("ev1")


def _work(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


def _drained(spark, sf_dir, events, parts: int = 3, **more) -> Store:
    """Write records as dump files, one part after the other in arrival order, and ingest a part per micro-batch."""
    work = _work(spark)
    files = spark.sparkContext.defaultParallelism
    for part in in_parts(events, parts, files):
        dump.write_dump(part, f"{work}/in", mode="append")
    run = ingest.start(
        spark, f"{work}/in", f"{work}/out", f"{work}/checkpoint", max_files=files, available_now=True, **more)
    run.awaitTermination()
    return Store(spark, f"{work}/out")


def _fed(spark, work: str, sender: str, events, compression: str = "none") -> Store:
    """Drain records, sent by the instances they name, through an ingest query of their own into a shared store."""
    named = events.withColumn("instance_name", F.concat(F.lit("i"), "instance_id"))
    dump.write_dump(named, f"{work}/{sender}", compression=compression)
    ingest.start(spark, f"{work}/{sender}", f"{work}/out", f"{work}/checkpoint-{sender}", available_now=True).awaitTermination()
    return Store(spark, f"{work}/out")


def _named(store: Store, rows):
    """Rows with the names of their instances."""
    names = F.broadcast(ingest.read_table(store, "instances").select("instance_id", "instance_name"))
    return rows.join(names, "instance_id")


def _moved(feed: Feed) -> Feed:
    return Feed(feed.rec_type, "ev1", feed.order, feed.fields, feed.where, feed.config_type)


@query("stream_service_status", latest_sql(f"""
    SELECT {object_sql(2, 'host', 'svc')} AS service_object_id, inst AS instance_id, {stamp_sql('sec')} AS status_update_time,
    CAST(k % 4 AS SMALLINT) AS current_state, concat(svc, ' is ', k) AS output, value AS execution_time, event_id AS ord
    FROM ({EV1})""", "service_object_id").replace("* EXCLUDE (rn)", "* EXCLUDE (rn, ord)"))
def stream_service_status(spark, sf_dir):
    """Latest service status kept by the ingest stream."""
    store = _drained(spark, sf_dir, _moved(SERVICE_STATUS).records(spark, sf_dir))
    return ingest.read_table(store, "servicestatus").select(
        "service_object_id", "instance_id", "status_update_time", "current_state", "output", "execution_time"
    )


@query("stream_queue", f"""
    WITH r AS (SELECT * FROM ({_QUEUE_ROWS.replace(source_sql('ev'), EV1)}) WHERE op <> 205),
    q AS (SELECT *, max(CASE WHEN op = 202 AND event_type IN (0, 12) THEN run END) OVER (
        PARTITION BY instance_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS purged,
        max(CASE WHEN op <> 200 THEN ord END) OVER (
        PARTITION BY {_T_MATCH} ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS removed FROM r)
    SELECT instance_id, event_type, queued_time, queued_time_usec, scheduled_time, recurring_event, object_id
    FROM q WHERE op = 200 AND removed IS NULL AND (purged IS NULL OR run >= purged)""")
def stream_queue(spark, sf_dir):
    """Event queue kept by the ingest stream."""
    store = _drained(spark, sf_dir, _moved(TIMED).records(spark, sf_dir))
    return ingest.read_table(store, "timedeventqueue").drop("timedeventqueue_id")


# one record of each table with an age, told apart by the event's number: table -> (record type, fields, age in minutes)
_TICK = ("sec", "event_id % 1000000")
_AGED = {
    "timedevents": (201, {1: "200", 4: _TICK, 41: "9", 111: "sec", 53: "host"}, 5760),
    "systemcommands": (203, {1: "401", 4: _TICK, 117: _TICK}, 10080),
    "servicechecks": (206, {1: "701", 4: _TICK, 117: _TICK, 53: "host", 114: "svc"}, 10090),
    "hostchecks": (207, {1: "801", 4: _TICK, 117: _TICK, 53: "host"}, 12345),
    "eventhandlers": (204, {1: "501", 4: _TICK, 117: _TICK, 53: "host"}, 17000),
    "externalcommands": (217, {1: "1400", 4: _TICK, 34: "sec", 15: "svc", 13: "event_id"}, 20000),
    "notifications": (205, {1: "600", 4: _TICK, 117: _TICK, 53: "host"}, 23000),
    "contactnotifications": (220, {1: "602", 4: _TICK, 117: _TICK, 134: "host"}, 26000),
    "contactnotificationmethods": (221, {1: "604", 4: _TICK, 117: _TICK, 134: "host"}, 29000),
    "logentries": (202, {1: "300", 4: _TICK, 73: "sec", 74: "1", 72: "concat(svc, ';', event_id)"}, 32000),
    "acknowledgements": (222, {1: "1700", 4: _TICK, 53: "host"}, 0),
}
_NOW = 1706443200


@query("trim_store", " UNION ALL ".join(f"""
    SELECT '{name}' AS table_name, {stamp_sql('sec')} AS event_time FROM ({EV1})
    WHERE event_id % {len(_AGED)} = {i}{f' AND sec >= {_NOW - age * 60}' if age else ''}"""
    for i, (name, (_, _, age)) in enumerate(_AGED.items())))
def trim_store(spark, sf_dir):
    """All eleven tables with an age, ingested with retention running after every batch; one of them keeps everything."""
    feeds = [
        Feed(kind, "ev1", "event_id", fields, where=f"event_id % {len(_AGED)} = {i}").records(spark, sf_dir)
        for i, (kind, fields, _) in enumerate(_AGED.values())
    ]
    store = _drained(
        spark, sf_dir, union(*feeds), optional=("timedevents",), ages={name: age for name, (_, _, age) in _AGED.items()},
        clock=lambda: datetime.fromtimestamp(_NOW, timezone.utc), trim_seconds=0)
    return union(*(
        ingest.read_table(store, name).select(F.lit(name).alias("table_name"), F.col(warehouse.TABLES[name].date_column).alias("event_time"))
        for name in _AGED
    ))


_NUMBERED_CHECK = Feed(206, "ev", "event_id", {**SERVICE_CHECK.fields, 14: "concat('check ', event_id)"})
_CHECK_SQL = f"""SELECT concat('i', inst) AS instance_name, {stamp_sql('sec')} AS start_time, concat('check ', event_id) AS command_line
    FROM ({EV}) WHERE k % 5 IN (0, 1)"""


@query("stream_two_writers", _CHECK_SQL)
def stream_two_writers(spark, sf_dir):
    """Two ingest queries, each with its own instances and checkpoint, into one store; then one of them starts afresh."""
    events, work = _NUMBERED_CHECK.records(spark, sf_dir), _work(spark)
    odd = events.where("instance_id % 2 = 1")
    _fed(spark, work, "odd", odd)
    store = _fed(spark, work, "even", events.where("instance_id % 2 = 0"))
    ingest.start(spark, f"{work}/odd", f"{work}/out", f"{work}/checkpoint-afresh", available_now=True).awaitTermination()
    return _named(store, ingest.read_table(store, "servicechecks")).select("instance_name", "start_time", "command_line")


@query("stream_replay", _CHECK_SQL + f"""
    UNION ALL SELECT concat('i', inst), {stamp_sql('sec')}, concat('state ', event_id) FROM ({EV}) WHERE k % 10 <> 0""")
def stream_replay(spark, sf_dir):
    """Append tables after every compressed file has been delivered twice, in different batches and sessions."""
    states = Feed(223, "ev", "event_id", {
        1: "CASE WHEN k % 10 = 0 THEN 1800 ELSE 1801 END", 4: ("sec", "usec"), 120: "0", 53: "host", 95: "concat('state ', event_id)"})
    events, work = union(_NUMBERED_CHECK.records(spark, sf_dir), states.records(spark, sf_dir)), _work(spark)
    _fed(spark, work, "first", events, "gzip")
    # other files and sessions of the same records, in chunks of another size
    again = events.withColumn("chunk", F.struct("chunk.file", F.expr("arrival.offset div 3000").cast("bigint").alias("n")))
    store = _fed(spark, work, "again", again, "gzip")
    checks = ingest.read_table(store, "servicechecks").select("instance_id", "start_time", "command_line")
    changes = ingest.read_table(store, "statehistory").select("instance_id", F.col("state_time"), F.col("output"))
    return _named(store, checks.union(changes)).select("instance_name", "start_time", "command_line")


@query("clear_instance_store", latest_sql(f"""
    SELECT inst AS instance_id, {object_sql(2, 'host', 'svc')} AS service_object_id, {stamp_sql('sec')} AS status_update_time,
    concat(svc, ' is ', k) AS output, 0 AS changed_files, event_id AS ord FROM ({EV}) WHERE inst <> 3""", "service_object_id").replace(
        "* EXCLUDE (rn)", "* EXCLUDE (rn, ord)"))
def clear_instance_store(spark, sf_dir):
    """Service status after one instance was cleared in place, with the number of files of the others that changed."""
    store = _fed(spark, _work(spark), "all", SERVICE_STATUS.records(spark, sf_dir))
    before = store.cells("servicestatus")
    store.clear_instance(3)
    after = store.cells("servicestatus")
    changed = sum(after.get(c) != f for c, f in before.items() if not c.startswith("3/"))
    return ingest.read_table(store, "servicestatus").select(
        "instance_id", "service_object_id", "status_update_time", "output", F.lit(changed).alias("changed_files"))


@query("stream_dedup", f"""
    SELECT DISTINCT CAST(1 AS SMALLINT) AS instance_id, {stamp_sql('sec')} AS logentry_time, concat(svc, ';', k) AS logentry_data
    FROM ({EV1})""")
def stream_dedup(spark, sf_dir):
    """Archived lines that come again, in the same or a later micro-batch, are stored once."""
    lines = Feed(100, "ev1", "event_id", {72: "concat('[', sec, '] ', svc, ';', k)"}).records(spark, sf_dir)
    # every line a second time, where the order puts it next to other lines
    last = lines.agg(F.max("arrival.offset")).first()[0] or 0
    again = lines.withColumn("arrival", F.struct(
        "arrival.batch", "arrival.file", (F.lit(last) - F.col("arrival.offset")).alias("offset")))
    store = _drained(spark, sf_dir, lines.unionByName(again))
    return store.history("logentries").select("instance_id", "logentry_time", "logentry_data")
