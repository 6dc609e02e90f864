"""History tables: what happened, appended or folded by unique key.  Histories are never gated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, wire
from ..operators import filters
from ..operators.ordered import carry_forward, later_max
from ..operators.upsert import upsert
from .table import (
    EVENT, Table, event_second, event_usec, host_or_service, name_of, named_id, neb_attr, neb_type, service_id,
    with_names,
)


def _command(key: int = 127):
    return named_id(ids.COMMAND, key)


def _code(key: int):
    return wire.code(key)


ACKNOWLEDGEMENTS = Table(
    "acknowledgements", (222,), """
    acknowledgement_id =, instance_id =, entry_time tv 4, entry_time_usec us 4, acknowledgement_type i16 7,
    object_id =, state i16 118, author_name str 10, comment_data str 17, is_sticky i16 122,
    persistent_comment i16 100, notify_contacts i16 90
    """,
    keys=("instance_id", "entry_time", "entry_time_usec"),
    given=lambda: {"object_id": host_or_service(_code(7) == 1, _code(7) == 0)},
    id_column="acknowledgement_id", id_parts=("instance_id", "entry_time", "entry_time_usec"),
    date_column="entry_time",
)

STATEHISTORY = Table(
    "statehistory", (223,), """
    statehistory_id =, instance_id =, state_time tv 4, state_time_usec us 4, object_id =,
    state_change i16 119, state i16 118, state_type i16 121, current_check_attempt i16 25,
    max_check_attempts i16 76, last_state =, last_hard_state =, output str 95, long_output str 125
    """,
    keep=lambda: filters.finished_state_change(neb_type()),
    given=lambda: {
        "object_id": host_or_service(_code(120) == 1),
        "last_state": _or_minus_one(265),
        "last_hard_state": _or_minus_one(56),
    },
    id_column="statehistory_id", date_column="state_time",
)


def _or_minus_one(key: int):
    return wire.clamp(F.when(wire.has_attr(key), _code(key)).otherwise(-1), "smallint")


EVENTHANDLERS = Table(
    "eventhandlers", (204,), """
    eventhandler_id =, instance_id =, eventhandler_type =, object_id =, state i16 118, state_type i16 121,
    start_time tv 117, start_time_usec us 117, end_time tv 33, end_time_usec us 33, command_object_id =,
    command_args str 13, command_line str 14, timeout i32 123, early_timeout i16 32,
    execution_time f64 42, return_code i16 110, output str 95, long_output str 125
    """,
    keys=("instance_id", "object_id", "start_time", "start_time_usec"),
    given=lambda: {
        "eventhandler_type": _handler_type(),
        "object_id": host_or_service(_handler_type().isin(1, 3)),
        "command_object_id": _command(),
    },
    id_column="eventhandler_id", id_parts=("instance_id", "object_id", "start_time", "start_time_usec"),
    date_column="start_time",
)


def _handler_type():
    """The sender leaves the type out: then a named service makes it a service handler."""
    guessed = F.when(name_of(114) != "", 1).otherwise(0)
    return F.when(wire.has_attr(40), _code(40)).otherwise(guessed).cast("smallint")


NOTIFICATIONS = Table(
    "notifications", (205,), """
    notification_id =, instance_id =, notification_type i16 89, notification_reason i16 87, object_id =,
    start_time tv 117, start_time_usec us 117, end_time tv 33, end_time_usec us 33, state i16 118,
    output str 95, long_output str 125, escalated i16 36, contacts_notified i16 24
    """,
    keys=("instance_id", "object_id", "start_time", "start_time_usec"),
    given=lambda: {"object_id": host_or_service(_code(89) == 1, _code(89) == 0)},
    id_column="notification_id", id_parts=("instance_id", "object_id", "start_time", "start_time_usec"),
    date_column="start_time",
)


def _started():
    text = wire.raw_sql(117)
    return F.expr(wire.seconds_sql(text)), F.expr(wire.micros_sql(text))


def _notification_id():
    subject = host_or_service(_code(89) == 1, _code(89) == 0)
    return ids.row_id("notifications", "instance_id", subject, *_started())


def _contactnotification_id():
    contact = named_id(ids.CONTACT, 134)
    return ids.row_id("contactnotifications", "instance_id", contact, *_started())


def parent_linkage(records: DataFrame, table: Table, start_type: int, parent_id, child_type: int, column: str) -> DataFrame:
    """Rows of the child records; ``column`` is the id of the last started parent of their session, 0 before the first.

    ``records`` holds parents and children; the session is scanned in arrival order.  Children are typed before the
    rows are shuffled, and of parents only the ids of those that start are: neither text nor other records move.
    """
    child = F.col("rec_type") == child_type
    started = with_names(records.where(~child & (neb_type() == start_type))).select(*EVENT, parent_id.alias("_started"))
    own = [c for c in table.column_names if c not in (column, table.id_column)]
    children = table.typed(records.where(child), own).withColumn("_child", F.lit(True))
    marked = started.withColumn("_child", F.lit(False)).unionByName(children, allowMissingColumns=True)
    # parents come before children of the same arrival, as where the arrival is not known
    linked = carry_forward(marked, "session", F.col("_started"), "_parent", order=("arrival", "_child")).where("_child")
    linked = linked.withColumn(column, F.coalesce("_parent", F.lit(0)))
    return linked.withColumn(table.id_column, table.key_id()).select(*table.column_names, *EVENT)


def _contactnotification_rows(picked: DataFrame, table: Table) -> DataFrame:
    return parent_linkage(picked, table, 600, _notification_id(), 220, "notification_id")


def _method_rows(picked: DataFrame, table: Table) -> DataFrame:
    return parent_linkage(picked, table, 602, _contactnotification_id(), 221, "contactnotification_id")


CONTACTNOTIFICATIONS = Table(
    "contactnotifications", (205, 220), """
    contactnotification_id =, instance_id =, notification_id =, contact_object_id obj10 134,
    start_time tv 117, start_time_usec us 117, end_time tv 33, end_time_usec us 33
    """,
    keys=("instance_id", "contact_object_id", "start_time", "start_time_usec"),
    rows_from=_contactnotification_rows,
    id_column="contactnotification_id",
    id_parts=("instance_id", "contact_object_id", "start_time", "start_time_usec"),
    date_column="start_time",
)

CONTACTNOTIFICATIONMETHODS = Table(
    "contactnotificationmethods", (220, 221), """
    contactnotificationmethod_id =, instance_id =, contactnotification_id =, start_time tv 117,
    start_time_usec us 117, end_time tv 33, end_time_usec us 33, command_object_id =, command_args str 13
    """,
    keys=("instance_id", "contactnotification_id", "start_time", "start_time_usec"),
    given=lambda: {"command_object_id": _command()},
    rows_from=_method_rows,
    id_column="contactnotificationmethod_id",
    id_parts=("instance_id", "contactnotification_id", "start_time", "start_time_usec"),
    date_column="start_time",
)

_CHECK_TAIL = """
    state i16 118, state_type i16 121, start_time tv 117, start_time_usec us 117, end_time tv 33,
    end_time_usec us 33, command_object_id =, command_args str 13, command_line str 14, timeout i32 123,
    early_timeout i16 32, execution_time f64 42, latency f64 71, return_code i16 110, output str 95,
    long_output str 125, perfdata str 99
"""

SERVICECHECKS = Table(
    "servicechecks", (206,), """
    servicecheck_id =, instance_id =, service_object_id =, check_type i16 12, current_check_attempt i16 25,
    max_check_attempts i16 76,""" + _CHECK_TAIL,
    keep=lambda: filters.stored_service_check(neb_type()),
    given=lambda: {
        "service_object_id": service_id(53, 114),
        "command_object_id": _command(),
    },
    id_column="servicecheck_id", date_column="start_time",
)

HOSTCHECKS = Table(
    "hostchecks", (207,), """
    hostcheck_id =, instance_id =, host_object_id obj1 53, check_type i16 12, is_raw_check =,
    current_check_attempt i16 25, max_check_attempts i16 76,""" + _CHECK_TAIL,
    keys=("instance_id", "host_object_id", "start_time", "start_time_usec"),
    insert_only=("command_object_id", "command_args", "command_line"),
    keep=lambda: filters.stored_host_check(neb_type()),
    given=lambda: {"is_raw_check": wire.raw_check_flag(neb_type()), "command_object_id": _command()},
    id_column="hostcheck_id", id_parts=("instance_id", "host_object_id", "start_time", "start_time_usec"),
    date_column="start_time",
)

SYSTEMCOMMANDS = Table(
    "systemcommands", (203,), """
    systemcommand_id =, instance_id =, start_time tv 117, start_time_usec us 117, end_time tv 33,
    end_time_usec us 33, command_line str 14, timeout i32 123, early_timeout i16 32,
    execution_time f64 42, return_code i16 110, output str 95, long_output str 125
    """,
    id_column="systemcommand_id", date_column="start_time",
)

EXTERNALCOMMANDS = Table(
    "externalcommands", (217,), """
    externalcommand_id =, instance_id =, entry_time ts 34, command_type i16 16, command_name str 15,
    command_args str 13
    """,
    keep=lambda: filters.started_external_command(neb_type()),
    id_column="externalcommand_id", date_column="entry_time",
)

FLAPPINGHISTORY = Table(
    "flappinghistory", (210,), """
    flappinghistory_id =, instance_id =, event_time tv 4, event_time_usec us 4, event_type i16 1,
    reason_type i16 3, flapping_type i16 48, object_id =, percent_state_change f64 98,
    low_threshold f64 75, high_threshold f64 52, comment_time ts 19, internal_comment_id i64 18
    """,
    given=lambda: {"object_id": host_or_service(_code(48) == 1, _code(48) == 0)},
    id_column="flappinghistory_id", date_column="event_time",
)

PROCESSEVENTS = Table(
    "processevents", (200,), """
    processevent_id =, instance_id =, event_type i16 1, event_time tv 4, event_time_usec us 4,
    process_id i32 102, program_name str 105, program_version str 107, program_date str 104
    """,
    id_column="processevent_id", date_column="event_time",
)


def _log_rows(picked: DataFrame, table: Table) -> DataFrame:
    """Live log data as sent; archived lines split, malformed ones dropped and those stored or live left out."""
    live = table.typed(picked.where(F.col("rec_type") == 202))
    return live.unionByName(archive_rows(picked.where(F.col("rec_type") == 100), table, stored=live))


def unseen_lines(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Log rows of a batch without the archived lines an earlier batch has stored; live rows all stay."""
    if stored is None:
        return rows
    key = ["instance_id", "logentry_time", "logentry_data"]
    archived = rows.where("realtime_data = 0").join(stored.select(*key), key, "left_anti")
    return rows.where("realtime_data <> 0").unionByName(archived.select(*rows.columns))


def archive_rows(picked: DataFrame, table: Table | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Archived log rows, one per (instance, time, text) that is not stored yet.

    Duplicates are reduced to their first arrival inside each task before the shuffle.
    """
    line = picked.withColumn("_line", wire.log_split(wire.attr(72))).where(F.col("_line").isNotNull())
    first = [F.min(c).alias(c) for c in EVENT if c in picked.columns]
    fresh = line.groupBy("instance_id", F.col("_line.epoch").alias("_epoch"), F.col("_line.text").alias("_text")).agg(
        *first
    )
    when = wire.from_epoch("_epoch")
    out = fresh.select(
        ids.row_id("logentries", "instance_id", "_epoch", "_text").alias("logentry_id"),
        F.col("instance_id"),
        when.alias("logentry_time"),
        when.alias("entry_time"),
        F.lit(0).alias("entry_time_usec"),
        F.lit(0).alias("logentry_type"),
        F.col("_text").alias("logentry_data"),
        F.lit(0).cast("smallint").alias("realtime_data"),
        F.lit(0).cast("smallint").alias("inferred_data_extracted"),
        *[c for c in EVENT if c in picked.columns],
    )
    if stored is None:
        return out
    known = stored.select("instance_id", "logentry_time", "logentry_data")
    return out.join(known, known.columns, "left_anti").select(*out.columns)


LOGENTRIES = Table(
    "logentries", (100, 202), """
    logentry_id =, instance_id =, logentry_time ts 73, entry_time tv 4, entry_time_usec us 4,
    logentry_type i32 74, logentry_data =, realtime_data =, inferred_data_extracted =
    """,
    given=lambda: {
        "logentry_data": F.rtrim(wire.attr(72), F.lit("\n")),
        "realtime_data": F.lit(1).cast("smallint"),
        "inferred_data_extracted": F.lit(1).cast("smallint"),
    },
    rows_from=_log_rows,
    id_column="logentry_id", date_column="entry_time",
)

# ---- comments ---------------------------------------------------------------------------------
COMMENT_COLUMNS = """
    entry_time tv 4, entry_time_usec us 4, comment_type i16 20, entry_type i16 35, object_id =,
    comment_time ts 34, internal_comment_id i64 18, author_name str 10, comment_data str 17,
    is_persistent i16 100, comment_source i16 116, expires i16 44, expiration_time ts 43
"""
COMMENT_KEYS = ("instance_id", "comment_time", "internal_comment_id")


def comment_given():
    return {
        "object_id": host_or_service(_code(20) == 2, _code(20) == 1),
        "is_delete": neb_type() == 901,
    }


def _fold_comment_history(rows: DataFrame, table: Table) -> DataFrame:
    """One aggregate per key: adds are folded, a delete stamps a row that was there before it."""
    stored = [c for c in table.column_names if c not in COMMENT_KEYS and not c.startswith("deletion")]
    first = ["entry_time", "entry_time_usec"]
    added = F.when(~F.col("is_delete"), F.col("arrival"))
    deleted = F.when(F.col("is_delete"), F.col("arrival"))
    merged = rows.groupBy(*COMMENT_KEYS).agg(
        F.min_by(F.struct(*first), added).alias("_first"),
        F.max_by(F.struct(*[c for c in stored if c not in first]), added).alias("_last"),
        F.min(added).alias("_added"),
        F.max_by(F.struct(*first), deleted).alias("_gone"),
        F.max(deleted).alias("_deleted"),
    ).where(F.col("_added").isNotNull())
    gone = F.when(F.col("_deleted") > F.col("_added"), F.col("_gone"))
    source = {c: F.col(f"_first.{c}") if c in first else F.col(f"_last.{c}") for c in stored}
    source.update({c: F.col(c) for c in COMMENT_KEYS})
    source["deletion_time"] = gone["entry_time"]
    source["deletion_time_usec"] = gone["entry_time_usec"]
    return merged.select(*[source[c].alias(c) for c in table.column_names])


COMMENTHISTORY = Table(
    "commenthistory", (208,),
    "commenthistory_id =, instance_id =," + COMMENT_COLUMNS + ", deletion_time =, deletion_time_usec =",
    keys=COMMENT_KEYS, insert_only=("entry_time", "entry_time_usec"),
    keep=lambda: neb_type().isin(900, 901, 902),
    given=lambda: {
        **comment_given(),
        "deletion_time": F.lit(None).cast("timestamp"),
        "deletion_time_usec": F.lit(None).cast("int"),
    },
    extra=("is_delete",),
    finish_with=_fold_comment_history,
    id_column="commenthistory_id", id_parts=COMMENT_KEYS, date_column="comment_time",
)

# ---- downtime ---------------------------------------------------------------------------------
DOWNTIME_COLUMNS = """
    downtime_type i16 30, object_id =, entry_time ts 34, author_name str 10, comment_data str 17,
    internal_downtime_id i64 29, triggered_by_id i64 124, is_fixed i16 46, duration DURATION 31,
    scheduled_start_time ts 117, scheduled_end_time ts 33
"""
DOWNTIME_KEYS = ("instance_id", "object_id", "entry_time", "internal_downtime_id")
# what a start, stop or delete is matched on
DOWNTIME_MATCH = (
    "instance_id", "downtime_type", "object_id", "entry_time", "scheduled_start_time", "scheduled_end_time",
)


def downtime_given():
    return {
        "object_id": host_or_service(_code(30) == 1, _code(30) == 2),
        "op": neb_type(),
        "op_time": wire.from_epoch(event_second()),
        "op_usec": event_usec(),
        "cancelled": wire.cancelled_flag(neb_attr()),
    }


DOWNTIME_OPS = ("op", "op_time", "op_usec", "cancelled")


def _fold_downtime_history(rows: DataFrame, table: Table) -> DataFrame:
    """Adds by unique key; the last start and stop after the add stamp the row.

    Both sides are reduced to one row per key before they meet, so the join carries no hot keys.
    """
    adds = rows.where(F.col("op").isin(1100, 1102))
    values = [
        c for c in table.column_names if c not in DOWNTIME_KEYS and not c.startswith(("was_", "actual_"))
    ]
    adds = adds.groupBy(*DOWNTIME_KEYS).agg(
        F.max_by(F.struct(*values), "arrival").alias("_v"), F.min("arrival").alias("_added")
    ).select(*DOWNTIME_KEYS, "_v.*", "_added")

    def last_of(op: int, *fields):
        at = F.when(F.col("op") == op, F.col("arrival"))
        return F.max_by(F.struct(*fields), at), F.max(at)

    start, start_at = last_of(1103, "op_time", "op_usec")
    stop, stop_at = last_of(1104, "op_time", "op_usec", "cancelled")
    marks = rows.where(F.col("op").isin(1103, 1104)).groupBy(*DOWNTIME_MATCH).agg(
        start.alias("_start"), start_at.alias("_start_at"), stop.alias("_stop"), stop_at.alias("_stop_at")
    )
    joined = adds.join(marks, list(DOWNTIME_MATCH), "left")
    started = F.col("_start_at") > F.col("_added")
    stopped = F.col("_stop_at") > F.col("_added")
    source = {
        "was_started": F.when(started, 1).otherwise(0).cast("smallint"),
        "actual_start_time": F.when(started, F.col("_start.op_time")),
        "actual_start_time_usec": F.when(started, F.col("_start.op_usec")).otherwise(0),
        "actual_end_time": F.when(stopped, F.col("_stop.op_time")),
        "actual_end_time_usec": F.when(stopped, F.col("_stop.op_usec")).otherwise(0),
        "was_cancelled": F.when(stopped, F.col("_stop.cancelled")).otherwise(0).cast("smallint"),
    }
    return joined.select(*[source.get(c, F.col(c)).alias(c) for c in table.column_names])


DOWNTIMEHISTORY = Table(
    "downtimehistory", (209,),
    "downtimehistory_id =, instance_id =," + DOWNTIME_COLUMNS.replace("DURATION", "i32") + """,
    was_started =, actual_start_time =, actual_start_time_usec =, actual_end_time =,
    actual_end_time_usec =, was_cancelled =
    """,
    keys=DOWNTIME_KEYS,
    keep=lambda: neb_type().isin(1100, 1102, 1103, 1104),
    given=lambda: {
        **downtime_given(),
        "was_started": F.lit(0).cast("smallint"),
        "actual_start_time": F.lit(None).cast("timestamp"),
        "actual_start_time_usec": F.lit(0),
        "actual_end_time": F.lit(None).cast("timestamp"),
        "actual_end_time_usec": F.lit(0),
        "was_cancelled": F.lit(0).cast("smallint"),
    },
    extra=DOWNTIME_OPS,
    finish_with=_fold_downtime_history,
    id_column="downtimehistory_id", id_parts=DOWNTIME_KEYS, date_column="entry_time",
)


# ---- timed events -----------------------------------------------------------------------------
def timed_event_object():
    kind = _code(41)
    service = name_of(114) != ""
    downtime = kind == 9
    return host_or_service((kind == 0) | (downtime & service), (kind == 12) | (downtime & ~service))


def timed_given():
    return {
        "object_id": timed_event_object(),
        "queued_time": F.when(neb_type() == 200, wire.from_epoch(event_second())),
        "queued_time_usec": F.when(neb_type() == 200, event_usec()),
        "event_time": F.when(neb_type() == 202, wire.from_epoch(event_second())),
        "event_time_usec": F.when(neb_type() == 202, event_usec()),
        "deletion_time": F.when(neb_type() == 201, wire.from_epoch(event_second())),
        "deletion_time_usec": F.when(neb_type() == 201, event_usec()),
        "op": neb_type(),
    }


TIMED_MATCH = ("instance_id", "event_type", "scheduled_time", "recurring_event", "object_id")


def _fold_timed_events(rows: DataFrame, table: Table) -> DataFrame:
    """Adds and executions are rows; a removal stamps the matching rows that came before it."""
    removal = F.when(F.col("op") == 201, F.struct("arrival", "deletion_time", "deletion_time_usec"))
    stamped = later_max(rows, TIMED_MATCH, removal, "_removed").where(F.col("op") != 201)
    return stamped.withColumns({
        "deletion_time": F.col("_removed.deletion_time"),
        "deletion_time_usec": F.col("_removed.deletion_time_usec"),
    })


TIMEDEVENTS = Table(
    "timedevents", (201,), """
    timedevent_id =, instance_id =, event_type i16 41, queued_time =, queued_time_usec =, event_time =,
    event_time_usec =, scheduled_time ts 111, recurring_event i16 108, object_id =, deletion_time =,
    deletion_time_usec =
    """,
    keep=lambda: neb_type().isin(200, 201, 202),
    given=timed_given, extra=("op",),
    finish_with=_fold_timed_events,
    id_column="timedevent_id", date_column="scheduled_time",
)

HISTORY = {
    t.name: t
    for t in (
        ACKNOWLEDGEMENTS, COMMENTHISTORY, CONTACTNOTIFICATIONMETHODS, CONTACTNOTIFICATIONS, DOWNTIMEHISTORY,
        EVENTHANDLERS, EXTERNALCOMMANDS, FLAPPINGHISTORY, HOSTCHECKS, LOGENTRIES, NOTIFICATIONS,
        PROCESSEVENTS, SERVICECHECKS, STATEHISTORY, SYSTEMCOMMANDS, TIMEDEVENTS,
    )
}
# built only on request: the writer of this table is switched off in the source system
OPTIONAL = ("timedevents",)
