"""Current-state tables: one row per live thing.  Stale records and those before a restart are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, wire
from ..operators import filters
from ..operators.ordered import later_max, live_items
from ..operators.upsert import upsert
from . import history
from .table import Table, event_second, named_id, neb_type, service_id


def _const(value, kind="smallint"):
    return F.lit(value).cast(kind)


_STATUS_HEAD = """
    status_update_time tv 4, output str 95, long_output str 125, perfdata str 99, current_state i16 27,
    has_been_checked i16 51, should_be_scheduled i16 115, current_check_attempt i16 25,
    max_check_attempts i16 76
"""
_STATUS_NOTICE = """
    no_more_notifications i16 85, notifications_enabled i16 88, problem_has_been_acknowledged i16 101,
    acknowledgement_type i16 7, current_notification_number i16 26
"""
_STATUS_FLAP = """
    flap_detection_enabled i16 47, is_flapping i16 54, percent_state_change f64 98, latency f64 71,
    execution_time f64 42, scheduled_downtime_depth i16 113, failure_prediction_enabled i16 45,
    process_performance_data i16 103
"""
_STATUS_TAIL = """
    event_handler str 37, check_command str 11, normal_check_interval f64 86, retry_check_interval f64 109
"""

HOSTSTATUS = Table(
    "hoststatus", (212,), "hoststatus_id =, instance_id =, host_object_id obj1 53," + _STATUS_HEAD + """,
    last_check ts 58, next_check ts 81, check_type i16 12, last_state_change ts 63,
    last_hard_state_change ts 57, last_hard_state i16 56, last_time_up ts 69, last_time_down ts 65,
    last_time_unreachable ts 68, state_type i16 121, last_notification ts 59, next_notification ts 82,
    """ + _STATUS_NOTICE + """, passive_checks_enabled i16 96, active_checks_enabled i16 8,
    event_handler_enabled i16 38,""" + _STATUS_FLAP + """, obsess_over_host i16 91,
    modified_host_attributes i32 78,""" + _STATUS_TAIL + ", check_timeperiod_object_id obj9 162",
    kind="current", gated=True, keys=("host_object_id",),
    id_column="hoststatus_id", id_parts=("host_object_id",),
)

SERVICESTATUS = Table(
    "servicestatus", (213,), "servicestatus_id =, instance_id =, service_object_id =," + _STATUS_HEAD + """,
    last_check ts 61, next_check ts 83, check_type i16 12, last_state_change ts 63,
    last_hard_state_change ts 57, last_hard_state i16 56, last_time_ok ts 66, last_time_warning ts 70,
    last_time_unknown ts 67, last_time_critical ts 64, state_type i16 121, last_notification ts 62,
    next_notification ts 84,
    """ + _STATUS_NOTICE + """, passive_checks_enabled i16 97, active_checks_enabled i16 9,
    event_handler_enabled i16 38,""" + _STATUS_FLAP + """, obsess_over_service i16 93,
    modified_service_attributes i32 80,""" + _STATUS_TAIL + ", check_timeperiod_object_id obj9 209",
    kind="current", gated=True, keys=("service_object_id",),
    given=lambda: {
        "service_object_id": service_id(53, 114),
    },
    id_column="servicestatus_id", id_parts=("service_object_id",),
)

CONTACTSTATUS = Table(
    "contactstatus", (224,), """
    contactstatus_id =, instance_id =, contact_object_id obj10 134, status_update_time tv 4,
    host_notifications_enabled i16 178, service_notifications_enabled i16 225, last_host_notification ts 59,
    last_service_notification ts 62, modified_attributes i32 261, modified_host_attributes i32 78,
    modified_service_attributes i32 80
    """,
    kind="current", gated=True, keys=("contact_object_id",),
    id_column="contactstatus_id", id_parts=("contact_object_id",),
)


def _customvar_object():
    return (
        F.when(F.col("rec_type") == 212, named_id(ids.HOST, 53))
        .when(F.col("rec_type") == 213, service_id(53, 114))
        .otherwise(named_id(ids.CONTACT, 134))
    )


def customvar_items():
    return F.filter(F.transform(wire.attrs(262), wire.split_customvar), lambda item: item.isNotNull())


CUSTOMVARIABLESTATUS = Table(
    "customvariablestatus", (212, 213, 224), """
    customvariablestatus_id =, instance_id =, object_id =, status_update_time tv 4, has_been_modified =,
    varname =, varvalue =
    """,
    kind="current", gated=True, keys=("object_id", "varname"),
    explode=customvar_items,
    given=lambda: {
        "object_id": _customvar_object(),
        "has_been_modified": wire.clamp(F.col("_item.modified"), "smallint"),
        "varname": F.col("_item.name"),
        "varvalue": F.col("_item.value"),
    },
    id_column="customvariablestatus_id", id_parts=("object_id", "varname"),
)


# ---- program status ---------------------------------------------------------------------------
def _program_rows(picked: DataFrame, table: Table) -> DataFrame:
    """Status records, and the shutdowns and restarts that end a program."""
    return table.typed(picked.where((F.col("rec_type") == 211) | neb_type().isin(102, 103)))


def _fold_program(rows: DataFrame, table: Table) -> DataFrame:
    """Status columns from the last record; an end counts when a status row was there to stamp."""
    status = [c for c in table.column_names if c not in ("instance_id", "program_end_time", "is_currently_running")]
    is_end = F.col("op").isNotNull()
    at, end_at = F.when(~is_end, F.col("arrival")), F.when(is_end, F.col("arrival"))
    merged = rows.groupBy("instance_id").agg(
        F.max_by(F.struct(*status), at).alias("_v"),
        F.min(at).alias("_created"),
        F.max(at).alias("_updated"),
        # a stored row carries the end it was stamped with
        F.max_by("program_end_time", F.when(F.col("program_end_time").isNotNull(), F.col("arrival"))).alias("_end_time"),
        F.max(end_at).alias("_end"),
        F.max(F.when(~is_end & F.col("program_end_time").isNotNull(), F.col("arrival"))).alias("_kept"),
        F.max_by("is_currently_running", "arrival").alias("_running"),
    ).where(F.col("_created").isNotNull())
    ended = F.col("_end") > F.col("_created")
    source = {c: F.col(f"_v.{c}") for c in status}
    source["instance_id"] = F.col("instance_id")
    source["program_end_time"] = F.when(ended | F.col("_kept").isNotNull(), F.col("_end_time"))
    source["is_currently_running"] = (
        F.when(ended & (F.col("_end") > F.col("_updated")), 0).otherwise(
            F.when(ended | F.col("_end").isNull(), F.col("_running")).otherwise(1)
        ).cast("smallint")
    )
    return merged.select(
        *[source[c].alias(c) for c in table.column_names],
        F.greatest("_updated", F.when(ended, F.col("_end"))).alias("arrival"),
    )


PROGRAMSTATUS = Table(
    "programstatus", (200, 211), """
    programstatus_id =, instance_id =, status_update_time tv 4, program_start_time ts 106,
    program_end_time =, is_currently_running =, process_id i32 102, daemon_mode i16 28,
    last_command_check ts 55, last_log_rotation ts 60, notifications_enabled i16 88,
    active_service_checks_enabled i16 9, passive_service_checks_enabled i16 97,
    active_host_checks_enabled i16 8, passive_host_checks_enabled i16 96, event_handlers_enabled i16 39,
    flap_detection_enabled i16 47, failure_prediction_enabled i16 45, process_performance_data i16 103,
    obsess_over_hosts i16 92, obsess_over_services i16 94, modified_host_attributes i32 78,
    modified_service_attributes i32 80, global_host_event_handler str 49,
    global_service_event_handler str 50
    """,
    kind="current", gated=True, keys=("instance_id",),
    given=lambda: {
        "program_end_time": F.when(F.col("rec_type") == 200, wire.from_epoch(event_second())),
        "is_currently_running": F.when(F.col("rec_type") == 200, 0).otherwise(1).cast("smallint"),
        "op": F.when(F.col("rec_type") == 200, neb_type()),
    },
    extra=("op",),
    rows_from=_program_rows, finish_with=_fold_program,
    id_column="programstatus_id", id_parts=("instance_id",),
)

RUNTIMEVARIABLES = Table(
    "runtimevariables", (303,), "runtimevariable_id =, instance_id =, varname =, varvalue =",
    kind="current", gated=True, keys=("instance_id", "varname"),
    explode=lambda: F.filter(F.transform(wire.attrs(112), wire.split_var), lambda item: item["name"] != ""),
    given=lambda: {"varname": F.col("_item.name"), "varvalue": F.col("_item.value")},
    id_column="runtimevariable_id", id_parts=("instance_id", "varname"),
)


# ---- comments and downtime --------------------------------------------------------------------
def _fold_comments(rows: DataFrame, table: Table) -> DataFrame:
    first = ["entry_time", "entry_time_usec"]
    last = [c for c in table.column_names if c not in history.COMMENT_KEYS and c not in first]
    return live_items(rows, history.COMMENT_KEYS, [], first, last)


COMMENTS = Table(
    "comments", (208,), "comment_id =, instance_id =," + history.COMMENT_COLUMNS,
    kind="current", gated=True, keys=history.COMMENT_KEYS,
    keep=lambda: neb_type().isin(900, 901, 902),
    given=history.comment_given, extra=("is_delete",),
    finish_with=_fold_comments,
    id_column="comment_id", id_parts=history.COMMENT_KEYS,
)


def _fold_downtime(rows: DataFrame, table: Table) -> DataFrame:
    """Adds that outlive their stops and deletes, stamped by the last start after them.

    Starts and ends name the six match columns, not the unique key, so the fold runs per match with the
    downtime number as item, and the unique key is settled last.
    """
    match = list(history.DOWNTIME_MATCH)
    item = ["internal_downtime_id"]
    values = [
        c for c in table.column_names if c not in match + item and not c.startswith(("was_", "actual_"))
    ]
    stamp = ["was_started", "actual_start_time", "actual_start_time_usec"]
    ops = rows.where(F.col("op") != 1103).withColumn("is_delete", F.col("op").isin(1101, 1104))
    ops = ops.withColumn(
        "internal_downtime_id", F.when(~F.col("is_delete"), F.col("internal_downtime_id"))
    )
    alive = live_items(ops, match, item, stamp, values)
    starts = rows.where(F.col("op") == 1103).groupBy(*match).agg(
        F.max_by(F.struct("op_time", "op_usec"), "arrival").alias("_start"), F.max("arrival").alias("_start_at")
    )
    joined = alive.join(starts, match, "left")
    hit = F.col("_start_at") > F.col("created")
    joined = joined.withColumns({
        "was_started": F.when(hit, 1).otherwise(F.col("was_started")).cast("smallint"),
        "actual_start_time": F.when(hit, F.col("_start.op_time")).otherwise(F.col("actual_start_time")),
        "actual_start_time_usec": F.when(hit, F.col("_start.op_usec")).otherwise(F.col("actual_start_time_usec")),
    })
    return upsert(
        joined.select(*table.column_names, "arrival"), table.keys, keep_order=True
    )


SCHEDULEDDOWNTIME = Table(
    "scheduleddowntime", (209,),
    "scheduleddowntime_id =, instance_id =," + history.DOWNTIME_COLUMNS.replace("DURATION", "i32")
    + ", was_started =, actual_start_time =, actual_start_time_usec =",
    kind="current", gated=True, keys=history.DOWNTIME_KEYS,
    given=lambda: {
        **history.downtime_given(),
        "was_started": _const(0),
        "actual_start_time": F.lit(None).cast("timestamp"),
        "actual_start_time_usec": F.lit(0),
    },
    extra=history.DOWNTIME_OPS,
    finish_with=_fold_downtime,
    id_column="scheduleddowntime_id", id_parts=history.DOWNTIME_KEYS,
)


# ---- event queue ------------------------------------------------------------------------------
def _queue_rows(picked: DataFrame, table: Table) -> DataFrame:
    """Queue operations, plus one purge for the first event of each session."""
    ops = table.typed(picked)
    opened = picked.groupBy("instance_id", "session").agg(
        F.min("arrival").alias("arrival"),
        F.min_by("chunk", "arrival").alias("chunk"),
        F.min_by(event_second(), "arrival").alias("_second"),
    )
    # everything scheduled at or before the first event goes: an exclusive bound one second later
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in ops.schema.fields]
    given = {
        "instance_id": F.col("instance_id"), "session": F.col("session"), "arrival": F.col("arrival"),
        "chunk": F.col("chunk"), "op": F.lit(0), "purge_before": F.col("_second") + 1,
    }
    purges = opened.select(
        *[given[f.name].alias(f.name) if f.name in given else b for f, b in zip(ops.schema.fields, blank)]
    )
    return ops.unionByName(purges)


def _fold_queue(rows: DataFrame, table: Table) -> DataFrame:
    """Adds that no later removal matches and no later purge of the instance reaches.

    The table has no unique key, so equal adds stay side by side.
    """
    order = ["arrival", "_rank"]
    # at the same arrival a session's opening purge comes before the event itself
    ops = rows.withColumn("_rank", F.when(F.col("op") == 0, 0).otherwise(1))
    ops = later_max(ops, "instance_id", F.col("purge_before"), "_purged", order)
    adds_and_removals = ops.where(F.col("op").isin(200, 201, 202))
    removal = F.when(F.col("op") != 200, F.col("arrival"))
    folded = later_max(adds_and_removals, history.TIMED_MATCH, removal, "_removed", order)
    alive = folded.where((F.col("op") == 200) & F.col("_removed").isNull())
    return alive.where(
        F.col("_purged").isNull() | (F.unix_timestamp("scheduled_time") >= F.col("_purged"))
    ).drop("_purged", "_removed", "_rank")


TIMEDEVENTQUEUE = Table(
    "timedeventqueue", (201,), """
    timedeventqueue_id =, instance_id =, event_type i16 41, queued_time tv 4, queued_time_usec us 4,
    scheduled_time ts 111, recurring_event i16 108, object_id =
    """,
    kind="current", gated=True,
    keep=lambda: filters.awake_timed_event(neb_type()),
    given=lambda: {
        "object_id": history.timed_event_object(),
        "op": neb_type(),
        "purge_before": F.when(
            (neb_type() == 202) & wire.code(41).isin(0, 12), F.expr(wire.number_sql(wire.raw_sql(111), "bigint"))
        ),
    },
    extra=("op", "purge_before"),
    rows_from=_queue_rows, finish_with=_fold_queue,
    id_column="timedeventqueue_id",
)

CURRENT = {
    t.name: t
    for t in (
        COMMENTS, CONTACTSTATUS, CUSTOMVARIABLESTATUS, HOSTSTATUS, PROGRAMSTATUS, RUNTIMEVARIABLES,
        SCHEDULEDDOWNTIME, SERVICESTATUS, TIMEDEVENTQUEUE,
    )
}
