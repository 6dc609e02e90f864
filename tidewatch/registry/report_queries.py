"""The 33 reports over tables built from the driver data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dimensions
from ..plans import reports, warehouse
from ..plans.table import Context
from ..steps import Steps
from . import feeds
from .entries import query
from .feeds import INSTANCES_SQL, Feed, arrival_sql, object_sql, row_sql, stamp_sql, union

TV = ("sec", "usec")
SUBJECT = "CASE WHEN k % 2 = 1 THEN svc ELSE '' END"
AS_OF_SEC = 1705320000  # 2024-01-15 12:00:00


def tables_for(spark, sf_dir, events, names, report=None):
    out = {n: warehouse.TABLES[n].build(events, Context(), reports.used(report, n)) for n in names}
    rec_types = {t for n in names for t in warehouse.TABLES[n].rec_types}
    out["objects"] = dimensions.build_objects(events, rec_types=rec_types, kinds=reports.KINDS.get(report))
    out["instances"] = feeds.instances(spark, sf_dir)
    return out


def tables_in_steps(spark, sf_dir, events, names, report, steps):
    """The tables of :func:`tables_for`, each saved as a step, and so are the records and the rows that are folded."""
    tables = {n: warehouse.TABLES[n] for n in names}
    rec_types = {t for table in tables.values() for t in table.rec_types}
    events = steps.saved("events", events.where(F.col("rec_type").isin(*sorted(rec_types))))
    objects = dimensions.build_objects(events, rec_types=rec_types, kinds=reports.KINDS.get(report))
    out = {"objects": steps.saved("objects", objects), "instances": feeds.instances(spark, sf_dir)}
    rows = {}
    for n, table in tables.items():
        if table.late:
            out[n] = steps.saved(n, table.build(events, Context(), reports.used(report, n)))
        else:
            rows[n] = steps.saved(f"{n}-rows", table.rows(events, Context()))
    steps.drop("events")
    for n in rows:
        out[n] = steps.saved(n, tables[n].finish(rows[n]))
        steps.drop(f"{n}-rows")
    return out


def _columns(table: str) -> list[str]:
    return warehouse.TABLES[table].column_names


def object_report_sql(rows: str, table: str, name: str) -> str:
    """Oracle of an object report: ``rows`` has the table's columns plus otype, host, svc_name."""
    spec = reports.OBJECT_REPORTS[name]
    listed = list(spec.columns or _columns(table))
    head = ["t.instance_id", "i.instance_name"]
    if spec.object_alias != "object_id":
        head.append(f"t.object_id AS {spec.object_alias}")
    else:
        head.append("t.object_id")
    if spec.objecttype is None:
        head.append("CAST(otype AS SMALLINT) AS objecttype_id")
    head.append("host AS host_name")
    if spec.objecttype != 1:
        head.append("nullif(svc_name, '') AS service_description")
    taken = {"instance_id"} | ({"object_id"} if spec.object_alias == "object_id" else set())
    body = [f"t.{c}" for c in listed if c not in taken]
    where = "" if spec.objecttype is None else f" WHERE otype = {spec.objecttype}"
    return (
        f"SELECT {', '.join(head + body)} FROM ({rows}) t LEFT JOIN ({INSTANCES_SQL}) i "
        f"ON t.instance_id = i.instance_id{where}"
    )


def latest_sql(rows: str, keys: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ord DESC) AS rn "
        f"FROM ({rows})) WHERE rn = 1"
    )


def register_object_reports(names, table, make_events, rows_sql, extra_tables=()):
    for name in names:
        def run(spark, sf_dir, name=name):
            events = make_events(spark, sf_dir)
            tables = tables_for(spark, sf_dir, events, (table, *extra_tables), name)
            return reports.report(name, tables, as_of=F.timestamp_seconds(F.lit(AS_OF_SEC)))

        run.__doc__ = f"Report {name} over {table}."
        query(name, object_report_sql(rows_sql, table, name))(run)


# ---- state history ----------------------------------------------------------------------------
STATE = Feed(223, "ev", "event_id", {
    1: "CASE WHEN k % 10 = 0 THEN 1800 ELSE 1801 END", 4: TV, 120: "k % 2", 53: "host", 114: SUBJECT,
    119: "1", 118: "k % 4", 121: "k % 3 % 2", 25: "k % 5 + 1", 76: "5", 265: "(k + 1) % 4",
    95: "concat('state ', svc)", 125: "concat(svc, chr(10), chr(9), chr(92), 'n')",
})
_STATE_ROWS = STATE.typed_sql(
    warehouse.TABLES["statehistory"].layout,
    {
        "statehistory_id": arrival_sql("statehistory", "event_id"), "instance_id": "inst",
        "object_id": f"CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END",
        "last_state": "CAST((k + 1) % 4 AS SMALLINT)", "last_hard_state": "CAST(-1 AS SMALLINT)",
    },
    f"CASE WHEN k % 2 = 1 THEN 2 ELSE 1 END AS otype, host, {SUBJECT} AS svc_name, k",
)
register_object_reports(
    ("state_history", "host_state_history", "service_state_history"), "statehistory", STATE.records,
    f"SELECT * FROM ({_STATE_ROWS}) WHERE k % 10 <> 0",
)

# ---- event handlers: a start and an end record share one row ------------------------------------
def _handler(op, order, code):
    return Feed(204, "ev", order, {
        1: str(op), 4: TV, 53: "host", 114: SUBJECT, 118: "k % 4", 121: "k % 2", 117: TV,
        33: ("sec + 1", "usec"), 127: "concat('handle_', svc)", 13: "concat('a', k, '!b')", 14: "concat('/bin/', svc)",
        42: "value", 110: code, 95: "svc",
    })


HANDLER_START, HANDLER_END = _handler(500, "event_id * 2", "0"), _handler(501, "event_id * 2 + 1", "k % 3")
register_object_reports(
    ("event_handlers", "host_event_handlers", "service_event_handlers"), "eventhandlers",
    lambda spark, d: union(HANDLER_START.records(spark, d), HANDLER_END.records(spark, d)),
    HANDLER_END.typed_sql(
        warehouse.TABLES["eventhandlers"].layout,
        {
            "eventhandler_id": row_sql(
                "eventhandlers", "inst",
                f"CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END",
                "sec", "usec",
            ),
            "instance_id": "inst", "eventhandler_type": "CAST(k % 2 AS SMALLINT)",
            "object_id": f"CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END",
            "command_object_id": object_sql(12, "concat('handle_', svc)"),
        },
        f"1 + k % 2 AS otype, host, {SUBJECT} AS svc_name",
    ),
)

# ---- flapping ---------------------------------------------------------------------------------
FLAPPING = Feed(210, "ev", "event_id", {
    1: "1000 + k % 3 % 2", 3: "k % 3", 4: TV, 48: "k % 2", 53: "host", 114: SUBJECT, 98: "value", 52: "50.5",
    75: "20.25", 19: "sec - 5", 18: "k",
})
register_object_reports(
    ("flapping_history", "host_flapping_history", "service_flapping_history"), "flappinghistory",
    FLAPPING.records,
    FLAPPING.typed_sql(
        warehouse.TABLES["flappinghistory"].layout,
        {
            "flappinghistory_id": arrival_sql("flappinghistory", "event_id"), "instance_id": "inst",
            "object_id": f"CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END",
        },
        f"1 + k % 2 AS otype, host, {SUBJECT} AS svc_name",
    ),
)

# ---- notifications: orders start and end, line items notify contacts ----------------------------
_PRIORITY = "CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority ELSE '' END"
_ORDER_TIME = ("sec", "o_orderkey % 1000000")


# the records of 8192 orders make a chunk
_ORDERS = 8192 * 10000000000


def _notification(op, order, told):
    return Feed(205, "ord", order, {
        1: str(op), 4: _ORDER_TIME, 89: "o_orderkey % 2", 117: _ORDER_TIME, 33: ("sec + 60", "o_orderkey % 1000000"),
        53: "host", 114: _PRIORITY, 87: "o_orderkey % 8", 118: "o_orderkey % 3", 95: "o_orderstatus",
        125: "concat('total ', o_orderstatus, ' = ', o_orderkey)", 36: "o_orderkey % 5 % 2", 24: told,
    }, chunk=_ORDERS)


NOTIFY_START = _notification(600, "o_orderkey * 10000000000", "0")
NOTIFY_END = _notification(601, "o_orderkey * 10000000000 + 9999999999", "o_orderkey % 7")
_SUBJECT_ID = (
    f"CASE WHEN o_orderkey % 2 = 1 THEN {object_sql(2, 'host', 'o_orderpriority')} ELSE {object_sql(1, 'host')} END"
)


def _notification_row(sec):
    return row_sql("notifications", "inst", _SUBJECT_ID, sec, "o_orderkey % 1000000")


def notification_events(spark, d):
    return union(NOTIFY_START.records(spark, d), NOTIFY_END.records(spark, d))


_NOTIFICATION_ROWS = latest_sql(
    NOTIFY_END.typed_sql(
        warehouse.TABLES["notifications"].layout,
        {"notification_id": _notification_row("sec"), "instance_id": "inst", "object_id": _SUBJECT_ID},
        f"1 + o_orderkey % 2 AS otype, host, {_PRIORITY} AS svc_name",
    ),
    "instance_id, object_id, start_time, start_time_usec",
)
register_object_reports(
    ("notifications", "host_notifications", "service_notifications"), "notifications", notification_events,
    _NOTIFICATION_ROWS,
)

_LINE_ORDER = "o_orderkey * 10000000000 + 1000 + (l_partkey * 10 + l_linenumber) * 10"
_LINE_TIME = ("sec", "l_partkey % 1000000")
CONTACTED = Feed(220, "line", _LINE_ORDER, {
    1: "602", 4: _LINE_TIME, 117: _LINE_TIME, 33: ("sec + 1", "l_linenumber"), 53: "host", 134: "contact",
}, chunk=_ORDERS)
METHOD = Feed(221, "line", f"{_LINE_ORDER} + 1", {
    1: "604", 4: _LINE_TIME, 117: _LINE_TIME, 33: ("sec + 2", "l_linenumber"), 53: "host", 134: "contact",
    127: "concat('notify_by_', l_linenumber)", 13: "concat('x!', l_partkey)",
}, chunk=_ORDERS)


def contact_events(spark, d):
    return union(notification_events(spark, d), CONTACTED.records(spark, d), METHOD.records(spark, d))


_CONTACT_ID = object_sql(10, "contact")
_CN_ID = row_sql("contactnotifications", "inst", _CONTACT_ID, "sec", "l_partkey % 1000000")
_CN_ROWS = latest_sql(
    CONTACTED.typed_sql(
        warehouse.TABLES["contactnotifications"].layout,
        {"contactnotification_id": _CN_ID, "instance_id": "inst", "notification_id": _notification_row("order_sec")},
        f"{_SUBJECT_ID} AS object_id, 1 + o_orderkey % 2 AS otype, host, {_PRIORITY} AS svc_name, contact",
    ),
    "instance_id, contact_object_id, start_time, start_time_usec",
)
_NAMED = "t.object_id, CAST(t.otype AS SMALLINT) AS objecttype_id, t.host AS host_name, nullif(t.svc_name, '') AS service_description, t.contact AS contact_name"


@query("contact_notifications", f"""
    SELECT t.instance_id, i.instance_name, {_NAMED}, t.contactnotification_id, t.notification_id,
           t.contact_object_id, t.start_time, t.start_time_usec, t.end_time, t.end_time_usec
    FROM ({_CN_ROWS}) t LEFT JOIN ({INSTANCES_SQL}) i ON t.instance_id = i.instance_id""")
def contact_notifications(spark, sf_dir):
    """Contact notifications with the notification they belong to."""
    steps = Steps(spark)
    tables = tables_in_steps(
        spark, sf_dir, contact_events(spark, sf_dir), ("notifications", "contactnotifications"), "contact_notifications", steps)
    return reports.report("contact_notifications", tables, steps=steps)


_METHOD_ROWS = latest_sql(
    METHOD.typed_sql(
        warehouse.TABLES["contactnotificationmethods"].layout,
        {
            "contactnotificationmethod_id": row_sql(
                "contactnotificationmethods", "inst", _CN_ID, "sec", "l_partkey % 1000000"),
            "instance_id": "inst", "contactnotification_id": _CN_ID,
            "command_object_id": object_sql(12, "concat('notify_by_', l_linenumber)"),
        },
        "concat('notify_by_', l_linenumber) AS command",
    ),
    "instance_id, contactnotification_id, start_time, start_time_usec",
)


@query("contact_notification_methods", f"""
    SELECT t.instance_id, i.instance_name, {_NAMED}, t.start_time AS notification_start_time,
           t.start_time_usec AS notification_start_time_usec, t.end_time AS notification_end_time,
           t.end_time_usec AS notification_end_time_usec, m.command AS notification_command_name,
           m.contactnotificationmethod_id, m.contactnotification_id, m.start_time, m.start_time_usec,
           m.end_time, m.end_time_usec, m.command_object_id, m.command_args
    FROM ({_METHOD_ROWS}) m JOIN ({_CN_ROWS}) t ON m.contactnotification_id = t.contactnotification_id
    LEFT JOIN ({INSTANCES_SQL}) i ON t.instance_id = i.instance_id""")
def contact_notification_methods(spark, sf_dir):
    """How each contact was notified."""
    steps = Steps(spark)
    tables = tables_in_steps(
        spark, sf_dir, contact_events(spark, sf_dir), ("notifications", "contactnotifications", "contactnotificationmethods"),
        "contact_notification_methods", steps)
    return reports.report("contact_notification_methods", tables, steps=steps)


# ---- comments: events add, load and delete ------------------------------------------------------
_COMMENT_SVC = "CASE WHEN user_id % 2 = 1 THEN concat('svc', k % 10) ELSE '' END"
COMMENT = Feed(208, "ev", "event_id", {
    1: "CASE svc WHEN 'error' THEN 901 WHEN 'purchase' THEN 901 WHEN 'signup' THEN 902 ELSE 900 END",
    4: TV, 20: "1 + user_id % 2", 53: "host", 114: _COMMENT_SVC, 34: "1700000000 + user_id", 10: "concat('author ', k)",
    17: "concat('note', chr(9), svc, ' ', k)", 100: "k % 2", 116: "k % 3", 35: "1 + k % 4", 44: "k % 2", 43: "sec + 60",
    18: "k % 10",
})
_COMMENT_OBJECT = (
    f"CASE WHEN user_id % 2 = 1 THEN {object_sql(2, 'host', _COMMENT_SVC)} ELSE {object_sql(1, 'host')} END"
)
_COMMENT_KEY = "instance_id, comment_time, internal_comment_id"


def _comment_sql(table, id_column, deletes):
    rows = COMMENT.typed_sql(
        warehouse.TABLES[table].layout,
        {
            id_column: row_sql(table, "inst", "1700000000 + user_id", "k % 10"), "instance_id": "inst",
            "object_id": _COMMENT_OBJECT, "deletion_time": "CAST(NULL AS TIMESTAMP)",
            "deletion_time_usec": "CAST(NULL AS INTEGER)",
        },
        f"1 + user_id % 2 AS otype, host, {_COMMENT_SVC} AS svc_name, svc IN ('error', 'purchase') AS gone",
    )
    part = f"PARTITION BY {_COMMENT_KEY}"
    if deletes:
        return f"""
        WITH r AS (SELECT *, min(CASE WHEN NOT gone THEN ord END) OVER ({part}) AS first_ord,
                          max(CASE WHEN NOT gone THEN ord END) OVER ({part}) AS last_ord,
                          max(CASE WHEN gone THEN ord END) OVER ({part}) AS del_ord FROM ({rows}))
        SELECT l.* REPLACE (f.entry_time AS entry_time, f.entry_time_usec AS entry_time_usec,
                 CASE WHEN l.del_ord > l.first_ord THEN d.entry_time END AS deletion_time,
                 CASE WHEN l.del_ord > l.first_ord THEN d.entry_time_usec END AS deletion_time_usec)
        FROM r l JOIN r f ON f.ord = l.first_ord LEFT JOIN r d ON d.ord = l.del_ord
        WHERE l.ord = l.last_ord"""
    return f"""
        WITH r AS (SELECT *, coalesce(max(CASE WHEN gone THEN ord END) OVER ({part}), -1) AS del_ord FROM ({rows})),
        a AS (SELECT *, min(ord) OVER ({part}) AS first_ord, max(ord) OVER ({part}) AS last_ord
              FROM r WHERE NOT gone AND ord > del_ord)
        SELECT l.* REPLACE (f.entry_time AS entry_time, f.entry_time_usec AS entry_time_usec)
        FROM a l JOIN a f ON f.ord = l.first_ord WHERE l.ord = l.last_ord"""


register_object_reports(
    ("comment_history",), "commenthistory", COMMENT.records, _comment_sql("commenthistory", "commenthistory_id", True)
)
register_object_reports(
    ("comments", "host_comments", "service_comments"), "comments", COMMENT.records,
    _comment_sql("comments", "comment_id", False),
)

# ---- downtime: every order schedules one, its status says what became of it ---------------------
_DOWN_SVC = "CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority ELSE '' END"


# step of an order's story -> (operation, condition, second, author)
DOWN_STEPS = {
    -1: (1101, "o_orderkey % 11 = 0", "sec", "'ops'"),  # a delete before the add has no effect
    0: (1100, "TRUE", "sec", "'ops'"),
    3: (1103, "o_orderstatus IN ('F', 'P')", "sec + 3601", "'ops'"),
    5: (1102, "o_orderkey % 5 = 0", "sec + 3700", "'reloaded'"),
    6: (1104, "o_orderstatus = 'P'", "sec + 7201", "'ops'"),
    7: (1101, "o_orderstatus = 'O' AND o_orderkey % 7 = 0", "sec", "'ops'"),
}


def _by_step(part: int) -> str:
    return "CASE step " + " ".join(f"WHEN {step} THEN {parts[part]}" for step, parts in DOWN_STEPS.items()) + " END"


def _downtime(op, order, where, sec, author):
    return Feed(209, "ord", order, {
        1: str(op), 3: "1 + o_orderkey % 3 % 2", 4: (sec, "o_orderkey % 1000000"), 30: "2 - o_orderkey % 2", 53: "host",
        114: _DOWN_SVC, 34: "sec", 10: author, 17: "concat('order ', o_orderkey)", 117: "sec + 3600 + o_orderkey",
        33: "sec + 7200 + o_orderkey", 46: "1", 31: "3600", 124: "o_orderkey % 4", 29: "o_orderkey",
    }, where)


_DOWN_OBJECT = (
    f"CASE WHEN o_orderkey % 2 = 1 THEN {object_sql(2, 'host', 'o_orderpriority')} ELSE {object_sql(1, 'host')} END"
)


def downtime_events(spark, d):
    steps = F.explode(F.array(*[F.lit(step) for step in DOWN_STEPS])).alias("step")
    told = feeds.source(spark, d, "ord").select("*", steps)
    return _downtime(_by_step(0), "o_orderkey * 10 + step", _by_step(1), _by_step(2), _by_step(3)).over(told)


def _downtime_sql(table, id_column, where):
    started = "o_orderstatus IN ('F', 'P')"
    stopped = "o_orderstatus = 'P'"
    usec = "CAST(o_orderkey % 1000000 AS INTEGER)"
    feed = _downtime(1100, "o_orderkey * 10", where, "sec", "CASE WHEN o_orderkey % 5 = 0 THEN 'reloaded' ELSE 'ops' END")
    return feed.typed_sql(
        warehouse.TABLES[table].layout,
        {
            id_column: row_sql(table, "inst", _DOWN_OBJECT, "sec", "o_orderkey"), "instance_id": "inst",
            "object_id": _DOWN_OBJECT,
            "was_started": f"CAST(CASE WHEN {started} THEN 1 ELSE 0 END AS SMALLINT)",
            "actual_start_time": f"CASE WHEN {started} THEN {stamp_sql('sec + 3601')} END",
            "actual_start_time_usec": f"CASE WHEN {started} THEN {usec} ELSE 0 END",
            "actual_end_time": f"CASE WHEN {stopped} THEN {stamp_sql('sec + 7201')} END",
            "actual_end_time_usec": f"CASE WHEN {stopped} THEN {usec} ELSE 0 END",
            "was_cancelled": f"CAST(CASE WHEN {stopped} AND o_orderkey % 3 % 2 = 1 THEN 1 ELSE 0 END AS SMALLINT)",
        },
        f"1 + o_orderkey % 2 AS otype, host, {_DOWN_SVC} AS svc_name",
    )


register_object_reports(
    ("downtime_history", "host_downtime_history", "service_downtime_history"), "downtimehistory", downtime_events,
    _downtime_sql("downtimehistory", "downtimehistory_id", "TRUE"),
)
register_object_reports(
    ("scheduled_downtime",), "scheduleddowntime", downtime_events,
    _downtime_sql(
        "scheduleddowntime", "scheduleddowntime_id",
        "o_orderstatus <> 'P' AND NOT (o_orderstatus = 'O' AND o_orderkey % 7 = 0)",
    ),
)

# ---- timed events -----------------------------------------------------------------------------
_T_HOST = "concat('host', user_id % 5)"
_T_KIND = "CASE user_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 12 WHEN 2 THEN 9 ELSE 5 END"
_T_SVC = "CASE WHEN user_id % 4 = 0 OR k % 2 = 0 THEN svc ELSE '' END"
_T_RUN = "sec - sec % 7200 + 14400"
TIMED = Feed(201, "ev", "event_id", {
    1: "CASE WHEN k % 10 < 5 THEN 200 WHEN k % 10 < 7 THEN 201 WHEN k % 10 < 9 THEN 202 ELSE 205 END",
    4: TV, 41: _T_KIND, 108: "k % 2", 111: _T_RUN, 53: _T_HOST, 114: _T_SVC,
})
_T_SERVICE = "(user_id % 4 = 0 OR (user_id % 4 = 2 AND k % 2 = 0))"
_T_IS_HOST = "(user_id % 4 = 1 OR (user_id % 4 = 2 AND k % 2 = 1))"
_T_OBJECT = (
    f"CASE WHEN {_T_SERVICE} THEN {object_sql(2, _T_HOST, 'svc')} "
    f"WHEN {_T_IS_HOST} THEN {object_sql(1, _T_HOST)} ELSE 0 END"
)
_T_NAMES = (
    f"CASE WHEN {_T_SERVICE} THEN 2 WHEN {_T_IS_HOST} THEN 1 END AS otype, "
    f"CASE WHEN {_T_SERVICE} OR {_T_IS_HOST} THEN {_T_HOST} END AS host, "
    f"CASE WHEN {_T_SERVICE} THEN svc END AS svc_name, "
    "CASE WHEN k % 10 < 5 THEN 200 WHEN k % 10 < 7 THEN 201 WHEN k % 10 < 9 THEN 202 ELSE 205 END AS op, "
    f"CAST({_T_RUN} AS BIGINT) AS run, sec"
)
_QUEUE_ROWS = TIMED.typed_sql(
    warehouse.TABLES["timedeventqueue"].layout,
    {"timedeventqueue_id": arrival_sql("timedeventqueue", "event_id"), "instance_id": "inst", "object_id": _T_OBJECT},
    _T_NAMES,
)
_T_MATCH = "instance_id, event_type, scheduled_time, recurring_event, object_id"
_QUEUE_SQL = f"""
    WITH r AS (SELECT * FROM ({_QUEUE_ROWS}) WHERE op <> 205),
    p AS (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY ord) AS nth FROM r),
    q AS (SELECT *,
        max(CASE WHEN op = 202 AND event_type IN (0, 12) THEN run END) OVER (
            PARTITION BY instance_id ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS purged,
        max(CASE WHEN op <> 200 THEN ord END) OVER (
            PARTITION BY {_T_MATCH} ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS removed
        FROM p)
    SELECT * FROM q WHERE op = 200 AND removed IS NULL AND (purged IS NULL OR run >= purged)"""
register_object_reports(("timed_event_queue",), "timedeventqueue", TIMED.records, _QUEUE_SQL)

_TIMED_ROWS = TIMED.typed_sql(
    warehouse.TABLES["timedevents"].layout,
    {
        "timedevent_id": arrival_sql("timedevents", "event_id"), "instance_id": "inst", "object_id": _T_OBJECT,
        "queued_time": f"CASE WHEN k % 10 < 5 THEN {stamp_sql('sec')} END",
        "queued_time_usec": "CASE WHEN k % 10 < 5 THEN CAST(usec AS INTEGER) END",
        "event_time": f"CASE WHEN k % 10 IN (7, 8) THEN {stamp_sql('sec')} END",
        "event_time_usec": "CASE WHEN k % 10 IN (7, 8) THEN CAST(usec AS INTEGER) END",
        "deletion_time": "CAST(NULL AS TIMESTAMP)", "deletion_time_usec": "CAST(NULL AS INTEGER)",
    },
    _T_NAMES,
)
register_object_reports(
    ("timed_events",), "timedevents", TIMED.records,
    f"SELECT * FROM ({_TIMED_ROWS}) WHERE op IN (200, 202) AND scheduled_time < {stamp_sql(AS_OF_SEC)}",
)

# ---- definitions ------------------------------------------------------------------------------
HOST_DEF = Feed(400, "host", "c_custkey", {
    4: ("1700000000", "0"), 174: "host", 258: "concat(host, ' display')", 159: "c_mktsegment", 158: "concat('10.0.', c_custkey)",
    160: "concat('check_host!', c_custkey, '!x')", 161: "c_acctbal", 173: "3", 177: "'24x7'", 240: "c_custkey % 100",
    242: "c_custkey % 50",
}, config_type="c_custkey % 2")
SERVICE_DEF = Feed(402, "svc", "c_custkey", {
    4: ("1700000000", "0"), 174: "host", 210: "svc", 207: "concat('check_', svc)", 208: "5", 185: "4",
}, config_type="c_custkey % 2")
CONTACT_DEF = Feed(410, "contact", "s_suppkey", {
    4: ("1700000000", "0"), 134: "contact", 129: "concat('alias ', contact)", 138: "concat(s_suppkey, '@example.org')",
    128: ["concat('1:', contact)", "concat('2:sms:', s_suppkey)", "'3'"], 177: "'24x7'",
    175: ["concat('mail!', s_suppkey)"], 222: ["'page'", "concat('sms!a!', s_suppkey)"],
}, config_type="s_suppkey % 2")


@query("hosts", f"""SELECT t.inst AS instance_id, i.instance_name, {object_sql(1, 'host')} AS host_object_id,
    host AS host_name FROM ({feeds.source_sql('host')}) t LEFT JOIN ({INSTANCES_SQL}) i ON t.inst = i.instance_id
    WHERE c_custkey % 2 = 1""")
def hosts(spark, sf_dir):
    """Hosts with a retained definition."""
    return reports.report("hosts", tables_for(spark, sf_dir, HOST_DEF.records(spark, sf_dir), ("hosts",), "hosts"))


@query("services", f"""SELECT t.inst AS instance_id, i.instance_name, {object_sql(1, 'host')} AS host_object_id,
    {object_sql(2, 'host', 'svc')} AS service_object_id, host AS host_name, svc AS service_description
    FROM ({feeds.source_sql('svc')}) t LEFT JOIN ({INSTANCES_SQL}) i ON t.inst = i.instance_id
    WHERE c_custkey % 2 = 1""")
def services(spark, sf_dir):
    """Services with a retained definition."""
    return reports.report("services", tables_for(spark, sf_dir, SERVICE_DEF.records(spark, sf_dir), ("services",), "services"))


@query("contacts", f"""SELECT t.inst AS instance_id, i.instance_name, {object_sql(10, 'contact')} AS contact_object_id,
    contact AS contact_name FROM ({feeds.source_sql('contact')}) t
    LEFT JOIN ({INSTANCES_SQL}) i ON t.inst = i.instance_id WHERE s_suppkey % 2 = 1""")
def contacts(spark, sf_dir):
    """Contacts with a retained definition."""
    return reports.report("contacts", tables_for(spark, sf_dir, CONTACT_DEF.records(spark, sf_dir), ("contacts",), "contacts"))


# ---- status -----------------------------------------------------------------------------------
SERVICE_STATUS = Feed(213, "ev", "event_id", {
    1: "1202", 4: TV, 53: "host", 114: "svc", 95: "concat(svc, ' is ', k)", 99: "concat('t=', k, ';', svc)", 27: "k % 4",
    51: "1", 25: "k % 3 + 1", 76: "3", 61: "sec", 83: "sec + 300", 121: "k % 2", 42: "value", 71: "value / 8",
    88: "1", 209: "concat('period_', k % 3)",
})
HOST_STATUS = Feed(212, "ev", "event_id", {
    1: "1201", 4: TV, 53: "host", 95: "concat('ping ', k)", 27: "k % 3", 51: "1", 58: "sec", 81: "sec + 300", 121: "k % 2",
    42: "value", 162: "concat('period_', k % 2)",
})
CONTACT_STATUS = Feed(224, "contact", "s_suppkey", {
    1: "1203", 4: ("1700000000 + s_suppkey", "1"), 134: "contact", 178: "s_suppkey % 2", 225: "1", 59: "1690000000",
    261: "s_suppkey",
})


def status_sql(feed, table, id_column, key, key_sql, ident, extra, keep):
    rows = latest_sql(
        feed.typed_sql(
            warehouse.TABLES[table].layout,
            {id_column: row_sql(table, key_sql), "instance_id": "inst", key: key_sql}, f"{ident}",
        ), key,
    )
    cols = [c for c in _columns(table) if c not in ("instance_id", key)]
    return (
        f"SELECT t.instance_id, i.instance_name, {extra}, t.{key}, {', '.join('t.' + c for c in cols)} "
        f"FROM ({rows}) t LEFT JOIN ({INSTANCES_SQL}) i ON t.instance_id = i.instance_id WHERE {keep}"
    )


@query("service_status", status_sql(
    SERVICE_STATUS, "servicestatus", "servicestatus_id", "service_object_id", object_sql(2, "host", "svc"),
    f"user_id, host, svc, {object_sql(1, 'host')} AS host_object_id",
    "t.host_object_id, t.host AS host_name, t.svc AS service_description", "t.user_id % 2 = 1"))
def service_status(spark, sf_dir):
    """Latest status of every service with a retained definition (flagship)."""
    events = union(SERVICE_STATUS.records(spark, sf_dir), SERVICE_DEF.records(spark, sf_dir))
    return reports.report("service_status", tables_for(spark, sf_dir, events, ("servicestatus", "services"), "service_status"))


@query("host_status", status_sql(
    HOST_STATUS, "hoststatus", "hoststatus_id", "host_object_id", object_sql(1, "host"), "user_id, host",
    "t.host AS host_name", "t.user_id % 2 = 1"))
def host_status(spark, sf_dir):
    """Latest status of every host with a retained definition."""
    events = union(HOST_STATUS.records(spark, sf_dir), HOST_DEF.records(spark, sf_dir))
    return reports.report("host_status", tables_for(spark, sf_dir, events, ("hoststatus", "hosts"), "host_status"))


@query("contact_status", status_sql(
    CONTACT_STATUS, "contactstatus", "contactstatus_id", "contact_object_id", object_sql(10, "contact"),
    "s_suppkey, contact", "t.contact AS contact_name", "t.s_suppkey % 2 = 1"))
def contact_status(spark, sf_dir):
    """Latest status of every contact with a retained definition."""
    events = union(CONTACT_STATUS.records(spark, sf_dir), CONTACT_DEF.records(spark, sf_dir))
    return reports.report("contact_status", tables_for(spark, sf_dir, events, ("contactstatus", "contacts"), "contact_status"))


# ---- membership: each member sends its group's definition with itself listed --------------------
HOST_GROUP = Feed(401, "host", "c_custkey", {
    4: ("1700000000", "0"), 172: "c_mktsegment", 170: "concat('group ', c_mktsegment)", 171: ["host"],
}, config_type="1")
SERVICE_GROUP = Feed(403, "svc", "c_custkey", {
    4: ("1700000000", "0"), 220: "concat('sg_', svc)", 218: "svc", 219: ["concat(host, ';', svc)"],
}, config_type="1")
CONTACT_GROUP = Feed(411, "contact", "s_suppkey", {
    4: ("1700000000", "0"), 133: "concat('cg_', s_suppkey % 7)", 131: "concat('on call ', s_suppkey % 7)", 132: ["contact"],
}, config_type="1")


def membership_sql(src, group, gtype, gname, alias, gid_parts, member, mtype, mnames, named):
    gobj = object_sql(gtype, gname)
    gid = row_sql(f"{group}s", *[gobj if p == "OBJ" else p for p in gid_parts])
    return (
        f"SELECT t.inst AS instance_id, i.instance_name, {gid} AS {group}_id, {gobj} AS {group}_object_id, "
        f"{gname} AS {group}_name, {alias} AS {group}_alias, {object_sql(mtype, *mnames)} AS {member}, {named} "
        f"FROM ({feeds.source_sql(src)}) t JOIN ({INSTANCES_SQL}) i ON t.inst = i.instance_id"
    )


@query("hostgroup_membership", membership_sql(
    "host", "hostgroup", 3, "c_mktsegment", "concat('group ', c_mktsegment)", ("inst", "OBJ"), "host_object_id", 1,
    ("host",), "host AS host_name"))
def hostgroup_membership(spark, sf_dir):
    """Hosts of each host group."""
    events = union(HOST_GROUP.records(spark, sf_dir), HOST_DEF.records(spark, sf_dir))
    return reports.report(
        "hostgroup_membership",
        tables_for(spark, sf_dir, events, ("hostgroups", "hostgroup_members", "hosts"), "hostgroup_membership"))


@query("servicegroup_membership", membership_sql(
    "svc", "servicegroup", 4, "concat('sg_', svc)", "svc", ("inst", "1", "OBJ"), "service_object_id", 2,
    ("host", "svc"), "host AS host_name, svc AS service_description"))
def servicegroup_membership(spark, sf_dir):
    """Services of each service group."""
    events = union(SERVICE_GROUP.records(spark, sf_dir), SERVICE_DEF.records(spark, sf_dir))
    return reports.report("servicegroup_membership", tables_for(
        spark, sf_dir, events, ("servicegroups", "servicegroup_members", "services"), "servicegroup_membership"))


@query("contactgroup_membership", membership_sql(
    "contact", "contactgroup", 11, "concat('cg_', s_suppkey % 7)", "concat('on call ', s_suppkey % 7)",
    ("inst", "1", "OBJ"), "contact_object_id", 10, ("contact",), "contact AS contact_name"))
def contactgroup_membership(spark, sf_dir):
    """Contacts of each contact group."""
    events = union(CONTACT_GROUP.records(spark, sf_dir), CONTACT_DEF.records(spark, sf_dir))
    return reports.report("contactgroup_membership", tables_for(
        spark, sf_dir, events, ("contactgroups", "contactgroup_members", "contacts"), "contactgroup_membership"))


# ---- the order of reports: what a limit keeps -----------------------------------------------------
@query("newest_states", f"""
    SELECT statehistory_id, state_time, state_time_usec, object_id FROM ({_STATE_ROWS}) WHERE k % 10 <> 0
    ORDER BY state_time DESC, state_time_usec DESC, statehistory_id DESC LIMIT 250""")
def newest_states(spark, sf_dir):
    """The 250 newest state changes."""
    tables = tables_for(spark, sf_dir, STATE.records(spark, sf_dir), ("statehistory",))
    return reports.report("state_history", tables, limit=250).select("statehistory_id", "state_time", "state_time_usec", "object_id")


@query("first_services", f"""
    SELECT i.instance_name, host AS host_name, svc AS service_description
    FROM ({feeds.source_sql('svc')}) t LEFT JOIN ({INSTANCES_SQL}) i ON t.inst = i.instance_id WHERE c_custkey % 2 = 1
    ORDER BY instance_name, host_name, service_description LIMIT 100""")
def first_services(spark, sf_dir):
    """The first hundred services by name."""
    tables = tables_for(spark, sf_dir, SERVICE_DEF.records(spark, sf_dir), ("services",))
    return reports.report("services", tables, limit=100).select("instance_name", "host_name", "service_description")


@query("queue_head", f"""
    SELECT event_type, scheduled_time, recurring_event, object_id FROM ({_QUEUE_SQL})
    ORDER BY scheduled_time, timedeventqueue_id LIMIT 20""")
def queue_head(spark, sf_dir):
    """The twenty events that are due next."""
    tables = tables_for(spark, sf_dir, TIMED.records(spark, sf_dir), ("timedeventqueue",))
    return reports.report("timed_event_queue", tables, limit=20).select(
        "event_type", "scheduled_time", "recurring_event", "object_id")
