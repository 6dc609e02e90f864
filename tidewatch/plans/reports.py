"""The 33 report queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids
from ..operators.filters import past_events, retained_config
from ..operators.lookup import with_instance, with_object
from ..steps import Steps

NAMES = {"objecttype_id": "objecttype_id", "name1": "host_name", "name2": "service_description"}


@dataclass(frozen=True)
class Report:
    """A table with the names of the object each row is about."""

    table: str
    order: tuple[str, ...]
    objecttype: int | None = None
    columns: tuple[str, ...] | None = None
    object_alias: str = "object_id"
    past_only: bool = False


_COMMENT = ("-entry_time", "-entry_time_usec", "-comment_id")
_COMMENT_HISTORY = ("-entry_time", "-entry_time_usec", "-commenthistory_id")
_DOWNTIME = ("-scheduled_start_time", "-actual_start_time", "-actual_start_time_usec", "-downtimehistory_id")
_HANDLER = ("-start_time", "-start_time_usec", "-eventhandler_id")
_FLAPPING = ("-event_time", "-event_time_usec", "-flappinghistory_id")
_NOTIFICATION = ("-start_time", "-start_time_usec", "-notification_id")
_STATE = ("-state_time", "-state_time_usec", "-statehistory_id")

OBJECT_REPORTS = {
    "comment_history": Report("commenthistory", _COMMENT_HISTORY),
    "comments": Report("comments", _COMMENT),
    "downtime_history": Report("downtimehistory", _DOWNTIME),
    "event_handlers": Report("eventhandlers", _HANDLER),
    "flapping_history": Report("flappinghistory", _FLAPPING),
    "host_comments": Report("comments", _COMMENT, 1),
    "host_downtime_history": Report("downtimehistory", _DOWNTIME, 1),
    "host_event_handlers": Report("eventhandlers", _HANDLER, 1),
    "host_flapping_history": Report("flappinghistory", _FLAPPING, 1),
    "host_notifications": Report("notifications", _NOTIFICATION, 1, object_alias="host_object_id"),
    "host_state_history": Report("statehistory", _STATE, 1),
    "notifications": Report("notifications", _NOTIFICATION),
    "scheduled_downtime": Report("scheduleddowntime", ("-scheduled_start_time", "-scheduleddowntime_id")),
    "service_comments": Report("comments", _COMMENT, 2),
    "service_downtime_history": Report("downtimehistory", _DOWNTIME, 2),
    "service_event_handlers": Report("eventhandlers", _HANDLER, 2),
    "service_flapping_history": Report("flappinghistory", _FLAPPING, 2),
    "service_notifications": Report("notifications", _NOTIFICATION, 2, object_alias="service_object_id"),
    "service_state_history": Report("statehistory", _STATE, 2),
    "state_history": Report("statehistory", _STATE),
    "timed_event_queue": Report(
        "timedeventqueue", ("scheduled_time", "timedeventqueue_id"),
        columns=("event_type", "scheduled_time", "recurring_event", "object_id"),
    ),
    "timed_events": Report(
        "timedevents", ("-scheduled_time", "-timedevent_id"),
        columns=("event_type", "scheduled_time", "event_time", "event_time_usec", "recurring_event", "object_id"),
        past_only=True,
    ),
}
OTHER_REPORTS = (
    "contact_notification_methods", "contact_notifications", "contact_status", "contactgroup_membership",
    "contacts", "host_status", "hostgroup_membership", "hosts", "service_status", "servicegroup_membership",
    "services",
)
REPORTS = tuple(sorted([*OBJECT_REPORTS, *OTHER_REPORTS]))


def _used_members(group: str, member: str, entity: str) -> dict[str, tuple[str, ...]]:
    return {
        f"{group}s": ("instance_id", f"{group}_id", f"{group}_object_id", "alias", "config_type"),
        f"{group}_members": (f"{group}_id", member), entity: (member, "config_type"),
    }


_NOTIFIED = ("notification_id", "instance_id", "object_id")
#: report -> table -> the columns it reads; of other tables it reads all
USED = {
    "contacts": {"contacts": ("instance_id", "contact_object_id", "config_type")},
    "contact_status": {"contacts": ("instance_id", "contact_object_id", "config_type")},
    "hosts": {"hosts": ("instance_id", "host_object_id", "config_type")},
    "host_status": {"hosts": ("instance_id", "host_object_id", "config_type")},
    "services": {"services": ("instance_id", "host_object_id", "service_object_id", "config_type")},
    "service_status": {"services": ("instance_id", "host_object_id", "service_object_id", "config_type")},
    "hostgroup_membership": _used_members("hostgroup", "host_object_id", "hosts"),
    "servicegroup_membership": _used_members("servicegroup", "service_object_id", "services"),
    "contactgroup_membership": _used_members("contactgroup", "contact_object_id", "contacts"),
    "contact_notifications": {"notifications": _NOTIFIED},
    "contact_notification_methods": {"notifications": _NOTIFIED},
}


#: report -> the object types whose names it shows
KINDS = {
    "contacts": (10,), "contact_status": (10,), "hosts": (1,), "host_status": (1,), "services": (2,), "service_status": (2,),
    "hostgroup_membership": (3, 1), "servicegroup_membership": (4, 2), "contactgroup_membership": (11, 10),
    **{name: (spec.objecttype,) for name, spec in OBJECT_REPORTS.items() if spec.objecttype is not None},
}


def used(name: str, table: str) -> tuple[str, ...] | None:
    """Columns of a table that a report reads, None for all."""
    return USED.get(name, {}).get(table)


def _sorted(rows: DataFrame, order, limit: int | None) -> DataFrame:
    keys = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]
    out = rows.orderBy(*keys)
    return out if limit is None else out.limit(limit)


def object_report(report: Report, tables: dict[str, DataFrame], limit=None, as_of: Column | None = None) -> DataFrame:
    base = tables[report.table]
    if report.past_only:
        base = past_events(base, F.current_timestamp() if as_of is None else as_of)
    objects = tables["objects"]
    how = "left"
    if report.objecttype is not None:
        # the filter on the looked-up side makes the outer join an inner one
        objects, how = objects.where(F.col("objecttype_id") == report.objecttype), "inner"
    rows = with_instance(with_object(base, objects, "object_id", NAMES, how), tables["instances"])
    # sort before the final projection, which may drop the tie-breaking id
    rows = _sorted(rows, report.order, limit)
    if report.objecttype is None:
        named = ["objecttype_id", "host_name", "service_description"]
    else:
        named = ["host_name"] if report.objecttype == 1 else ["host_name", "service_description"]
    listed = list(report.columns or base.columns)
    head = ["instance_id", "instance_name"]
    if report.object_alias != "object_id":
        rows = rows.withColumn(report.object_alias, F.col("object_id"))
        head.append(report.object_alias)
    else:
        head.append("object_id")
    head += named
    return rows.select(*head, *[c for c in listed if c not in head])


def _status(tables, status: str, definition: str, key: str, names: dict[str, str], extra=(), limit=None) -> DataFrame:
    """Current status of every object with a retained definition."""
    # only key columns of the definition are read; other copies of a column would clash with the status
    known = retained_config(tables[definition]).select(key, "instance_id", *extra)
    rows = with_object(tables[status].drop("instance_id"), tables["objects"], key, names).join(known, key)
    rows = with_instance(rows, tables["instances"])
    head = ["instance_id", "instance_name", *extra, key, *names.values()]
    rows = rows.select(*head, *[c for c in tables[status].columns if c not in head])
    return _sorted(rows, ("instance_name", *names.values()), limit)


def _definitions(tables, definition: str, key: str, names: dict[str, str], extra=(), limit=None) -> DataFrame:
    rows = retained_config(tables[definition]).select("instance_id", *extra, key)
    rows = with_instance(with_object(rows, tables["objects"], key, names), tables["instances"])
    return _sorted(
        rows.select("instance_id", "instance_name", *extra, key, *names.values()),
        ("instance_name", *names.values()), limit,
    )


def _membership(tables, group: str, member: str, entity: str, names: dict[str, str], config_type=None) -> DataFrame:
    """Groups and their members.  Both dumps of a definition count unless a config type is asked for."""
    groups = tables[f"{group}s"].select(
        "instance_id", f"{group}_id", f"{group}_object_id", F.col("alias").alias(f"{group}_alias"), "config_type"
    )
    entities = tables[entity].select(member, F.col("config_type").alias("_kind"))
    if config_type is not None:
        groups = groups.where(F.col("config_type") == config_type)
        entities = entities.where(F.col("_kind") == config_type)
    rows = tables[f"{group}_members"].select(f"{group}_id", member).join(groups, f"{group}_id").join(entities, member)
    rows = with_object(rows, tables["objects"], f"{group}_object_id", {"name1": f"{group}_name"}, "inner")
    rows = with_object(rows, tables["objects"], member, names, "inner")
    rows = with_instance(rows, tables["instances"], "inner")
    return rows.select(
        "instance_id", "instance_name", f"{group}_id", f"{group}_object_id", f"{group}_name", f"{group}_alias",
        member, *names.values(),
    )


def _of_type(objects: DataFrame, objecttype: int) -> DataFrame:
    """Objects of one type, few enough for some types that adaptive execution broadcasts them."""
    return objects.where(F.col("objecttype_id") == objecttype)


def _notified(tables) -> DataFrame:
    """Notifications with the names of what they are about, which are looked up before the many rows that notify contacts."""
    return with_object(tables["notifications"].select(*_NOTIFIED), tables["objects"], "object_id", NAMES)


def _step(steps: Steps | None, name: str, rows: DataFrame, *used: str) -> DataFrame:
    """The rows, saved if the work is done in steps; what was ``used`` for them is then deleted."""
    if steps is None:
        return rows
    rows = steps.saved(name, rows)
    steps.drop(*used)
    return rows


def _contact_notifications(tables, limit=None, steps: Steps | None = None) -> DataFrame:
    sent = tables["contactnotifications"].drop("instance_id")
    rows = sent.join(_notified(tables), "notification_id")
    rows = _step(steps, "notified", rows, "contactnotifications", "notifications")
    rows = with_object(rows, _of_type(tables["objects"], ids.CONTACT), "contact_object_id", {"name1": "contact_name"})
    rows = with_instance(rows, tables["instances"])
    rows = rows.select("instance_id", "instance_name", "object_id", *NAMES.values(), "contact_name", *sent.columns)
    rows = _step(steps, "named", rows, "notified", "objects")
    return _sorted(rows, ("-start_time", "-start_time_usec", "-contactnotification_id"), limit)


def _contact_notification_methods(tables, limit=None, steps: Steps | None = None) -> DataFrame:
    methods = tables["contactnotificationmethods"].drop("instance_id")
    sent = tables["contactnotifications"].select(
        "contactnotification_id", "notification_id", "contact_object_id",
        *[F.col(c).alias(f"notification_{c}") for c in ("start_time", "start_time_usec", "end_time", "end_time_usec")],
    )
    rows = methods.join(sent, "contactnotification_id")
    rows = _step(steps, "sent", rows, "contactnotificationmethods", "contactnotifications")
    rows = _step(steps, "notified", rows.join(_notified(tables), "notification_id"), "sent", "notifications")
    rows = with_object(rows, _of_type(tables["objects"], ids.CONTACT), "contact_object_id", {"name1": "contact_name"})
    rows = with_object(
        rows, _of_type(tables["objects"], ids.COMMAND), "command_object_id", {"name1": "notification_command_name"})
    rows = with_instance(rows, tables["instances"])
    rows = rows.select(
        "instance_id", "instance_name", "object_id", *NAMES.values(), "contact_name", "notification_start_time",
        "notification_start_time_usec", "notification_end_time", "notification_end_time_usec",
        "notification_command_name", *methods.columns,
    )
    rows = _step(steps, "named", rows, "notified", "objects")
    return _sorted(rows, ("-start_time", "-start_time_usec", "-contactnotificationmethod_id"), limit)


_HOST = {"name1": "host_name"}
_SERVICE = {"name1": "host_name", "name2": "service_description"}
_CONTACT = {"name1": "contact_name"}


def report(
    name: str, tables: dict[str, DataFrame], limit=None, as_of: Column | None = None, config_type=None,
    steps: Steps | None = None,
) -> DataFrame:
    """One report over warehouse tables.  ``limit`` turns the full sort into a top-k.

    With ``steps`` the joins of the contact notification reports are done at once, and tables saved there are used up.
    """
    if name in OBJECT_REPORTS:
        return object_report(OBJECT_REPORTS[name], tables, limit, as_of)
    if name == "contact_status":
        return _status(tables, "contactstatus", "contacts", "contact_object_id", _CONTACT, limit=limit)
    if name == "host_status":
        return _status(tables, "hoststatus", "hosts", "host_object_id", _HOST, limit=limit)
    if name == "service_status":
        return _status(
            tables, "servicestatus", "services", "service_object_id", _SERVICE, ("host_object_id",), limit
        )
    if name == "contacts":
        return _definitions(tables, "contacts", "contact_object_id", _CONTACT, limit=limit)
    if name == "hosts":
        return _definitions(tables, "hosts", "host_object_id", _HOST, limit=limit)
    if name == "services":
        return _definitions(tables, "services", "service_object_id", _SERVICE, ("host_object_id",), limit)
    if name == "hostgroup_membership":
        return _membership(tables, "hostgroup", "host_object_id", "hosts", _HOST, config_type)
    if name == "servicegroup_membership":
        return _membership(tables, "servicegroup", "service_object_id", "services", _SERVICE, config_type)
    if name == "contactgroup_membership":
        return _membership(tables, "contactgroup", "contact_object_id", "contacts", _CONTACT, config_type)
    if name == "contact_notifications":
        return _contact_notifications(tables, limit, steps)
    if name == "contact_notification_methods":
        return _contact_notification_methods(tables, limit, steps)
    raise KeyError(name)


def create_views(spark: SparkSession, tables: dict[str, DataFrame], as_of: Column | None = None) -> list[str]:
    """Temporary views ``v_<report>``."""
    made = []
    for name in REPORTS:
        view = f"v_{name}"
        report(name, tables, as_of=as_of).createOrReplaceTempView(view)
        made.append(view)
    return made
