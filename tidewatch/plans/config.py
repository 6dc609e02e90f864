"""Configuration tables: definitions and the membership tables exploded from their lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import ids, wire
from . import columns
from .current import customvar_items
from .table import Table, named_id, service_id


def _service(host_key: int = 174, name_key: int = 210) -> Column:
    return service_id(host_key, name_key)


def _config(name, rec_type, layout, keys, id_column, given=dict, **more) -> Table:
    return Table(
        name, rec_type if isinstance(rec_type, tuple) else (rec_type,), layout, kind="config", gated=True,
        keys=keys, given=given, id_column=id_column, id_parts=keys, **more,
    )


def _bridge(name, parent: Table, list_key, member, objecttype, id_column, service=False) -> Table:
    """Membership rows: parent row id and the id of each listed object."""
    parent_id = parent.id_column

    def given():
        if service:
            ref = wire.split_service_ref(F.col("_item"))
            object_id = ids.object_id("instance_id", objecttype, ref["host"], ref["service"])
        else:
            object_id = ids.object_id("instance_id", objecttype, F.col("_item"))
        return {parent_id: parent_row_id(parent), member: object_id}

    keys = (parent_id, member)
    return Table(
        name, parent.rec_types, f"{id_column} =, instance_id =, {parent_id} =, {member} =",
        kind="config", gated=True, keys=keys, given=given, id_column=id_column, id_parts=keys,
        explode=lambda: wire.attrs(list_key),
    )


def parent_row_id(parent: Table) -> Column:
    """Row id of the definition in the same record."""
    kinds = {name: (kind, key) for name, kind, key in columns.parse(parent.layout)}
    given = {"instance_id": F.col("instance_id"), "config_type": F.col("config_type"), **parent.given()}
    parts = []
    for name in parent.id_parts:
        kind, key = kinds[name]
        parts.append(given[name] if kind == "=" else columns.attribute(kind, key))
    return ids.row_id(parent.name, *parts)


HOSTS = _config("hosts", 400, """
    host_id =, instance_id =, config_type =, host_object_id obj1 174, alias str 159, display_name str 258,
    address str 158, importance i32 266, check_command_object_id cmd 160, check_command_args arg 160,
    eventhandler_command_object_id cmd 163, eventhandler_command_args arg 163,
    notification_timeperiod_object_id obj9 177, check_timeperiod_object_id obj9 162,
    failure_prediction_options str 166, check_interval f64 161, retry_interval f64 247,
    max_check_attempts i16 173, first_notification_delay f64 246, notification_interval f64 176,
    notify_on_down i16 189, notify_on_unreachable i16 192, notify_on_recovery i16 191,
    notify_on_flapping i16 190, notify_on_downtime i16 248, stalk_on_up i16 230, stalk_on_down i16 228,
    stalk_on_unreachable i16 229, flap_detection_enabled i16 167, flap_detection_on_up i16 251,
    flap_detection_on_down i16 252, flap_detection_on_unreachable i16 253, low_flap_threshold f64 183,
    high_flap_threshold f64 156, process_performance_data i16 201, freshness_checks_enabled i16 168,
    freshness_threshold i32 169, passive_checks_enabled i16 96, event_handler_enabled i16 164,
    active_checks_enabled i16 8, retain_status_information i16 204, retain_nonstatus_information i16 203,
    notifications_enabled i16 178, obsess_over_host i16 91, failure_prediction_enabled i16 165,
    notes str 186, notes_url str 187, action_url str 126, icon_image str 179, icon_image_alt str 180,
    vrml_image str 239, statusmap_image str 235, have_2d_coords i16 154, x_2d i16 240, y_2d i16 242,
    have_3d_coords i16 155, x_3d f64 241, y_3d f64 243, z_3d f64 244
    """, ("instance_id", "config_type", "host_object_id"), "host_id")

HOSTGROUPS = _config(
    "hostgroups", 401,
    "hostgroup_id =, instance_id =, config_type =, hostgroup_object_id obj3 172, alias str 170",
    ("instance_id", "hostgroup_object_id"), "hostgroup_id",
)

SERVICES = _config("services", 402, """
    service_id =, instance_id =, config_type =, host_object_id obj1 174, service_object_id =,
    display_name str 258, importance i32 266, check_command_object_id cmd 207, check_command_args arg 207,
    eventhandler_command_object_id cmd 211, eventhandler_command_args arg 211,
    notification_timeperiod_object_id obj9 224, check_timeperiod_object_id obj9 209,
    failure_prediction_options str 214, check_interval f64 208, retry_interval f64 226,
    max_check_attempts i16 185, first_notification_delay f64 246, notification_interval f64 223,
    notify_on_warning i16 197, notify_on_unknown i16 196, notify_on_critical i16 193,
    notify_on_recovery i16 195, notify_on_flapping i16 194, notify_on_downtime i16 249,
    stalk_on_ok i16 232, stalk_on_warning i16 234, stalk_on_unknown i16 233, stalk_on_critical i16 231,
    is_volatile i16 221, flap_detection_enabled i16 215, flap_detection_on_ok i16 254,
    flap_detection_on_warning i16 255, flap_detection_on_unknown i16 256,
    flap_detection_on_critical i16 257, low_flap_threshold f64 184, high_flap_threshold f64 157,
    process_performance_data i16 202, freshness_checks_enabled i16 216, freshness_threshold i32 217,
    passive_checks_enabled i16 97, event_handler_enabled i16 212, active_checks_enabled i16 9,
    retain_status_information i16 206, retain_nonstatus_information i16 205, notifications_enabled i16 225,
    obsess_over_service i16 93, failure_prediction_enabled =, notes str 186, notes_url str 187,
    action_url str 126, icon_image str 179, icon_image_alt str 180
    """, ("instance_id", "config_type", "service_object_id"), "service_id",
    given=lambda: {
        "service_object_id": _service(),
        # read under 213, but sent under 45
        "failure_prediction_enabled": wire.clamp(
            wire.to_int(F.when(wire.has_attr(213), wire.raw_attr(213)).otherwise(wire.raw_attr(45))), "smallint"
        ),
    },
)

SERVICEGROUPS = _config(
    "servicegroups", 403,
    "servicegroup_id =, instance_id =, config_type =, servicegroup_object_id obj4 220, alias str 218",
    ("instance_id", "config_type", "servicegroup_object_id"), "servicegroup_id",
)

HOSTDEPENDENCIES = _config("hostdependencies", 404, """
    hostdependency_id =, instance_id =, config_type =, host_object_id obj1 174,
    dependent_host_object_id obj1 136, dependency_type i16 135, inherits_parent i16 181,
    timeperiod_object_id obj9 259, fail_on_up i16 151, fail_on_down i16 147, fail_on_unreachable i16 150
    """,
    ("instance_id", "config_type", "host_object_id", "dependent_host_object_id", "dependency_type",
     "inherits_parent", "fail_on_up", "fail_on_down", "fail_on_unreachable"), "hostdependency_id",
)

SERVICEDEPENDENCIES = _config("servicedependencies", 405, """
    servicedependency_id =, instance_id =, config_type =, service_object_id =,
    dependent_service_object_id =, dependency_type i16 135, inherits_parent i16 181,
    timeperiod_object_id obj9 259, fail_on_ok i16 148, fail_on_warning i16 152, fail_on_unknown i16 149,
    fail_on_critical i16 146
    """,
    ("instance_id", "config_type", "service_object_id", "dependent_service_object_id", "dependency_type",
     "inherits_parent", "fail_on_ok", "fail_on_warning", "fail_on_unknown", "fail_on_critical"),
    "servicedependency_id",
    given=lambda: {"service_object_id": _service(), "dependent_service_object_id": _service(136, 137)},
)

HOSTESCALATIONS = _config("hostescalations", 406, """
    hostescalation_id =, instance_id =, config_type =, host_object_id obj1 174,
    timeperiod_object_id obj9 145, first_notification i16 153, last_notification i16 182,
    notification_interval f64 188, escalate_on_recovery i16 141, escalate_on_down i16 140,
    escalate_on_unreachable i16 143
    """,
    ("instance_id", "config_type", "host_object_id", "timeperiod_object_id", "first_notification",
     "last_notification"), "hostescalation_id",
)

SERVICEESCALATIONS = _config("serviceescalations", 407, """
    serviceescalation_id =, instance_id =, config_type =, service_object_id =,
    timeperiod_object_id obj9 145, first_notification i16 153, last_notification i16 182,
    notification_interval f64 188, escalate_on_recovery i16 141, escalate_on_warning i16 144,
    escalate_on_unknown i16 142, escalate_on_critical i16 139
    """,
    ("instance_id", "config_type", "service_object_id", "timeperiod_object_id", "first_notification",
     "last_notification"), "serviceescalation_id",
    given=lambda: {"service_object_id": _service()},
)

COMMANDS = _config(
    "commands", 408,
    "command_id =, instance_id =, config_type =, object_id obj12 127, command_line str 14",
    ("instance_id", "object_id", "config_type"), "command_id",
)

TIMEPERIODS = _config(
    "timeperiods", 409,
    "timeperiod_id =, instance_id =, config_type =, timeperiod_object_id obj9 237, alias str 236",
    ("instance_id", "config_type", "timeperiod_object_id"), "timeperiod_id",
)

CONTACTS = _config("contacts", 410, """
    contact_id =, instance_id =, config_type =, contact_object_id obj10 134, alias str 129,
    email_address str 138, pager_address str 198, minimum_importance i32 267,
    host_timeperiod_object_id obj9 177, service_timeperiod_object_id obj9 224,
    host_notifications_enabled i16 178, service_notifications_enabled i16 225, can_submit_commands i16 250,
    notify_service_recovery i16 195, notify_service_warning i16 197, notify_service_unknown i16 196,
    notify_service_critical i16 193, notify_service_flapping i16 194, notify_service_downtime i16 249,
    notify_host_recovery i16 191, notify_host_down i16 189, notify_host_unreachable i16 192,
    notify_host_flapping i16 190, notify_host_downtime i16 248
    """, ("instance_id", "config_type", "contact_object_id"), "contact_id")

CONTACTGROUPS = _config(
    "contactgroups", 411,
    "contactgroup_id =, instance_id =, config_type =, contactgroup_object_id obj11 133, alias str 131",
    ("instance_id", "config_type", "contactgroup_object_id"), "contactgroup_id",
)

CONFIGFILES = _config(
    "configfiles", (300, 301),
    "configfile_id =, instance_id =, configfile_type =, configfile_path str 21",
    ("instance_id", "configfile_type", "configfile_path"), "configfile_id",
    given=lambda: {"configfile_type": (F.col("rec_type") - 300).cast("smallint")},
)

CONFIGFILEVARIABLES = Table(
    "configfilevariables", (300, 301),
    "configfilevariable_id =, instance_id =, configfile_id =, varname =, varvalue =",
    kind="config", gated=True,
    given=lambda: {
        "configfile_id": parent_row_id(CONFIGFILES),
        "varname": F.col("_item.name"),
        "varvalue": F.col("_item.value"),
    },
    explode=lambda: F.filter(F.transform(wire.attrs(22), wire.split_var), lambda item: item["name"] != ""),
    id_column="configfilevariable_id",
)

HOST_PARENTHOSTS = _bridge("host_parenthosts", HOSTS, 200, "parent_host_object_id", ids.HOST, "host_parenthost_id")
HOST_CONTACTGROUPS = _bridge(
    "host_contactgroups", HOSTS, 130, "contactgroup_object_id", ids.CONTACTGROUP, "host_contactgroup_id"
)
HOST_CONTACTS = _bridge("host_contacts", HOSTS, 264, "contact_object_id", ids.CONTACT, "host_contact_id")
HOSTGROUP_MEMBERS = _bridge("hostgroup_members", HOSTGROUPS, 171, "host_object_id", ids.HOST, "hostgroup_member_id")
SERVICE_PARENTSERVICES = _bridge(
    "service_parentservices", SERVICES, 268, "parent_service_object_id", ids.SERVICE,
    "service_parentservice_id", service=True,
)
SERVICE_CONTACTGROUPS = _bridge(
    "service_contactgroups", SERVICES, 130, "contactgroup_object_id", ids.CONTACTGROUP, "service_contactgroup_id"
)
SERVICE_CONTACTS = _bridge("service_contacts", SERVICES, 264, "contact_object_id", ids.CONTACT, "service_contact_id")
SERVICEGROUP_MEMBERS = _bridge(
    "servicegroup_members", SERVICEGROUPS, 219, "service_object_id", ids.SERVICE, "servicegroup_member_id",
    service=True,
)
HOSTESCALATION_CONTACTGROUPS = _bridge(
    "hostescalation_contactgroups", HOSTESCALATIONS, 130, "contactgroup_object_id", ids.CONTACTGROUP,
    "hostescalation_contactgroup_id",
)
HOSTESCALATION_CONTACTS = _bridge(
    "hostescalation_contacts", HOSTESCALATIONS, 264, "contact_object_id", ids.CONTACT, "hostescalation_contact_id"
)
SERVICEESCALATION_CONTACTGROUPS = _bridge(
    "serviceescalation_contactgroups", SERVICEESCALATIONS, 130, "contactgroup_object_id", ids.CONTACTGROUP,
    "serviceescalation_contactgroup_id",
)
SERVICEESCALATION_CONTACTS = _bridge(
    "serviceescalation_contacts", SERVICEESCALATIONS, 264, "contact_object_id", ids.CONTACT,
    "serviceescalation_contact_id",
)
CONTACTGROUP_MEMBERS = _bridge(
    "contactgroup_members", CONTACTGROUPS, 132, "contact_object_id", ids.CONTACT, "contactgroup_member_id"
)


def _split_items(key: int, split) -> Column:
    return F.filter(F.transform(wire.attrs(key), split), lambda item: item.isNotNull())


TIMEPERIOD_TIMERANGES = Table(
    "timeperiod_timeranges", (409,),
    "timeperiod_timerange_id =, instance_id =, timeperiod_id =, day =, start_sec =, end_sec =",
    kind="config", gated=True, keys=("timeperiod_id", "day", "start_sec", "end_sec"),
    given=lambda: {
        "timeperiod_id": parent_row_id(TIMEPERIODS),
        "day": wire.clamp(F.col("_item.day"), "smallint"),
        "start_sec": F.col("_item.start_sec"),
        "end_sec": F.col("_item.end_sec"),
    },
    explode=lambda: _split_items(238, wire.split_timerange),
    id_column="timeperiod_timerange_id", id_parts=("timeperiod_id", "day", "start_sec", "end_sec"),
)

CONTACT_ADDRESSES = Table(
    "contact_addresses", (410,),
    "contact_address_id =, instance_id =, contact_id =, address_number =, address =",
    kind="config", gated=True, keys=("contact_id", "address_number"),
    given=lambda: {
        "contact_id": parent_row_id(CONTACTS),
        "address_number": wire.clamp(F.col("_item.number"), "smallint"),
        "address": F.col("_item.address"),
    },
    explode=lambda: _split_items(128, wire.split_address),
    id_column="contact_address_id", id_parts=("contact_id", "address_number"),
)

def _commands(key: int, kind: int) -> Column:
    return F.transform(
        wire.attrs(key),
        lambda text: F.struct(F.lit(kind).cast("smallint").alias("kind"), wire.split_command(text).alias("command")),
    )


CONTACT_NOTIFICATIONCOMMANDS = Table(
    "contact_notificationcommands", (410,), """
    contact_notificationcommand_id =, instance_id =, contact_id =, notification_type =,
    command_object_id =, command_args =
    """,
    kind="config", gated=True, keys=("contact_id", "notification_type", "command_object_id", "command_args"),
    given=lambda: {
        "contact_id": parent_row_id(CONTACTS),
        "notification_type": F.col("_item.kind"),
        "command_object_id": ids.object_id("instance_id", ids.COMMAND, F.col("_item.command.name")),
        "command_args": F.col("_item.command.args"),
    },
    explode=lambda: F.concat(_commands(175, 0), _commands(222, 1)),
    id_column="contact_notificationcommand_id",
    id_parts=("contact_id", "notification_type", "command_object_id", "command_args"),
)

CUSTOMVARIABLES = Table(
    "customvariables", (400, 402, 410), """
    customvariable_id =, instance_id =, object_id =, config_type =, has_been_modified =, varname =,
    varvalue =
    """,
    kind="config", gated=True, keys=("object_id", "config_type", "varname"),
    given=lambda: {
        "object_id": F.when(F.col("rec_type") == 400, named_id(ids.HOST, 174))
        .when(F.col("rec_type") == 402, _service())
        .otherwise(named_id(ids.CONTACT, 134)),
        "has_been_modified": wire.clamp(F.col("_item.modified"), "smallint"),
        "varname": F.col("_item.name"),
        "varvalue": F.col("_item.value"),
    },
    explode=customvar_items,
    id_column="customvariable_id", id_parts=("object_id", "config_type", "varname"),
)

CONFIG = {t.name: t for t in list(globals().values()) if isinstance(t, Table) and t.kind == "config"}
