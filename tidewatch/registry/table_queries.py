"""History and configuration tables not covered by a report, built from the driver data."""

from __future__ import annotations

from ..plans import warehouse
from ..plans.table import Context
from . import feeds
from .entries import query
from .feeds import Feed, arrival_sql, hash_sql, object_sql, row_sql, stamp_sql, union
from .report_queries import CONTACT_DEF, HOST_DEF, SERVICE_STATUS, SUBJECT, TV, latest_sql

TABLES = warehouse.TABLES


def register(name, table, make_events, rows_sql):
    columns = ", ".join(TABLES[table].column_names)

    def run(spark, sf_dir):
        return TABLES[table].build(make_events(spark, sf_dir), Context())

    run.__doc__ = f"Table {table}."
    query(name, f"SELECT {columns} FROM ({rows_sql})")(run)


_OBJECT = f"CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END"

ACK = Feed(222, "ev", "event_id", {
    1: "1700", 4: ("sec - sec % 3600", "k"), 7: "k % 2", 53: "host", 114: SUBJECT, 10: "concat('me', k)", 17: "svc",
    118: "k % 4", 122: "k % 3 % 2", 100: "1", 90: "0",
})
register("acknowledgements", "acknowledgements", ACK.records, latest_sql(ACK.typed_sql(
    TABLES["acknowledgements"].layout,
    {"acknowledgement_id": row_sql("acknowledgements", "inst", "sec - sec % 3600", "k"), "instance_id": "inst",
     "object_id": _OBJECT},
), "instance_id, entry_time, entry_time_usec"))

_CHECK = {
    4: TV, 53: "host", 12: "k % 2", 25: "k % 3 + 1", 76: "3", 121: "k % 2", 118: "k % 4", 123: "60",
    127: "CASE WHEN k % 7 = 0 THEN '' ELSE concat('check_', svc) END", 13: "concat('-w!', k)", 14: "concat('/bin/', svc)",
    117: TV, 33: ("sec + 2", "usec"), 42: "value", 71: "value / 4", 110: "k % 4", 95: "svc", 125: "'a b'", 99: "concat('v=', k)",
}
_COMMAND_ID = object_sql(12, "CASE WHEN k % 7 = 0 THEN '' ELSE concat('check_', svc) END")
SERVICE_CHECK = Feed(206, "ev", "event_id", {1: "700 + k % 5", 114: "svc", **_CHECK})
register("service_checks", "servicechecks", SERVICE_CHECK.records, SERVICE_CHECK.typed_sql(
    TABLES["servicechecks"].layout,
    {"servicecheck_id": arrival_sql("servicechecks", "event_id"), "instance_id": "inst",
     "service_object_id": object_sql(2, "host", "svc"), "command_object_id": _COMMAND_ID},
    "k",
) + " AND k % 5 IN (0, 1)")

HOST_CHECK_START = Feed(207, "ev", "event_id * 2", {**_CHECK, 1: "800 + k % 6"})
HOST_CHECK_END = Feed(207, "ev", "event_id * 2 + 1", {
    **_CHECK, 1: "801 + k % 3", 118: "k % 3", 13: "'later'", 14: "'later'", 127: "'later'",
})
_HC_ID = row_sql("hostchecks", "inst", object_sql(1, "host"), "sec", "usec")
# a start record that is stored keeps its command, the end record brings everything else
_HC_KEPT = "k % 6 NOT IN (4, 5)"
register(
    "host_checks", "hostchecks",
    lambda spark, d: union(HOST_CHECK_START.records(spark, d), HOST_CHECK_END.records(spark, d)),
    Feed(207, "ev", "event_id", {
        **_CHECK, 118: "k % 3", 13: f"CASE WHEN {_HC_KEPT} THEN concat('-w!', k) ELSE 'later' END",
        14: f"CASE WHEN {_HC_KEPT} THEN concat('/bin/', svc) ELSE 'later' END",
    }).typed_sql(
        TABLES["hostchecks"].layout,
        {"hostcheck_id": _HC_ID, "instance_id": "inst",
         "is_raw_check": "CAST(CASE WHEN k % 3 IN (1, 2) THEN 1 ELSE 0 END AS SMALLINT)",
         "command_object_id": f"CASE WHEN {_HC_KEPT} THEN {_COMMAND_ID} ELSE {object_sql(12, chr(39) + 'later' + chr(39))} END"},
    ),
)

SYSTEM_COMMAND = Feed(203, "ev", "event_id", {
    1: "401", 4: TV, 117: TV, 33: ("sec + 1", "0"), 123: "30", 14: "concat('run ', svc, chr(9), k)", 32: "k % 2",
    42: "value", 110: "k % 3", 95: "svc",
})
register("system_commands", "systemcommands", SYSTEM_COMMAND.records, SYSTEM_COMMAND.typed_sql(
    TABLES["systemcommands"].layout,
    {"systemcommand_id": arrival_sql("systemcommands", "event_id"), "instance_id": "inst"},
))

EXTERNAL = Feed(217, "ev", "event_id", {
    1: "1400 + k % 2", 4: TV, 16: "k", 34: "sec", 15: "upper(svc)", 13: "concat(host, ';', k)",
})
register("external_commands", "externalcommands", EXTERNAL.records, EXTERNAL.typed_sql(
    TABLES["externalcommands"].layout,
    {"externalcommand_id": arrival_sql("externalcommands", "event_id"), "instance_id": "inst"},
) + " AND k % 2 = 0")

PROCESS = Feed(200, "ev", "event_id", {
    1: "100 + k % 7", 4: TV, 105: "'core'", 107: "concat('4.', k)", 104: "'2024-01-01'", 102: "event_id",
})
register("process_events", "processevents", PROCESS.records, PROCESS.typed_sql(
    TABLES["processevents"].layout,
    {"processevent_id": arrival_sql("processevents", "event_id"), "instance_id": "inst"},
))

LOG_LIVE = Feed(202, "ev", "event_id", {
    1: "300", 4: TV, 73: "sec - 1", 74: "k * 1000", 72: "concat(svc, ';', k, chr(10), chr(10))",
})
register("log_data", "logentries", LOG_LIVE.records, LOG_LIVE.typed_sql(
    TABLES["logentries"].layout,
    {"logentry_id": arrival_sql("logentries", "event_id"), "instance_id": "inst",
     "logentry_data": "concat(svc, ';', CAST(k AS VARCHAR))", "realtime_data": "CAST(1 AS SMALLINT)",
     "inferred_data_extracted": "CAST(1 AS SMALLINT)"},
))

# ---- configuration ----------------------------------------------------------------------------
COMMAND_DEF = Feed(408, "part", "p_partkey", {
    4: ("1700000000", "0"), 127: "p_name", 14: "concat('/bin/', p_brand, ' -s ', p_size)",
}, config_type="p_partkey % 2")
register("commands", "commands", COMMAND_DEF.records, latest_sql(COMMAND_DEF.typed_sql(
    TABLES["commands"].layout,
    {"command_id": row_sql("commands", "inst", object_sql(12, "p_name"), "p_partkey % 2"), "instance_id": "inst",
     "config_type": "CAST(p_partkey % 2 AS SMALLINT)"},
), "instance_id, object_id, config_type"))

_PERIOD_RANGES = ["concat(p_size % 7, ':', p_size * 60, '-', p_size * 120)", "'6:0-86400'", "'2:broken'"]
PERIOD_DEF = Feed(409, "part", "p_partkey", {
    4: ("1700000000", "0"), 237: "concat('period ', p_partkey)", 236: "p_type", 238: _PERIOD_RANGES,
}, config_type="1")
_PERIOD_OBJECT = object_sql(9, "concat('period ', p_partkey)")
_PERIOD_ID = row_sql("timeperiods", "inst", "1", _PERIOD_OBJECT)
register("timeperiods", "timeperiods", PERIOD_DEF.records, PERIOD_DEF.typed_sql(
    TABLES["timeperiods"].layout,
    {"timeperiod_id": _PERIOD_ID, "instance_id": "inst", "config_type": "CAST(1 AS SMALLINT)"},
))


def _range_sql(day, start, end):
    return f"""SELECT {row_sql('timeperiod_timeranges', _PERIOD_ID, day, start, end)} AS timeperiod_timerange_id,
        inst AS instance_id, {_PERIOD_ID} AS timeperiod_id, CAST({day} AS SMALLINT) AS day,
        CAST({start} AS INTEGER) AS start_sec, CAST({end} AS INTEGER) AS end_sec FROM ({feeds.source_sql('part')})"""


register("timeperiod_ranges", "timeperiod_timeranges", PERIOD_DEF.records,
         _range_sql("p_size % 7", "p_size * 60", "p_size * 120") + " UNION ALL " + _range_sql("6", "0", "86400"))

_CONTACT_ROW = row_sql("contacts", "inst", "s_suppkey % 2", object_sql(10, "contact"))


def _address_sql(number, address):
    return f"""SELECT {row_sql('contact_addresses', _CONTACT_ROW, number)} AS contact_address_id, inst AS instance_id,
        {_CONTACT_ROW} AS contact_id, CAST({number} AS SMALLINT) AS address_number, {address} AS address
        FROM ({feeds.source_sql('contact')})"""


register("contact_addresses", "contact_addresses", CONTACT_DEF.records,
         _address_sql("1", "contact") + " UNION ALL " + _address_sql("2", "concat('sms:', s_suppkey)"))


def _notify_sql(kind, command, args):
    command_id = object_sql(12, command)
    return f"""SELECT {row_sql('contact_notificationcommands', _CONTACT_ROW, kind, command_id, args)}
        AS contact_notificationcommand_id, inst AS instance_id, {_CONTACT_ROW} AS contact_id,
        CAST({kind} AS SMALLINT) AS notification_type, {command_id} AS command_object_id, {args} AS command_args
        FROM ({feeds.source_sql('contact')})"""


register("contact_notification_commands", "contact_notificationcommands", CONTACT_DEF.records, " UNION ALL ".join([
    _notify_sql("0", "'mail'", "CAST(s_suppkey AS VARCHAR)"), _notify_sql("1", "'page'", "''"),
    _notify_sql("1", "'sms'", "concat('a!', s_suppkey)"),
]))
register("contact_definitions", "contacts", CONTACT_DEF.records, CONTACT_DEF.typed_sql(
    TABLES["contacts"].layout,
    {"contact_id": _CONTACT_ROW, "instance_id": "inst", "config_type": "CAST(s_suppkey % 2 AS SMALLINT)"},
))
register("host_definitions", "hosts", HOST_DEF.records, HOST_DEF.typed_sql(
    TABLES["hosts"].layout,
    {"host_id": row_sql("hosts", "inst", "c_custkey % 2", object_sql(1, "host")), "instance_id": "inst",
     "config_type": "CAST(c_custkey % 2 AS SMALLINT)"},
))

# ---- edges ------------------------------------------------------------------------------------
PARENTS = Feed(400, "parent", "c_custkey", {
    4: ("1700000000", "0"), 174: "host", 200: ["parent", "host"], 130: ["concat('cg', c_custkey % 3)"], 264: ["'root'", "parent"],
    262: ["concat('RACK:', c_custkey % 2, ':r', c_custkey, ':x')", "'EMPTY:0'", "'BAD'"],
})
_PARENT_HOST = row_sql("hosts", "inst", "0", object_sql(1, "host"))


def _edge_sql(table, id_column, member, objects):
    return f"""SELECT DISTINCT {row_sql(table, _PARENT_HOST, 'm')} AS {id_column}, instance_id, {_PARENT_HOST} AS host_id,
        m AS {member} FROM (SELECT *, inst AS instance_id, unnest([{', '.join(objects)}]) AS m
        FROM ({feeds.source_sql('parent')}))"""


register("parents_edges", "host_parenthosts", PARENTS.records, _edge_sql(
    "host_parenthosts", "host_parenthost_id", "parent_host_object_id", [object_sql(1, "parent"), object_sql(1, "host")]))
register("host_contacts", "host_contacts", PARENTS.records, _edge_sql(
    "host_contacts", "host_contact_id", "contact_object_id", [object_sql(10, "'root'"), object_sql(10, "parent")]))
register("host_contactgroups", "host_contactgroups", PARENTS.records, _edge_sql(
    "host_contactgroups", "host_contactgroup_id", "contactgroup_object_id", [object_sql(11, "concat('cg', c_custkey % 3)")]))


def _variable_sql(name, modified, value):
    return f"""SELECT {row_sql('customvariables', object_sql(1, 'host'), '0', name)} AS customvariable_id,
        inst AS instance_id, {object_sql(1, 'host')} AS object_id, CAST(0 AS SMALLINT) AS config_type,
        CAST({modified} AS SMALLINT) AS has_been_modified, {name} AS varname, {value} AS varvalue
        FROM ({feeds.source_sql('parent')})"""


register("custom_variables", "customvariables", PARENTS.records,
         _variable_sql("'RACK'", "c_custkey % 2", "concat('r', c_custkey, ':x')") + " UNION ALL "
         + _variable_sql("'EMPTY'", "0", "''"))

STATUS_VARS = Feed(213, "ev", "event_id", {**SERVICE_STATUS.fields, 262: ["concat('K:', k % 2, ':', k)"]})
register("custom_variable_status", "customvariablestatus", STATUS_VARS.records, latest_sql(f"""
    SELECT {row_sql('customvariablestatus', object_sql(2, 'host', 'svc'), "'K'")} AS customvariablestatus_id,
    inst AS instance_id, {object_sql(2, 'host', 'svc')} AS object_id, {stamp_sql('sec')} AS status_update_time,
    CAST(k % 2 AS SMALLINT) AS has_been_modified, 'K' AS varname, CAST(k AS VARCHAR) AS varvalue, event_id AS ord
    FROM ({feeds.source_sql('ev')})""", "object_id, varname"))

HOST_DEPENDENCY = Feed(404, "parent", "c_custkey", {
    4: ("1700000000", "0"), 174: "parent", 136: "host", 135: "c_custkey % 2", 181: "1", 259: "'24x7'", 147: "1", 150: "c_custkey % 3 % 2",
})
_HD = [object_sql(1, "parent"), object_sql(1, "host"), "c_custkey % 2", "1", "0", "1", "c_custkey % 3 % 2"]
register("dependencies", "hostdependencies", HOST_DEPENDENCY.records, HOST_DEPENDENCY.typed_sql(
    TABLES["hostdependencies"].layout,
    {"hostdependency_id": row_sql("hostdependencies", "inst", "0", *_HD), "instance_id": "inst",
     "config_type": "CAST(0 AS SMALLINT)"},
))

SERVICE_DEPENDENCY = Feed(405, "svc", "c_custkey", {
    4: ("1700000000", "0"), 174: "host", 210: "svc", 136: "host", 137: "'ping'", 135: "1", 148: "1", 146: "c_custkey % 2",
})
_SD = [object_sql(2, "host", "svc"), object_sql(2, "host", "'ping'"), "1", "0", "1", "0", "0", "c_custkey % 2"]
register("service_dependencies", "servicedependencies", SERVICE_DEPENDENCY.records, SERVICE_DEPENDENCY.typed_sql(
    TABLES["servicedependencies"].layout,
    {"servicedependency_id": row_sql("servicedependencies", "inst", "0", *_SD), "instance_id": "inst",
     "config_type": "CAST(0 AS SMALLINT)", "service_object_id": object_sql(2, "host", "svc"),
     "dependent_service_object_id": object_sql(2, "host", "'ping'")},
))

# one escalation per host and first notification; a later order of the host replaces an earlier one
ESCALATION = Feed(406, "ord", "o_orderkey", {
    4: ("1700000000", "0"), 174: "host", 145: "o_orderpriority", 153: "o_orderkey % 3", 182: "0", 188: "o_totalprice",
    141: "o_orderkey % 2", 140: "1", 130: ["o_orderpriority"], 264: ["concat('c', o_orderkey % 4)"],
})
_ESC_ID = row_sql("hostescalations", "inst", "0", object_sql(1, "host"), object_sql(9, "o_orderpriority"), "o_orderkey % 3", "0")
register("escalations", "hostescalations", ESCALATION.records, latest_sql(ESCALATION.typed_sql(
    TABLES["hostescalations"].layout,
    {"hostescalation_id": _ESC_ID, "instance_id": "inst", "config_type": "CAST(0 AS SMALLINT)"},
), "instance_id, config_type, host_object_id, timeperiod_object_id, first_notification, last_notification"))
_ESC_CONTACT = object_sql(10, "concat('c', o_orderkey % 4)")
register("escalation_contacts", "hostescalation_contacts", ESCALATION.records, f"""
    SELECT DISTINCT {row_sql('hostescalation_contacts', _ESC_ID, _ESC_CONTACT)} AS hostescalation_contact_id,
    inst AS instance_id, {_ESC_ID} AS hostescalation_id, {_ESC_CONTACT} AS contact_object_id
    FROM ({feeds.source_sql('ord')})""")

SERVICE_ESCALATION = Feed(407, "svc", "c_custkey", {
    4: ("1700000000", "0"), 174: "host", 210: "svc", 145: "'24x7'", 153: "2", 182: "5", 188: "30.5", 144: "1", 139: "c_custkey % 2",
})
register("service_escalations", "serviceescalations", SERVICE_ESCALATION.records, SERVICE_ESCALATION.typed_sql(
    TABLES["serviceescalations"].layout,
    {"serviceescalation_id": row_sql(
        "serviceescalations", "inst", "0", object_sql(2, "host", "svc"), object_sql(9, "'24x7'"), "2", "5"),
     "instance_id": "inst", "config_type": "CAST(0 AS SMALLINT)", "service_object_id": object_sql(2, "host", "svc")},
))

# ---- name/value records -----------------------------------------------------------------------
CONFIG_FILE = Feed(300, "part", "p_partkey", {
    4: ("1700000000", "0"), 21: "concat('/etc/', p_brand, '.cfg')",
    22: ["concat('name=', p_name)", "concat('name=', p_type, '=x')", "'flag'"],
})
_FILE_ID = row_sql("configfiles", "inst", "0", "concat('/etc/', p_brand, '.cfg')")
register("config_files", "configfiles", CONFIG_FILE.records, f"""SELECT DISTINCT {_FILE_ID} AS configfile_id,
    inst AS instance_id, CAST(0 AS SMALLINT) AS configfile_type, concat('/etc/', p_brand, '.cfg') AS configfile_path
    FROM ({feeds.source_sql('part')})""")
register("config_file_variables", "configfilevariables", CONFIG_FILE.records, " UNION ALL ".join(
    f"""SELECT {hash_sql("'configfilevariables'", "''", 'p_partkey', pos)} AS configfilevariable_id,
    inst AS instance_id, {_FILE_ID} AS configfile_id, {name} AS varname, {value} AS varvalue
    FROM ({feeds.source_sql('part')})"""
    for pos, name, value in (("0", "'name'", "p_name"), ("1", "'name'", "concat(p_type, '=x')"), ("2", "'flag'", "''"))
))

RUNTIME = Feed(303, "ev", "event_id", {4: TV, 112: ["concat('last_', svc, '=', k)", "concat('seen=', event_id)"]})
register("runtime_variables", "runtimevariables", RUNTIME.records, latest_sql(" UNION ALL ".join(
    f"""SELECT {row_sql('runtimevariables', 'inst', name)} AS runtimevariable_id, inst AS instance_id, {name} AS varname,
    CAST({value} AS VARCHAR) AS varvalue, event_id AS ord FROM ({feeds.source_sql('ev')})"""
    for name, value in (("concat('last_', svc)", "k"), ("'seen'", "event_id"))
), "instance_id, varname"))
