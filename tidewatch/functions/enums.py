"""Numeric codes and their labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .wire import as_col

# Fixed values.  Note that the host/service polarity differs between classes.
ENUMS: dict[str, dict[int, str]] = {
    "service_state": {0: "OK", 1: "WARNING", 2: "CRITICAL", 3: "UNKNOWN"},
    "host_state": {0: "UP", 1: "DOWN", 2: "UNREACHABLE"},
    "state_type": {0: "SOFT", 1: "HARD"},
    "downtime_type": {1: "SERVICE", 2: "HOST"},
    "comment_type": {1: "HOST", 2: "SERVICE"},
    "acknowledgement_type": {0: "HOST", 1: "SERVICE"},
    "notification_type": {0: "HOST", 1: "SERVICE"},
    "flapping_type": {0: "HOST", 1: "SERVICE"},
    "statechange_type": {0: "HOST", 1: "SERVICE"},
    "eventhandler_type": {0: "HOST", 1: "SERVICE", 2: "GLOBAL_HOST", 3: "GLOBAL_SERVICE"},
    "comment_entry_type": {1: "USER", 2: "DOWNTIME", 3: "FLAPPING", 4: "ACKNOWLEDGEMENT"},
    "notification_reason": {
        0: "NORMAL", 1: "ACKNOWLEDGEMENT", 2: "FLAPPINGSTART", 3: "FLAPPINGSTOP", 4: "FLAPPINGDISABLED",
        5: "DOWNTIMESTART", 6: "DOWNTIMEEND", 7: "DOWNTIMECANCELLED", 8: "CUSTOM",
    },
    "timed_event_type": {
        0: "SERVICE_CHECK", 1: "COMMAND_CHECK", 2: "LOG_ROTATION", 3: "PROGRAM_SHUTDOWN",
        4: "PROGRAM_RESTART", 5: "CHECK_REAPER", 6: "ORPHAN_CHECK", 7: "RETENTION_SAVE",
        8: "STATUS_SAVE", 9: "SCHEDULED_DOWNTIME", 10: "SFRESHNESS_CHECK", 11: "EXPIRE_DOWNTIME",
        12: "HOST_CHECK", 13: "HFRESHNESS_CHECK", 14: "RESCHEDULE_CHECKS", 15: "EXPIRE_COMMENT",
        16: "CHECK_PROGRAM_UPDATE", 98: "SLEEP", 99: "USER_FUNCTION",
    },
    "object_type": {
        1: "HOST", 2: "SERVICE", 3: "HOSTGROUP", 4: "SERVICEGROUP", 5: "HOSTESCALATION",
        6: "SERVICEESCALATION", 7: "HOSTDEPENDENCY", 8: "SERVICEDEPENDENCY", 9: "TIMEPERIOD",
        10: "CONTACT", 11: "CONTACTGROUP", 12: "COMMAND",
    },
    "record_type": {
        100: "LOGENTRY", 200: "PROCESSDATA", 201: "TIMEDEVENTDATA", 202: "LOGDATA",
        203: "SYSTEMCOMMANDDATA", 204: "EVENTHANDLERDATA", 205: "NOTIFICATIONDATA",
        206: "SERVICECHECKDATA", 207: "HOSTCHECKDATA", 208: "COMMENTDATA", 209: "DOWNTIMEDATA",
        210: "FLAPPINGDATA", 211: "PROGRAMSTATUSDATA", 212: "HOSTSTATUSDATA", 213: "SERVICESTATUSDATA",
        214: "ADAPTIVEPROGRAMDATA", 215: "ADAPTIVEHOSTDATA", 216: "ADAPTIVESERVICEDATA",
        217: "EXTERNALCOMMANDDATA", 218: "AGGREGATEDSTATUSDATA", 219: "RETENTIONDATA",
        220: "CONTACTNOTIFICATIONDATA", 221: "CONTACTNOTIFICATIONMETHODDATA", 222: "ACKNOWLEDGEMENTDATA",
        223: "STATECHANGEDATA", 224: "CONTACTSTATUSDATA", 225: "ADAPTIVECONTACTDATA",
        300: "MAINCONFIGFILEVARIABLES", 301: "RESOURCECONFIGFILEVARIABLES", 302: "CONFIGVARIABLES",
        303: "RUNTIMEVARIABLES", 400: "HOSTDEFINITION", 401: "HOSTGROUPDEFINITION",
        402: "SERVICEDEFINITION", 403: "SERVICEGROUPDEFINITION", 404: "HOSTDEPENDENCYDEFINITION",
        405: "SERVICEDEPENDENCYDEFINITION", 406: "HOSTESCALATIONDEFINITION",
        407: "SERVICEESCALATIONDEFINITION", 408: "COMMANDDEFINITION", 409: "TIMEPERIODDEFINITION",
        410: "CONTACTDEFINITION", 411: "CONTACTGROUPDEFINITION", 412: "HOSTEXTINFODEFINITION",
        413: "SERVICEEXTINFODEFINITION", 414: "ACTIVEOBJECTSLIST", 900: "STARTCONFIGDUMP",
        901: "ENDCONFIGDUMP",
    },
    "event_type": {
        0: "NONE", 1: "HELLO", 2: "GOODBYE", 3: "INFO", 100: "PROCESS_START", 101: "PROCESS_DAEMONIZE",
        102: "PROCESS_RESTART", 103: "PROCESS_SHUTDOWN", 104: "PROCESS_PRELAUNCH",
        105: "PROCESS_EVENTLOOPSTART", 106: "PROCESS_EVENTLOOPEND", 200: "TIMEDEVENT_ADD",
        201: "TIMEDEVENT_REMOVE", 202: "TIMEDEVENT_EXECUTE", 203: "TIMEDEVENT_DELAY",
        204: "TIMEDEVENT_SKIP", 205: "TIMEDEVENT_SLEEP", 206: "TIMEDEVENT_END", 300: "LOG_DATA",
        301: "LOG_ROTATION", 400: "SYSTEM_COMMAND_START", 401: "SYSTEM_COMMAND_END",
        500: "EVENTHANDLER_START", 501: "EVENTHANDLER_END", 600: "NOTIFICATION_START",
        601: "NOTIFICATION_END", 602: "CONTACTNOTIFICATION_START", 603: "CONTACTNOTIFICATION_END",
        604: "CONTACTNOTIFICATIONMETHOD_START", 605: "CONTACTNOTIFICATIONMETHOD_END",
        700: "SERVICECHECK_INITIATE", 701: "SERVICECHECK_PROCESSED", 702: "SERVICECHECK_RAW_START",
        703: "SERVICECHECK_RAW_END", 704: "SERVICECHECK_ASYNC_PRECHECK", 800: "HOSTCHECK_INITIATE",
        801: "HOSTCHECK_PROCESSED", 802: "HOSTCHECK_RAW_START", 803: "HOSTCHECK_RAW_END",
        804: "HOSTCHECK_ASYNC_PRECHECK", 805: "HOSTCHECK_SYNC_PRECHECK", 900: "COMMENT_ADD",
        901: "COMMENT_DELETE", 902: "COMMENT_LOAD", 1000: "FLAPPING_START", 1001: "FLAPPING_STOP",
        1100: "DOWNTIME_ADD", 1101: "DOWNTIME_DELETE", 1102: "DOWNTIME_LOAD", 1103: "DOWNTIME_START",
        1104: "DOWNTIME_STOP", 1200: "PROGRAMSTATUS_UPDATE", 1201: "HOSTSTATUS_UPDATE",
        1202: "SERVICESTATUS_UPDATE", 1203: "CONTACTSTATUS_UPDATE", 1300: "ADAPTIVEPROGRAM_UPDATE",
        1301: "ADAPTIVEHOST_UPDATE", 1302: "ADAPTIVESERVICE_UPDATE", 1303: "ADAPTIVECONTACT_UPDATE",
        1400: "EXTERNALCOMMAND_START", 1401: "EXTERNALCOMMAND_END", 1500: "AGGREGATEDSTATUS_STARTDUMP",
        1501: "AGGREGATEDSTATUS_ENDDUMP", 1600: "RETENTIONDATA_STARTLOAD", 1601: "RETENTIONDATA_ENDLOAD",
        1602: "RETENTIONDATA_STARTSAVE", 1603: "RETENTIONDATA_ENDSAVE", 1700: "ACKNOWLEDGEMENT_ADD",
        1701: "ACKNOWLEDGEMENT_REMOVE", 1702: "ACKNOWLEDGEMENT_LOAD", 1800: "STATECHANGE_START",
        1801: "STATECHANGE_END",
    },
}
# Definition record type -> object type.
DEFINITION_OBJECT_TYPES = {400: 1, 401: 3, 402: 2, 403: 4, 404: 7, 405: 8, 406: 5, 407: 6, 408: 12, 409: 9, 410: 10, 411: 11}


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode_enum(code, name: str) -> Column:
    """Label of a code, NULL when the code is unknown."""
    return F.try_element_at(_literal_map(ENUMS[name]), as_col(code).cast("int"))


def encode_enum(label, name: str) -> Column:
    return F.try_element_at(_literal_map({v: k for k, v in ENUMS[name].items()}), as_col(label))


def map_objecttype(rec_type) -> Column:
    return F.try_element_at(_literal_map(DEFINITION_OBJECT_TYPES), as_col(rec_type).cast("int"))


def enum_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(sorted(ENUMS[name].items()), "code INT, label STRING")
