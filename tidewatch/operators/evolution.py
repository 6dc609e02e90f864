"""Schema evolution: bring a table written under an older schema version up to the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Versions in order and the column changes each one brought.
VERSIONS = ("1.2", "1.3", "1.4b1", "1.4b2", "1.4b8", "2.0.0", "2.1.2")
ADDED = {
    "1.3": {
        "hosts": """
            notes string, notes_url string, action_url string, icon_image string, icon_image_alt string,
            vrml_image string, statusmap_image string, have_2d_coords smallint, x_2d smallint, y_2d smallint,
            have_3d_coords smallint, x_3d double, y_3d double, z_3d double, first_notification_delay double,
            notify_on_downtime smallint, retry_interval double, flap_detection_on_up smallint,
            flap_detection_on_down smallint, flap_detection_on_unreachable smallint, display_name string
        """,
        "services": """
            notes string, notes_url string, action_url string, icon_image string, icon_image_alt string,
            first_notification_delay double, notify_on_downtime smallint, flap_detection_on_ok smallint,
            flap_detection_on_warning smallint, flap_detection_on_unknown smallint,
            flap_detection_on_critical smallint, display_name string
        """,
        "contacts": """
            host_notifications_enabled smallint, service_notifications_enabled smallint,
            can_submit_commands smallint, notify_host_downtime smallint, notify_service_downtime smallint
        """,
        "hoststatus": "check_timeperiod_object_id bigint",
        "servicestatus": "check_timeperiod_object_id bigint",
        "hostdependencies": "timeperiod_object_id bigint",
        "servicedependencies": "timeperiod_object_id bigint",
    },
    "1.4b1": {
        "services": "host_object_id bigint",
        "hosts": "alias string",
        "statehistory": "last_state smallint -1, last_hard_state smallint -1",
    },
    "1.4b2": {"hosts": "alias string"},
    "1.4b8": dict.fromkeys(
        ("hostchecks", "hoststatus", "servicechecks", "servicestatus", "statehistory", "eventhandlers",
         "systemcommands", "notifications"),
        "long_output string",
    ),
    "2.0.0": {
        "contacts": "minimum_importance int",
        "hosts": "importance int",
        "services": "importance int",
    },
}
CAST = {
    "1.3": {
        "hostescalations": "notification_interval double",
        "serviceescalations": "notification_interval double",
        "services": "check_interval double, retry_interval double, notification_interval double",
        "hosts": "check_interval double, notification_interval double",
        "hoststatus": "normal_check_interval double, retry_check_interval double",
        "servicestatus": "normal_check_interval double, retry_check_interval double",
    },
    "2.1.2": {"scheduleddowntime": "duration int"},
}
DROPPED = {"1.3": {"services": "parallelize_check"}}


def _parts(text: str) -> list[list[str]]:
    return [item.split() for item in text.split(",") if item.split()]


def step(rows: DataFrame, table: str, version: str) -> DataFrame:
    """The column changes one version brought.  New columns are filled as the store filled them."""
    for name, kind, *default in _parts(ADDED.get(version, {}).get(table, "")):
        if name not in rows.columns:
            empty = "" if kind == "string" else 0
            rows = rows.withColumn(name, F.lit(default[0] if default else empty).cast(kind))
    for name, kind in _parts(CAST.get(version, {}).get(table, "")):
        if name in rows.columns:
            rows = rows.withColumn(name, F.col(name).cast(kind))
    return rows.drop(*[name for (name,) in _parts(DROPPED.get(version, {}).get(table, ""))])


def current_name(name: str, prefixes=()) -> str:
    """Table name without a deployment's prefix."""
    for prefix in prefixes:
        if name.startswith(prefix):
            return name[len(prefix):]
    return name


def evolve(rows: DataFrame, table: str, from_version: str, prefixes=()) -> DataFrame:
    """Apply every change after ``from_version``: projections only, no data movement."""
    table = current_name(table, prefixes)
    for version in VERSIONS[VERSIONS.index(from_version) + 1:]:
        rows = step(rows, table, version)
    return rows


def dbversion(spark, version: str = VERSIONS[-1]) -> DataFrame:
    return spark.createDataFrame([("tidewatch", version)], "name STRING, version STRING")
