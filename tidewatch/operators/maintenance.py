"""Retention, restart and deletion rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .lookup import per_instance

# fixed values: table -> (time column, default age in minutes)
RETENTION = {
    "timedevents": ("scheduled_time", 1440),
    "systemcommands": ("start_time", 10080),
    "servicechecks": ("start_time", 10080),
    "hostchecks": ("start_time", 10080),
    "eventhandlers": ("start_time", 44640),
    "externalcommands": ("entry_time", 44640),
    "notifications": ("start_time", 44640),
    "contactnotifications": ("start_time", 44640),
    "contactnotificationmethods": ("start_time", 44640),
    "logentries": ("entry_time", 129600),
    "acknowledgements": ("entry_time", 44640),
}


def trim(rows: DataFrame, table: str, as_of: Column, minutes: int | None = None) -> DataFrame:
    """Keep rows not older than the table's age; 0 keeps everything.

    With an ``event_date`` partition column the bound is repeated on it, so whole days are pruned.
    """
    field, default = RETENTION[table]
    age = default if minutes is None else minutes
    if not age:
        return rows
    bound = as_of - F.expr(f"INTERVAL {age} MINUTES")
    kept = rows.where(F.col(field) >= bound)
    return kept.where(F.col("event_date") >= F.to_date(bound)) if "event_date" in rows.columns else kept


def restart_points(process_events: DataFrame, order="arrival") -> DataFrame:
    """Arrival of the last start of each instance (``process_events`` is gated and typed)."""
    starts = process_events.where(F.col("neb_type") == 104)
    return starts.groupBy("instance_id").agg(F.max(order).alias("restart"))


def after_restart(rows: DataFrame, restarts: DataFrame | None, order="arrival") -> DataFrame:
    """Drop what arrived before the last start of its instance."""
    if restarts is None:
        return rows
    # rows exploded from a record carry (arrival of the record, position in it)
    kind = rows.schema[order].dataType
    at = f"{order}.arrival" if isinstance(kind, StructType) and "arrival" in kind.names else order
    joined = per_instance(rows, restarts)
    return joined.where(F.col("restart").isNull() | (F.col(at) > F.col("restart"))).drop("restart")


def clear_instance(rows: DataFrame, instance_id: int) -> DataFrame:
    return rows.where(F.col("instance_id") != instance_id)


def deactivate_all(objects: DataFrame, instance_id: int | None = None) -> DataFrame:
    hit = F.lit(True) if instance_id is None else F.col("instance_id") == instance_id
    return objects.withColumn("is_active", F.when(hit, 0).otherwise(F.col("is_active")).cast("smallint"))
