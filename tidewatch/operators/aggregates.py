"""Per-instance and per-session aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from .lookup import per_instance

# table -> the time column that dates its newest realtime data
REALTIME_FIELDS = {
    "programstatus": "status_update_time",
    "hoststatus": "status_update_time",
    "servicestatus": "status_update_time",
    "contactstatus": "status_update_time",
    "timedeventqueue": "queued_time",
}


def latest_data_time(table: DataFrame, field: str) -> DataFrame:
    """Newest time per instance."""
    return table.groupBy("instance_id").agg(F.max(field).alias("latest_time"))


def realtime_cutoff(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Epoch second per instance before which current-state records are stale, never after ``as_of``."""
    latest = None
    for name, field in REALTIME_FIELDS.items():
        if name in tables:
            part = latest_data_time(tables[name], field)
            latest = part if latest is None else latest.unionByName(part)
    return latest.groupBy("instance_id").agg(
        F.least(F.unix_timestamp(F.max("latest_time")), F.unix_timestamp(as_of)).alias("cutoff")
    )


def session_audit(decoded: DataFrame, instances: DataFrame) -> DataFrame:
    """Connection audit: what each session carried and when it ran."""
    live = decoded.where(F.col("header").isNotNull() & (F.col("header.protocol") == 2))
    # partial aggregation first: a session may hold a third of all rows
    sums = live.groupBy("session").agg(
        F.first("header").alias("header"),
        F.sum("bytes").cast("bigint").alias("bytes_processed"),
        F.sum("lines").cast("bigint").alias("lines_processed"),
        F.count("rec_type").alias("entries_processed"),
    )
    ends = live.where(F.col("closes").isNotNull()).groupBy(F.col("closes").alias("session")).agg(
        F.max("end_time").alias("data_end_time")
    )
    audit = sums.join(ends, "session", "left").withColumn("instance_name", F.col("header.instance_name"))
    named = audit.join(F.broadcast(instances.select("instance_id", "instance_name")), "instance_name", "left")
    return named.select(
        ids.row_id("conninfo", "session.file", "session.number").alias("conninfo_id"),
        "instance_id",
        F.col("header.agent").alias("agent_name"),
        "header.agent_version",
        "header.disposition",
        "header.connect_source",
        "header.connect_type",
        F.col("header.start_time").alias("connect_time"),
        F.col("data_end_time").alias("disconnect_time"),
        F.coalesce("data_end_time", "header.start_time").alias("last_checkin_time"),
        F.col("header.start_time").alias("data_start_time"),
        "data_end_time",
        "bytes_processed",
        "lines_processed",
        "entries_processed",
    )


def runtime_totals(hosts: DataFrame, services: DataFrame) -> DataFrame:
    """Recomputed name/value totals per instance: hosts, services and services per host."""
    h = hosts.groupBy("instance_id").agg(F.count("*").alias("total_hosts"))
    s = services.groupBy("instance_id").agg(F.count("*").alias("total_services"))
    both = per_instance(h, s)
    total_s = F.coalesce("total_services", F.lit(0))
    values = F.map_from_arrays(
        F.array(F.lit("total_hosts"), F.lit("total_services"), F.lit("average_services_per_host")),
        F.array(
            F.col("total_hosts").cast("string"),
            total_s.cast("string"),
            F.format_string("%.5f", total_s / F.col("total_hosts")),
        ),
    )
    return both.select("instance_id", F.explode(values).alias("varname", "varvalue"))
