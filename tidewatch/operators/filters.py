"""Predicates that decide which records reach which table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from .lookup import per_instance

# fixed values: data class bit -> record types
CLASS_BITS = {
    1: (200,), 2: (201,), 4: (202,), 8: (203,), 16: (204,), 32: (205, 220, 221), 64: (206,), 128: (207,),
    256: (208,), 512: (209,), 1024: (210,), 2048: (211,), 4096: (212,), 8192: (213,), 16384: (214,),
    32768: (215,), 65536: (216,), 131072: (217,), 262144: tuple(range(400, 415)) + (900, 901),
    524288: (300, 301, 302, 303), 1048576: (218,), 2097152: (219,), 4194304: (222,), 8388608: (223,),
    16777216: (224,), 33554432: (225,),
}


def enabled_types(options: int) -> list[int]:
    """Record types switched on by a bit mask; contact notifications follow notifications."""
    return sorted(t for bit, types in CLASS_BITS.items() if options < 0 or options & bit for t in types)


def class_filter(records: DataFrame, options: int) -> DataFrame:
    return records.where(F.col("rec_type").isin(enabled_types(options)))


def config_dump_filter(records: DataFrame, option: int) -> DataFrame:
    """0 none, 1 original, 2 retained, 3 both; only definition records are touched."""
    wanted = [kind for kind, bit in ((0, 1), (1, 2)) if option & bit]
    return records.where(~F.col("rec_type").between(400, 411) | F.col("config_type").isin(wanted))


def stored_service_check(neb_type) -> Column:
    return wire.as_col(neb_type).isin(700, 701)


def sent_service_check(neb_type) -> Column:
    return wire.as_col(neb_type) == 701


def stored_host_check(neb_type) -> Column:
    return ~wire.as_col(neb_type).isin(804, 805)


def sent_host_check(neb_type) -> Column:
    return wire.as_col(neb_type) == 801


def finished_state_change(neb_type) -> Column:
    return wire.as_col(neb_type) == 1801


def started_external_command(neb_type) -> Column:
    return wire.as_col(neb_type) == 1400


def awake_timed_event(neb_type) -> Column:
    return wire.as_col(neb_type) != 205


def realtime_gate(rows: DataFrame, cutoff: DataFrame | None, seconds: Column) -> DataFrame:
    """Drop rows older than the cutoff of their instance; a row at the cutoff stays."""
    if cutoff is None:
        return rows
    gated = per_instance(rows, cutoff.select("instance_id", F.col("cutoff").alias("_cutoff")))
    return gated.where(F.col("_cutoff").isNull() | (seconds >= F.col("_cutoff"))).drop("_cutoff")


def instance_scope(rows: DataFrame, instance_id: int) -> DataFrame:
    return rows.where(F.col("instance_id") == instance_id)


def retained_config(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("config_type") == 1)


def past_events(rows: DataFrame, as_of) -> DataFrame:
    return rows.where(F.col("scheduled_time") < as_of)
