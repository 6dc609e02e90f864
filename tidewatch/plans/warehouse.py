"""All tables of a warehouse from one set of decoded records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wire
from ..operators import aggregates, dimensions, filters, maintenance
from ..session import ensure_checkpoint_dir
from ..sources import dump
from . import config, current, history
from .table import Context, Table, event_second, neb_type

TABLES: dict[str, Table] = {**history.HISTORY, **current.CURRENT, **config.CONFIG}


def context(events: DataFrame, cutoff: DataFrame | None = None) -> Context:
    """Gate values of a run: the fixed cutoff, and each instance's last start that passes it."""
    process = filters.realtime_gate(events.where(F.col("rec_type") == 200), cutoff, event_second())
    starts = process.select("instance_id", "arrival", neb_type().alias("neb_type"))
    return Context(cutoff=cutoff, restarts=maintenance.restart_points(starts))


def build_tables(
    events: DataFrame,
    instances: DataFrame | None = None,
    cutoff: DataFrame | None = None,
    stored_objects: DataFrame | None = None,
    only=None,
) -> dict[str, DataFrame]:
    """Lazy plans for the asked tables; every plan reads only its own record types and columns."""
    ctx = context(events, cutoff)
    out = {}
    for name, table in TABLES.items():
        if (only is None and name not in history.OPTIONAL) or (only is not None and name in only):
            out[name] = table.build(events, ctx)
    if only is None or "objects" in only:
        out["objects"] = dimensions.build_objects(events, cutoff, ctx.restarts, stored_objects)
    if instances is not None:
        out["instances"] = instances
    return out


def load_dump(
    spark: SparkSession,
    paths,
    stored_instances: DataFrame | None = None,
    cutoff: DataFrame | None = None,
    options: int = -1,
    work_dir: str | None = None,
    by_time: bool = False,
) -> dict[str, DataFrame]:
    """Dump files -> tables, with the session audit and the rejects.  ``by_time`` orders the files as last written.

    The decoded layer is written once, partitioned by record type, so the tables do not decode the text
    again and each reads one partition.
    """
    decoded = saved_decoded(spark, dump.read_dump(spark, paths, by_time=by_time), work_dir)
    names = decoded.where(F.col("header.protocol") == wire.PROTOCOL_VERSION).select("header.instance_name")
    instances = dimensions.get_or_insert_instances(names, stored_instances)
    events = dimensions.assign_instance(dump.records(decoded), instances)
    if options >= 0:
        events = filters.class_filter(events, options)
    tables = build_tables(events, instances, cutoff)
    tables["conninfo"] = aggregates.session_audit(decoded, instances)
    tables["rejects"] = dump.rejects(decoded)
    return tables


def saved_decoded(spark: SparkSession, decoded: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Write decoded rows to the shared folder and read them back."""
    folder = work_dir or f"{ensure_checkpoint_dir(spark)}/decoded-{uuid.uuid4().hex}"
    save_decoded(decoded, folder)
    return spark.read.schema(decoded.schema).parquet(folder)


def save_decoded(decoded: DataFrame, path: str, mode: str = "append") -> None:
    """Decoded layer, partitioned by record type: each table builder then reads one partition.

    The rebalance splits the types that hold most of the records and gathers the rare ones, so files
    come out even-sized whatever the mix is.
    """
    decoded.hint("rebalance", "rec_type").write.mode(mode).partitionBy("rec_type").parquet(path)


def save_history(rows: DataFrame, path: str, date_column: str, mode: str = "append") -> None:
    """Append typed history rows by instance and event date."""
    dated = rows.withColumn("event_date", F.to_date(date_column))
    dated = dated.hint("rebalance", "instance_id", "event_date")
    dated.write.mode(mode).partitionBy("instance_id", "event_date").parquet(path)
