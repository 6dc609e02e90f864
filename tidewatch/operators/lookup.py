"""Joins against dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_instance(rows: DataFrame, table: DataFrame, how: str = "left") -> DataFrame:
    """Join a table with one row per instance.

    ``instance_id`` is a SMALLINT, so such a table has at most 65,536 rows: broadcasting it is safe at
    any data size.
    """
    return rows.join(F.broadcast(table), "instance_id", how)


def with_instance(rows: DataFrame, instances: DataFrame, how: str = "left") -> DataFrame:
    return per_instance(rows, instances.select("instance_id", "instance_name"), how)


def with_object(rows: DataFrame, objects: DataFrame, key: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    """Look up object columns (source -> alias) by id.

    No hint: the planner broadcasts objects below its size threshold and otherwise sort-merges, where
    adaptive execution splits the partitions of objects that own most of the rows.
    """
    side = objects.select(F.col("object_id").alias(key), *[F.col(c).alias(a) for c, a in columns.items()])
    return rows.join(side, key, how)


def null_safe_lookup(names: DataFrame, objects: DataFrame, columns=("object_id",)) -> DataFrame:
    """Find objects by (instance, type, name1, name2) where an absent name matches an absent name."""
    keys = ["instance_id", "objecttype_id", "name1", "name2"]
    side = objects.select(*[F.col(k).alias(f"_{k}") for k in keys], *columns)
    match = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_{k}"))
        match = term if match is None else match & term
    return names.join(side, match, "left").drop(*[f"_{k}" for k in keys])


def attach_comment_time(flapping: DataFrame, comments: DataFrame) -> DataFrame:
    """Fill ``comment_time`` from the comment a flapping row refers to, where the row has none."""
    known = comments.groupBy("instance_id", "internal_comment_id").agg(F.max("comment_time").alias("_time"))
    return (
        flapping.join(known, ["instance_id", "internal_comment_id"], "left")
        .withColumn("comment_time", F.coalesce(F.nullif("comment_time", F.timestamp_seconds(F.lit(0))), "_time"))
        .drop("_time")
        .select(*flapping.columns)
    )
