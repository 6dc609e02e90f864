"""Archived plain-text logs and the spool of unsent protocol text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wire
from . import dump


def read_archive_log(spark: SparkSession, paths, instance_name: str = "default") -> DataFrame:
    """Archived logs as LOGENTRY records, one per line.

    A log line needs nothing from its neighbours and is identified by its content, so its split is
    position enough and no shuffle is needed.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    text = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return archive_records(
        text.withColumn(
            "arrival", F.struct(
                F.lit(0).cast("bigint").alias("batch"), F.col("file").alias("rank"), "file", F.col("block").alias("offset"))
        ),
        instance_name,
    ).withColumn("chunk", F.struct("arrival.file", F.col("arrival.offset").alias("n")))


def archive_records(lines: DataFrame, instance_name: str = "default") -> DataFrame:
    """Records of type 100 from a ``value`` column of raw log lines."""
    return lines.select(
        "arrival",
        F.lit(instance_name).alias("instance_name"),
        F.lit(100).alias("rec_type"),
        wire.encode_body((72, "value")).alias("body"),
    )


def read_spool(spark: SparkSession, path: str) -> DataFrame:
    """Spool files hold one escaped protocol chunk per line; give back the plain chunks in order."""
    return spark.read.text(path).select(
        wire.unescape("value").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def spool_frames(spool: DataFrame) -> DataFrame:
    """Frames of a spool.  A chunk is always written as whole records, so each line re-frames alone."""
    pieces = F.posexplode(F.split(F.col("value"), r"\n999\n\n", -1)).alias("pos", "piece")
    exploded = spool.select("file", "block", pieces)
    return exploded.where(F.length(F.trim(F.replace("piece", F.lit("\n"), F.lit("")))) > 0).select(
        F.col("piece").alias("value"), "file", "block", F.lit(None).cast("bigint").alias("file_size"),
        F.lit(None).cast("timestamp").alias("file_time"),
    )


def read_spool_records(spark: SparkSession, path: str, instance_name: str = "default") -> DataFrame:
    """Decoded records of a spool.  A spool carries no session header, so the caller names its sender."""
    return dump.decode(spool_frames(read_spool(spark, path)), instance_name=instance_name)
