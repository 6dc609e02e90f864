"""Helpers shared by the operators: folds, ASCII case, shared scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: str.translate table that lower-cases A-Z alone
ASCII_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER)}


def fold(key: str, parts: int) -> Column:
    """crc32 of the key's text modulo ``parts``; NULL for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage and survives lost executors."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: bytes of the rows that one batch sends to a Python worker
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Cut what goes to Python workers by bytes, unless the session asks for less.

    Spark's bound is 64 MB: each task then holds that much in Arrow buffers, and its worker several times that in Python
    objects, and both processes keep what they once took.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def sent_if_small(frame: DataFrame, most: int) -> DataFrame:
    """A frame of keys marked for broadcast if it has at most ``most`` rows; otherwise the planner joins it."""
    return F.broadcast(frame) if frame.count() <= most else frame


#: longest key a memo keeps, in characters: a text without spaces is one key
REMEMBERED = 64


class Memo(dict):
    """Values by key, computed where missing, in two generations of at most ``size`` entries of short keys.

    When the younger one is full it becomes the older one, so what is met often stays known.
    """

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > REMEMBERED:
                return value
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
