"""Places of rows within their key, without ever gathering a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, sent_if_small

#: rows of (key, range) sent to all workers, some 100 bytes each; beyond that they are joined by a shuffle
SENT_RUNS = 100_000


def ranked(spark: SparkSession, rows: DataFrame, key: str, order: list, ranges: list | None = None) -> DataFrame:
    """The rows with ``_pos``, their place within ``key`` from 0 ascending by ``order``, and ``_n``, the rows of their key.

    Rows are dealt by ranges of (key, ``ranges``), so a hot key spreads over many tasks; ``ranges`` (``order`` unless
    given) has to be short, since a sample of it passes through the driver, and coarser than ``order`` or equal to it.
    Rows that tie in all of it are told apart by where they were read, so ``rows`` should come from a saved table.
    The key must not be null.  The dealt rows are written once; places come from one count per key and range.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = order if ranges is None else ranges
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(key, *ranges, "_tie")
    dealt = dealt.sortWithinPartitions(key, *order, "_tie").drop("_tie")
    placed = save(spark, dealt.withColumn("_seq", F.monotonically_increasing_id()), "ranked")
    # the upper bits of the id are the number of the range
    placed = placed.withColumn("_range", F.shiftright("_seq", 33))
    runs = placed.groupBy(key, "_range").agg(F.count("*").alias("_here"), F.min("_seq").alias("_first"))
    # a key has at most one run a range
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        key, "_range", (F.coalesce(F.sum("_here").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_here").over(Window.partitionBy(key)).alias("_n"))
    joined = placed.join(sent_if_small(save(spark, runs, "runs"), SENT_RUNS), [key, "_range"])
    return joined.select(*rows.columns, (F.col("_seq") + F.col("_shift")).alias("_pos"), "_n")


def looked_up(rows: DataFrame, values: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """The rows with the columns of ``values``, which holds each key once; rows without a match are left out.

    ``weight`` is the number of rows of a key and ``total`` that of all.  Fewer than 1000 keys can hold more than a
    thousandth of the rows each; these are broadcast, so that no task gets a hot key's rows by a shuffle.
    """
    often = F.col(weight) * 1000 > total
    rest = values.where(~often).drop(weight)
    hot = F.broadcast(values.where(often).drop(weight))
    cold = rows.join(hot.select(key), key, "left_anti").join(rest, key)
    return rows.join(hot, key).unionByName(cold)
