"""Order-dependent folds that survive hot groups.

A group (session, instance, comment, ...) may hold a third of all rows, so no window below spans a
group.  Rows carry ``chunk``, a bounded run of their arrival order: windows run inside (group, chunk),
chunk summaries are scanned per group (one small row per chunk), and the two are joined on
(group, chunk).  The result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def carry_forward(rows: DataFrame, group, value: Column, out: str, order="arrival", chunk="chunk") -> DataFrame:
    """Add ``out``: the last non-null ``value`` at or before each row of its group."""
    group, order = _names(group), _names(order)
    rows = rows.withColumn(out, value)
    position = F.struct(*order)
    summary = rows.groupBy(*group, chunk).agg(
        F.max_by(out, F.when(F.col(out).isNotNull(), position)).alias("_own")
    )
    earlier = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*group, chunk, F.last("_own", ignorenulls=True).over(earlier).alias("_in"))
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(summary, [*group, chunk])
        .withColumn(out, F.coalesce(F.last(out, ignorenulls=True).over(inside), "_in"))
        .drop("_in")
    )


def later_max(rows: DataFrame, group, value: Column, out: str, order="arrival", chunk="chunk") -> DataFrame:
    """Add ``out``: the largest ``value`` among the rows of the group that come after each row."""
    group, order = _names(group), _names(order)
    rows = rows.withColumn(out, value)
    summary = rows.groupBy(*group, chunk).agg(F.max(out).alias("_own"))
    # read backwards: a frame that grows from the start is aggregated incrementally, one that shrinks
    # towards the end would be aggregated anew for every row
    grows = (Window.unboundedPreceding, -1)
    following = Window.partitionBy(*group).orderBy(F.col(chunk).desc()).rowsBetween(*grows)
    summary = summary.select(*group, chunk, F.max("_own").over(following).alias("_in"))
    inside = Window.partitionBy(*group, chunk).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(*grows)
    return (
        rows.join(summary, [*group, chunk])
        .withColumn(out, F.greatest(F.max(out).over(inside), "_in"))
        .drop("_in")
    )


def live_items(ops: DataFrame, scope, item, first, last, order="arrival", chunk="chunk") -> DataFrame:
    """Fold adds and deletes: one row per item that was added after the last delete of its scope.

    ``ops`` has a boolean ``is_delete``.  A delete removes every item of its scope that arrived before
    it.  ``first`` columns come from the first add of the surviving life, ``last`` columns from the last;
    ``created`` and ``order`` are the arrivals of those two adds.
    """
    scope, item = _names(scope), _names(item)
    first, last = list(first), list(last)
    in_chunk = Window.partitionBy(*scope, chunk)
    ops = ops.withColumn("_deleted", F.max(F.when(F.col("is_delete"), F.col(order))).over(in_chunk))
    ops = ops.where(F.col("is_delete") | F.col("_deleted").isNull() | (F.col(order) > F.col("_deleted")))
    add = ~F.col("is_delete")
    added = F.when(add, F.col(order))
    reduced = ops.groupBy(*scope, chunk, "is_delete", *item).agg(
        F.max("_deleted").alias("_deleted"),
        F.min(added).alias("created"),
        F.max(added).alias(order),
        F.min_by(F.struct(*first), added).alias("_first"),
        F.max_by(F.struct(*last), added).alias("_last"),
    )
    # second level: one row per (item, chunk)
    reduced = reduced.withColumn("_deleted", F.max("_deleted").over(Window.partitionBy(*scope)))
    alive = reduced.where(add & (F.col("_deleted").isNull() | (F.col("created") > F.col("_deleted"))))
    merged = alive.groupBy(*scope, *item).agg(
        F.min_by("_first", "created").alias("_first"),
        F.max_by("_last", order).alias("_last"),
        F.min("created").alias("created"),
        F.max(order).alias(order),
    )
    return merged.select(
        *scope, *item, *[f"_first.{c}" for c in first], *[f"_last.{c}" for c in last], "created", order
    )
