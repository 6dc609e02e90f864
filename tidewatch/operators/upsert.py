"""Insert-or-update by unique key, decided by arrival order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(rows: DataFrame, keys, insert_only=(), order="arrival", keep_order=False) -> DataFrame:
    """One row per key: the last arrival wins, ``insert_only`` columns keep the first arrival's value.

    Written as an aggregate, not as a ranking window: each task reduces its rows to one per key before
    the shuffle, so a key that holds a third of the table costs one row per task.
    """
    keys, insert_only = list(keys), list(insert_only)
    updated = [c for c in rows.columns if c not in keys and c not in insert_only and c != order]
    aggregates = [F.max_by(F.struct(*updated), order).alias("_last")] if updated else []
    if insert_only:
        aggregates.append(F.min_by(F.struct(*insert_only), order).alias("_first"))
    if keep_order or not aggregates:
        aggregates.append(F.max(order).alias(order))
    merged = rows.groupBy(*keys).agg(*aggregates)
    source = {c: c for c in keys}
    source.update({c: f"_last.{c}" for c in updated})
    source.update({c: f"_first.{c}" for c in insert_only})
    if keep_order:
        source[order] = order
    return merged.select(*[F.col(source[c]).alias(c) for c in rows.columns if c in source])


def latest_by_key(rows: DataFrame, keys, order="arrival") -> DataFrame:
    return upsert(rows, keys, order=order, keep_order=True)


def upsert_into(stored: DataFrame, rows: DataFrame, keys, insert_only=(), order="arrival") -> DataFrame:
    """Merge new rows into a stored table; both sides carry ``order``, stored rows with earlier values."""
    return upsert(stored.unionByName(rows), keys, insert_only, order, keep_order=True)
