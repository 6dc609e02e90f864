"""Deterministic 60-bit ids.

Ids are hashes of natural keys, so a name resolves to its id inside the row that mentions it: no
lookup join, no sequence, and the same id from any task, run or batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .wire import as_col, literal

_MARK = "\u0001"

# fixed values: object types
HOST, SERVICE, HOSTGROUP, SERVICEGROUP = 1, 2, 3, 4
TIMEPERIOD, CONTACT, CONTACTGROUP, COMMAND = 9, 10, 11, 12


def hash60(*parts) -> Column:
    text = F.concat_ws(_MARK, *[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def object_id(instance, objecttype, name1, name2=None) -> Column:
    """Id of a named object; 0 when both names are empty.  Names compare case-sensitively."""
    first = F.coalesce(as_col(name1), F.lit(""))
    second = F.lit("") if name2 is None else F.coalesce(as_col(name2), F.lit(""))
    kind = objecttype if isinstance(objecttype, Column) else F.lit(objecttype)
    return F.when((first == "") & (second == ""), F.lit(0).cast("bigint")).otherwise(
        hash60(instance, kind, first, second)
    )


def row_id(table: str, *key) -> Column:
    """Id of a row from its unique key; times enter as epoch seconds."""
    return hash60(F.lit(table), *key)


def object_id_sql(objecttype: int, name1: str, name2: str = "''") -> str:
    """SQL text of :func:`object_id` for the instance of the row."""
    parts = f"CAST(instance_id AS STRING), '{objecttype}', {name1}, {name2}"
    text = f"concat_ws({literal(_MARK)}, {parts})"
    return (
        f"CASE WHEN {name1} = '' AND {name2} = '' THEN 0L ELSE "
        f"CAST(conv(substr(md5(CAST({text} AS BINARY)), 1, 15), 16, 10) AS BIGINT) END"
    )
