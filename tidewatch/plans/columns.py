"""Typed projections declared as text.

A layout lists the columns of a table in order, one ``name kind key`` per line (or comma separated):

=======  ==========================================================
kind     value
=======  ==========================================================
i16 i32  integer attribute, fitted to the column's range
i64 f64  long / double attribute
str      text attribute
ts       attribute in epoch seconds as TIMESTAMP
tv us    seconds as TIMESTAMP / microseconds of a ``sec.usec`` attribute
objN     id of the object of type N named by the attribute
cmd arg  command id / arguments of a ``name!args`` attribute
=        given by the builder
=======  ==========================================================
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, wire

TYPES = {
    "i16": "smallint", "i32": "int", "i64": "bigint", "f64": "double", "str": "string",
    "ts": "timestamp", "tv": "timestamp", "us": "int", "cmd": "bigint", "arg": "string",
}


def parse(layout: str) -> list[tuple[str, str, int | None]]:
    out = []
    for item in layout.replace("\n", ",").split(","):
        parts = item.split()
        if parts:
            out.append((parts[0], parts[1], int(parts[2]) if len(parts) > 2 else None))
    return out


# what plain numbers, joined by newlines, never hold: any text without it is ``[+-]?digits`` (or with a fraction) of safe length
_ODD = {
    "bigint": r"[^0-9+\n-]|[0-9]{19}|[0-9][+-]|[+-]([+\n-]|$)",
    "double": r"[^0-9.+\n-]|[0-9]{301}|[0-9.][+-]|[+-]([.+\n-]|$)|(^|\n)[.]|[.][0-9]*[.]",
}


@dataclass
class _Arrays:
    """Attribute texts of a layout, gathered by how they are converted."""

    numbers: list[str] = field(default_factory=list)
    doubles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)

    def number(self, text: str) -> str:
        return f"coalesce({self._add('_n', self.numbers, text)}, 0L)"

    def double(self, text: str) -> str:
        return f"coalesce({self._add('_d', self.doubles, text)}, 0D)"

    def text(self, text: str) -> str:
        return self._add("_s", self.texts, text)

    @staticmethod
    def _add(column: str, texts: list[str], text: str) -> str:
        if text not in texts:
            texts.append(text)
        return f"get({column}, {texts.index(text)})"

    def over(self, rows: DataFrame) -> DataFrame:
        """Add the converted arrays.  A function over array elements is interpreted, so it is left to records that need it:
        an array of plain numbers is cast as a whole, and text without a backslash stays as it is."""
        raw, out = [], []
        for alias, texts, kind in (("_n", self.numbers, "bigint"), ("_d", self.doubles, "double")):
            if texts:
                # absent numbers are NULL here and 0 where they are read
                raw.append(F.expr(f"array({', '.join(f"nullif({t}, '')" for t in texts)})").alias(f"{alias}t"))
                slow = f"transform({alias}t, x -> {wire.number_sql('x', kind)})"
                odd = f"array_join({alias}t, {wire.literal(chr(10))}) RLIKE {wire.literal(_ODD[kind])}"
                out.append(F.expr(f"CASE WHEN {odd} THEN {slow} ELSE try_cast({alias}t AS array<{kind}>) END").alias(alias))
        if self.texts:
            texts = f"array({', '.join(self.texts)})"
            slash = wire.literal("\\")
            coded = f"transform({texts}, x -> {wire.unescape_sql('x')})"
            out.append(F.expr(f"CASE WHEN contains(body, {slash}) THEN {coded} ELSE {texts} END").alias("_s"))
        return rows.select("*", *raw).select("*", *out)


def _attribute(kind: str, key: int, arrays: _Arrays) -> str:
    raw = wire.raw_sql(key)
    if kind in ("i16", "i32"):
        return wire.clamp_sql(arrays.number(raw), TYPES[kind])
    if kind == "i64":
        return arrays.number(raw)
    if kind == "f64":
        return arrays.double(raw)
    if kind == "str":
        return arrays.text(raw) if key in wire.ESCAPED_KEYS else raw
    if kind == "ts":
        return wire.from_epoch_sql(arrays.number(raw))
    if kind == "tv":
        return wire.from_epoch_sql(arrays.number(wire.whole_part_sql(raw)))
    if kind == "us":
        return wire.clamp_sql(arrays.number(wire.fraction_sql(raw)), "int")
    if kind == "cmd":
        return ids.object_id_sql(ids.COMMAND, arrays.text(wire.command_sql(raw)[0]))
    if kind == "arg":
        return arrays.text(wire.command_sql(raw)[1])
    if kind.startswith("obj"):
        name = arrays.text(raw) if key in wire.ESCAPED_KEYS else raw
        return ids.object_id_sql(int(kind[3:]), name)
    raise ValueError(f"unknown column kind {kind!r}")


def project(rows: DataFrame, layout: str, given: dict[str, Column], extra=()) -> DataFrame:
    """Select a layout from records; ``=`` columns come from ``given``, ``extra`` columns are appended.

    Attributes are converted array-wise: one expression for all numbers, one for all doubles, one for
    all texts.  Fifty separate conversions would outgrow what the JVM compiles as one method.
    """
    arrays = _Arrays()
    out = []
    for name, kind, key in parse(layout):
        value = given[name] if kind == "=" else F.expr(_attribute(kind, key, arrays))
        out.append(value.alias(name))
    return arrays.over(rows).select(*out, *extra)


def attribute(kind: str, key: int) -> Column:
    """One attribute on its own."""
    raw = wire.raw_sql(key)
    if kind in ("i16", "i32"):
        return F.expr(wire.clamp_sql(wire.number_sql(raw, "bigint"), TYPES[kind]))
    if kind == "ts":
        return F.expr(wire.from_epoch_sql(wire.number_sql(raw, "bigint")))
    if kind == "str":
        return wire.attr(key)
    if kind.startswith("obj"):
        return F.expr(ids.object_id_sql(int(kind[3:]), wire.attr_sql(key)))
    raise ValueError(f"unknown column kind {kind!r}")


def part(layout: str, wanted) -> str:
    """The layout of some of the columns, in the same order."""
    return ",".join(" ".join(map(str, item if item[2] is not None else item[:2])) for item in parse(layout) if item[0] in wanted)


def names(layout: str) -> list[str]:
    return [name for name, _, _ in parse(layout)]
