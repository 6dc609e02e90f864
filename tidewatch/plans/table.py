"""What a warehouse table is: which records feed it, its rows, and how rows become the table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, wire
from ..operators import filters, maintenance
from ..operators.upsert import upsert
from . import columns

EVENT = ("arrival", "chunk", "session")
#: what a record's columns are cut out of
RECORD = ("instance_id", "rec_type", "config_type", "arrival", "body")


@dataclass
class Context:
    """What gated tables compare against: stale cutoffs and restart points, one row per instance."""

    cutoff: DataFrame | None = None
    restarts: DataFrame | None = None


def neb_type() -> Column:
    return wire.code(1)


def neb_attr() -> Column:
    return wire.code(3)


def event_second() -> Column:
    return F.expr(wire.seconds_sql(wire.raw_sql(4)))


def event_usec() -> Column:
    return F.expr(wire.micros_sql(wire.raw_sql(4)))


# attributes that name objects; cut out once per record and used in ids and conditions
NAME_KEYS = (53, 114, 127, 134, 136, 137, 174, 210)


def with_names(rows: DataFrame) -> DataFrame:
    """Add the unescaped naming attributes as ``_k<key>``; the optimizer drops those not used."""
    return rows.withColumns({f"_k{key}": wire.attr(key) for key in NAME_KEYS})


def name_of(key: int) -> Column:
    return F.col(f"_k{key}")


def service_id(host_key: int, name_key: int) -> Column:
    return F.expr(ids.object_id_sql(ids.SERVICE, f"_k{host_key}", f"_k{name_key}"))


def named_id(objecttype: int, key: int) -> Column:
    return F.expr(ids.object_id_sql(objecttype, f"_k{key}"))


def host_or_service(service: Column, host: Column | None = None) -> Column:
    """Object a record is about; 0 when it says neither host nor service."""
    as_service = service_id(53, 114)
    as_host = named_id(ids.HOST, 53)
    out = F.when(service, as_service)
    if host is None:
        return out.otherwise(as_host)
    return out.when(host, as_host).otherwise(F.lit(0).cast("bigint"))


def arrival_id(table: str) -> Column:
    """Row id for tables without a unique key: the position of the record (and of the row in it)."""
    return ids.row_id(table, "arrival.file", "arrival.offset")


def epoch(name: str) -> Column:
    return F.unix_timestamp(F.col(name))


@dataclass
class Table:
    name: str
    rec_types: tuple[int, ...]
    layout: str
    kind: str = "history"  # history, current or config
    keys: tuple[str, ...] = ()
    insert_only: tuple[str, ...] = ()
    gated: bool = False
    given: Callable[[], dict[str, Column]] = dict
    keep: Callable[[], Column] | None = None
    id_column: str | None = None
    id_parts: tuple[str, ...] = ()
    explode: Callable[[], Column] | None = None
    rows_from: Callable[[DataFrame, "Table"], DataFrame] | None = None
    finish_with: Callable[[DataFrame, "Table"], DataFrame] | None = None
    extra: tuple[str, ...] = ()
    date_column: str | None = None

    @property
    def column_names(self) -> list[str]:
        return columns.names(self.layout)

    def select_records(self, events: DataFrame, ctx: Context | None = None) -> DataFrame:
        """Records of this table: type filter first (a pruned partition on disk), then the gates."""
        ctx = ctx or Context()
        out = events.where(F.col("rec_type").isin(*self.rec_types))
        if self.keep is not None:
            out = out.where(self.keep())
        if self.gated:
            out = filters.realtime_gate(out, ctx.cutoff, event_second())
            out = maintenance.after_restart(out, ctx.restarts)
        return out

    @property
    def late(self) -> bool:
        """Whether the records that decide about a row can be found by its keys and arrival alone."""
        return bool(self.keys) and self.finish_with is None and self.rows_from is None and self.explode is None

    def rows(self, events: DataFrame, ctx: Context | None = None, only=None) -> DataFrame:
        """Typed rows with their arrival, before updates are folded together.

        ``only`` names the columns that are wanted; of plain tables no others are cut out of the records.
        """
        picked = self.select_records(events, ctx)
        if self.rows_from is not None:
            return self.rows_from(picked, self)
        return self.typed(picked, only)

    def latest(self, events: DataFrame, ctx: Context | None = None, only=None) -> DataFrame:
        """Rows with updates folded together as far as that is an upsert by keys, with the arrival of the last one.

        Records are told apart by their keys, and only those that decide about a row are decoded further.
        """
        if not self.late:
            return self.rows(events, ctx, only)
        wanted = [c for c in self.column_names if only is None or c in only]
        updated = [c for c in wanted if c not in self.keys and c not in self.insert_only and c != self.id_column]
        kept = [c for c in wanted if c in self.insert_only]
        picked = self.select_records(events, ctx)
        record = F.struct(*[c for c in RECORD if c in picked.columns])
        keyed = self.typed(picked, self.keys, [record.alias("_record")]).select(*self.keys, "arrival", "_record")
        found = [F.max("arrival").alias("arrival")]
        if updated:
            found.append(F.max_by("_record", "arrival").alias("_last"))
        if kept:
            found.append(F.min_by("_record", "arrival").alias("_first"))
        out, done = keyed.groupBy(*self.keys).agg(*found), [*self.keys, "arrival"]
        for source, names in (("_last", updated), ("_first", kept)):
            if names:
                rest = F.struct(*done, *(["_first"] if source == "_last" and kept else [])).alias("_done")
                out = self.typed(out.select(f"{source}.*", rest), names, [F.col("_done")], plain=True).select("_done.*", *names)
                done += names
        if self.id_column in wanted:
            out = out.withColumn(self.id_column, self.key_id() if self.id_parts else arrival_id(self.name))
        return out.select(*wanted, *[c for c in self.keys if c not in wanted], "arrival")

    def typed(self, picked: DataFrame, only=None, more=(), plain: bool = False) -> DataFrame:
        """Layout columns of records (those of ``only``), ``more`` columns and, unless ``plain``, the place of the record."""
        if self.explode is not None:
            picked = picked.select("*", F.posexplode(self.explode()).alias("_pos", "_item"))
        picked = with_names(picked)
        given = {"instance_id": F.col("instance_id")}
        if "config_type" in self.column_names:
            given["config_type"] = F.col("config_type")
        given.update(self.given())
        late_id, layout = self.id_column, self.layout
        if only is not None:
            late_id = late_id if late_id in only else None
            layout = columns.part(layout, {*only, *(self.id_parts if late_id else ())})
        if late_id:
            given[late_id] = F.lit(None).cast("bigint") if self.id_parts else arrival_id(self.name)
            if not self.id_parts and self.explode is not None:
                given[late_id] = ids.row_id(self.name, "arrival.file", "arrival.offset", "_pos")
        carried = [c for c in EVENT if c in picked.columns]
        if self.explode is not None:
            # items of one record arrive in list order
            carried = [F.struct(F.col("arrival"), F.col("_pos")).alias("arrival")] + [
                F.col(c) for c in carried if c != "arrival"
            ]
        extras = [self.given()[c].alias(c) for c in self.extra if only is None]
        out = columns.project(picked, layout, given, [*extras, *([] if plain else carried), *more])
        if late_id and self.id_parts:
            out = out.withColumn(late_id, self.key_id())
        return out

    def key_id(self) -> Column:
        """Row id from the unique key, so that every version of a row has the same id."""
        return ids.row_id(self.name, *[_id_part(p) for p in self.id_parts])

    def finish(self, rows: DataFrame, keep_order: bool = False) -> DataFrame:
        """Rows -> table."""
        if self.finish_with is not None:
            out = self.finish_with(rows, self)
        elif self.keys:
            out = upsert(
                rows.drop("chunk", "session"), self.keys, self.insert_only, keep_order=True
            )
        else:
            out = rows
        kept = [c for c in EVENT if c in out.columns] if keep_order else []
        return out.select(*self.column_names, *kept)

    def build(self, events: DataFrame, ctx: Context | None = None, only=None) -> DataFrame:
        """The table, or some columns of it."""
        wanted = [c for c in self.column_names if only is None or c in only]
        if self.late:
            return self.latest(events, ctx, only).select(*wanted)
        return self.finish(self.rows(events, ctx)).select(*wanted)


def _id_part(name: str) -> Column:
    return epoch(name) if name.endswith("_time") else F.col(name)
