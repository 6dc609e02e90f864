"""Instances and objects: dimensions filled from the names records mention."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, wire
from ..functions.enums import DEFINITION_OBJECT_TYPES
from . import filters
from .filters import realtime_gate
from .lookup import per_instance

MAX_INSTANCES = 32767


def get_or_insert_instances(names: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Stored instances plus new names, numbered on after the highest stored id in name order.

    The id is a SMALLINT, so there are at most 32,767 names and numbering them in one row is bounded;
    more than that fails instead of wrapping.
    """
    fresh = names.select(
        F.coalesce(wire.null_if_empty("instance_name"), F.lit("default")).alias("instance_name")
    ).distinct()
    seen = fresh.withColumn("_stored", F.lit(0))
    if stored is not None:
        fresh = fresh.join(F.broadcast(stored.select("instance_name")), "instance_name", "left_anti")
        # the highest stored id travels along as a row without a name, which the set below leaves out
        highest = stored.select(F.lit(None).cast("string").alias("instance_name"), F.col("instance_id").cast("int").alias("_stored"))
        seen = fresh.withColumn("_stored", F.lit(0)).unionByName(highest)
    numbered = seen.agg(F.array_sort(F.collect_set("instance_name")).alias("names"), F.max("_stored").alias("_base"))
    fits = F.size("names") + F.col("_base") <= MAX_INSTANCES
    checked = F.when(fits, F.col("names")).otherwise(F.raise_error(F.lit("more instances than SMALLINT ids")))
    out = numbered.select(F.posexplode(checked).alias("pos", "instance_name"), "_base").select(
        (F.col("pos") + 1 + F.col("_base")).cast("smallint").alias("instance_id"),
        "instance_name",
        F.lit("").alias("instance_description"),
    )
    return out if stored is None else stored.unionByName(out)


def assign_instance(decoded: DataFrame, instances: DataFrame) -> DataFrame:
    """Replace the session header by the instance id."""
    if "instance_name" not in decoded.columns:
        decoded = decoded.withColumn("instance_name", F.col("header.instance_name"))
    side = F.broadcast(instances.select("instance_id", "instance_name"))
    return decoded.join(side, "instance_name").drop("instance_name")


# Names are cut out as raw text and unescaped after they are distinct, so that the work is done once per
# name and not once per record.  Splitting marks are never escaped, so the order does not matter.
def _one(objecttype, name1: str, name2: str = "''") -> str:
    return f"named_struct('objecttype_id', {objecttype}, 'name1', {name1}, 'name2', {name2})"


def _scalar(objecttype: int, key: int, key2: int | None = None) -> str:
    second = wire.raw_sql(key2) if key2 else "''"
    return f"array({_one(objecttype, wire.raw_sql(key), second)})"


def _command(key: int) -> str:
    return f"array({_one(ids.COMMAND, wire.command_sql(wire.raw_sql(key))[0])})"


def _lines(key: int) -> str:
    return f"regexp_extract_all(body, {wire.literal(f'(?dm)^{key}=(.*)$')}, 1)"


def _listed(objecttype: int, key: int) -> str:
    return f"transform({_lines(key)}, x -> {_one(objecttype, 'x')})"


def _listed_services(key: int) -> str:
    host = "substring_index(ltrim(';', x), ';', 1)"
    service = f"substr(ltrim(';', x), length({host}) + 2)"
    return f"transform({_lines(key)}, x -> {_one(ids.SERVICE, host, service)})"


def _listed_commands(key: int) -> str:
    return f"transform({_lines(key)}, x -> {_one(ids.COMMAND, wire.command_sql('x')[0])})"


def _code(key: int) -> str:
    return wire.number_sql(wire.raw_sql(key), "int")


def _subject(service: str, host: str) -> str:
    return (
        f"CASE WHEN {service} THEN {_scalar(ids.SERVICE, 53, 114)} WHEN {host} THEN {_scalar(ids.HOST, 53)} "
        f"ELSE CAST(array() AS {_ARRAY}) END"
    )


def _by_flag(key: int, service: int, host: int) -> str:
    return _subject(f"{_code(key)} = {service}", f"{_code(key)} = {host}")


def _naming() -> dict[int, list[str]]:
    """Record type -> the arrays of names its records mention."""
    period, contact, group = ids.TIMEPERIOD, ids.CONTACT, ids.CONTACTGROUP
    with_service = f"{wire.raw_sql(114)} <> ''"
    kind = _code(41)
    has_type = f"contains(body, {wire.literal(chr(10) + '40=')})"
    handler = f"IF({has_type}, {_code(40)} IN (1, 3), {with_service})"
    return {
        201: [_subject(f"({kind} = 0 OR ({kind} = 9 AND {with_service}))",
                       f"({kind} = 12 OR ({kind} = 9 AND NOT {with_service}))")],
        204: [_subject(handler, "TRUE"), _scalar(ids.COMMAND, 127)],
        205: [_by_flag(89, 1, 0)],
        206: [_scalar(ids.SERVICE, 53, 114), _scalar(ids.COMMAND, 127)],
        207: [_scalar(ids.HOST, 53), _scalar(ids.COMMAND, 127)],
        208: [_by_flag(20, 2, 1)],
        209: [_by_flag(30, 1, 2)],
        210: [_by_flag(48, 1, 0)],
        212: [_scalar(ids.HOST, 53), _scalar(period, 162)],
        213: [_scalar(ids.SERVICE, 53, 114), _scalar(period, 209)],
        220: [_scalar(contact, 134)],
        221: [_scalar(ids.COMMAND, 127)],
        222: [_by_flag(7, 1, 0)],
        223: [_subject(f"{_code(120)} = 1", "TRUE")],
        224: [_scalar(contact, 134)],
        400: [_scalar(ids.HOST, 174), _command(160), _command(163), _scalar(period, 177), _scalar(period, 162),
              _listed(ids.HOST, 200), _listed(group, 130), _listed(contact, 264)],
        401: [_scalar(ids.HOSTGROUP, 172), _listed(ids.HOST, 171)],
        402: [_scalar(ids.SERVICE, 174, 210), _scalar(ids.HOST, 174), _command(207), _command(211),
              _scalar(period, 224), _scalar(period, 209), _listed_services(268), _listed(group, 130),
              _listed(contact, 264)],
        403: [_scalar(ids.SERVICEGROUP, 220), _listed_services(219)],
        404: [_scalar(ids.HOST, 174), _scalar(ids.HOST, 136), _scalar(period, 259)],
        405: [_scalar(ids.SERVICE, 174, 210), _scalar(ids.SERVICE, 136, 137), _scalar(period, 259)],
        406: [_scalar(ids.HOST, 174), _scalar(period, 145), _listed(group, 130), _listed(contact, 264)],
        407: [_scalar(ids.SERVICE, 174, 210), _scalar(period, 145), _listed(group, 130), _listed(contact, 264)],
        408: [_scalar(ids.COMMAND, 127)],
        409: [_scalar(period, 237)],
        410: [_scalar(contact, 134), _scalar(period, 177), _scalar(period, 224), _listed_commands(175),
              _listed_commands(222)],
        411: [_scalar(group, 133), _listed(contact, 132)],
    }


def _active_names() -> str:
    """Names in an active-objects list: under keys 1, 2, ...; services as host and description in turn."""
    cases = " ".join(f"WHEN {rec} THEN {kind}" for rec, kind in DEFINITION_OBJECT_TYPES.items())
    kind = f"CASE {_code(269)} {cases} END"
    pairs = (
        f"transform(regexp_extract_all(body, {wire.literal('(?dm)^([0-9]+=.*)$')}, 1), "
        "x -> named_struct('k', try_cast(substring_index(x, '=', 1) AS INT), "
        "'v', substr(x, length(substring_index(x, '=', 1)) + 2)))"
    )
    names = f"array_sort(filter({pairs}, p -> p.k BETWEEN 1 AND 268))"
    singles = f"transform({names}, p -> {_one(kind, 'p.v')})"
    partner = f"coalesce(get({names}, i + 1).v, '')"
    twos = (
        f"filter(transform({names}, (p, i) -> IF(i % 2 = 0, {_one(kind, 'p.v', partner)}, NULL)), "
        "p -> p IS NOT NULL)"
    )
    return f"IF({_code(269)} = 402, {twos}, {singles})"


def _of_kinds(by_type: dict[int, list[str]], kinds) -> dict[int, list[str]]:
    """The arrays that may hold names of some object types."""
    def holds(text: str) -> bool:
        return any(int(kind) in kinds for kind in re.findall(r"'objecttype_id', (\d+),", text))

    kept = {t: [text for text in texts if holds(text)] for t, texts in by_type.items()}
    return {t: texts for t, texts in kept.items() if texts}


def _pick(by_type: dict[int, list[str]], rec_types) -> Column:
    wanted = [t for t in by_type if rec_types is None or t in rec_types]
    branches = []
    for t in wanted:
        arrays = by_type[t][0] if len(by_type[t]) == 1 else f"concat({', '.join(by_type[t])})"
        branches.append(f"WHEN {t} THEN {arrays}")
    return F.expr(f"CASE rec_type {' '.join(branches)} END") if wanted else F.lit(None).cast(_ARRAY)


def mentioned_names(rec_types=None, kinds=None) -> Column:
    """Array of (objecttype_id, name1, name2) a record mentions, as raw text, by record type.

    With ``kinds`` the names of other object types may be left out.
    """
    return _pick(_naming() if kinds is None else _of_kinds(_naming(), kinds), rec_types)


_NAME_TYPES = {"objecttype_id": "int", "name1": "string", "name2": "string"}
_ARRAY = "array<struct<objecttype_id:int,name1:string,name2:string>>"
NAMING_TYPES = (201, 204, 205, 206, 207, 208, 209, 210, 212, 213, 220, 221, 222, 223, 224, *range(400, 412))


# record types that activate an object -> its name
def _activating() -> dict[int, list[str]]:
    scalars = {400: (1, 174), 401: (3, 172), 402: (2, 174, 210), 403: (4, 220), 408: (12, 127), 409: (9, 237),
               410: (10, 134), 411: (11, 133)}
    return {**{t: [_scalar(*name)] for t, name in scalars.items()}, 414: [_active_names()]}


OBJECT_KEY = ["instance_id", "objecttype_id", "name1", "name2"]


# current state and definitions beyond the cutoff are dropped before their names are looked at; histories are not
GATED_NAMES = (212, 213, 224, *range(400, 412))


# record type -> which of its records are stored; records that no table stores name nothing
STORED_NAMES = {
    201: filters.awake_timed_event, 206: filters.stored_service_check, 207: filters.stored_host_check,
    223: filters.finished_state_change,
}


def object_names(events: DataFrame, rec_types=None, cutoff: DataFrame | None = None, kinds=None) -> DataFrame:
    """Distinct names (of some object types) of the records that are stored, reduced inside each task before the shuffle."""
    naming = _naming() if kinds is None else _of_kinds(_naming(), kinds)
    wanted = [t for t in NAMING_TYPES if t in naming and (rec_types is None or t in rec_types)]
    if not wanted:
        return events.limit(0).select(
            "instance_id", *[F.lit(None).cast(kind).alias(name) for name, kind in _NAME_TYPES.items()]
        )
    stored = events.where(F.col("rec_type").isin(*wanted))
    for kind in sorted(set(wanted) & set(STORED_NAMES)):
        stored = stored.where((F.col("rec_type") != kind) | STORED_NAMES[kind](wire.code(1)))
    gated = ", ".join(map(str, GATED_NAMES))
    second = F.expr(f"IF(rec_type IN ({gated}), {wire.seconds_sql(wire.raw_sql(4))}, {2**62})")
    names = realtime_gate(stored, cutoff, second).select("instance_id", F.explode(mentioned_names(wanted, kinds)).alias("n"))
    names = names.select("instance_id", "n.*").where("name1 <> '' OR name2 <> ''")
    if kinds is not None:
        names = names.where(F.col("objecttype_id").isin(*kinds))
    return _unescaped(names.distinct())


def _unescaped(names: DataFrame) -> DataFrame:
    # escaping is one-to-one for text a writer emits, so distinct names stay distinct
    return names.withColumns({n: F.expr(wire.unescape_sql(n)) for n in ("name1", "name2")})


ACTIVATING_TYPES = (400, 401, 402, 403, 408, 409, 410, 411, 414)


def activations(events: DataFrame, cutoff: DataFrame | None = None, rec_types=None) -> DataFrame:
    """Last activation of each name by a definition (gated) or an active-objects list."""
    wanted = [t for t in ACTIVATING_TYPES if rec_types is None or t in rec_types]
    picked = events.where(F.col("rec_type").isin(*wanted))
    second = F.expr(f"IF(rec_type = 414, {2**62}, {wire.seconds_sql(wire.raw_sql(4))})")
    picked = realtime_gate(picked, cutoff, second)
    raw = (
        picked.select("instance_id", "arrival", F.explode(_pick(_activating(), wanted)).alias("n"))
        .select("instance_id", "arrival", "n.*")
        .groupBy(*OBJECT_KEY)
        .agg(F.max("arrival").alias("activated"))
    )
    return _unescaped(raw)


def get_or_insert_objects(names: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Stored objects plus the names not stored yet.  Ids are hashes, so nothing needs numbering."""
    fresh = names.select(
        ids.object_id("instance_id", F.col("objecttype_id"), "name1", "name2").alias("object_id"),
        F.col("instance_id").cast("smallint").alias("instance_id"),
        F.col("objecttype_id").cast("smallint").alias("objecttype_id"),
        wire.null_if_empty("name1").alias("name1"),
        wire.null_if_empty("name2").alias("name2"),
        F.lit(0).cast("smallint").alias("is_active"),
    ).where(F.col("object_id") != 0)
    if stored is None:
        return fresh
    return stored.unionByName(fresh.join(stored.select("object_id"), "object_id", "left_anti").select(*stored.columns))


def mark_active(objects: DataFrame, activated: DataFrame, restarts: DataFrame | None = None) -> DataFrame:
    """Activated objects become active; a restart of the instance resets all that came before it."""
    on = activated.select(
        ids.object_id("instance_id", F.col("objecttype_id"), "name1", "name2").alias("object_id"), "activated"
    )
    joined = objects.join(on, "object_id", "left")
    active = F.when(F.col("activated").isNotNull(), 1).otherwise(F.col("is_active"))
    if restarts is not None:
        joined = per_instance(joined, restarts)
        stale = F.col("restart").isNotNull() & (F.col("activated").isNull() | (F.col("activated") <= F.col("restart")))
        active = F.when(stale, 0).otherwise(active)
    return joined.withColumn("is_active", active.cast("smallint")).select(*objects.columns)


def mark_active_names(objects: DataFrame, names: DataFrame) -> DataFrame:
    """Activate the objects with the given (instance, type, name1, name2), one set-based join."""
    on = names.select(
        ids.object_id("instance_id", F.col("objecttype_id"), "name1", "name2").alias("object_id"),
        F.lit(True).alias("_hit"),
    ).distinct()
    return (
        objects.join(on, "object_id", "left")
        .withColumn("is_active", F.when(F.col("_hit"), 1).otherwise(F.col("is_active")).cast("smallint"))
        .select(*objects.columns)
    )


def build_objects(
    events: DataFrame,
    cutoff: DataFrame | None = None,
    restarts: DataFrame | None = None,
    stored: DataFrame | None = None,
    rec_types=None,
    kinds=None,
) -> DataFrame:
    """Objects dimension.  ``rec_types`` narrows the work when the events are known to hold only some, ``kinds`` the result
    to some object types."""
    objects = get_or_insert_objects(object_names(events, rec_types, cutoff, kinds), stored)
    activating = rec_types is None or bool(set(rec_types) & set(ACTIVATING_TYPES))
    if not activating and restarts is None:
        return objects
    return mark_active(objects, activations(events, cutoff, rec_types if activating else None), restarts)
