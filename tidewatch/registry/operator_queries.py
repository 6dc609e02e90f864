"""Operators on their own: codec, casts, dimensions, gates, folds, retention and evolution."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import enums, wire
from ..operators import aggregates, dimensions, evolution, filters, lookup, maintenance
from ..operators.ordered import carry_forward
from ..operators.upsert import upsert
from ..plans import history, warehouse
from ..plans.table import Context, event_second
from ..session import ensure_checkpoint_dir
from ..sources import archive, dump
from . import feeds
from .entries import query
from .feeds import Feed, in_parts, object_sql, row_sql, source_sql, stamp_sql, union
from .report_queries import (
    COMMENT, FLAPPING, HOST_DEF, SERVICE_DEF, SERVICE_STATUS, STATE, SUBJECT, TV, latest_sql,
)
from .table_queries import LOG_LIVE, SERVICE_CHECK

EV = source_sql("ev")


# ---- codec ------------------------------------------------------------------------------------
@query("unescape_roundtrip", "SELECT doc_id, text AS back, text AS via_record FROM documents")
def unescape_roundtrip(spark, sf_dir):
    """Escape and unescape whole texts, alone and inside a record body."""
    docs = feeds.load(spark, sf_dir, "documents")
    coded = docs.select("doc_id", wire.escape("text").alias("coded"), wire.encode_body((95, "text"), (53, "lang")).alias("body"))
    return coded.select("doc_id", wire.unescape("coded").alias("back"), wire.attr(95).alias("via_record"))


@query("escape_text", r"""
    SELECT doc_id, replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), chr(9), chr(92) || 't'),
    chr(13), chr(92) || 'r'), chr(10), chr(92) || 'n') AS coded FROM documents""")
def escape_text(spark, sf_dir):
    """Escaped form of whole texts."""
    return feeds.load(spark, sf_dir, "documents").select("doc_id", wire.escape("text").alias("coded"))


@query("decode_kv", f"""
    SELECT event_id, inst AS instance_id, host, svc AS service, CAST(k % 4 AS INTEGER) AS state,
    concat('state ', svc) AS output, 13 AS n_keys FROM ({EV})""")
def decode_kv(spark, sf_dir):
    """Records parsed into a key -> values map."""
    records = Feed(223, "ev", "event_id", {**STATE.fields, 114: "svc"}).records(spark, sf_dir)
    kv = records.select("arrival.offset", "instance_id", wire.parse_kv().alias("kv"))
    return kv.select(
        F.col("offset").alias("event_id"), "instance_id", wire.scalar("kv", 53).alias("host"),
        wire.scalar("kv", 114).alias("service"), wire.to_int(wire.scalar("kv", 118)).alias("state"),
        wire.scalar("kv", 95).alias("output"), F.size("kv").alias("n_keys"),
    )


@query("decode_multivalue", f"""
    SELECT event_id, pos, v FROM (SELECT event_id, unnest([0, 1, 2]) AS pos,
    unnest([concat(host, ';', svc), svc, concat(svc, '=', chr(9), k)]) AS v FROM ({EV}))""")
def decode_multivalue(spark, sf_dir):
    """List attributes keep their order."""
    feed = Feed(403, "ev", "event_id", {220: "svc", 219: ["concat(host, ';', svc)", "svc", "concat(svc, '=', chr(9), k)"]})
    return feed.records(spark, sf_dir).select(
        F.col("arrival.offset").alias("event_id"), F.posexplode(wire.attrs(219)).alias("pos", "v")
    )


_NUMBERED = Feed(223, "ev", "event_id", {**STATE.fields, 18: "event_id"})
_DECODED_SQL = f"""
    SELECT event_id, CAST(223 AS INTEGER) AS rec_type, host, {SUBJECT} AS service, CAST(k % 4 AS INTEGER) AS state,
    concat(svc, chr(10), chr(9), chr(92), 'n') AS long_output, 'default' AS instance_name, CAST(NULL AS VARCHAR) AS reject
    FROM ({EV})"""


def _folder(spark, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def _decoded(decoded):
    return decoded.select(
        F.expr(wire.number_sql(wire.raw_sql(18), "bigint")).alias("event_id"), "rec_type", wire.attr(53).alias("host"),
        wire.attr(114).alias("service"), wire.code(118).alias("state"), wire.attr(125).alias("long_output"),
        F.col("header.instance_name").alias("instance_name"), "reject",
    )


@query("dump_roundtrip", _DECODED_SQL)
def dump_roundtrip(spark, sf_dir):
    """Records written as protocol dump files and decoded again."""
    path = _folder(spark, "dump")
    dump.write_dump(_NUMBERED.records(spark, sf_dir), path)
    return _decoded(dump.read_dump(spark, path))


@query("dump_compressed", _DECODED_SQL)
def dump_compressed(spark, sf_dir):
    """The same from compressed files, whose size is not that of their text."""
    path = _folder(spark, "dump")
    dump.write_dump(_NUMBERED.records(spark, sf_dir), path, compression="gzip")
    return _decoded(dump.read_dump(spark, path))


@query("spool_records", _DECODED_SQL.replace("'default'", "'sender'"))
def spool_records(spark, sf_dir):
    """Records of a spool: one escaped record a line, without any session header."""
    path = _folder(spark, "spool")
    records = _NUMBERED.records(spark, sf_dir)
    text = F.concat(F.lit("\n"), F.col("rec_type").cast("string"), F.lit(":"), "body", F.lit(dump.RECORD_END))
    records.select(wire.escape(text).alias("value")).write.text(path)
    return _decoded(archive.read_spool_records(spark, path, "sender"))


@query("protocol_check", f"""
    SELECT event_id, CASE WHEN k % 2 = 0 THEN 'protocol' END AS reject FROM ({EV})""")
def protocol_check(spark, sf_dir):
    """Records of sessions that speak another protocol are rejected, those of the right one are not."""
    records, path = _NUMBERED.records(spark, sf_dir), _folder(spark, "dump")
    for mode, rows, version in (("error", records.join(_even(spark, sf_dir).select("arrival"), "arrival", "left_anti"), "2"),
                                ("append", _even(spark, sf_dir), "1")):
        text = dump.framed(rows.select("rec_type", "body", "arrival")).select(
            F.replace("value", F.lit("PROTOCOL: 2"), F.lit(f"PROTOCOL: {version}")).alias("value"))
        text.write.mode(mode).option("lineSep", dump.RECORD_END).text(path)
    read = dump.read_dump(spark, path).where("rec_type = 223")
    return read.select(wire.code(18).cast("bigint").alias("event_id"), "reject")


@query("union_instances", f"""
    SELECT name AS instance_name, count(*) AS n FROM ({EV}), (SELECT unnest(['east', 'west']) AS name)
    WHERE name = 'east' OR k % 2 = 0 GROUP BY name""")
def union_instances(spark, sf_dir):
    """Records of two senders side by side, apart by their session headers."""
    records, parts = _NUMBERED.records(spark, sf_dir), []
    for name, rows in (("east", records), ("west", _even(spark, sf_dir))):
        path = _folder(spark, "dump")
        dump.write_dump(rows.withColumn("instance_name", F.lit(name)), path)
        parts.append(dump.read_dump(spark, path))
    both = dump.records(dump.union_instances(*parts))
    return both.groupBy(F.col("header.instance_name").alias("instance_name")).agg(F.count("*").alias("n"))


@query("file_order", f"""
    SELECT host, service, max(event_id) AS event_id, arg_max(state, event_id) AS state, count(*) AS n
    FROM ({_DECODED_SQL}) GROUP BY host, service""")
def file_order(spark, sf_dir):
    """The last record of each service over eleven rotated files, of which the one numbered 10 is the latest."""
    path, records = _folder(spark, "dump"), _NUMBERED.records(spark, sf_dir)
    for number, rotation in enumerate(in_parts(records, 11, 4)):
        dump.write_dump(rotation, f"{path}/f{number}")
    read = dump.records(dump.read_dump(spark, f"{path}/f*")).where("rec_type = 223").select(
        "arrival", F.expr(wire.number_sql(wire.raw_sql(18), "bigint")).alias("event_id"), wire.attr(53).alias("host"),
        wire.attr(114).alias("service"), wire.code(118).alias("state"))
    return read.groupBy("host", "service").agg(
        F.max_by("event_id", "arrival").alias("event_id"), F.max_by("state", "arrival").alias("state"),
        F.count("*").alias("n"))


def _even(spark, sf_dir):
    return Feed(223, "ev", "event_id", _NUMBERED.fields, where="k % 2 = 0").records(spark, sf_dir)


@query("session_audit", f"""
    SELECT CAST(1 AS SMALLINT) AS instance_id, 'tidewatch' AS agent_name, 'ARCHIVED' AS disposition,
    count(*) AS entries FROM ({EV})""")
def session_audit(spark, sf_dir):
    """Entries per agent, summed over the sessions of a written dump."""
    path = f"{ensure_checkpoint_dir(spark)}/dump-{uuid.uuid4().hex}"
    dump.write_dump(STATE.records(spark, sf_dir), path)
    decoded = dump.read_dump(spark, path)
    instances = dimensions.get_or_insert_instances(decoded.select("header.instance_name"))
    audit = aggregates.session_audit(decoded, instances)
    return audit.groupBy("instance_id", "agent_name", "disposition").agg(F.sum("entries_processed").alias("entries"))


# ---- casts and pieces -------------------------------------------------------------------------
@query("casts_prefix", f"""
    SELECT event_id, CAST(k AS INTEGER) AS leading, CAST(0 AS INTEGER) AS none, CAST(-k AS BIGINT) AS negative,
    value AS number, CAST(k AS DOUBLE) + 0.5 AS number_prefix FROM ({EV})""")
def casts_prefix(spark, sf_dir):
    """Numbers are read from the front of a text, 0 when there is none."""
    ev = feeds.source(spark, sf_dir, "ev")
    return ev.select(
        "event_id", wire.to_int(F.expr("concat(' ', k, 'abc', k)")).alias("leading"),
        wire.to_int(F.expr("concat(svc, k)")).alias("none"), wire.to_long(F.expr("concat('-', k, '.9')")).alias("negative"),
        wire.to_double(F.col("value").cast("string")).alias("number"),
        wire.to_double(F.expr("concat(k, '.5s')")).alias("number_prefix"),
    )


@query("timeval", f"""
    SELECT event_id, sec, usec, make_timestamp(sec * 1000000 + usec) AS ts, make_timestamp(sec * 1000000) AS whole
    FROM ({EV})""")
def timeval(spark, sf_dir):
    """Seconds and microseconds of ``sec.usec`` texts; microseconds are decimal, also with leading zeros."""
    ev = feeds.source(spark, sf_dir, "ev").select("event_id", F.expr("concat(sec, '.', lpad(usec, 6, '0'))").alias("t"))
    return ev.select(
        "event_id", wire.timeval_sec("t").alias("sec"), wire.timeval_usec("t").alias("usec"),
        wire.to_timeval("t").alias("ts"), wire.from_epoch(wire.to_epoch(wire.to_timeval("t"))).alias("whole"),
    )


@query("std_elements", f"""
    SELECT event_id, CAST(CASE WHEN k % 10 = 0 THEN 1800 ELSE 1801 END AS INTEGER) AS neb_type, 0 AS neb_flags,
    0 AS neb_attr, make_timestamp(sec * 1000000 + usec) AS event_ts FROM ({EV})""")
def std_elements(spark, sf_dir):
    """Type, flags, attributes and time of each record."""
    return STATE.records(spark, sf_dir).select(F.col("arrival.offset").alias("event_id"), *wire.std_elements())


@query("split_pieces", """
    SELECT p_partkey, p_name AS command, concat(p_brand, '!', p_type) AS args, p_brand AS host, p_type AS service,
    'V' AS var_name, CAST(p_size AS INTEGER) AS var_modified, concat(p_type, ':', p_brand) AS var_value,
    CAST(p_size % 7 AS INTEGER) AS day, CAST(p_size AS INTEGER) AS start_sec, CAST(p_size * 2 AS INTEGER) AS end_sec,
    CAST(p_size AS INTEGER) AS number, concat(p_brand, ':', p_type) AS address FROM part""")
def split_pieces(spark, sf_dir):
    """Composite values cut at their marks."""
    part = feeds.load(spark, sf_dir, "part")
    command = wire.split_command(F.expr("concat(p_name, '!', p_brand, '!', p_type)"))
    ref = wire.split_service_ref(F.expr("concat(p_brand, ';', p_type)"))
    variable = wire.split_customvar(F.expr("concat('V:', p_size, ':', p_type, ':', p_brand)"))
    span = wire.split_timerange(F.expr("concat(p_size % 7, ':', p_size, '-', p_size * 2)"))
    place = wire.split_address(F.expr("concat(p_size, ':', p_brand, ':', p_type)"))
    return part.select(
        "p_partkey", command["name"].alias("command"), command["args"].alias("args"), ref["host"].alias("host"),
        ref["service"].alias("service"), variable["name"].alias("var_name"), variable["modified"].alias("var_modified"),
        variable["value"].alias("var_value"), span["day"].alias("day"), span["start_sec"].alias("start_sec"),
        span["end_sec"].alias("end_sec"), place["number"].alias("number"), place["address"].alias("address"),
    )


@query("float5", f"SELECT event_id, printf('%.5f', value) AS text FROM ({EV})")
def float5(spark, sf_dir):
    """Numbers as they are written on the wire."""
    return feeds.source(spark, sf_dir, "ev").select("event_id", wire.float5("value").alias("text"))


@query("decode_enum", f"""
    SELECT event_id, CASE k % 5 WHEN 0 THEN 'OK' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'CRITICAL' WHEN 3 THEN 'UNKNOWN' END
    AS state_label, CASE k % 2 WHEN 0 THEN 'SOFT' ELSE 'HARD' END AS type_label FROM ({EV})""")
def decode_enum(spark, sf_dir):
    """Labels of numeric codes; unknown codes have none."""
    return feeds.source(spark, sf_dir, "ev").select(
        "event_id", enums.decode_enum(F.expr("k % 5"), "service_state").alias("state_label"),
        enums.decode_enum(F.expr("k % 2"), "state_type").alias("type_label"),
    )


@query("fit_varchar", "SELECT doc_id, substr(text, 1, 255) AS fitted FROM documents")
def fit_varchar(spark, sf_dir):
    """Text cut to a column width, where a table asks for it."""
    return feeds.load(spark, sf_dir, "documents").select("doc_id", wire.fit_varchar("text", 255).alias("fitted"))


# ---- dimensions -------------------------------------------------------------------------------
_OBJECTS_SQL = f"""
    SELECT {object_sql('otype', 'name1', 'name2')} AS object_id, inst AS instance_id, CAST(otype AS SMALLINT) AS objecttype_id,
    nullif(name1, '') AS name1, nullif(name2, '') AS name2, CAST(0 AS SMALLINT) AS is_active FROM (
    SELECT DISTINCT inst, 2 AS otype, host AS name1, svc AS name2 FROM ({EV})
    UNION SELECT DISTINCT inst, 9, concat('period_', k % 3), '' FROM ({EV}))"""


@query("object_get_or_insert", _OBJECTS_SQL)
def object_get_or_insert(spark, sf_dir):
    """Objects named by status records; half of them are stored already and keep their row."""
    events = SERVICE_STATUS.records(spark, sf_dir)
    names = dimensions.object_names(events, (213,))
    stored = dimensions.get_or_insert_objects(names.where("name1 < 'Customer#000000075'"))
    return dimensions.get_or_insert_objects(names, stored)


# records of several kinds, named apart; those of instances 1 and 2 meet a cutoff, others have none
_CUTOFF = 1705000000
_NAMED = [
    Feed(213, "ev", "event_id", {1: "1202", 4: TV, 53: "concat('s', host)", 114: "concat(svc, k)"}),
    Feed(206, "ev", "event_id", {1: "700 + k % 5", 4: TV, 53: "concat('c', host)", 114: "concat(svc, k)"}),
    Feed(207, "ev", "event_id", {1: "800 + k % 6", 4: TV, 53: "concat('h', host, k)"}),
    Feed(223, "ev", "event_id", {1: "1800 + k % 2", 4: TV, 120: "0", 53: "concat('t', host, k)"}),
    Feed(201, "ev", "event_id", {1: "CASE WHEN k % 3 = 0 THEN 205 ELSE 200 END", 4: TV, 41: "12", 111: "sec", 53: "concat('q', host, k)"}),
    Feed(401, "host", "c_custkey", {4: ("1700000000", "0"), 172: "c_mktsegment", 171: ["concat('g', host)"]}),
]
_GATE_SQL = f"(inst > 2 OR sec >= {_CUTOFF})"


@query("objects_gated", f"""
    SELECT {object_sql('otype', 'name1', 'name2')} AS object_id, inst AS instance_id, CAST(otype AS SMALLINT) AS objecttype_id,
    nullif(name1, '') AS name1, nullif(name2, '') AS name2 FROM (
    SELECT DISTINCT inst, 2 AS otype, concat('s', host) AS name1, concat(svc, k) AS name2 FROM ({EV}) WHERE {_GATE_SQL}
    UNION SELECT DISTINCT inst, 2, concat('c', host), concat(svc, k) FROM ({EV}) WHERE k % 5 IN (0, 1)
    UNION SELECT DISTINCT inst, 1, concat('h', host, k), '' FROM ({EV}) WHERE k % 6 NOT IN (4, 5)
    UNION SELECT DISTINCT inst, 1, concat('t', host, k), '' FROM ({EV}) WHERE k % 2 = 1
    UNION SELECT DISTINCT inst, 1, concat('q', host, k), '' FROM ({EV}) WHERE k % 3 <> 0
    UNION SELECT DISTINCT inst, 3, c_mktsegment, '' FROM ({source_sql('host')}) WHERE inst > 2
    UNION SELECT DISTINCT inst, 1, concat('g', host), '' FROM ({source_sql('host')}) WHERE inst > 2)""")
def objects_gated(spark, sf_dir):
    """Objects of records that get past their gates: stale state and definitions and unstored checks name nothing."""
    events = feeds.union(*(feed.records(spark, sf_dir) for feed in _NAMED))
    cutoff = spark.createDataFrame([(1, _CUTOFF), (2, _CUTOFF)], "instance_id short, cutoff long")
    return dimensions.build_objects(events, cutoff).select("object_id", "instance_id", "objecttype_id", "name1", "name2")


@query("name_null_safe", f"""
    SELECT DISTINCT inst AS instance_id, CASE WHEN k % 2 = 1 THEN 2 ELSE 1 END AS objecttype_id, host AS name1,
    nullif({SUBJECT}, '') AS name2,
    CASE WHEN k % 2 = 1 THEN {object_sql(2, 'host', 'svc')} ELSE {object_sql(1, 'host')} END AS object_id FROM ({EV})""")
def name_null_safe(spark, sf_dir):
    """Lookup by names where an absent second name matches an absent second name."""
    events = STATE.records(spark, sf_dir)
    objects = dimensions.build_objects(events, rec_types=(223,))
    wanted = feeds.source(spark, sf_dir, "ev").selectExpr(
        "inst AS instance_id", "CASE WHEN k % 2 = 1 THEN 2 ELSE 1 END AS objecttype_id", "host AS name1",
        f"nullif({SUBJECT}, '') AS name2",
    ).distinct()
    return lookup.null_safe_lookup(wanted, objects)


@query("instances", "SELECT CAST(row_number() OVER (ORDER BY r_name) AS SMALLINT) AS instance_id, r_name AS instance_name FROM region")
def instances(spark, sf_dir):
    """Instances numbered by name, the first three stored before the rest arrive."""
    names = feeds.load(spark, sf_dir, "region").select(F.col("r_name").alias("instance_name"))
    stored = dimensions.get_or_insert_instances(names.where("instance_name < 'EUROPE'"))
    return dimensions.get_or_insert_instances(names, stored).select("instance_id", "instance_name")


# retained definitions are activated by their record, every fifth host also by a list
ACTIVE_LIST = Feed(414, "host", "c_custkey + 1000000000", {269: "400", 1: "host"}, where="c_custkey % 5 = 0")


@query("active_objects", f"""
    SELECT {object_sql(1, 'host')} AS object_id, inst AS instance_id,
    CAST(CASE WHEN c_custkey % 5 = 0 OR c_custkey % 3 = 1 THEN 1 ELSE 0 END AS SMALLINT) AS is_active
    FROM ({source_sql('host')})""")
def active_objects(spark, sf_dir):
    """Hosts made active by a definition or by an active-objects list."""
    defined = Feed(400, "host", "c_custkey", {4: ("1700000000", "0"), 174: "host"}, where="c_custkey % 3 = 1")
    seen = Feed(212, "host", "c_custkey", {4: ("1700000000", "0"), 53: "host"})
    events = union(defined.records(spark, sf_dir), ACTIVE_LIST.records(spark, sf_dir), seen.records(spark, sf_dir))
    return dimensions.build_objects(events, rec_types=(212, 400, 414)).where("objecttype_id = 1").select(
        "object_id", "instance_id", "is_active"
    )


# ---- upserts ----------------------------------------------------------------------------------
_LINE = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query("upsert_last_wins", f"""
    SELECT l_orderkey, l_linenumber, {_LINE} FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
    l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def upsert_last_wins(spark, sf_dir):
    """One row per key: the last arrival."""
    lines = feeds.load(spark, sf_dir, "lineitem").withColumn(
        "arrival", F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
    return upsert(lines, ["l_orderkey", "l_linenumber"])


@query("upsert_first_cols", """
    SELECT l_orderkey, l_linenumber, first_flag AS l_returnflag, last_qty AS l_quantity FROM (SELECT l_orderkey, l_linenumber,
    first_value(l_returnflag) OVER (w ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS first_flag,
    first_value(l_quantity) OVER (w ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
    l_extendedprice DESC) AS last_qty, row_number() OVER (w ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
    l_extendedprice) AS rn FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber)) WHERE rn = 1""")
def upsert_first_cols(spark, sf_dir):
    """Insert-only columns keep the first arrival's value."""
    lines = feeds.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("arrival"))
    return upsert(lines, ["l_orderkey", "l_linenumber"], insert_only=["l_returnflag"])


# ---- archived logs ----------------------------------------------------------------------------
_ARCHIVE_SQL = f"""
    SELECT DISTINCT {row_sql('logentries', 'inst', 'sec - sec % 3600', "concat(svc, ';', k)")} AS logentry_id,
    inst AS instance_id, {stamp_sql('sec - sec % 3600')} AS logentry_time, {stamp_sql('sec - sec % 3600')} AS entry_time,
    0 AS entry_time_usec, 0 AS logentry_type, concat(svc, ';', k) AS logentry_data, CAST(0 AS SMALLINT) AS realtime_data,
    CAST(0 AS SMALLINT) AS inferred_data_extracted FROM ({EV})"""


def _archive_events(spark, sf_dir):
    ev = feeds.source(spark, sf_dir, "ev")
    hour = "sec - sec % 3600"
    lines = F.array(
        F.expr(f"concat('[', {hour}, '] ', svc, ';', k, chr(10))"),
        F.expr(f"CASE WHEN svc = 'error' THEN concat('no bracket ', k) ELSE concat('[', {hour}, '] ', svc, ';', k) END"),
    )
    return ev.select(
        F.col("inst").alias("instance_id"),
        F.struct(F.lit(0).cast("bigint").alias("batch"), F.lit("").alias("file"), F.col("event_id").alias("offset")).alias("arrival"),
        F.lit(100).alias("rec_type"),
        F.explode(lines).alias("value"),
    ).withColumn("body", wire.encode_body((72, "value"))).drop("value")


@query("archive_log_import", _ARCHIVE_SQL)
def archive_log_import(spark, sf_dir):
    """Archived log lines: split, malformed lines dropped, one row per (instance, time, text)."""
    return history.archive_rows(_archive_events(spark, sf_dir)).drop("arrival")


@query("archive_log_files", f"""
    SELECT DISTINCT CAST(1 AS SMALLINT) AS instance_id, {stamp_sql('sec')} AS logentry_time, concat(svc, ';', k) AS logentry_data
    FROM ({EV})""")
def archive_log_files(spark, sf_dir):
    """Archived log files read line by line, malformed and repeated lines left out."""
    path = _folder(spark, "archive")
    line = F.expr("concat('[', sec, '] ', svc, ';', k)")
    bad = F.expr("concat('no bracket ', k)")
    feeds.source(spark, sf_dir, "ev").select(F.explode(F.array(line, line, bad)).alias("value")).write.text(path)
    events = archive.read_archive_log(spark, path).withColumn("instance_id", F.lit(1).cast("smallint"))
    return history.archive_rows(events).select("instance_id", "logentry_time", "logentry_data")


@query("archive_log_dedup", f"SELECT * FROM ({_ARCHIVE_SQL}) WHERE NOT (logentry_data LIKE 'view;%')")
def archive_log_dedup(spark, sf_dir):
    """Lines stored by an earlier import are skipped."""
    events = _archive_events(spark, sf_dir)
    stored = history.archive_rows(events).where("logentry_data LIKE 'view;%'").drop("arrival")
    return history.archive_rows(events, stored=stored).drop("arrival")


# ---- gates ------------------------------------------------------------------------------------
def _stored_status(spark, sf_dir):
    """Status built from all events, as an earlier session left it."""
    return warehouse.TABLES["servicestatus"].build(SERVICE_STATUS.records(spark, sf_dir), Context())


_STORED = f"(SELECT inst, max(sec) AS cut FROM ({EV}) GROUP BY inst)"
AS_OF = 1706000000


@query("latest_data_time", f"SELECT inst AS instance_id, {stamp_sql('cut')} AS latest_time FROM {_STORED}")
def latest_data_time(spark, sf_dir):
    """Newest stored status time per instance."""
    return aggregates.latest_data_time(_stored_status(spark, sf_dir), "status_update_time")


@query("realtime_cutoff", f"SELECT inst AS instance_id, least(cut, {AS_OF}) AS cutoff FROM {_STORED}")
def realtime_cutoff(spark, sf_dir):
    """Cutoff per instance, never after the reading time."""
    return aggregates.realtime_cutoff({"servicestatus": _stored_status(spark, sf_dir)}, F.timestamp_seconds(F.lit(AS_OF)))


@query("realtime_gate", f"""
    SELECT e.event_id, e.inst AS instance_id FROM ({EV}) e LEFT JOIN {_STORED} c ON e.inst = c.inst AND e.inst <> 3
    WHERE c.cut IS NULL OR e.sec >= least(c.cut, {AS_OF})""")
def realtime_gate(spark, sf_dir):
    """Records older than the cutoff are dropped; an instance without stored data keeps all."""
    stored = maintenance.clear_instance(_stored_status(spark, sf_dir), 3)
    cutoff = aggregates.realtime_cutoff({"servicestatus": stored}, F.timestamp_seconds(F.lit(AS_OF)))
    events = SERVICE_STATUS.records(spark, sf_dir)
    return filters.realtime_gate(events, cutoff, event_second()).select(
        F.col("arrival.offset").alias("event_id"), "instance_id"
    )


@query("class_filter", f"SELECT event_id, CAST(206 AS INTEGER) AS rec_type FROM ({EV})")
def class_filter(spark, sf_dir):
    """Only the record classes switched on by a bit mask."""
    events = union(SERVICE_CHECK.records(spark, sf_dir), STATE.records(spark, sf_dir), COMMENT.records(spark, sf_dir))
    return filters.class_filter(events, 64 | 2).select(F.col("arrival.offset").alias("event_id"), "rec_type")


@query("subtype_filter", f"""
    SELECT event_id, k % 5 IN (0, 1) AS stored, k % 5 = 1 AS sent, k % 6 NOT IN (4, 5) AS host_stored, k % 6 = 1 AS host_sent,
    CAST(CASE WHEN k % 6 IN (2, 3) THEN 1 ELSE 0 END AS SMALLINT) AS is_raw FROM ({EV})""")
def subtype_filter(spark, sf_dir):
    """Which check subtypes are stored and which a sender passes on."""
    rows = feeds.source(spark, sf_dir, "ev").select("event_id", F.expr("700 + k % 5").alias("s"), F.expr("800 + k % 6").alias("h"))
    return rows.select(
        "event_id", filters.stored_service_check("s").alias("stored"), filters.sent_service_check("s").alias("sent"),
        filters.stored_host_check("h").alias("host_stored"), filters.sent_host_check("h").alias("host_sent"),
        wire.raw_check_flag("h").alias("is_raw"),
    )


@query("config_dump_filter", f"SELECT c_custkey FROM ({source_sql('host')}) WHERE c_custkey % 2 = 1")
def config_dump_filter(spark, sf_dir):
    """Only retained definitions."""
    return filters.config_dump_filter(HOST_DEF.records(spark, sf_dir), 2).select(F.col("arrival.offset").alias("c_custkey"))


@query("instance_scope", f"SELECT event_id FROM ({EV}) WHERE inst = 2")
def instance_scope(spark, sf_dir):
    """Records of one instance."""
    return filters.instance_scope(STATE.records(spark, sf_dir), 2).select(F.col("arrival.offset").alias("event_id"))


# ---- order-dependent operators ------------------------------------------------------------------
@query("parent_linkage", f"""
    SELECT event_id, inst AS instance_id, coalesce(last_value(CASE WHEN svc = 'purchase' THEN event_id END IGNORE NULLS)
    OVER (PARTITION BY inst ORDER BY event_id), -1) AS parent_event FROM ({EV})""")
def parent_linkage(spark, sf_dir):
    """Each event with the last purchase of its instance, in arrival order."""
    ev = feeds.source(spark, sf_dir, "ev").select("event_id", F.col("inst").alias("instance_id"), "svc")
    ev = ev.withColumn("chunk", F.expr("event_id div 1024"))
    parent = F.when(F.col("svc") == "purchase", F.col("event_id"))
    linked = carry_forward(ev, "instance_id", parent, "parent_event", order="event_id")
    return linked.select("event_id", "instance_id", F.coalesce("parent_event", F.lit(-1)).alias("parent_event"))


_RESTART = f"(SELECT inst, max(event_id) AS cut FROM ({EV}) WHERE k = 4 GROUP BY inst)"


@query("restart_clear", latest_sql(f"""
    SELECT {object_sql(2, 'host', 'svc', 'e.inst')} AS service_object_id, e.inst AS instance_id,
    {stamp_sql('sec')} AS status_update_time, CAST(k % 4 AS SMALLINT) AS current_state, event_id AS ord
    FROM ({EV}) e LEFT JOIN {_RESTART} r ON e.inst = r.inst WHERE r.cut IS NULL OR event_id > r.cut""",
    "service_object_id").replace("* EXCLUDE (rn)", "* EXCLUDE (rn, ord)"))
def restart_clear(spark, sf_dir):
    """Status rows that survive the last start of their instance."""
    starts = Feed(200, "ev", "event_id", {1: "104", 4: TV}, where="k = 4")
    events = union(SERVICE_STATUS.records(spark, sf_dir), starts.records(spark, sf_dir))
    table = warehouse.TABLES["servicestatus"].build(events, warehouse.context(events))
    return table.select("service_object_id", "instance_id", "status_update_time", "current_state")


_PROGRAM = Feed(211, "ev", "event_id", {1: "1200", 4: TV, 106: "sec - 100", 102: "event_id"}, where="k % 2 = 0")
_ENDS = Feed(200, "ev", "event_id", {1: "CASE WHEN k % 4 = 1 THEN 102 ELSE 103 END", 4: TV}, where="k % 2 <> 0")


@query("close_program", f"""
    SELECT s.inst AS instance_id, {stamp_sql('s.sec')} AS status_update_time, CAST(s.event_id AS INTEGER) AS process_id,
    CASE WHEN e.event_id > f.first_id THEN {stamp_sql('e.sec')} END AS program_end_time,
    CAST(CASE WHEN e.event_id > s.event_id THEN 0 ELSE 1 END AS SMALLINT) AS is_currently_running
    FROM (SELECT inst, arg_max(sec, event_id) AS sec, max(event_id) AS event_id FROM ({EV}) WHERE k % 2 = 0 GROUP BY inst) s
    JOIN (SELECT inst, min(event_id) AS first_id FROM ({EV}) WHERE k % 2 = 0 GROUP BY inst) f ON s.inst = f.inst
    LEFT JOIN (SELECT inst, arg_max(sec, event_id) AS sec, max(event_id) AS event_id FROM ({EV}) WHERE k % 2 <> 0 GROUP BY inst) e
    ON s.inst = e.inst""")
def close_program(spark, sf_dir):
    """Program status with the shutdowns and restarts that ended it."""
    events = union(_PROGRAM.records(spark, sf_dir), _ENDS.records(spark, sf_dir))
    return warehouse.TABLES["programstatus"].build(events, Context()).select(
        "instance_id", "status_update_time", "process_id", "program_end_time", "is_currently_running"
    )


@query("flapping_comment_time", f"""
    SELECT f.event_id, CASE WHEN f.k % 2 = 0 THEN {stamp_sql('f.sec - 5')} ELSE {stamp_sql('c.t')} END AS comment_time FROM ({EV}) f
    LEFT JOIN (SELECT inst, k % 10 AS cid, max(1700000000 + user_id) AS t FROM ({EV}) WHERE svc NOT IN ('error', 'purchase')
    GROUP BY inst, k % 10) c ON f.inst = c.inst AND f.k = c.cid""")
def flapping_comment_time(spark, sf_dir):
    """Flapping rows without a comment time take it from the comment they name."""
    feed = Feed(210, "ev", "event_id", {**FLAPPING.fields, 19: "CASE WHEN k % 2 = 0 THEN sec - 5 ELSE 0 END", 102: "event_id"})
    events = feed.records(spark, sf_dir)
    flapping = warehouse.TABLES["flappinghistory"].rows(events)
    comments = warehouse.TABLES["commenthistory"].build(COMMENT.records(spark, sf_dir))
    rows = lookup.attach_comment_time(flapping, comments)
    return rows.select(F.col("arrival.offset").alias("event_id"), "comment_time")


# ---- retention, totals, evolution ---------------------------------------------------------------
@query("trim_history", f"""
    SELECT event_id, {stamp_sql('sec')} AS start_time FROM ({EV}) WHERE k % 5 IN (0, 1) AND sec >= 1706400000 - 10080 * 60""")
def trim_history(spark, sf_dir):
    """Service checks younger than their retention age at a fixed time."""
    rows = warehouse.TABLES["servicechecks"].rows(SERVICE_CHECK.records(spark, sf_dir), only=("start_time",))
    kept = maintenance.trim(rows, "servicechecks", F.timestamp_seconds(F.lit(1706400000)))
    return kept.select(F.col("arrival.offset").alias("event_id"), "start_time")


@query("clear_instance", f"SELECT event_id FROM ({EV}) WHERE inst <> 3")
def clear_instance(spark, sf_dir):
    """All rows but those of one instance."""
    return maintenance.clear_instance(LOG_LIVE.records(spark, sf_dir), 3).select(F.col("arrival.offset").alias("event_id"))


@query("deactivate_all", f"""
    SELECT {object_sql(1, 'host')} AS object_id, CAST(CASE WHEN inst = 2 THEN 0 ELSE 1 END AS SMALLINT) AS is_active
    FROM ({source_sql('host')})""")
def deactivate_all(spark, sf_dir):
    """Objects of one instance set inactive."""
    objects = dimensions.build_objects(HOST_DEF.records(spark, sf_dir), rec_types=(400,)).where("objecttype_id = 1")
    return maintenance.deactivate_all(objects, 2).select("object_id", "is_active")


@query("runtime_totals", f"""
    WITH h AS (SELECT inst, count(*) AS n FROM ({source_sql('host')}) GROUP BY inst),
    s AS (SELECT inst, count(*) AS n FROM ({source_sql('svc')}) GROUP BY inst)
    SELECT h.inst AS instance_id, unnest(['total_hosts', 'total_services', 'average_services_per_host']) AS varname,
    unnest([CAST(h.n AS VARCHAR), CAST(coalesce(s.n, 0) AS VARCHAR), printf('%.5f', coalesce(s.n, 0) / h.n)]) AS varvalue
    FROM h LEFT JOIN s ON h.inst = s.inst""")
def runtime_totals(spark, sf_dir):
    """Totals of hosts and services per instance."""
    hosts = warehouse.TABLES["hosts"].build(HOST_DEF.records(spark, sf_dir), only=("instance_id",))
    services = warehouse.TABLES["services"].build(SERVICE_DEF.records(spark, sf_dir), only=("instance_id",))
    return aggregates.runtime_totals(hosts, services)


@query("evolve_schema", """
    SELECT p_partkey AS hostescalation_id, p_name AS alias_before, CAST(p_size AS DOUBLE) AS check_interval, '' AS display_name,
    CAST(0 AS SMALLINT) AS notify_on_downtime, CAST(0 AS INTEGER) AS importance, '' AS notes, '' AS alias,
    CAST(0 AS DOUBLE) AS x_3d FROM part""")
def evolve_schema(spark, sf_dir):
    """A table in the oldest layout brought up to the current one."""
    old = feeds.load(spark, sf_dir, "part").selectExpr(
        "p_partkey AS hostescalation_id", "p_name AS alias_before", "p_size AS check_interval")
    return evolution.evolve(old, "old_hosts", "1.2", prefixes=("old_",)).select(
        "hostescalation_id", "alias_before", "check_interval", "display_name", "notify_on_downtime", "importance",
        "notes", "alias", "x_3d",
    )


@query("evolve_state_history", f"""
    SELECT event_id, CAST(k % 4 AS SMALLINT) AS state, CAST(-1 AS SMALLINT) AS last_state,
    CAST(-1 AS SMALLINT) AS last_hard_state, '' AS long_output FROM ({EV})""")
def evolve_state_history(spark, sf_dir):
    """State history of an older version gets its new columns with their defaults."""
    old = feeds.source(spark, sf_dir, "ev").selectExpr("event_id", "CAST(k % 4 AS SMALLINT) AS state")
    return evolution.evolve(old, "statehistory", "1.3")
