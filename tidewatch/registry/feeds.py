"""Monitoring records made from the driver tables.

A feed says, once and in SQL both engines understand, which rows of which source become records and
which attributes they carry.  ``records`` writes them as wire bodies, so a query runs the real decoding
and table builders; ``typed_sql`` states the plain values the decoded rows must have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import wire
from ..plans import columns
from ..session import prepare

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")
CHUNK = 1 << 16


class Spark:
    """Source SQL in Spark's dialect; tables are passed in as DataFrames."""

    @staticmethod
    def table(name):
        return "{" + name + "}"

    @staticmethod
    def micros(col):
        return f"unix_micros(CAST({col} AS TIMESTAMP))"

    div = "div"


class Duck:
    @staticmethod
    def table(name):
        return name

    @staticmethod
    def micros(col):
        return f"epoch_us({col})"

    div = "//"


def source_sql(name: str, d=Duck) -> str:
    """Base rows.  Every source has ``inst``, the instance the rows belong to."""
    t = d.table
    inst = "CAST(n.n_regionkey + 1 AS SMALLINT) AS inst"
    if name in ("ev", "ev1"):
        if name == "ev1":  # all events on one instance
            inst = "CAST(1 AS SMALLINT) AS inst"
        us = d.micros("e.ts")
        return f"""SELECT e.event_id, {us} {d.div} 1000000 AS sec, CAST({us} % 1000000 AS INT) AS usec,
            e.user_id, c.c_name AS host, e.event_type AS svc, e.value,
            CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INT) AS k, {inst}
            FROM {t('events')} e JOIN {t('customer')} c ON e.user_id = c.c_custkey
            JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey"""
    if name == "svc":
        return f"""SELECT e.svc, c.c_custkey, c.c_name AS host, {inst}
            FROM (SELECT user_id, event_type AS svc FROM {t('events')} GROUP BY user_id, event_type) e
            JOIN {t('customer')} c ON e.user_id = c.c_custkey
            JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey"""
    if name == "host":
        return f"""SELECT c.c_custkey, c.c_name AS host, c.c_acctbal, c.c_mktsegment, {inst}
            FROM {t('customer')} c JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey"""
    if name == "parent":
        return f"""SELECT c.c_custkey, c.c_name AS host, p.c_name AS parent, {inst}
            FROM {t('customer')} c JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey
            JOIN {t('customer')} p ON p.c_custkey = c.c_custkey {d.div} 10"""
    if name == "contact":
        return f"""SELECT s.s_suppkey, s.s_name AS contact, s.s_acctbal, {inst}
            FROM {t('supplier')} s JOIN {t('nation')} n ON s.s_nationkey = n.n_nationkey"""
    if name == "part":
        return f"""SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
            CAST(1 AS SMALLINT) AS inst FROM {t('part')} p"""
    if name == "ord":
        us = d.micros("o.o_orderdate")
        return f"""SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
            {us} {d.div} 1000000 AS sec, c.c_name AS host, {inst}
            FROM {t('orders')} o JOIN {t('customer')} c ON o.o_custkey = c.c_custkey
            JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey"""
    if name == "line":
        us = d.micros("l.shipdate")
        odate = d.micros("o.o_orderdate")
        return f"""SELECT l.l_orderkey AS o_orderkey, l.l_partkey, l.l_linenumber, {us} {d.div} 1000000 AS sec,
            {odate} {d.div} 1000000 AS order_sec, o.o_orderpriority, c.c_name AS host, s.s_name AS contact, {inst}
            FROM (SELECT l_orderkey, l_partkey, l_linenumber, min(l_suppkey) AS suppkey, min(l_shipdate) AS shipdate
                  FROM {t('lineitem')} GROUP BY l_orderkey, l_partkey, l_linenumber) l
            JOIN {t('orders')} o ON l.l_orderkey = o.o_orderkey
            JOIN {t('customer')} c ON o.o_custkey = c.c_custkey
            JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey
            JOIN {t('supplier')} s ON l.suppkey = s.s_suppkey"""
    raise KeyError(name)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    sql = source_sql(name, Spark)
    used = {t: load(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("smallint").alias("instance_id"),
        F.col("r_name").alias("instance_name"),
        F.lit("").alias("instance_description"),
    )


INSTANCES_SQL = "SELECT CAST(r_regionkey + 1 AS SMALLINT) AS instance_id, r_name AS instance_name FROM region"


@dataclass(frozen=True)
class Feed:
    """Records of one type.  ``fields``: key -> SQL, a (seconds, microseconds) pair, or a list of SQL."""

    rec_type: int
    source: str
    order: str
    fields: dict = field(hash=False)
    where: str = "TRUE"
    config_type: str = "0"
    #: span of ``order`` that makes a chunk; wider where the orders lie far apart, for a chunk is a run of many records
    chunk: int = CHUNK

    def records(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        base = source(spark, sf_dir, self.source)
        return self.over(base)

    def over(self, base: DataFrame) -> DataFrame:
        parts = []
        for key, value in self.fields.items():
            if isinstance(value, tuple):
                text = F.concat(F.expr(value[0]), F.lit("."), F.lpad(F.expr(value[1]).cast("string"), 6, "0"))
            elif isinstance(value, list):
                text = F.array(*[F.expr(v).cast("string") for v in value])
            else:
                text = F.expr(value)
            parts.append((key, text))
        order = F.expr(self.order).cast("bigint")
        return base.where(self.where).select(
            F.col("inst").alias("instance_id"),
            F.struct(F.lit(0).cast("bigint").alias("batch"), F.lit("").alias("file"), order.alias("offset")).alias("arrival"),
            F.struct(F.lit("").alias("file"), F.expr(f"({self.order}) div {self.chunk}L").cast("bigint").alias("n")).alias("chunk"),
            F.struct(F.lit("").alias("file"), F.col("inst").cast("bigint").alias("number")).alias("session"),
            F.lit(self.rec_type).alias("rec_type"),
            F.expr(self.config_type).cast("smallint").alias("config_type"),
            wire.encode_body(*parts).alias("body"),
        )

    def typed_sql(self, layout: str, given: dict[str, str], extra: str = "") -> str:
        """Plain SELECT of a table layout over this feed's source; ``ord`` is the arrival."""
        out = []
        for name, kind, key in columns.parse(layout):
            value = given[name] if kind == "=" else sql_value(kind, self.fields.get(key))
            out.append(f"{value} AS {name}")
        extra = f", {extra}" if extra else ""
        return (
            f"SELECT {', '.join(out)}, {self.order} AS ord{extra} "
            f"FROM ({source_sql(self.source)}) WHERE {self.where}"
        )


def union(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def in_parts(events: DataFrame, parts: int, files: int) -> Iterator[DataFrame]:
    """Records in equal spans of their order, each dealt to ``files`` partitions that follow one another.

    The bounds of the partitions are taken from the order alone, so no record is made for them.
    """
    offset = F.col("arrival.offset")
    last = events.agg(F.max(offset)).first()[0] or 0
    part = F.expr(f"arrival.offset * {parts} div {last + 1}")
    shares = [i / files for i in range(1, files)] or [1.0]
    bounds = dict(events.groupBy(part.alias("part")).agg(F.percentile_approx(offset, shares)).collect())
    for number in range(parts):
        place = F.lit(0)
        for bound in sorted(set(bounds.get(number, [])))[:files - 1]:
            place = place + (offset > bound).cast("int")
        yield events.where(part == number).repartitionById(files, place).sortWithinPartitions("arrival")


# ---- oracle fragments -------------------------------------------------------------------------
def hash_sql(*parts: str) -> str:
    texts = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(concat('0x', substr(md5(concat_ws(chr(1), {texts})), 1, 15)) AS BIGINT)"


def object_sql(objecttype, name1: str, name2: str = "''", inst: str = "inst") -> str:
    return (
        f"(CASE WHEN {name1} = '' AND {name2} = '' THEN 0 ELSE "
        f"{hash_sql(inst, str(objecttype), name1, name2)} END)"
    )


def row_sql(table: str, *parts: str) -> str:
    return hash_sql(f"'{table}'", *parts)


def arrival_sql(table: str, order: str) -> str:
    return row_sql(table, "''", order)


def stamp_sql(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"


def sql_value(kind: str, value) -> str:
    if kind in ("i16", "i32", "i64"):
        return f"CAST({value or 0} AS {'SMALLINT' if kind == 'i16' else 'INTEGER' if kind == 'i32' else 'BIGINT'})"
    if kind == "f64":
        return f"CAST({value or 0} AS DOUBLE)"
    if kind == "str":
        return f"CAST({value} AS VARCHAR)" if value else "''"
    if kind == "ts":
        return stamp_sql(value or 0)
    if kind == "tv":
        return stamp_sql(value[0] if value else 0)
    if kind == "us":
        return f"CAST({value[1] if value else 0} AS INTEGER)"
    if kind.startswith("obj"):
        return object_sql(kind[3:], value) if value else "CAST(0 AS BIGINT)"
    if kind == "cmd":
        return object_sql(12, f"split_part({value}, '!', 1)") if value else "CAST(0 AS BIGINT)"
    if kind == "arg":
        return f"CASE WHEN contains({value}, '!') THEN substr({value}, strpos({value}, '!') + 1) ELSE '' END" if value else "''"
    raise ValueError(kind)
