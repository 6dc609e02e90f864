"""Trie of conversation prefixes with totals of every subtree.

The node of a conversation's first d turns is named by a sum of d hashes, one of each (depth, role, text): running
sums need no order across tasks, so a conversation that holds a third of all turns is summed in chunks.  The name has
128 bits; nodes are grouped by it.

Totals of subtrees are rolled up by bands of ``HEIGHT`` depths.  A node explodes only to its ancestors within its
band, which gives every node the total of its band.  The bands' topmost nodes form a trie of their own, ``HEIGHT`` times
lower, which is rolled up in the same way; then their completed totals are handed to the node they hang from and explode
to its ancestors within that band.  A depth of D takes 2 log_HEIGHT(D) rounds, and no node explodes to more than
``HEIGHT`` rows in a round, however deep the trie or large a conversation is.

Edge cases: rows without a conversation id are left out; null role and text are empty; turns that tie are ordered by the first
64 characters of role and of text and then by a hash, repeated ones count one by one; a conversation without turns belongs
to the root alone; without conversations there is no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, sent_if_small
from .ranked import looked_up, ranked

HEIGHT = 8
#: turns of a conversation summed in one window; a multiple of HEIGHT
CHUNK = 1024
#: conversation ids joined to one string
LISTED = 256
#: rows sent to all workers
SENT = 100_000
#: words of 32 bits in a name
WORDS = 4
ROOT = b"\0" * (4 * WORDS)


def placed_turns(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, pos, n, content, n_bytes): turns in order, reduced to a digest and the size of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(role, 1, 64).alias("role_begin"), F.substring(text, 1, 64).alias("text_begin"),
        F.unhex(F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text).cast("binary"), 256)).alias("content"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    placed = ranked(spark, rows, "conv_id", [F.col("turn").asc_nulls_first(), "role_begin", "text_begin", "content"])
    return save(spark, placed.select("conv_id", F.col("_pos").alias("pos"), F.col("_n").alias("n"), "content", "n_bytes"), "turns")


def rebuilt(spark: SparkSession, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) where c begins with the first h turns of c - c % 5 in place of its own; h = crc32(c) % 9."""
    counts = placed.groupBy("conv_id").agg(F.any_value("n").alias("n"))
    counts = counts.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9)
    counts = save(spark, counts.withColumn("base", F.expr("conv_id - conv_id % 5")), "conversations")
    base = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = counts.join(base, "base", "left").select(
        "conv_id", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken"))
    convs = save(spark, convs, "conversations")
    # h is at most 8 and a base serves at most nine conversations
    heads = placed.where("pos < 8").select(F.col("conv_id").alias("base"), "pos", "content", "n_bytes")
    begin = convs.join(heads, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "content", "n_bytes")
    total = placed.count()
    own = looked_up(placed.drop("n"), convs.select("conv_id", "n", "h", "taken"), "conv_id", "n", total)
    own = own.where("pos >= h").select("conv_id", F.expr("taken + pos - h + 1").alias("depth"), "content", "n_bytes")
    return begin.unionByName(own), convs.select("conv_id")


def _word(i: int) -> Column:
    return F.conv(F.substring(F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.col("content")), 256), 8 * i + 1, 8), 16, 10)


def _name(sums: list[Column]) -> Column:
    """Sums modulo 2^32 as one binary."""
    return F.unhex(F.concat(*(F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0") for s in sums)))


def named(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv, depth, key, parent, path, n_bytes): ``path`` holds the keys from the band's topmost node to the node."""
    terms = turns.select(
        F.col("conv_id").alias("conv"), "depth", "n_bytes", F.expr(f"depth div {CHUNK}").alias("chunk"),
        *(_word(i).cast("long").alias(f"w{i}") for i in range(WORDS)))
    terms = save(spark, terms, "terms")
    # a conversation's chunks, each one row
    sums = terms.groupBy("conv", "chunk").agg(*(F.sum(f"w{i}").alias(f"s{i}") for i in range(WORDS)))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    long = terms.where("chunk > 0").select("conv").distinct()
    carried = sums.join(sent_if_small(long, SENT), "conv", "left_semi").select(
        "conv", "chunk", *(F.sum(f"s{i}").over(before).alias(f"s{i}") for i in range(WORDS))).where("chunk > 0")
    upto = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = terms.join(sent_if_small(save(spark, carried, "carried"), SENT), ["conv", "chunk"], "left")
    ends = [F.sum(f"w{i}").over(upto) + F.coalesce(F.col(f"s{i}"), F.lit(0)) for i in range(WORDS)]
    rows = rows.select("conv", "depth", "n_bytes", "chunk", *(f"w{i}" for i in range(WORDS)),
                       *(e.alias(f"e{i}") for i, e in enumerate(ends)))
    rows = rows.select(
        "conv", "depth", "n_bytes", "chunk", _name([F.col(f"e{i}") for i in range(WORDS)]).alias("key"),
        _name([F.col(f"e{i}") - F.col(f"w{i}") for i in range(WORDS)]).alias("parent"))
    return save(spark, _with_path(rows, 1, "chunk").drop("chunk"), "named")


def _with_path(rows: DataFrame, step: int, *known) -> DataFrame:
    """Keys of the ancestors within a band of ``HEIGHT * step`` depths, among rows of every ``step``-th depth."""
    band = F.expr(f"depth div {HEIGHT * step}")
    inside = Window.partitionBy("conv", *known, "_band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_band", band).withColumn("path", F.collect_list("key").over(inside))
    # the root is in no conversation's rows
    top = F.when(F.col("_band") == 0, F.array(F.lit(ROOT))).otherwise(F.array().cast("array<binary>"))
    return rows.withColumn("path", F.concat(top, "path")).drop("_band")


def _root_item(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("up"),
        F.array(F.lit(ROOT)).alias("path"))


def _band_tops(spark: SparkSession, rows: DataFrame, step: int) -> DataFrame:
    """(key, depth, up, path) of the nodes at every ``step``-th depth; ``up`` is the node ``step`` depths above."""
    tops = rows.where(F.col("depth") % step == 0).select("conv", "depth", "key")
    above = tops.select("conv", (F.col("depth") + step).alias("depth"), F.col("key").alias("up"))
    linked = _with_path(tops, step).join(above, ["conv", "depth"], "left")
    linked = linked.withColumn("up", F.coalesce("up", F.lit(ROOT)))
    nodes = linked.groupBy("key").agg(*(F.any_value(c).alias(c) for c in ("depth", "up", "path")))
    return nodes.unionByName(_root_item(spark))


def _add(rows: DataFrame, key: str, weights: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(*(F.sum(w).alias(w) for w in weights))


def roll_up(spark: SparkSession, items: DataFrame, rows: DataFrame, weights: list[str], deepest: int, step: int = 1) -> DataFrame:
    """Totals of ``weights`` over each item's subtree; items: (key, depth, up, path, weights) of every ``step``-th depth."""
    def exploded(nodes: DataFrame) -> DataFrame:
        return _add(nodes.select(F.explode("path").alias("key"), *weights), "key", weights)

    inside = exploded(items)
    if deepest < HEIGHT * step:
        return inside
    inside = save(spark, inside, "inside")
    tops = save(spark, _band_tops(spark, rows, HEIGHT * step), "tops")
    totals = save(spark, roll_up(spark, tops.join(inside, "key"), rows, weights, deepest, HEIGHT * step), "totals")
    # what hangs below a band, at the node it hangs from
    hanging = items.where(f"depth > 0 AND depth % {HEIGHT * step} = 0").select("key", "up").join(totals, "key")
    below = _add(hanging.withColumn("key", F.col("up")), "key", weights)
    handed = exploded(items.drop(*weights).join(below, "key"))
    summed = _add(inside.unionByName(handed), "key", weights)
    full = totals.select("key", *(F.col(w).alias(f"_{w}") for w in weights))
    return summed.join(full, "key", "left").select("key", *(F.coalesce(f"_{w}", w).alias(w) for w in weights))


def _list_digests(spark: SparkSession, ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of ascending, comma-joined conversation ids; a long list is joined in pieces and hashed on the way."""
    placed = ranked(spark, save(spark, ends, "ends"), "key", ["conv"])
    pieces = placed.groupBy("key", F.expr(f"_pos div {LISTED}").alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"), F.any_value("_n").alias("n"))
    pieces = save(spark, pieces, "lists")
    short = pieces.where(F.col("n") <= LISTED).select("key", F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))

    def streamed(batches):
        here, state = None, None
        schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
        for batch in batches:
            keys, digests = [], []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == here:
                    state.update(b",")
                else:
                    if here is not None:
                        keys.append(here)
                        digests.append(state.hexdigest())
                    here, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], schema=schema)
        if here is not None:
            yield pa.record_batch([pa.array([here], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    long = pieces.where(F.col("n") > LISTED).select("key", "ids", "piece").repartition("key").sortWithinPartitions("key", "piece")
    return short.unionByName(long.select("key", "ids").mapInArrow(streamed, "key binary, ends_sha256 string"))


def trie(spark: SparkSession, turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node, named by its smallest conversation and its depth.

    ``turns``: (conv_id, depth from 1, content, n_bytes); ``conversations``: every conv_id once.
    """
    rows = named(spark, turns)
    members = conversations.select(F.col("conv_id").alias("conv"))
    nodes = rows.groupBy("key").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"),
        *(F.any_value(c).alias(c) for c in ("depth", "parent", "path", "n_bytes")))
    root = members.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("key"), "conv_id", "n_convs", F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("parent"), F.array(F.lit(ROOT)).alias("path"), F.lit(0).cast("long").alias("n_bytes"))
    nodes = save(spark, nodes.unionByName(root), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = save(spark, nodes.join(children, "key", "left").fillna({"n_children": 0}), "nodes")

    items = nodes.select(
        "key", "depth", F.col("parent").alias("up"), "path", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    found = nodes.agg(F.max("depth"), F.count("*")).first()
    totals = roll_up(spark, items, rows, ["n_leaves", "saved_tokens"], found[0] or 0)

    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    shown = nodes.select("key", "conv_id", "depth", "parent", "n_convs", "n_children")
    with_parent = looked_up(shown.where("parent IS NOT NULL"), parents, "parent", "n_children", found[1]).unionByName(
        shown.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")))

    last = rows.groupBy("conv").agg(F.max_by("key", "depth").alias("key"))
    ends = members.join(last, "conv", "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv")
    return with_parent.join(totals, "key").join(_list_digests(spark, ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def rebuilt_trie(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Trie of the rebuilt conversations."""
    return trie(spark, *rebuilt(spark, placed_turns(spark, turns)))
