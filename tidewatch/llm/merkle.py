"""Merkle manifest of a table: every row a leaf, one tree of runs of three per group, one tree of the groups' roots.

A parent is the SHA-256 of its children's digests, written as hex text one after the other.  While a parent is
hashed, the hash state before each child's slot is copied and kept; folding a changed leaf upwards resumes the state of
its slot with the replacement and the siblings to its right, and never hashes what stands to the left again.

On Spark, positions come from counts over ranges (:mod:`ranked`), so a hot group spreads over many tasks.  Trees are
climbed in bands of ``BAND`` levels: a block of 3^BAND consecutive nodes of one level is sorted into one task, which
gives the block's root; after ceil(levels / BAND) rounds every group has its root.  Coming down again, each block gets one
row with the way from its root to the top, and hands each of its nodes its own.  Every block is bounded, and a round
moves a 3^BAND-th of the rows of the one below.

Edge cases: null fields are part of the leaf; a null group is a group of its own, in front; null keys come
first within their group and are not tampered with; rows that tie in the key are ordered by leaf, and rows that also tie in it
are alike in every result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save
from .ranked import ranked

ARITY = 3
#: levels climbed in one task: blocks of at most 3^7 = 2187 nodes
BAND = 7
BLOCK = ARITY**BAND
#: rows of one Arrow batch sent back to Spark
ROWS = 4096

_STEPS = "array<struct<left:binary,right:binary>>"
_NODE = "tree binary, pos long, n long, digest binary"
_HEAD = f"tree binary, pos long, steps {_STEPS}, subroot binary, root binary"
_LEAF = ("tree binary, pos long, key long, leaf string, subroot string, root string, proof_sha256 string,"
         " folded_root string, verified boolean")


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


def levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    up = 0
    while n > 1:
        n, up = -(-n // ARITY), up + 1
    return up


def height(n: int, band: int) -> int:
    """Levels that lie in a band of a tree with ``n`` leaves."""
    return min(BAND, max(0, levels(n) - BAND * band))


def climb(nodes: list[bytes], up: int) -> tuple[bytes, list[tuple[list, list, list]]]:
    """Root of a block ``up`` levels above, and of each level (states before the slots, right siblings, all siblings)."""
    kept = []
    for _ in range(up):
        states, rights, others, above = [], [], [], []
        for at in range(0, len(nodes), ARITY):
            run, state = nodes[at:at + ARITY], hashlib.sha256()
            for slot, node in enumerate(run):
                right = b"".join(run[slot + 1:])
                states.append(state.copy())
                rights.append(right)
                others.append(b"".join(run[:slot]) + right)
                state.update(node)
            above.append(state.hexdigest().encode())
        kept.append((states, rights, others))
        nodes = above
    if len(nodes) != 1:
        raise ValueError(f"a block of {len(nodes)} nodes has no root {up} levels above")
    return nodes[0], kept


def resume(value: bytes, steps: Iterable[tuple]) -> bytes:
    """Fold a digest upwards: each parent goes on from the state before the slot."""
    for before, right in steps:
        state = before.copy()
        state.update(value)
        state.update(right)
        value = state.hexdigest().encode()
    return value


def _text(digest: bytes) -> bytes:
    return digest.hex().encode()


def _raw(text: bytes) -> bytes:
    return bytes.fromhex(text.decode())


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict | None, list[dict]]]:
    """(head, nodes) of each (tree, block) of sorted rows; the head, if any, comes first with no position."""
    here, head, nodes = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != here:
                if nodes:
                    yield head, nodes
                here, head, nodes = (row["tree"], row["block"]), None, []
            if row["pos"] is None:
                head = row
            else:
                nodes.append(row)
    if nodes:
        yield head, nodes


def _batched(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_STEPS_ARROW = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))
_NODE_ARROW = pa.schema([("tree", pa.binary()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
_HEAD_ARROW = pa.schema([("tree", pa.binary()), ("pos", pa.int64()), ("steps", _STEPS_ARROW), ("subroot", pa.binary()),
                         ("root", pa.binary())])
_LEAF_ARROW = pa.schema([("tree", pa.binary()), ("pos", pa.int64()), ("key", pa.int64()), ("leaf", pa.string()),
                         ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()),
                         ("folded_root", pa.string()), ("verified", pa.bool_())])


def _sorted_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("pos").asc_nulls_first())


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))


def block_roots(nodes: DataFrame, band: int) -> DataFrame:
    """Nodes of the next band: the root of every block."""
    def grow(batches):
        def rows():
            for _, block in _blocks(batches):
                first = block[0]
                root, _ = climb([_text(r["digest"]) for r in block], height(first["n"], band))
                yield first["tree"], first["block"], first["n"], _raw(root)
        return _batched(rows(), _NODE_ARROW)

    return _sorted_blocks(_with_block(nodes.select("tree", "pos", "n", "digest"))).mapInArrow(grow, _NODE)


def _headed(nodes: DataFrame, heads: DataFrame) -> DataFrame:
    """Nodes with one more row in front of each block: the way from its root to the top."""
    heads = heads.select("tree", F.col("pos").alias("block"), "steps", "subroot", "root")
    return _sorted_blocks(_with_block(nodes).unionByName(heads, allowMissingColumns=True))


def node_steps(nodes: DataFrame, heads: DataFrame, band: int) -> DataFrame:
    """The way of every node of a band to the top, from that of its block's root."""
    def descend(batches):
        def rows():
            for head, block in _blocks(batches):
                _, kept = climb([_text(r["digest"]) for r in block], height(block[0]["n"], band))
                digests = [r["digest"] for r in block]
                steps = [[] for _ in block]
                for level in range(len(kept)):
                    for at, path in enumerate(steps):
                        slot = at // ARITY**level
                        first = slot - slot % ARITY
                        path.append({"left": b"".join(digests[first:slot]), "right": b"".join(digests[slot + 1:first + ARITY])})
                    digests = [
                        hashlib.sha256(b"".join(map(_text, digests[i:i + ARITY]))).digest() for i in range(0, len(digests), ARITY)]
                for row, path in zip(block, steps):
                    yield row["tree"], row["pos"], path + head["steps"], head["subroot"], head["root"]
        return _batched(rows(), _HEAD_ARROW)

    return _headed(nodes.select("tree", "pos", "n", "digest"), heads).mapInArrow(descend, _HEAD)


def fold_leaves(leaves: DataFrame, heads: DataFrame) -> DataFrame:
    """Proof, folded root and verdict of every leaf."""
    def fold(batches):
        def rows():
            for head, block in _blocks(batches):
                _, kept = climb([_text(r["digest"]) for r in block], height(block[0]["n"], 0))
                # the states of the parents above this block, kept once for all its leaves
                upper = [(hashlib.sha256(_text(s["left"])), _text(s["right"])) for s in head["steps"]]
                above = b"".join(_text(s["left"]) + _text(s["right"]) for s in head["steps"])
                subroot, root = head["subroot"].hex(), head["root"].hex()
                for at, row in enumerate(block):
                    steps, proof, slot = [], [], at
                    for states, rights, others in kept:
                        steps.append((states[slot], rights[slot]))
                        proof.append(others[slot])
                        slot //= ARITY
                    value = row["digest"] if row["changed"] is None else row["changed"]
                    folded = resume(resume(_text(value), steps), upper).decode()
                    proof.append(above)
                    yield (row["tree"], row["pos"], row["key"], row["digest"].hex(), subroot, root,
                           hashlib.sha256(b"".join(proof)).hexdigest(), folded, folded == root)
        return _batched(rows(), _LEAF_ARROW)

    return _headed(leaves.select("tree", "pos", "n", "digest", "key", "changed"), heads).mapInArrow(fold, _LEAF)


def _bands(spark: SparkSession, nodes: DataFrame) -> list[DataFrame]:
    """Nodes of every band, up to the one with a single node per tree."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = [nodes]
    for band in range(-(-levels(most) // BAND) or 1):
        out.append(save(spark, block_roots(out[-1], band), "merkle-nodes"))
    return out


def manifest(spark: SparkSession, rows: DataFrame, group: str, key: str, fields: list[str],
             changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """One row per input row: ``key`` (long), leaf, subroot, root, proof_sha256, folded_root, verified.

    Groups are ordered by their text, leaves by ``key``.  ``changed`` gives other values of some fields in the rows
    for which ``where`` holds; ``folded_root`` is what these rows' leaves then fold to, with the siblings as they were.
    """
    other = [(changed or {}).get(f, F.col(f)) for f in fields]
    differs = F.lit(False)
    for f, column in (changed or {}).items():
        differs = differs | ~F.col(f).eqNullSafe(column)
    if where is not None:
        differs = differs & F.coalesce(where, F.lit(False))
    # a group's text with a mark in front, so that null comes before the empty text
    name = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    leaves = save(spark, rows.select(
        F.unhex(F.sha2(name.cast("binary"), 256)).alias("tree"), name.alias("name"), F.col(key).cast("long").alias("key"),
        F.unhex(leaf_digest(F.col(f) for f in fields)).alias("digest"),
        F.unhex(F.when(differs, leaf_digest(other))).alias("changed")), "merkle-leaves")
    placed = ranked(spark, leaves.drop("name"), "tree", [F.col("key").asc_nulls_first(), F.col("digest")]).select(
        "tree", F.col("_pos").alias("pos"), F.col("_n").alias("n"), "digest", "key", "changed")

    bands = _bands(spark, placed)
    subroots = save(spark, bands[-1].select("tree", "digest").join(
        leaves.groupBy("tree").agg(F.any_value("name").alias("name")), "tree"), "merkle-subroots")
    # the names' order decides; the driver sees a sample of their beginnings only
    top = ranked(spark, subroots.withColumn("all", F.lit(b"")), "all", ["name"], [F.substring("name", 1, 64)])
    top_nodes = save(spark, top.select(
        F.col("all").alias("tree"), F.col("_pos").alias("pos"), F.col("_n").alias("n"), "digest",
        F.col("tree").alias("of")), "merkle-groups")
    top_bands = _bands(spark, top_nodes.drop("of"))

    heads = top_bands[-1].select(
        "tree", "pos", F.array().cast(_STEPS).alias("steps"), F.lit(b"").alias("subroot"), F.col("digest").alias("root"))
    for band in range(len(top_bands) - 2, -1, -1):
        heads = node_steps(top_bands[band], heads, band)
    heads = top_nodes.select("pos", "of", "digest").join(save(spark, heads, "merkle-ways"), "pos").select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("pos"), "steps", F.col("digest").alias("subroot"), "root")
    for band in range(len(bands) - 2, 0, -1):
        heads = node_steps(bands[band], heads, band)
    out = fold_leaves(bands[0], save(spark, heads, "merkle-ways"))
    return out.select(F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
