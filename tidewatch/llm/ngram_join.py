"""Jaccard self-join on word shingles by T-occurrence search with DivideSkip.

Two sets of sizes x and y reach the similarity only if they share T = ceil(p (x + y) / (100 + p)) shingles, at least
ceil(p x / 100) of either.  So of a document's inverted lists, taken from short to long, all but T - 1 are *short*:
whoever shares T shingles stands on one of them.  Spark sorts the (shingle, document) rows of the short lists;
documents with equal sets were folded into one before.  Candidates whose shingles, counted in classes, leave no room
for T are dropped before any text moves.

The search goes in three rounds.  First each document is asked for by one other, the smallest that leads one of its
short lists, which links most of a group of near copies without pairing them.  Then the leader of each short list asks
for those on it that still lie in other components.  Last, lists whose documents lie in different components are
searched by all their documents outside the list's largest component: every link that could join two components has
such an end.  Such a list is cut into blocks whose pairs are told apart where they meet, by the class counts that come
with its rows, so that only pairs with room for T are written.  A search heap-merges the query's short lists, counts how often each
candidate stands on them, and probes the long ones by binary search in the candidate's sorted shingles until T is
reached or out of reach.

List lengths are estimated from a share of the documents; this orders the lists and does not touch the result.

Edge cases: a text with fewer words than a shingle is one shingle of all of them; null and empty texts have no
shingles and are linked with nothing; rows with one id are one node, so that unlike texts with one id join what either is
linked with (each of them searches under a key of its own); a null id takes no part in the search, and its
component is that of equal sets, if any; repeated rows are kept; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, sent_if_small, small_batches
from .components import components

#: share of the documents from which list lengths are estimated, and the most shingles told apart as frequent (8 MB)
SAMPLE, FREQUENT = 1 / 16, 1_000_000
#: candidates of a query that one search handles; a query with more is searched in several parts
PART = 256
#: ids that are sent to where the rows are read (some 20 MB); more of them are joined
SENT_IDS = 500_000
#: documents of a list that meet those of another block, or each other, in one unit of work
BLOCK = 2048
#: classes a document's shingles are counted in, which bounds what two documents can share
CLASSES = 128
#: remembered words in a worker, some 150 bytes each; hashing one anew costs little
MEMO = 32_768
_ROWS = 256


class Shingler:
    """Sorted 64-bit hashes of the distinct word shingles of a text."""

    def __init__(self, width: int):
        self.width, self.codes = width, {}

    def _code(self, word: bytes) -> int:
        if len(self.codes) >= MEMO:
            self.codes.clear()
        code = self.codes[word] = xxhash.xxh64_intdigest(word)
        return code

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else ()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        get, make = self.codes.get, self._code
        codes = np.array([get(w) or make(w) for w in words], dtype=np.uint64)
        size = min(self.width, len(codes))
        mixed = np.full(len(codes) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            mixed = (mixed ^ codes[i:len(codes) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9))


def required(x: int, y: int, percent: int) -> int:
    """T: shingles that sets of these sizes have to share."""
    return -(-percent * (x + y) // (100 + percent))


def _short(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The document's short lists: all but T - 1, frequent shingles last."""
    count = len(shingles) - -(-percent * len(shingles) // 100) + 1 if len(shingles) else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        common = frequent[at] == shingles
        shingles = np.concatenate([shingles[~common], shingles[common]])
    return shingles[:count]


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each class, 255 for that many or more."""
    counts = np.bincount((shingles >> np.uint64(40)).astype(np.int64) % CLASSES, minlength=CLASSES)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _classes(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), dtype=np.uint8).reshape(-1, CLASSES)


def _room(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether the classes of sets of these sizes leave room for the required overlap."""
    most = np.minimum(left, right).sum(axis=1, dtype=np.int64)
    full = (np.maximum(left, right) == 255).any(axis=1)  # counts that are not known
    return full | (most * (100 + percent) >= percent * (x + y))


def _plausible(percent: int):
    """Rows (a, b, key, both sizes, both sketches): those whose classes leave room for the required overlap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.asarray(batch.column(i), dtype=np.int64) for i in (3, 4))
            keep = _room(x, y, _classes(batch.column(5)), _classes(batch.column(6)), percent)
            yield batch.select([0, 1, 2]).filter(pa.array(keep))
    return run


def _describe(width: int, percent: int, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                prints = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array([p >> 64 for p in prints], dtype=np.uint64).view(np.int64)),
                    pa.array(np.array([p & (1 << 64) - 1 for p in prints], dtype=np.uint64).view(np.int64)),
                    pa.array([_sketch(s) for s in sets], pa.binary()),
                    _lists([_short(s, frequent.value, percent) for s in sets]),
                ], names=["doc", "n", "f1", "f2", "sketch", "keys"])
    return run


def _frequent(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles that occur repeatedly in a sample, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                sets = [shingler(t) for t in batch.slice(at, _ROWS).column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["key"])

    place = (F.xxhash64("doc").cast("double") / 2.0**64) + 0.5
    rows = docs.where(place < SAMPLE).mapInArrow(run, "key long")
    found = rows.groupBy("key").count().where("count > 1").orderBy(F.desc("count"), "key").limit(FREQUENT)
    return np.sort(np.asarray(found.select("key").toArrow().column(0), dtype=np.int64).view(np.uint64))


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc, n) in the order of key and doc: those of lists with several, each with the list's first row."""
    held = None  # first row of the list at the end of the last batch, and whether it was given out
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, n = (np.asarray(batch.column(i)) for i in range(3))
        if held:
            key, doc, n = (np.concatenate([[h], x]) for h, x in zip(held, (key, doc, n)))
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        give = np.repeat(sizes > 1, sizes)
        if held and held[3]:
            give[0] = False
        last = starts[-1]
        held = key[last], doc[last], n[last], bool(sizes[-1] > 1 or len(starts) == 1 and held and held[3])
        first = np.repeat(starts, sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[give]) for x in (key, doc, n, doc[first], n[first])], names=["key", "doc", "n", "hub", "hub_n"])


def _open_pairs(percent: int):
    """Rows (key, i, j, block, outside, component, doc, n, sketch) by key, i and j: pairs that may still join two components.

    A unit (key, i, j) holds two blocks of a list, or one if i = j.  The end outside the list's largest component asks.
    """
    def pairs(key: int, i: int, j: int, rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        block, outside, part, doc, n, classes = rows
        place = np.arange(len(doc))
        for at in place if i == j else np.flatnonzero(block == i):
            fits = (place > at if i == j else block == j) & (part != part[at])
            if not outside[at]:
                fits &= outside
            fits &= 100 * np.minimum(n, n[at]) >= percent * np.maximum(n, n[at])
            others = np.flatnonzero(fits)
            if len(others):
                others = others[_room(n[at], n[others], classes[at], classes[others], percent)]
            if len(others):
                asks = outside[at] & (~outside[others] | (doc[others] > doc[at]))
                yield (np.where(asks, doc[at], doc[others]), np.where(asks, doc[others], doc[at]),
                       np.full(len(others), key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts = None, []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def given() -> pa.RecordBatch:
            out = [pa.array(np.concatenate(x)) for x in zip(*found)]
            found.clear()
            return pa.RecordBatch.from_arrays(out, names=["a", "b", "key"])

        def ended() -> Iterator[pa.RecordBatch]:
            for some in pairs(*unit, [np.concatenate(x) for x in zip(*parts)]):
                found.append(some)
                if len(found) >= _ROWS:
                    yield given()

        for batch in batches:
            units = [np.asarray(batch.column(i)) for i in range(3)]
            columns = [np.asarray(batch.column(3)), batch.column(4).to_numpy(zero_copy_only=False),
                       *(np.asarray(batch.column(i)) for i in (5, 6, 7)), _classes(batch.column(8))]
            changes = np.any([u[1:] != u[:-1] for u in units], axis=0)
            cuts = [0, *(np.flatnonzero(changes) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                now = tuple(int(u[a]) for u in units)
                if now != unit:
                    if parts:
                        yield from ended()
                    unit, parts = now, []
                parts.append([c[a:b] for c in columns])
        if parts:
            yield from ended()
        if found:
            yield given()
    return run


def divide_skip(query: np.ndarray, short: dict[int, list[int]], candidates: list[np.ndarray], percent: int) -> list[int]:
    """Candidates that share T shingles with the query.

    ``short``: for some of the query's shingles, the numbers of candidates known to have it, in order.  Whatever the
    merge has not counted for a candidate is a long list: it is probed in the candidate's own shingles.
    """
    met: dict[int, list[int]] = {}
    streams = [[(number, key) for number in numbers] for key, numbers in short.items()]
    for number, key in heapq.merge(*streams):
        met.setdefault(number, []).append(key)
    found = []
    for number, keys in met.items():
        other, count = candidates[number], len(keys)
        need = required(len(query), len(other), percent)
        probes = query[~np.isin(query, np.array(keys, dtype=np.uint64))]
        for at in range(0, len(probes), 128):
            if count >= need or count + len(probes) - at < need:
                break
            part = probes[at:at + 128]
            place = np.minimum(np.searchsorted(other, part), len(other) - 1)
            count += int((other[place] == part).sum())
        if count >= need:
            found.append(number)
    return found


def _search(width: int, percent: int):
    """Rows (a, part, b, text, keys) by a and part, the query itself (b = a) first: links (a, b)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        unit = query = None
        waiting: list[tuple[int, np.ndarray, list[int]]] = []

        def links() -> pa.RecordBatch:
            short: dict[int, list[int]] = {}
            for number, (_, _, keys) in enumerate(waiting):
                for key in set(keys):
                    short.setdefault(key & (1 << 64) - 1, []).append(number)
            hits = divide_skip(query, short, [w[1] for w in waiting], percent) if query is not None else []
            out = [waiting[i][0] for i in hits]
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([unit[0]] * len(out), pa.int64()), pa.array(out, pa.int64())], names=["a", "b"])

        for batch in batches:
            a, part, b = (np.asarray(batch.column(i)) for i in range(3))
            for row in range(batch.num_rows):
                now = a[row], part[row]
                if now != unit:
                    if waiting:
                        yield links()
                    unit, query = now, None
                shingles = shingler(batch.column(3)[row].as_py())
                if a[row] == b[row]:
                    query = shingles
                else:
                    waiting.append((int(b[row]), shingles, batch.column(4)[row].as_py()))
                    if len(waiting) >= PART:
                        yield links()
        if waiting:
            yield links()
    return run


def _with_room(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of rows (a, b, key) those whose classes leave room for the required overlap."""
    sketches = sets.select("doc", "n", "sketch").distinct()
    return pairs.join(sketches.toDF("a", "na", "sa"), "a").join(sketches.toDF("b", "nb", "sb"), "b").select(
        "a", "b", "key", "na", "nb", "sa", "sb").mapInArrow(_plausible(percent), "a long, b long, key long")


def _verified(spark: SparkSession, pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links among rows (a, b, key), where a asks for b, which it meets on the short list key."""
    asked = pairs.groupBy("a", "b").agg(F.collect_set("key").alias("keys"))
    asked = save(spark, asked, "asked")
    parts = asked.groupBy("a").agg(F.ceil(F.count("*") / F.lit(4 * PART)).cast("int").alias("parts"))
    members = asked.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts").cast("int"))
    queries = parts.select(
        "a", F.col("a").alias("b"), F.array().cast("array<bigint>").alias("keys"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    members = members.select("a", "b", "keys", "part").unionByName(queries)
    wanted = save(spark, asked.select("a").union(asked.select("b")).distinct().toDF("doc"), "wanted")
    docs = docs.join(sent_if_small(wanted, SENT_IDS), "doc", "left_semi")
    rows = members.join(docs.withColumnRenamed("doc", "b"), "b").select("a", "part", "b", "text", "keys")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b") != F.col("a"), "b")
    return rows.mapInArrow(_search(width, percent), "a long, b long")


def _sized(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def link(spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Key, n_shingles and component_id (smallest key reachable by links) of every row."""
    small_batches(spark)
    docs = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    content = F.xxhash64("text")
    shared = save(spark, docs.where("doc IS NOT NULL").groupBy("doc").agg(F.min(content).alias("lo"), F.max(content).alias("hi")).where(
        "lo <> hi").select("doc"), "shared")
    if shared.isEmpty():
        return _link(spark, docs, width, percent).toDF(key, "n_shingles", "component_id")
    # unlike texts of one id search under a key of their own; afterwards the id joins their components
    marked = docs.join(sent_if_small(shared.withColumn("several", F.lit(True)), SENT_IDS), "doc", "left")
    nodes = save(spark, marked.select(
        F.when(F.col("several"), F.xxhash64("doc", "text")).otherwise(F.col("doc")).alias("node"), "doc", "several", "text"), "nodes")
    found = _link(spark, nodes.select(F.col("node").alias("doc"), "text"), width, percent).toDF("node", "n", "part")
    ids = nodes.select("node", "doc", "several").where("node IS NOT NULL").distinct()
    # rows without an id only follow the component of an equal set
    known = save(spark, found.where("node IS NOT NULL").distinct().join(ids, "node"), "parts")
    several = known.where("several AND n > 0").groupBy("doc").agg(F.min("part").alias("b"))
    joined = components(spark, known.where("several AND n > 0").join(several, "doc").select(F.col("part").alias("a"), "b").where("a <> b"))
    named = known.where("n > 0").join(joined.toDF("part", "_whole"), "part", "left").select(
        "doc", "part", F.coalesce("_whole", "part").alias("whole"))
    least = named.groupBy("whole").agg(F.min("doc").alias("component_id"))
    final = named.select("part", "whole").distinct().join(least, "whole").select("part", "component_id")
    final = save(spark, final, "final")
    counts = nodes.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("times"))
    result = known.select("node", "doc", "n", "part").join(counts, "node")
    result = result.join(sent_if_small(final, SENT_IDS), "part", "left").select(
        "doc", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
        F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_time")).drop("_time")
    nameless = found.where("node IS NULL").join(sent_if_small(final, SENT_IDS), "part", "left").select(
        F.lit(None).cast("long").alias("doc"), "n", "component_id")
    return result.unionByName(nameless).toDF(key, "n_shingles", "component_id")


def _link(spark: SparkSession, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc, n_shingles and component_id of rows (doc, text) where an id has one text."""
    frequent = spark.sparkContext.broadcast(_frequent(docs, width))
    sets = save(spark, docs.mapInArrow(
        _describe(width, percent, frequent), "doc long, n long, f1 long, f2 long, sketch binary, keys array<long>"),
        "sets")
    # documents with equal sets stand for each other: the smallest is searched for
    classes = sets.where("n > 0").groupBy("f1", "f2").agg(F.min("doc").alias("rep"))
    copies = save(spark, sets.select("doc", "f1", "f2").join(classes, ["f1", "f2"]).where("doc <> rep").select(
        "doc", "f1", "f2").distinct(), "copies")
    searched = sets.where("doc IS NOT NULL").join(sent_if_small(copies, SENT_IDS), ["doc", "f1", "f2"], "left_anti")
    short = searched.select(F.explode("keys").alias("key"), "doc", "n").repartition("key")
    lists = save(spark, short.sortWithinPartitions("key", "doc").mapInArrow(
        _shared_lists, "key long, doc long, n long, hub long, hub_n long"), "lists")

    led = lists.where((F.col("hub") != F.col("doc")) & _sized(F.col("n"), F.col("hub_n"), percent)).select(
        F.col("hub").alias("a"), F.col("doc").alias("b"), "key")
    nearest = led.groupBy("b").agg(F.min_by(F.struct("a", "key"), F.struct("a", "key")).alias("_m")).select(
        "_m.a", "b", "_m.key")
    links = save(spark, _verified(spark, _with_room(nearest, sets, percent), docs, width, percent), "links")
    named = components(spark, links)

    apart = led.join(named.toDF("a", "_ca"), "a", "left").join(named.toDF("b", "_cb"), "b", "left").where(
        F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b", "key")
    apart = apart.join(nearest.select("a", "b"), ["a", "b"], "left_anti").groupBy("a", "b").agg(F.min("key").alias("key"))
    apart = save(spark, apart, "pairs")
    links = save(spark, links.union(_verified(spark, _with_room(apart, sets, percent), docs, width, percent)), "links")
    named = components(spark, links)

    rows = lists.join(named.withColumnRenamed("node", "doc"), "doc", "left").select(
        "key", F.coalesce("component", "doc").alias("component"), "doc", "n", "hub")
    size = rows.groupBy("key", "component").agg(F.count("*").alias("size"))
    mixed = size.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"), F.sum("size").alias("size"),
        F.count("*").alias("several")).where("several > 1").select(
        "key", "largest", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks"))
    # the leader of a list has asked for all of it
    rows = rows.where("doc <> hub").join(mixed, "key").join(sets.select("doc", "sketch").distinct(), "doc").select(
        "key", F.pmod(F.xxhash64("doc"), "blocks").cast("int").alias("block"),
        (F.col("component") != F.col("largest")).alias("outside"), "component", "doc", "n", "sketch",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "outside",
        "component", "doc", "n", "sketch")
    opened = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
        _open_pairs(percent), "a long, b long, key long")
    done = nearest.select("a", "b").union(apart.select("a", "b")).select(
        F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    opened = save(spark, opened.join(
        done, (F.least("a", "b") == F.col("lo")) & (F.greatest("a", "b") == F.col("hi")), "left_anti"), "pairs")
    more = save(spark, _verified(spark, opened, docs, width, percent), "links")
    named = components(spark, links.union(more))

    owners = classes.join(named, classes["rep"] == named["node"], "left").select(
        "f1", "f2", F.coalesce("component", "rep").alias("component_id"))
    return sets.select("doc", "n", "f1", "f2").join(owners, ["f1", "f2"], "left").select(
        "doc", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
