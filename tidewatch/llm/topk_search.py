"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation over blocks of rows.

Vectors are rows of weighted terms (term: position in the vector, weight: quantised component, zero weights left
out).  Rows are packed into bounded blocks where they are read.  Each block of queries meets each block of candidates
once; inside, every query scatters weight times posting into a dense score array, and a partition selection keeps
its best rows.  A ranked window merges the blocks, with its own limit applied before the exchange.

Edge cases: a vector that is null or holds a null or non-finite component takes no part; vectors of different
lengths are taken as zero where they end; equal scores go to the smaller id; a query never meets rows with its own
id; of repeated rows each counts as a candidate, and of several query rows with one id the largest vector asks.
Weights saturate at the range of a long and sums wrap around it.  Null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "ids binary, starts binary, terms binary, weights binary"
_ARROW_BLOCK = pa.schema([(name, pa.binary()) for name in ("ids", "starts", "terms", "weights")])
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_LONG = 9.2e18
#: rows and components of a packed block, and query rows of a block
BLOCK_ROWS, BLOCK_CELLS, QUERY_ROWS = 4096, 1 << 20, 1024
#: groups of candidate blocks a shuffle task
GROUPS_A_TASK = 4


def quantise(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as long, saturating."""
    return np.clip(np.floor(values.astype(np.float64) * scale), -_LONG, _LONG).astype(np.int64)


def sparse_rows(ids: pa.Array, vectors: pa.Array, scale: float) -> tuple[np.ndarray, ...]:
    """(ids, starts, terms, weights) of the rows that take part."""
    usable = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    ids, vectors = ids.filter(pa.array(usable)), vectors.filter(pa.array(usable))
    flat = vectors.flatten()
    lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    owner = np.repeat(np.arange(len(lengths)), lengths)
    good = np.ones(len(lengths), dtype=bool)
    good[owner[~np.isfinite(values)]] = False
    terms = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weights = quantise(np.where(np.isfinite(values), values, 0.0), scale)
    keep = good[owner] & (weights != 0)
    counts = np.bincount(owner[keep], minlength=len(lengths))[good]
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return np.asarray(ids, dtype=np.int64)[good], starts, terms[keep].astype(np.int32), weights[keep]


def _blobs(ids, starts, terms, weights) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part.tobytes()], pa.binary()) for part in (ids, starts, terms, weights)], schema=_ARROW_BLOCK
    )


def pack(scale: float, rows: int = BLOCK_ROWS, cells: int = BLOCK_CELLS):
    """mapInArrow function: (id, vector) rows to blocks of at most ``rows`` rows and about ``cells`` components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            lengths = np.asarray(batch.column(1).value_lengths().fill_null(0), dtype=np.int64)
            ends = np.cumsum(lengths)
            while at < batch.num_rows:
                base = ends[at - 1] if at else 0
                upto = max(at + 1, min(at + rows, int(np.searchsorted(ends, base + cells, "right"))))
                part = batch.slice(at, upto - at)
                at = upto
                packed = sparse_rows(part.column(0), part.column(1), scale)
                if len(packed[0]):
                    yield _blobs(*packed)
    return run


class Postings:
    """Inverted lists of one block."""

    def __init__(self, ids, starts, terms, weights):
        self.ids = ids
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.rows, self.weights = owner[order], weights[order]
        self.terms, first = np.unique(terms[order], return_index=True)
        self.bounds = np.append(first, len(terms))

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Dense scores of one query, term at a time."""
        out = np.zeros(len(self.ids), dtype=np.int64)
        slots = np.searchsorted(self.terms, terms)
        for term, weight, slot in zip(terms, weights, slots):
            if slot == len(self.terms) or self.terms[slot] != term:
                continue
            a, b = self.bounds[slot], self.bounds[slot + 1]
            if b - a == len(out):  # every row has the term, in row order
                out += weight * self.weights[a:b]
            else:
                out[self.rows[a:b]] += weight * self.weights[a:b]
        return out


def best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> np.ndarray:
    """Positions of the k best rows, without the query's own; ties to smaller ids."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at].astype(np.float64), ))][:k] if _exact(scores[at]) else \
        np.array(sorted(at, key=lambda i: (-int(scores[i]), ids[i]))[:k], dtype=np.int64)


def _exact(scores: np.ndarray) -> bool:
    """Whether doubles keep these scores apart."""
    return len(scores) == 0 or bool(np.abs(scores.astype(np.float64)).max() < 2.0**53)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for row in range(batch.num_rows):
                    yield _block_hits(batch, row, k)
    return run


def _block_hits(batch: pa.RecordBatch, row: int, k: int) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int32, np.int64)
    parts = [np.frombuffer(batch.column(i)[row].as_buffer(), dtype=kinds[i % 4]) for i in range(8)]
    postings = Postings(*parts[:4])
    queries, starts, terms, weights = parts[4:]
    out: list[list[np.ndarray]] = [[], [], []]
    for q, own in enumerate(queries):
        a, b = starts[q], starts[q + 1]
        scores = postings.scores(terms[a:b], weights[a:b])
        top = best(postings.ids, scores, own, k)
        out[0].append(np.full(len(top), own))
        out[1].append(postings.ids[top])
        out[2].append(scores[top])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], schema=_HITS)


def top_k(rows: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of every row for which ``queries`` holds."""
    pairs = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    asking = rows.where(queries).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    asking = asking.where("id IS NOT NULL AND vector IS NOT NULL").groupBy("id").agg(F.max("vector").alias("vector"))
    blocks = -(-asking.count() // QUERY_ROWS) or 1

    def pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # each partition is one block of queries
        got = pa.Table.from_batches(batches, pa.schema([("id", pa.int64()), ("vector", pa.list_(pa.float64()))]))
        got = got.combine_chunks()
        if got.num_rows:
            packed = sparse_rows(got.column(0).combine_chunks(), got.column(1).combine_chunks(), scale)
            yield pa.RecordBatch.from_arrays(
                _blobs(*packed).columns, schema=pa.schema([(f"q_{f.name}", f.type) for f in _ARROW_BLOCK]))

    asked = asking.repartition(blocks).mapInArrow(
        pack_queries, "q_ids binary, q_starts binary, q_terms binary, q_weights binary")
    # candidates move once, to groups that spread over all tasks; the few blocks of queries are copied to every group
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = GROUPS_A_TASK * tasks
    spread = pairs.mapInArrow(pack(scale), _BLOCK).withColumn("group", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    copied = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    units = spread.repartition(tasks, "group").join(copied.repartition(tasks, "group"), "group").drop("group")
    hits = units.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", ranked).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
