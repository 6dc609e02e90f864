"""Language-model scoring by subword lattices.

A text is a sequence of words and an end.  A word's probability is the sum over all its segmentations: into pieces of
an existing vocabulary, by a log-space forward recursion over the lattice, and into the one arc that is the word
itself, if the corpus has it.  The piece vocabulary is the given one, in its order of scores, which sets the first
weights; one expectation step over the corpus' word types re-weights the pieces.  The weight of whole-word arcs is what
the corpus leaves after words seen once (Good-Turing).  The result is a proper distribution over word sequences.

Words are maximal runs without ASCII white space, A-Z lower-cased.  Counts cover every training row: words are counted
where rows are read, merged by one shuffle, and each distinct word is scored once.  Rows then look up the ``HOT`` most
frequent words in a table of bounded size that every worker has; the rest, none of them frequent, meet the counts in
one join.

Edge cases: null and empty texts are the end alone; rows with a null key are scored but not learned from; characters
without a piece fall back to bytes of fixed small weight; repeated rows are scored one by one; other columns are
ignored; without training rows every token has base probability 1 and pieces keep their first weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_LOWER, save
from .piece_codec import MARK, NORMAL, PieceModel

#: words looked up in the workers (some 20 MB), and distinct words counted before they are handed on
HOT, FLUSH = 1 << 17, 200_000
#: probability left for bytes of characters without a piece, and counts added to each piece
BYTE_MASS, PRIOR = 1e-4, 0.05
#: characters of the words that are scored at a time
CELLS = 1 << 15
_PRIME = np.uint64(0x100000001B3)


@dataclass
class Pieces:
    """Pieces with natural-log weights."""
    texts: list[str]
    weights: np.ndarray

    @classmethod
    def from_model(cls, model: PieceModel) -> Pieces:
        """Pieces a lower-cased word can hold; weights fall with the rank of their scores."""
        usable = [i for i, p in enumerate(model.pieces) if model.types[i] == NORMAL and p.translate(ASCII_LOWER) == p
                  and MARK not in p[1:]]
        usable.sort(key=lambda i: (-model.scores[i], i))
        texts = [model.pieces[i] for i in usable]
        return cls(texts, cls.normal(1.0 / (np.arange(len(texts)) + 10.0)))

    @staticmethod
    def normal(mass: np.ndarray) -> np.ndarray:
        return np.log(mass / mass.sum() * (1 - BYTE_MASS))


class Lattice:
    """Forward and backward recursions over batches of words of one length."""

    def __init__(self, pieces: Pieces):
        self.weights = pieces.weights
        by_length: dict[int, list[int]] = {}
        for i, text in enumerate(pieces.texts):
            by_length.setdefault(len(text), []).append(i)
        self.tables = {}
        for length, members in sorted(by_length.items()):
            codes = np.array([[ord(c) for c in pieces.texts[i]] for i in members], dtype=np.uint64)
            hashes = np.zeros(len(members), dtype=np.uint64)
            for k in range(length):
                hashes = self._step(hashes, codes[:, k])
            order = np.argsort(hashes)
            self.tables[length] = hashes[order], np.array(members)[order]

    @staticmethod
    def _step(state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        mixed = (state + codes + np.uint64(1)) * _PRIME
        return mixed ^ (mixed >> np.uint64(31))

    def arcs(self, codes: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By piece length: number of the piece that starts at each place (-1: none), and its weight."""
        size, found = codes.shape[1], {}
        state = np.zeros(codes.shape, dtype=np.uint64)
        for length in range(1, min(size, max(self.tables, default=1)) + 1):
            state = self._step(state[:, :size - length + 1], codes[:, length - 1:])
            if length not in self.tables:
                continue
            hashes, members = self.tables[length]
            at = np.minimum(np.searchsorted(hashes, state), len(hashes) - 1)
            known = hashes[at] == state
            if length > 1 and not known.any():
                continue
            number = np.where(known, members[at], -1)
            found[length] = number, np.where(known, self.weights[number], -np.inf)
        single = found.get(1) or (np.full(codes.shape, -1), np.full(codes.shape, -np.inf))
        n_bytes = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype(int)
        found[1] = single[0], np.where(single[0] < 0, n_bytes * np.log(BYTE_MASS / 256), single[1])
        return found

    @staticmethod
    def forward(arcs: dict, shape: tuple[int, int]) -> np.ndarray:
        """Log probability of every prefix, summed over its segmentations."""
        alpha = np.full((shape[1] + 1, shape[0]), -np.inf)
        alpha[0] = 0.0
        for end in range(1, shape[1] + 1):
            ways = [alpha[end - n] + w[:, end - n] for n, (_, w) in arcs.items() if n <= end]
            alpha[end] = np.logaddexp.reduce(ways)
        return alpha

    @staticmethod
    def backward(arcs: dict, shape: tuple[int, int]) -> np.ndarray:
        beta = np.full((shape[1] + 1, shape[0]), -np.inf)
        beta[shape[1]] = 0.0
        for start in range(shape[1] - 1, -1, -1):
            ways = [beta[start + n] + w[:, start] for n, (_, w) in arcs.items() if start + n <= shape[1]]
            beta[start] = np.logaddexp.reduce(ways)
        return beta

    @staticmethod
    def batches(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, code points with the leading mark) of words of equal length, at most ``CELLS`` characters."""
        lengths = np.array([len(w) + 1 for w in words])
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            size = int(lengths[order[at]])
            upto = int(np.searchsorted(lengths[order], size, "right"))
            upto = min(upto, at + max(1, CELLS // size))
            part = order[at:upto]
            joined = "".join(MARK + words[i] for i in part)
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            yield part, codes.reshape(len(part), size).astype(np.uint64)
            at = upto

    def marginals(self, words: list[str]) -> np.ndarray:
        """Natural-log probability of each word."""
        out = np.zeros(len(words))
        for part, codes in self.batches(words):
            out[part] = self.forward(self.arcs(codes), codes.shape)[-1]
        return out

    def expected(self, words: list[str]) -> np.ndarray:
        """How often each piece is expected in the words' segmentations, one occurrence of each word."""
        total = np.zeros(len(self.weights))
        for _, codes in self.batches(words):
            arcs, size = self.arcs(codes), codes.shape[1]
            alpha, beta = self.forward(arcs, codes.shape), self.backward(arcs, codes.shape)
            for n, (number, weight) in arcs.items():
                share = np.exp(alpha[:size - n + 1].T + weight + beta[n:].T - alpha[-1][:, None])
                known = number >= 0
                total += np.bincount(number[known], share[known], minlength=len(total))
        return total


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (learn, text): word counts of learned rows, and the other rows' words with count 0."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        # words are valid UTF-8, since white space is ASCII
        out = pa.RecordBatch.from_arrays([
            pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())],
            names=["word", "c"])
        counts.clear()
        return out

    for batch in batches:
        for learn, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = words_of(text.as_py())
            counts.update(found if learn else dict.fromkeys(found, 0))
            if len(counts) >= FLUSH:
                yield flush()
    if counts:
        yield flush()


def _expect(pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = Lattice(pieces.value), None
        for batch in batches:
            part = lattice.expected(batch.column(0).to_pylist())
            total = part if total is None else total + part
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["piece", "n"])
    return run


def _weigh(pieces, seen: int, distinct: int, whole: float, ends: float):
    """Rows (word, c): base and model log10 probability of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        for batch in batches:
            counts = np.asarray(batch.column(1), dtype=np.float64)
            parts = np.log(max(1 - whole, 1e-12) * (1 - ends)) + lattice.marginals(batch.column(0).to_pylist())
            with np.errstate(divide="ignore"):
                known = np.log(whole * counts / max(1, seen))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(np.log10((counts + 1) / (seen + distinct + 1))),
                pa.array(np.logaddexp(parts, known) / np.log(10))], names=["word", "c", "base", "model"])
    return run


def _look_up(hot, end: tuple[int, float, float]):
    """Rows (key, held, text): one row with the sums over frequent words, one for each other distinct word."""
    schema = pa.schema([("row", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("sums", pa.struct([
        ("key", pa.int64()), ("held", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
        ("model", pa.float64())]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, facts = hot.value
        known_words = dict(zip(words, facts))
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows, rest, times, sums = [], [], [], []
                part = batch.slice(start, 512)
                for key, held, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    total, known, base, model = 1, int(end[0] > 0), end[1], end[2]
                    for word, n in Counter(words_of(text)).items():
                        total += n
                        fact = known_words.get(word)
                        if fact is None:
                            rows.append(number)
                            rest.append(word)
                            times.append(n)
                            sums.append(None)
                        else:
                            known += n * fact[0]
                            base += n * fact[1]
                            model += n * fact[2]
                    rows.append(number)
                    rest.append(b" %d" % number)  # no word, so it meets nothing, and it spreads over the partitions
                    times.append(0)
                    sums.append({"key": key, "held": held, "n": total, "known": known, "base": base, "model": model})
                    number += 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows, pa.int64()), pa.array(rest, pa.binary()).cast(pa.string()),
                    pa.array(times, pa.int64()), pa.array(sums, schema.field(3).type)], schema=schema)
    return run


def score(spark: SparkSession, docs: DataFrame, model_file: str, learn: Column, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Key, held_out (not learned from), n_tokens, n_known, train_tokens, base_score and score of every row.

    ``learn``: whether a row is learned from.  The driver holds the pieces (32,000) and the ``HOT`` frequent words.
    """
    with open(model_file, "rb") as file:
        first = Pieces.from_model(PieceModel(file.read()))
    learned = F.coalesce(learn & F.col(key).isNotNull(), F.lit(False))
    docs = docs.select(F.col(key).cast("long").alias("key"), learned.alias("learn"), F.col(text).alias("text"))
    n_ends = docs.where("learn").count()
    counts = save(spark, docs.select("learn", "text").mapInArrow(_count, "word string, c long").groupBy("word").agg(
        F.sum("c").alias("c")), "counts")
    known = counts.where("c > 0").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once")).first()
    seen, distinct = known["n"] + n_ends, known["v"] + (n_ends > 0)
    whole = 1 - max(known["once"], 1) / max(known["n"], 1) if known["n"] else 0.0
    ends = (n_ends + 0.5) / (seen + 1)

    sent = spark.sparkContext.broadcast(first)
    gathered = counts.where("c > 0").select("word").mapInArrow(_expect(sent), "piece int, n double").groupBy(
        "piece").agg(F.sum("n").alias("n")).collect()
    mass = np.full(len(first.texts), PRIOR)
    for row in gathered:
        mass[row["piece"]] += row["n"]
    pieces = Pieces(first.texts, Pieces.normal(mass) if gathered else first.weights)
    weighed = save(spark, counts.mapInArrow(
        _weigh(spark.sparkContext.broadcast(pieces), seen, distinct, whole, ends),
        "word string, c long, base double, model double"), "weighed")

    top = weighed.where("c > 0").orderBy(F.desc("c"), "word").limit(HOT).toArrow()
    facts = list(zip([1] * top.num_rows, top.column("base").to_pylist(), top.column("model").to_pylist()))
    hot = spark.sparkContext.broadcast(([w.encode() for w in top.column("word").to_pylist()], facts))
    end = (n_ends, float(np.log10((n_ends + 1) / (seen + distinct + 1))), float(np.log10(ends)))
    rows = docs.select("key", ~F.col("learn"), "text").mapInArrow(
        _look_up(hot, end), "row long, word string, n long, "
        "sums struct<key:bigint,held:boolean,n:bigint,known:bigint,base:double,model:double>")
    # words are unique on the right, so its hash tables stay as small as its partitions
    rows = rows.join(weighed.hint("shuffle_hash"), "word", "left")
    part = lambda name: F.coalesce(f"sums.{name}", F.lit(0))
    times = lambda name: F.coalesce(F.col("n") * F.col(name), F.lit(0))
    summed = rows.groupBy("row").agg(
        F.max("sums.key").alias(key), F.max("sums.held").alias("held_out"), F.max("sums.n").alias("n_tokens"),
        F.sum(part("known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(part("base") + times("base")).alias("base_score"), F.sum(part("model") + times("model")).alias("score"))
    return summed.select(key, "held_out", "n_tokens", "n_known", F.lit(seen).cast("long").alias("train_tokens"),
                         "base_score", "score")
