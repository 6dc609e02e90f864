"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence's logit is a bias plus the weights of its distinct words and of their beginnings; a document is toxic
unless none of its distinct sentences is (noisy-or).  Weights are trained from document labels alone, by proximal
gradient steps that leave most features at zero, and then locate the offending sentences.

The classifier is fitted on a sample of labelled documents bounded in number (``per_label`` for each label, chosen by
a hash of the key) and in size (``most_bytes`` of text, whole documents in that order).  Workers cut it into hashes
of features, Spark counts these, and the driver gets the numbers of the features that occur in ``least`` documents, four
bytes each.  Scores cover every row and whole texts.

Edge cases: of several texts with one key the smallest is learned from; null and empty texts get the score of a document without sentences, 0; without labels of both kinds
every score is 0; null keys and labels are not learned from; several labels of a key count as toxic if one does;
repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import save, small_batches

#: sentence ends as line feeds, other ASCII punctuation as spaces; lengths stay
_PLAIN = bytes(10 if chr(c) in ".!?\n\r" else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
#: bytes of the word beginnings that are features of their own
BEGINNINGS = (4, 5, 6, 7, 8)
#: remembered words in a worker, some 100 bytes each; the table starts anew when it is full
MEMO = 100_000
#: remembered words while the training texts are cut, with all their features, some 500 bytes each
CUT_MEMO = 16_384
#: rows cut at a time
_ROWS = 128
#: longest word remembered
REMEMBERED = 64


def _lower(text: str) -> bytes:
    """Lower-cased UTF-8 with every character at the place it had."""
    low, plain = text.lower().encode(), text.encode()
    if len(low) != len(plain):
        low = b"".join(b if len(b := c.lower().encode()) == len(a := c.encode()) else a for c in text)
    return low


def features(word: bytes) -> list[bytes]:
    """The word and its beginnings, which end with a star."""
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) >= n)]


def codes(word: bytes) -> list[int]:
    """The features as signed 64-bit hashes."""
    return [xxhash.xxh3_64_intdigest(f) - 2**63 for f in features(word)]


def sentences(text: str | None) -> list[tuple[int, bytes]]:
    """(first byte, words) of each stretch between sentence ends."""
    at, found = 0, []
    for part in _lower(text or "").translate(_PLAIN).split(b"\n"):
        if part and not part.isspace():
            found.append((at, part))
        at += len(part) + 1
    return found


@dataclass
class ToxicityModel:
    #: weight by hash of the feature
    weights: dict[int, float] = field(default_factory=dict)
    bias: float | None = None
    #: words seen lately: their features with a weight
    memo: dict[bytes, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def _weighted(self, word: bytes) -> tuple[int, ...]:
        found = tuple(f for f in codes(word) if f in self.weights)
        if len(word) <= REMEMBERED:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = found
        return found

    def sentence_logits(self, text: str | None) -> list[tuple[int, int, float]]:
        """(first byte, byte after, logit) of each sentence."""
        memo, rare, out = self.memo, self._weighted, []
        for at, words in sentences(text):
            found: set[int] = set()
            for word in words.split():
                known = memo.get(word)
                if known is None:
                    known = rare(word)
                if known:
                    found.update(known)
            out.append((at, at + len(words), self.bias + sum(self.weights[f] for f in sorted(found))))
        return out

    def score(self, text: str | None, located: float = 0.3) -> tuple[float, list[dict]]:
        """Noisy-or of the sentences, and those that reach ``located`` alone."""
        if self.bias is None:
            return 0.0, []
        scored = self.sentence_logits(text)
        if not scored:
            return 0.0, []
        data = _lower(text).translate(_PLAIN)
        distinct = {data[a:b]: z for a, b, z in scored}  # a repeated sentence says nothing new
        logits = np.array(list(distinct.values()))
        # log(1 - sigmoid(z)) = -log(1 + e^z)
        total = float(-np.expm1(-np.logaddexp(0.0, logits).sum()))
        limit = np.log(located / (1 - located))
        found = [{"begin": a, "end": b, "score": float(1 / (1 + np.exp(-z)))} for a, b, z in scored if z >= limit]
        return min(1.0, max(0.0, total)), found


def train(tokens: np.ndarray, owners: np.ndarray, docs: np.ndarray, labels: np.ndarray, n: int, share: float,
          steps: int = 150, rate: float = 0.2, sparsity: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights of ``n`` features and a bias.

    ``tokens``: the features of each sentence, one after the other; ``owners``: the sentence of each token; ``docs``: the
    document of each sentence; ``share``: how much of what the sample comes from is toxic.
    """
    y = labels.astype(float)
    weigh = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    weights, bias = np.zeros(n), -6.0
    mean, spread, bias_mean, bias_spread = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, steps + 1):
        z = bias + np.bincount(owners, weights[tokens], minlength=len(docs))
        clean = np.bincount(docs, np.logaddexp(0.0, z), minlength=len(y))  # -log P(no toxic sentence)
        toxic = np.maximum(-np.expm1(-clean), 1e-9)
        # d loss / d z = sigmoid(z) * (1 for clean documents, -(1 - toxic) / toxic for toxic ones)
        back = (weigh * np.where(y == 1, -np.exp(-clean) / toxic, 1.0))[docs] * np.exp(-np.logaddexp(0.0, -z))
        slope, bias_slope = np.bincount(tokens, back[owners], minlength=n), back.sum()
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        bias_mean, bias_spread = 0.9 * bias_mean + 0.1 * bias_slope, 0.99 * bias_spread + 0.01 * bias_slope**2
        fix, fix2 = 1 - 0.9**step, 1 - 0.99**step
        scale = rate / (np.sqrt(spread / fix2) + 1e-4)
        weights -= scale * mean / fix
        weights = np.maximum(weights - scale * sparsity, 0.0)
        bias -= rate * bias_mean / fix / (np.sqrt(bias_spread / fix2) + 1e-4)
    return weights, float(bias)


def cut(text: str | None, known: dict[bytes, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, sizes) of a text: the distinct features of every distinct sentence, and how many each has."""
    flat, sizes = [], []
    for words in dict.fromkeys(s for _, s in sentences(text)):
        found: set[int] = set()
        for word in set(words.split()):
            if word not in known:
                if len(known) >= CUT_MEMO:
                    known.clear()
                known[word] = codes(word)
            found.update(known[word])
        flat += sorted(found)
        sizes.append(len(found))
    return np.array(flat, dtype=np.int64), np.array(sizes, dtype=np.int32)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, label, place, bytes, text) with features in place of texts, in small batches."""
    known: dict[bytes, list[int]] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            done = [cut(t.as_py(), known) for t in part.column(4)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:4], _lists([d[0] for d in done]), _lists([d[1] for d in done])],
                names=["key", "_label", "_place", "_bytes", "codes", "sizes"])


def _numbered(vocabulary: np.ndarray):
    """Documents with their features' numbers as bytes, unknown ones left out."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sizes = [], []
            for flat, each in zip(batch.column("codes"), batch.column("sizes")):
                flat, each = flat.values.to_numpy(), each.values.to_numpy()
                place = np.searchsorted(vocabulary, flat)
                hit = vocabulary[np.minimum(place, len(vocabulary) - 1)] == flat if len(vocabulary) else np.zeros(len(flat), bool)
                owner = np.repeat(np.arange(len(each)), each)[hit]
                tokens.append(place[hit].astype(np.int32).tobytes())
                sizes.append(np.bincount(owner, minlength=len(each)).astype(np.int32).tobytes())
            yield pa.record_batch(
                [batch.column("key").cast(pa.string()), batch.column("_label"), pa.array(tokens, pa.binary()), pa.array(sizes, pa.binary())],
                names=["key", "_label", "tokens", "sizes"])
    return number


def fit(rows: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
        label: str = "toxic", per_label: int = 2000, most_bytes: int = 32 << 20, least: int = 3) -> ToxicityModel:
    """Fit on about ``per_label`` documents of each label, among the labelled keys for which ``learn`` holds."""
    known = labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        F.max(F.col(label).cast("int")).alias("_label")).where("_label IN (0, 1)")
    sizes = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel()
    place = (F.xxhash64(F.col(key)).cast("double") / 2.0**64) + 0.5
    share = F.when(F.col("_label") == 1, per_label / sizes[1]).otherwise(per_label / sizes[0])
    # some per_label keys of each label: a bound that does not grow with the tables
    chosen = known.where(place < share)
    sample = rows.select(F.col(key), F.col(text).alias("_text")).join(F.broadcast(chosen), key).groupBy(
        F.col(key).cast("string").alias("key"), "_label", place.alias("_place")).agg(F.min("_text").alias("_text"))
    spark = rows.sparkSession
    small_batches(spark)
    sample = save(spark, sample.select(
        "key", "_label", "_place", F.coalesce(F.octet_length("_text"), F.lit(0)).alias("_bytes"), "_text").mapInArrow(
        _cut_rows, "key string, _label int, _place double, _bytes int, codes array<long>, sizes array<int>"), "toxic-sample")
    # a window over the sizes of some 2 * per_label documents
    upto = F.sum("_bytes").over(Window.orderBy("_place", "key"))
    fits = sample.select("key", "_place", "_bytes").withColumn("_upto", upto).where(F.col("_upto") <= most_bytes).select("key")
    sample = sample.join(F.broadcast(fits), "key").select("key", "_label", "codes", "sizes")
    often = sample.select(F.explode(F.array_distinct("codes")).alias("code")).groupBy("code").count().where(F.col("count") >= least)
    vocabulary = np.sort(often.select("code").toArrow().column("code").to_numpy())
    got = sample.mapInArrow(_numbered(vocabulary), "key string, _label int, tokens binary, sizes binary").toArrow()
    order = np.argsort(np.array(got.column("key").to_pylist(), dtype=object), kind="stable")
    tags = got.column("_label").to_numpy()[order]
    if len(set(tags.tolist())) < 2:
        return ToxicityModel()
    parts = [(got.column("tokens")[i].as_buffer(), got.column("sizes")[i].as_buffer()) for i in map(int, order)]
    tokens = np.concatenate([np.frombuffer(t, dtype=np.int32) for t, _ in parts])
    each = [np.frombuffer(s, dtype=np.int32) for _, s in parts]
    counts = np.concatenate(each)
    owners = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    docs = np.repeat(np.arange(len(each), dtype=np.int32), [len(s) for s in each])
    weights, bias = train(tokens, owners, docs, tags, len(vocabulary), sizes[1] / (sizes[0] + sizes[1]))
    return ToxicityModel({int(vocabulary[i]): float(weights[i]) for i in np.flatnonzero(weights)}, bias)


def score(rows: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows' columns, then score, predicted and the offending sentences' byte ranges and scores."""
    small_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, offending array<struct<begin:int,end:int,score:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sent.value.score(t, threshold) for t in texts], columns=["score", "offending"])

    kept = [c for c in rows.columns if c not in ("score", "predicted", "offending")]
    return rows.select(*kept, scored(F.col(text)).alias("_s")).select(
        *kept, "_s.score", (F.col("_s.score") >= threshold).cast("int").alias("predicted"), "_s.offending")
