"""Language identification: averaged hashed subword embeddings and a linear softmax, trained by SGD in numpy.

Subwords are the byte n-grams (1 to 4) of the lower-cased text, everything but letters taken as one space, hashed into
buckets.  A text's vector is the mean of its buckets' embeddings.  Temperature and rejection threshold come from a
part of the sample that is not trained on: confidences are scaled to fit its labels, and texts less certain than
nearly all of its right ones are not accepted.

The classifier is fitted on a sample bounded per language (``per_language`` rows, chosen by a hash of the key); the
driver holds the sample's bucket counts, some 10 KB a text.  Prediction covers every row and whole texts.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and not accepted; rows with a null key or
language are not learned from; without any labelled row every text is ``und``; ties go to the language that sorts
first; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BUCKETS, ORDERS = 1 << 14, (1, 2, 3, 4)
#: bytes of a text that are hashed at a time
PIECE = 1 << 20
UNKNOWN = "und"
#: one byte for everything that is not a letter; bytes of other characters stay
_SPACED = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text."""
    data = b" " + text.lower().encode().translate(_SPACED) + b" "
    total = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data), PIECE):
        codes = np.frombuffer(data[at:at + PIECE + max(ORDERS) - 1], dtype=np.uint8).astype(np.uint32) + np.uint32(1)
        starts = min(PIECE, len(data) - at)
        state = np.zeros(len(codes), dtype=np.uint32)
        for order in range(1, max(ORDERS) + 1):
            n = min(starts, len(codes) - order + 1)
            if n <= 0:
                break
            state = state[:n] * np.uint32(0x01000193) + codes[order - 1:order - 1 + n] if order > 1 else codes[:n].copy()
            if order in ORDERS:
                mixed = (state ^ np.uint32(order)) * np.uint32(0x9E3779B1)
                total += np.bincount(mixed >> np.uint32(18), minlength=BUCKETS)
    return total


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    languages: list[str]
    #: contribution of each bucket to each language, embeddings and softmax weights multiplied out
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        mean = counts / max(1, counts.sum())
        return _softmax((mean @ self.table + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        p = self.probabilities(bucket_counts(text))
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(counts: list[tuple[np.ndarray, np.ndarray]], labels: list[str], dim: int = 16, epochs: int = 30,
          batch: int = 32, rate: float = 20.0, seed: int = 7) -> LanguageModel:
    """Fit on (buckets, counts) of each text; a fifth of them is kept for calibration."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    rng = np.random.default_rng(seed)
    target = np.array([languages.index(x) for x in labels])
    order = rng.permutation(len(labels))
    held = order[: len(order) // 5]
    used = order[len(held):]
    embed = rng.normal(0, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights = rng.normal(0, 0.1, (dim, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)

    def dense(rows: np.ndarray) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), dtype=np.float32)
        for i, r in enumerate(rows):
            buckets, n = counts[r]
            x[i, buckets] = n / max(1, n.sum())
        return x

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for at in range(0, len(used), batch):
            rows = used[at:at + batch]
            x = dense(rows)
            hidden = x @ embed
            error = _softmax(hidden @ weights + bias)
            error[np.arange(len(rows)), target[rows]] -= 1
            error /= len(rows)
            back = error @ weights.T
            weights -= step * 0.1 * (hidden.T @ error)
            bias -= step * 0.01 * error.sum(axis=0)
            embed -= step * (x.T @ back)
        rng.shuffle(used)
    table = (embed @ weights).astype(np.float64)
    if len(held) < 10:
        return LanguageModel(languages, table, bias.astype(np.float64), 1.0, 0.0)
    logits = np.concatenate([dense(held[i:i + batch]) @ table + bias for i in range(0, len(held), batch)])
    loss = {t: -np.log(_softmax(logits / t)[np.arange(len(held)), target[held]] + 1e-12).mean()
            for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)}
    temperature = min(loss, key=loss.get)
    p = _softmax(logits / temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == target[held]]
    # accept what is as certain as 99.8 % of the right answers, with a margin for what the sample has not shown
    threshold = max(1.5 / (len(languages) + 1), 0.6 * float(np.quantile(right, 0.002))) if len(right) else 0.0
    return LanguageModel(languages, table, bias.astype(np.float64), temperature, min(threshold, 0.9))


def fit(rows: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 600, most_rows: int = 120_000) -> LanguageModel:
    """Fit on about ``per_language`` rows of every language where ``learn``, on fewer of each if that makes ``most_rows``."""
    labelled = rows.where(learn & F.col(lang).isNotNull() & F.col(key).isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy(F.col(lang).alias("lang")).count().collect()}
    if not sizes:
        return train([], [])
    small_batches(rows.sparkSession)
    each = min(per_language, max(1, most_rows // len(sizes)))
    shares = {name: min(1.0, each / sizes[name]) for name in sorted(sizes)}
    place = (F.xxhash64(F.col(key)).cast("double") / 2.0**64) + 0.5
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col(lang)]

    @F.pandas_udf("buckets binary, counts binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        found = []
        for t in texts:
            counts = bucket_counts(t) if has_letter(t) else np.zeros(0, dtype=np.int64)
            at = np.flatnonzero(counts)
            found.append((at.astype(np.int32).tobytes(), counts[at].astype(np.float32).tobytes()))
        return pd.DataFrame(found, columns=["buckets", "counts"])

    sample = labelled.where(place < share).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), features(F.col(text)).alias("f"))
    # a few hundred numbers a row, as they come
    got = sample.select("key", "lang", "f.*").where(F.octet_length("buckets") > 0).toArrow()
    keys, names = got.column("key").to_pylist(), got.column("lang").to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (keys[i], names[i]))
    pairs = [(np.frombuffer(got.column("buckets")[i].as_buffer(), dtype=np.int32),
              np.frombuffer(got.column("counts")[i].as_buffer(), dtype=np.float32)) for i in order]
    return train(pairs, [names[i] for i in order])


def predict(rows: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows' columns, then lang_pred, score and accepted; the model (2 MB at most a language) is sent to workers."""
    small_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang_pred", "score", "accepted"])

    taken = {"lang_pred", "score", "accepted"}
    kept = [F.col(c) for c in rows.columns if c not in taken]
    return rows.select(*kept, judged(F.col(text)).alias("_j")).select(*[c for c in rows.columns if c not in taken], "_j.*")
