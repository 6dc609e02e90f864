"""Filtering stages over ``documents``, each written as Parquet and read again by the next.

Every stage decides on whole rows: whatever columns the documents have are carried in one struct, so that none can
clash with the columns an operator adds.  Rows with a null id are judged like the others, except that the similarity
join leaves them as they are; null and empty texts are neither toxic nor of any language, so the second stage drops
them; empty tables pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, language_id, ngram_join, piece_codec, toxicity
from tidewatch.llm.common import save, sent_if_small, table


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("_row"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.3, by a model of the labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.score(_packed(docs), model, threshold=0.3).where("predicted = 0").select("_row.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough certainty."""
    model = language_id.fit(docs, F.lit(True))
    return language_id.predict(_packed(docs), model).where("accepted").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked by 0.8 of their five-word shingles.

    Of several rows with its id the one with the smallest text stays.
    """
    linked = save(spark, ngram_join.link(spark, docs, width=5, percent=80).select("doc_id", "component_id"), "linked")
    others = linked.where("doc_id <> component_id").select("doc_id").distinct()
    rows = docs.join(sent_if_small(others, ngram_join.SENT_IDS), "doc_id", "left_anti").select(docs.columns)
    again = linked.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return rows
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    several = rows.join(again, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("_row"), first.alias("_first"))
    return rows.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(
        several.where("_first = 1").select("_row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, verbatim or re-parameterised; a row without an id goes by its text."""
    rows = docs.select(
        F.coalesce("doc_id", F.xxhash64("text")).alias("doc_id"), "text", F.struct(*docs.columns).alias("_row"))
    hits = decontaminate.contaminated(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return rows.join(hits.select("doc_id").distinct(), "doc_id", "left_anti").select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the number and hash of their ids, and the hashes of the text these decode to and of their spans."""
    coded = piece_codec.digests(_packed(docs), public_tokenizers.path("piece_bpe_32k.model"), keep=("_row",))
    new = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256")
    return coded.select(*(F.col("_row")[c].alias(c) for c in docs.columns if c not in new), *new)


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_unknown_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]
#: learned models decide, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
