import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import language_id, ngram_join
from tidewatch.llm.common import BATCH_BYTES, save

from .test_documents import components_by_hand


@pytest.fixture(scope="module")
def kept(spark):
    sf, out = "/root/testdata/sf0.001", []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        out.append(docs := save(spark, stage(spark, docs, sf), "test"))
    return out


def test_stages_keep_the_columns(kept):
    for frame in kept[:-1]:
        assert frame.columns == kept[0].columns
    assert kept[-1].columns[:len(kept[0].columns)] == kept[0].columns


def test_each_stage_works_on_what_the_last_one_kept(kept):
    ids = [{r.doc_id for r in frame.select("doc_id").collect()} for frame in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[4] == ids[5]
    assert len(ids[1]) < len(ids[0]) and len(ids[3]) < len(ids[2]) and len(ids[5]) > 0.5 * len(ids[0])


def test_near_copies_leave_one(spark, kept):
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    want = {d for d, (_, name) in components_by_hand(rows, 5, 80).items() if d == name}
    assert {r.doc_id for r in kept[3].collect()} == want


def test_clashing_columns_null_ids_and_repeats(spark, tmp_path):
    text = "the and of to that with this from which there"
    rows = [(1, text, "en", "s", 1, "x", 1), (1, text, "en", "s", 1, "y", 2), (2, text + " end", "en", "s", 1, "x", 1),
            (None, text, "en", "s", 1, "x", 1), (3, None, None, None, None, None, None)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string, n_tokens int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} <= {1, 2, None}
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    linked = ngram_join.link(spark, docs)
    assert linked.count() == 5


def test_rows_go_to_workers_in_batches_bounded_by_bytes(spark):
    rows = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 1000) AS text")

    @F.pandas_udf("long")
    def taken(texts: pd.Series) -> pd.Series:
        return pd.Series([texts.str.len().sum()] * len(texts))

    language_id.predict(rows, language_id.train([], []))
    assert rows.select(taken("text").alias("n")).agg(F.max("n")).first()[0] <= 2 * BATCH_BYTES
