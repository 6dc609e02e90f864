"""Parts of a feed are cut by the order of its records alone."""

from pyspark.sql import functions as F

from tidewatch.registry import report_queries
from tidewatch.registry.feeds import in_parts

SMALL = "/root/testdata/sf0.001"


def test_parts_follow_one_another_and_lose_nothing(spark):
    events = report_queries.STATE.records(spark, SMALL)
    seen = []
    for part in in_parts(events, 3, 4):
        placed = part.select(F.spark_partition_id().alias("p"), F.col("arrival.offset").alias("o"))
        spans = placed.groupBy("p").agg(F.min("o"), F.max("o"), F.count("*")).orderBy("p").collect()
        assert len(spans) == 4
        seen += [tuple(s)[1:] for s in spans]
        # no sample of whole records is drawn
        assert "rangepartitioning" not in part._jdf.queryExecution().executedPlan().toString()
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    assert sum(s[2] for s in seen) == events.count()
