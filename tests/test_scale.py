"""What keeps work in proportion to the input: chunks of many records, generated code that compiles, cheap clean text."""

from pyspark.sql import functions as F
from wiretext import rows

from tidewatch.functions import wire
from tidewatch.plans import columns, warehouse
from tidewatch.plans.table import Context
from tidewatch.registry import report_queries

SMALL = "/root/testdata/sf0.001"


def test_contact_events_have_chunks_of_many_records(spark):
    told = report_queries.contact_events(spark, SMALL).select("chunk", "session", "arrival")
    # a summary row for each chunk is scanned by session, so there must be few of them
    assert told.select("chunk").distinct().count() * 1000 < told.count()
    spans = told.groupBy("chunk").agg(F.min("arrival").alias("a"), F.max("arrival").alias("z")).orderBy("chunk").collect()
    assert all(one.z < other.a for one, other in zip(spans, spans[1:]))


def test_downtime_code_compiles(spark):
    built = warehouse.TABLES["downtimehistory"].build(report_queries.downtime_events(spark, SMALL), Context())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = built._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        made = debug.codegenStringSeq(plan)
        sizes = [made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and min(sizes) > 0  # -1 says that a stage outgrew the JVM's limit and is not compiled


ODD = ["", "0", "7", "-7", "+7", " 7", "7 ", "7x", "x7", "\x017", "7\x01", "1.5", ".5", "-.5", "5.", "1e3", "1.2.3", "NaN", "Infinity", "-", "+",
       "--7", "999999999999999999", "9223372036854775807", "9223372036854775808", "-9223372036854775809", "12345678901234567890123",
       "1,2", ",", "7+", "5.5.", "1" * 301]


def test_numbers_are_read_alike_whatever_else_the_record_holds(spark):
    bodies = [(i, f"\n3={text}\n7=8\n10=a\\\\b\\tc") for i, text in enumerate(ODD)]
    events = spark.createDataFrame(bodies, "n INT, body STRING")
    got = columns.project(events, "whole i64 3, part f64 3, clean i64 7, absent i64 9, said str 10", {}, [F.col("n")])
    raw = wire.raw_sql(3)
    want = events.select(
        F.expr(wire.number_sql(raw, "bigint")).alias("whole"), F.expr(wire.number_sql(raw, "double")).alias("part"),
        F.lit(8).cast("bigint").alias("clean"), F.lit(0).cast("bigint").alias("absent"), F.lit("a\\b\tc").alias("said"), "n")
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert dict(rows(got.join(events, "n").where("n < 8"), "n", "whole")) == {0: 0, 1: 0, 2: 7, 3: -7, 4: 7, 5: 7, 6: 7, 7: 7}
