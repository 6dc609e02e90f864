"""A session's end is found without a regular expression over every record."""

from pyspark.sql import functions as F

from tidewatch.sources import dump

TEXTS = ["", "1000", "1000\nENDTIME: 5", "\n1000\nENDTIME: 5\nGOODBYE", "10001\nENDTIME: 5", "1=1000\nENDTIME: 5", " 1000\nENDTIME: 5",
         "213:\n1=2\n1000\nENDTIME: 5", "x\nHELLO\n1000\nENDTIME: 5", "1000\r\nENDTIME: 5"]


def test_footers_are_those_the_pattern_finds(spark):
    frames = spark.createDataFrame([(t,) for t in TEXTS], "value string")
    got = frames.select("value", dump.parse_footer("value").isNotNull().alias("closes"), F.substring_index(
        F.concat(F.lit("\n"), "value"), "\nHELLO\n", 1).rlike(r"(?dm)^1000$").alias("want"))
    assert all(r.closes == r.want for r in got.collect()) and got.where("closes").count() == 4
    plan = frames.select(dump.parse_footer("value"))._jdf.queryExecution().analyzed().toString()
    assert "RLIKE (?dm)" not in plan
