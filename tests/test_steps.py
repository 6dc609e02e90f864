"""The contact notification reports are made in steps, so that not all of their shuffles are on disk together."""

import os
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from wiretext import rows

import __spark_entry__
from tidewatch.plans import reports, warehouse
from tidewatch.plans.table import Context
from tidewatch.registry import report_queries
from tidewatch.session import ensure_checkpoint_dir
from tidewatch.steps import Steps

DAY = datetime(1996, 1, 1)


def tables(spark, folder):
    """A few rows of every table the reports read, with a key that is null and rows that come twice."""
    made = {
        "region": ([(n, f"r{n}") for n in range(2)], "r_regionkey INT, r_name STRING"),
        "nation": ([(n, f"n{n}", n % 2) for n in range(3)], "n_nationkey INT, n_name STRING, n_regionkey INT"),
        "customer": ([(n, f"c{n}", n % 3, 0.5, "M") for n in range(5)],
                     "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"),
        "supplier": ([(n, f"s{n}") for n in range(4)], "s_suppkey BIGINT, s_name STRING"),
        "orders": (
            [(n, n % 5 if n else None, "OF"[n % 2], 1.5 * n, DAY + timedelta(n), f"{n % 3}-P") for n in [*range(12), 3]],
            "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP, o_orderpriority STRING",
        ),
        "lineitem": (
            [(n % 12 if n != 5 else None, n % 7, n % 4, n % 3, DAY + timedelta(n % 30)) for n in [*range(90), 17]],
            "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP",
        ),
    }
    for name, (data, schema) in made.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def kept_shuffles(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if re.fullmatch(r"shuffle_.*\.data", name)}


def test_a_step_leaves_no_shuffle_files(spark):
    steps, before = Steps(spark), kept_shuffles(spark)
    counted = spark.range(1000).groupBy(F.expr("id % 7").alias("k")).count().orderBy("k")
    saved = steps.saved("counted", counted)
    assert kept_shuffles(spark) <= before
    assert rows(saved, "k", "count") == rows(counted, "k", "count")  # read again, with shuffles of its own
    assert kept_shuffles(spark) > before
    steps.drop("counted", "never saved")
    assert not os.path.exists(f"{steps.root}/counted".removeprefix("file:"))


def reports_in_steps(spark, folder, name, names, part):
    """One of the reports as made in one plan must have the same rows, and its plan must not hold the joins."""
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    got = __spark_entry__.queries()[name](spark, folder)
    events = report_queries.contact_events(spark, folder)
    whole = reports.report(name, report_queries.tables_for(spark, folder, events, names, name))
    whole = whole.select([F.col(c).cast(t) for c, t in got.dtypes])
    assert got.columns == whole.columns and got.count() > 40
    assert rows(got, *got.columns) == rows(whole, *got.columns)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Sort" in plan
    made = [f"{shared}/{folder}" for folder in set(os.listdir(shared)) - before if folder.startswith("steps-")]
    assert [os.listdir(folder) for folder in made] == [[part]]


def test_contact_notification_methods_in_steps(spark, tmp_path):
    reports_in_steps(spark, tables(spark, tmp_path), "contact_notification_methods",
                     ("notifications", "contactnotifications", "contactnotificationmethods"), "named")


def test_contact_notifications_in_steps(spark, tmp_path):
    reports_in_steps(
        spark, tables(spark, tmp_path), "contact_notifications", ("notifications", "contactnotifications"), "named")


def test_linked_rows_are_shuffled_without_their_text(spark):
    def event(n, rec_type, *pairs):
        return (1, (0, "", n), ("", n // 3), ("", 1), rec_type, 0, "".join(f"\n{k}={v}" for k, v in pairs))

    def sent(n, op, contact):
        return event(n, 220, (1, op), (117, f"{n}.5"), (33, f"{n}.6"), (134, contact))

    started = [event(n, 205, (1, op), (89, 0), (53, f"h{n}"), (117, f"{n}.25")) for n, op in ((2, 600), (4, 601), (7, 600))]
    events = spark.createDataFrame(
        [*started, *[sent(n, 602, f"c{n}") for n in (0, 3, 6, 8)], sent(9, 603, "c9"),
         *[event(n, 221, (1, 604), (127, "mail"), (13, "a"), (117, f"{n}.75")) for n in (1, 5, 10)]],
        "instance_id SMALLINT, arrival STRUCT<batch: BIGINT, file: STRING, offset: BIGINT>, chunk STRUCT<file: STRING, n: BIGINT>, "
        "session STRUCT<file: STRING, number: BIGINT>, rec_type INT, config_type SMALLINT, body STRING",
    )
    built = {n: warehouse.TABLES[n].rows(events, Context()) for n in ("contactnotifications", "contactnotificationmethods")}
    about = dict(rows(warehouse.TABLES["notifications"].rows(events, Context()), "arrival.offset", "notification_id"))
    contacts = dict(rows(built["contactnotifications"], "arrival.offset", "contactnotification_id"))
    assert rows(built["contactnotifications"], "arrival.offset", "notification_id") == [
        (0, 0), (3, about[2]), (6, about[2]), (8, about[7]), (9, about[7])]
    assert rows(built["contactnotificationmethods"], "arrival.offset", "contactnotification_id", "command_args") == [
        (1, contacts[0], "a"), (10, contacts[8], "a"), (5, contacts[3], "a")]
    # where the arrival is not known, parents count as earlier
    lost = events.withColumn("arrival", F.expr("named_struct('batch', arrival.batch, 'file', arrival.file, 'offset', CAST(NULL AS BIGINT))"))
    lost = lost.withColumn("chunk", F.expr("named_struct('file', '', 'n', CAST(NULL AS BIGINT))"))
    first = lost.where("rec_type = 221").unionByName(lost.where("rec_type = 220 AND body LIKE '%=602%c6'"))
    late = warehouse.TABLES["contactnotificationmethods"].rows(first, Context())
    assert {r[0] for r in rows(late, "contactnotification_id")} == {contacts[6]}
    for table in built.values():
        text = table._jdf.queryExecution().explainString(
            getattr(getattr(spark._jvm.org.apache.spark.sql.execution, "FormattedMode$"), "MODULE$"))
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
        assert moved and not any("body" in columns for columns in moved)
