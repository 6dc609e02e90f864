"""Records that don't decide about a row are not decoded, and columns nobody asks for are not cut out."""

from wiretext import rows

from tidewatch.operators import dimensions
from tidewatch.plans import reports, warehouse
from tidewatch.plans.table import Context
from tidewatch.registry import operator_queries, report_queries, table_queries
from tidewatch.registry.feeds import union

SMALL = "/root/testdata/sf0.001"


def host_checks(spark):
    return union(table_queries.HOST_CHECK_START.records(spark, SMALL), table_queries.HOST_CHECK_END.records(spark, SMALL))


def test_updates_are_folded_before_they_are_decoded(spark):
    feeds = {
        "notifications": report_queries.notification_events(spark, SMALL), "hostchecks": host_checks(spark),
        "servicestatus": report_queries.SERVICE_STATUS.records(spark, SMALL),
    }
    for name, events in feeds.items():
        table = warehouse.TABLES[name]
        built = table.build(events, Context())
        assert rows(built, *built.columns) == rows(table.finish(table.rows(events, Context())), *built.columns)
        # whole records go through the aggregate, typed columns come after it
        assert "max_by(_record" in built._jdf.queryExecution().optimizedPlan().toString(), name


def test_asked_columns_alone_are_cut_out(spark):
    for report, events, table in (
        ("hostgroup_membership", report_queries.HOST_DEF.records(spark, SMALL), "hosts"),
        ("contact_notifications", report_queries.notification_events(spark, SMALL), "notifications"),
    ):
        only = reports.used(report, table)
        part, whole = (warehouse.TABLES[table].build(events, Context(), o) for o in (only, None))
        assert sorted(part.columns) == sorted(only)
        assert rows(part, *only) == rows(whole, *only)
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "max_by" not in plan  # keys alone tell the rows


def test_trim_history_cuts_out_the_time_alone(spark):
    def cuts(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString().count("substring_index(")

    whole = warehouse.TABLES["servicechecks"].rows(table_queries.SERVICE_CHECK.records(spark, SMALL)).select("start_time")
    assert cuts(operator_queries.trim_history(spark, SMALL)) < cuts(whole)


def test_objects_of_the_kinds_a_report_shows(spark):
    events = report_queries.HOST_DEF.records(spark, SMALL)
    every = dimensions.build_objects(events, rec_types=(400,))
    hosts = dimensions.build_objects(events, rec_types=(400,), kinds=(1,))
    assert every.select("objecttype_id").distinct().count() > 1
    assert rows(hosts, *hosts.columns) == rows(every.where("objecttype_id = 1"), *hosts.columns)
