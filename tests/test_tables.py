"""Semantics of the tables on hand-written record streams."""

import pytest
from pyspark.sql import functions as F
from wiretext import dump_file, escape, events_of, record, rows, session

from tidewatch.operators import aggregates, dimensions, filters, maintenance
from tidewatch.plans import reports, warehouse
from tidewatch.plans.table import Context

T0 = 1700000000
TABLES = warehouse.TABLES


def at(n, usec=1):
    return (4, f"{T0 + n}.{usec:06d}")


def comment(op, n, comment_id=7, **extra):
    return record(208, (1, op), at(n), (20, 1), (53, "h"), (34, T0), (18, comment_id), (17, extra.get("text", f"t{n}")))


def downtime(op, n, number=1, start=100, host="h", attr=1):
    return record(
        209, (1, op), (3, attr), at(n), (30, 2), (53, host), (34, T0), (117, T0 + start), (33, T0 + start + 50), (29, number), (31, 90000)
    )


def timed(op, n, run, kind=0, host="h", service="s"):
    return record(201, (1, op), at(n), (41, kind), (111, T0 + run), (53, host), (114, service))


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    path = dump_file(folder / "d", "a.dump", session(
        # comments: delete before add, add twice, delete then load again
        comment(901, 1, 1), comment(900, 2, 1), comment(902, 3, 1, text="again"),
        comment(900, 4, 2), comment(901, 5, 2), comment(902, 6, 2, text="back"),
        comment(900, 7, 3), comment(901, 8, 3),
        # downtime: started, stopped (cancelled), deleted before the add
        downtime(1100, 1), downtime(1103, 2), downtime(1100, 1, 2, 200), downtime(1103, 3, 2, 200),
        downtime(1104, 4, 2, 200, attr=2), downtime(1101, 5, 3, 300), downtime(1100, 6, 3, 300),
        # checks: command columns keep the first write
        record(207, (1, 800), at(1), (53, "h"), (117, f"{T0}.5"), (127, "ping"), (13, "a"), (14, "first")),
        record(207, (1, 801), at(2), (53, "h"), (117, f"{T0}.5"), (118, 2), (14, "second"), (95, "done")),
        record(207, (1, 804), at(3), (53, "h"), (117, f"{T0}.6")),
        record(206, (1, 701), at(3), (53, "h"), (114, "s"), (117, f"{T0}.7")),
        record(206, (1, 701), at(3), (53, "h"), (114, "s"), (117, f"{T0}.7")),
        record(206, (1, 703), at(3), (53, "h"), (114, "s"), (117, f"{T0}.8")),
        # notification with contacts, before and after a start
        record(220, (1, 602), at(1), (117, f"{T0}.1"), (134, "early")),
        record(205, (1, 600), at(2), (89, 1), (53, "h"), (114, "s"), (117, f"{T0}.2"), (95, "o"), (125, "long")),
        record(220, (1, 602), at(3), (117, f"{T0}.3"), (134, "joe")),
        record(221, (1, 604), at(3), (117, f"{T0}.4"), (134, "joe"), (127, "mail")),
        record(205, (1, 601), at(4), (89, 1), (53, "h"), (114, "s"), (117, f"{T0}.2"), (24, 1), (95, "o"), (125, "long")),
        # handlers without a type, state changes without last states
        record(204, (1, 501), at(5), (53, "h"), (114, "s"), (117, f"{T0}.1")),
        record(204, (1, 501), at(5), (53, "h"), (114, ""), (117, f"{T0}.1")),
        record(223, (1, 1801), at(6), (53, "h"), (120, 0), (118, 1)),
        record(223, (1, 1800), at(6), (53, "h"), (120, 0), (118, 1)),
        # queue: purge at connect, removal, duplicate adds, purge by an executed check
        timed(200, 10, 5), timed(200, 11, 40), timed(200, 12, 40), timed(200, 13, 50), timed(201, 14, 50),
        timed(200, 15, 20, 5), timed(202, 16, 30, 12), timed(200, 17, 25, 5),
        # status
        record(213, (1, 1202), at(20), (53, "h"), (114, "s"), (27, 2), (42, "1.25000"), (262, "V:0:a")),
        record(213, (1, 1202), at(19), (53, "h"), (114, "s"), (27, 1), (95, escape("x\ty")), (262, "V:1:b")),
        record(224, (1, 1203), at(20), (134, "joe"), (178, 1)),
        record(211, (1, 1200), at(20), (106, T0), (102, 77)), record(200, (1, 103), at(30)),
        record(222, (1, 1700), at(1), (7, 0), (53, "h")), record(222, (1, 1700), at(1), (7, 1), (53, "h"), (114, "s")),
        record(303, at(1), (112, "a=1"), (112, "b=x=y")),
        record(300, at(1), (21, "/etc/c.cfg"), (22, "v=1"), (22, "v=1")),
        # configuration: both dumps
        record(900, (245, "ORIGINAL"), at(40)),
        record(400, at(41), (174, "h"), (160, "check!a!b"), (200, "up"), (262, "OS:0:linux"), (240, 3), (242, 4), (243, "9.5")),
        record(401, at(41), (172, "g"), (170, "first"), (171, "h"), (171, "up")),
        record(901, at(42)), record(900, (245, "RETAINED"), at(43)),
        record(400, at(44), (174, "h"), (160, "check!a!b")), record(401, at(44), (172, "g"), (170, "second"), (171, "h")),
        record(402, at(44), (174, "h"), (210, "s"), (268, "up;ping"), (45, 1)),
        record(410, at(44), (134, "joe"), (128, "1:j@x"), (175, "mail!q"), (222, "page"), (262, "C:0:1")),
        record(409, at(44), (237, "24x7"), (238, "1:0-10"), (238, "bad")),
        record(414, (269, 402), (1, "h"), (2, "s"), (3, "h"), (4, "listed")),
        record(900, (245, "RETAINED"), at(45)),
    ))
    return events_of(spark, path).cache()


def build(events, name, ctx=None):
    return TABLES[name].build(events, ctx or Context())


def test_comments(events):
    got = rows(build(events, "comments"), "internal_comment_id", F.unix_timestamp("entry_time") - T0, "comment_data")
    assert got == [(1, 2, "again"), (2, 6, "back")]
    history = rows(
        build(events, "commenthistory"), "internal_comment_id", F.unix_timestamp("entry_time") - T0, "comment_data",
        F.unix_timestamp("deletion_time") - T0,
    )
    assert history == [(1, 2, "again", None), (2, 4, "back", 5), (3, 7, "t7", 8)]


def test_downtime(events):
    current = rows(build(events, "scheduleddowntime"), "internal_downtime_id", "was_started", "duration")
    assert current == [(1, 1, 90000), (3, 0, 90000)]
    history = rows(
        build(events, "downtimehistory"), "internal_downtime_id", "was_started", "was_cancelled",
        F.unix_timestamp("actual_end_time") - T0, "duration",
    )
    assert history == [(1, 1, 0, None, 90000), (2, 1, 1, 4, 90000), (3, 0, 0, None, 90000)]


def test_checks(events):
    assert rows(build(events, "hostchecks"), "command_line", "command_args", "state", "output", "is_raw_check") == [
        ("first", "a", 2, "done", 0)]
    checks = build(events, "servicechecks")
    assert checks.count() == 2 and checks.select("servicecheck_id").distinct().count() == 2
    assert {r.command_object_id for r in checks.collect()} == {0}


def test_notifications(events):
    notes = build(events, "notifications")
    assert rows(notes, "contacts_notified", "long_output") == [(1, "long")]
    sent = build(events, "contactnotifications")
    note_id = notes.first().notification_id
    assert sorted(r.notification_id for r in sent.collect()) == [0, note_id]
    tables = {n: build(events, n) for n in ("notifications", "contactnotifications", "contactnotificationmethods")}
    tables["objects"] = dimensions.build_objects(events)
    tables["instances"] = dimensions.get_or_insert_instances(events.select(F.lit("default").alias("instance_name")))
    got = rows(reports.report("contact_notification_methods", tables), "host_name", "service_description", "contact_name", "notification_command_name")
    assert got == [("h", "s", "joe", "mail")]


def test_handlers_states_acks(events):
    assert rows(build(events, "eventhandlers"), "eventhandler_type") == [(0,), (1,)]
    assert rows(build(events, "statehistory"), "state", "last_state", "last_hard_state") == [(1, -1, -1)]
    acks = build(events, "acknowledgements").collect()
    assert len(acks) == 1 and acks[0].acknowledgement_type == 1


def test_queue(events):
    queue = rows(build(events, "timedeventqueue"), F.unix_timestamp("scheduled_time") - T0, "event_type")
    # two equal adds stay; the add after the purge stays although it is scheduled earlier
    assert queue == [(25, 5), (40, 0), (40, 0)]
    stamps = build(events, "timedevents").where("deletion_time IS NOT NULL")
    assert rows(stamps, F.unix_timestamp("scheduled_time") - T0, F.unix_timestamp("deletion_time") - T0) == [(50, 14)]


def test_status_by_arrival_and_gate(events, spark):
    # arrival decides, not event time
    assert rows(build(events, "servicestatus"), "current_state", "output") == [(1, "x\ty")]
    assert rows(build(events, "customvariablestatus"), "varname", "varvalue", "has_been_modified") == [("V", "b", 1)]
    for cut, states in ((T0 + 20, [(2,)]), (T0 + 19, [(1,)]), (T0 + 21, [])):
        cutoff = spark.createDataFrame([(1, cut)], "instance_id SMALLINT, cutoff BIGINT")
        assert rows(build(events, "servicestatus", Context(cutoff)), "current_state") == states
        assert build(events, "statehistory", Context(cutoff)).count() == 1
    program = build(events, "programstatus").first()
    assert (program.is_currently_running, program.process_id) == (0, 77) and program.program_end_time is not None


def test_configuration(events):
    hosts = rows(build(events, "hosts"), "config_type", "check_command_args", "x_2d", "y_2d", "y_3d")
    assert hosts == [(0, "a!b", 3, 4, 9.5), (1, "a!b", 0, 0, 0.0)]
    assert rows(build(events, "hostgroups"), "config_type", "alias") == [(1, "second")]
    assert build(events, "hostgroup_members").count() == 2
    assert rows(build(events, "services"), "failure_prediction_enabled") == [(1,)]
    assert build(events, "service_parentservices").count() == 1
    assert rows(build(events, "contact_notificationcommands"), "notification_type", "command_args") == [(0, "q"), (1, "")]
    assert rows(build(events, "contact_addresses"), "address_number", "address") == [(1, "j@x")]
    assert rows(build(events, "timeperiod_timeranges"), "day", "start_sec", "end_sec") == [(1, 0, 10)]
    variables = build(events, "customvariables")
    joe = rows(dimensions.build_objects(events).where("name1 = 'joe'"), "object_id")
    assert rows(variables.where("varname = 'C'"), "object_id") == joe
    assert build(events, "configfilevariables").count() == 2
    assert rows(build(events, "runtimevariables"), "varname", "varvalue") == [("a", "1"), ("b", "x=y")]


def test_objects_active(events):
    objects = dimensions.build_objects(events)
    active = rows(objects.where("is_active = 1"), "objecttype_id", "name1", "name2")
    assert active == sorted([(1, "h", None), (2, "h", "s"), (3, "g", None), (9, "24x7", None), (10, "joe", None)], key=repr)
    names = rows(objects, "objecttype_id", "name1", "name2")
    # an active-objects list only marks objects that exist
    assert (2, "h", "listed") not in names
    assert (12, "check", None) in names and (1, "up", None) in names and (2, "up", "ping") in names


def test_membership_counts_both_dumps(events):
    tables = {n: build(events, n) for n in ("hostgroups", "hostgroup_members", "hosts")}
    tables["objects"] = dimensions.build_objects(events)
    tables["instances"] = dimensions.get_or_insert_instances(events.select(F.lit("default").alias("instance_name")))
    assert rows(reports.report("hostgroup_membership", tables), "hostgroup_name", "host_name") == [("g", "h"), ("g", "h")]
    assert rows(reports.report("hostgroup_membership", tables, config_type=1), "host_name") == [("h",)]


def test_restart_clears(spark, tmp_path):
    def status(n, service):
        return record(213, (1, 1202), at(n), (53, "h"), (114, service), (27, n))

    path = dump_file(tmp_path / "d", "a.dump", session(
        status(1, "old"), record(408, at(1), (127, "cmd")), comment(900, 1), record(223, (1, 1801), at(1), (53, "h")),
        record(200, (1, 104), at(5)), status(6, "new"), record(408, at(6), (127, "cmd2")),
    ))
    events = events_of(spark, path)
    tables = warehouse.build_tables(events)
    assert rows(tables["servicestatus"], "current_state") == [(6,)]
    assert tables["commands"].count() == 1 and tables["comments"].count() == 0
    assert tables["commenthistory"].count() == 1 and tables["statehistory"].count() == 1
    assert rows(tables["objects"].where("is_active = 1"), "name1") == [("cmd2",)]
    # a start older than the cutoff clears nothing
    cutoff = spark.createDataFrame([(1, T0 + 6)], "instance_id SMALLINT, cutoff BIGINT")
    assert warehouse.context(events, cutoff).restarts.count() == 0


def test_cutoff_and_trim(spark):
    stamps = spark.createDataFrame([(1, T0), (1, T0 + 5), (2, T0 + 99)], "instance_id SMALLINT, s BIGINT")
    status = stamps.select("instance_id", F.timestamp_seconds("s").alias("status_update_time"))
    cut = aggregates.realtime_cutoff({"hoststatus": status, "contactstatus": status}, F.timestamp_seconds(F.lit(T0 + 50)))
    assert rows(cut, "instance_id", "cutoff") == [(1, T0 + 5), (2, T0 + 50)]
    old = stamps.select(F.timestamp_seconds("s").alias("start_time"))
    now = F.timestamp_seconds(F.lit(T0 + 60 * 60 + 5))
    assert maintenance.trim(old, "servicechecks", now, 60).count() == 2
    assert maintenance.trim(old, "servicechecks", now, 0).count() == 3


def test_class_filter_bits():
    assert set(filters.enabled_types(32)) == {205, 220, 221}
    assert 201 not in filters.enabled_types(67108863 - 2) and 201 in filters.enabled_types(-1)


def test_instances_are_numbered_on(spark):
    names = spark.createDataFrame([("b",), ("a",), ("",), ("a",)], "instance_name STRING")
    first = dimensions.get_or_insert_instances(names)
    assert rows(first, "instance_id", "instance_name") == [(1, "a"), (2, "b"), (3, "default")]
    more = dimensions.get_or_insert_instances(spark.createDataFrame([("aa",), ("b",)], "instance_name STRING"), first)
    assert rows(more, "instance_id", "instance_name") == [(1, "a"), (2, "b"), (3, "default"), (4, "aa")]
