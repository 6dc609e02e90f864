from pyspark.sql import functions as F
from wiretext import dump_file, escape, record, rows, session

from tidewatch.functions import wire
from tidewatch.operators import aggregates, dimensions
from tidewatch.plans import warehouse
from tidewatch.sources import archive, dump


def state(n, **extra):
    return record(223, (1, 1801), (4, f"{1700000000 + n}.000001"), (53, "h"), (18, n), *extra.get("pairs", ()))


def test_sessions_offsets_and_rejects(spark, tmp_path):
    text = [
        session(state(1), record(999999, (1, 1)), state(2), name="one"),
        session(state(3), name="old", protocol=1),
        session(state(4), record(223, (1, 1801), (53, "cut")).removesuffix("\n999\n\n"), name="two", close=False),
    ]
    path = dump_file(tmp_path / "d", "a.dump", *text)
    decoded = dump.read_dump(spark, path)
    good = dump.records(decoded)
    assert rows(good, wire.code(18), "header.instance_name", "session.number") == [(1, "one", 1), (2, "one", 1), (4, "two", 3)]
    assert sorted(r.reject for r in dump.rejects(decoded).collect()) == ["protocol", "truncated", "unknown type"]
    # offsets are byte positions in the file
    raw = open(path, "rb").read()
    for row in decoded.select("arrival.offset", "bytes", "body").collect():
        chunk = raw[row.offset:row.offset + row.bytes].decode()
        assert row.body is None or row.body in chunk
    assert decoded.agg(F.sum("bytes")).first()[0] == len(raw)


def test_split_inside_records(spark, tmp_path):
    hard = "v\t\n\\=:;!é" * 5
    body = [record(223, (1, 1801), (4, f"{1700000000 + n}.5"), (53, "h"), (95, escape(hard + str(n))), (18, n)) for n in range(300)]
    path = dump_file(
        tmp_path / "d", "a.dump", session(*body[:100], name="a"), session(*body[100:], record(900, (245, "RETAINED")),
        record(400, (174, "h")), name="b"),
    )
    whole = dump.read_dump(spark, path)
    columns = ("arrival", "session", "rec_type", "config_type", "body", "bytes", "lines", "header", "reject")
    expected = rows(whole, *columns)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        small = dump.read_dump(spark, path)
        assert dump.read_frames(spark, path).select("block").distinct().count() > 10
        assert rows(small, *columns) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.n: r.o for r in dump.records(whole).where("rec_type = 223").select(wire.code(18).alias("n"), wire.attr(95).alias("o")).collect()}
    assert got == {n: hard + str(n) for n in range(300)}
    assert rows(dump.records(whole).where("rec_type = 400"), "config_type", "header.instance_name") == [(1, "b")]


def test_keep_types_keeps_positions(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", session(state(1), record(212, (53, "h")), state(2)))
    all_rows = rows(dump.records(dump.read_dump(spark, path)).where("rec_type = 223"), "arrival", "body")
    assert rows(dump.records(dump.read_dump(spark, path, keep_types=[223])), "arrival", "body") == all_rows


def test_write_dump_roundtrip(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", session(*[state(n, pairs=((262, f"A:0:{n}"), (262, "B:1:x"))) for n in range(50)]))
    events = dump.records(dump.read_dump(spark, path))
    dump.write_dump(events.repartition(3), str(tmp_path / "out"))
    back = dump.records(dump.read_dump(spark, str(tmp_path / "out")))
    assert rows(back, "rec_type", "body") == rows(events, "rec_type", "body")
    both = dump.union_instances(dump.read_dump(spark, path), dump.read_dump(spark, str(tmp_path / "out")))
    assert dump.records(both).count() == 100


def test_write_dump_keeps_instances_apart(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", session(state(1), state(2), name="x"), session(state(3), state(4), name="y"))
    events = dump.records(dump.read_dump(spark, path)).withColumn("instance_name", F.col("header.instance_name"))
    dump.write_dump(events.repartition(2), str(tmp_path / "out"))
    back = dump.records(dump.read_dump(spark, str(tmp_path / "out")))
    assert rows(back, "header.instance_name", wire.code(18)) == [("x", 1), ("x", 2), ("y", 3), ("y", 4)]


def test_write_dump_keeps_order_over_chunks(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", *[session(*[state(n) for n in range(60)], name=name) for name in "xy"])
    events = dump.records(dump.read_dump(spark, path)).withColumn("instance_name", F.col("header.instance_name"))
    chunk = F.struct("chunk.file", (F.col("arrival.offset") / 300).cast("bigint").alias("n"))
    with_adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dump.write_dump(events.withColumn("chunk", chunk).repartition(3), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_adaptive)
    back = dump.records(dump.read_dump(spark, str(tmp_path / "out")))
    told = back.select("arrival", F.col("header.instance_name").alias("name"), wire.code(18).alias("n")).orderBy("arrival").collect()
    assert len({r.arrival.file for r in told}) > 1
    for name in "xy":
        assert [r.n for r in told if r.name == name] == list(range(60))


def test_session_audit(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", session(state(1), state(2), name="x", end=1700000500), session(state(3), name="y", end=1700000900))
    decoded = dump.read_dump(spark, path)
    instances = dimensions.get_or_insert_instances(decoded.select("header.instance_name"))
    audit = aggregates.session_audit(decoded, instances)
    got = rows(audit, "instance_id", "entries_processed", F.unix_timestamp("data_end_time"), F.unix_timestamp("data_start_time"))
    assert got == [(1, 2, 1700000500, 1700000000), (2, 1, 1700000900, 1700000000)]


def test_archive_log(spark, tmp_path):
    log = tmp_path / "archive.log"
    log.write_text("[1700000000] one\n[1700000000] one\n[1700000001] one\nbroken\n[1700000002] \n")
    events = archive.read_archive_log(spark, str(log)).withColumn("instance_id", F.lit(1).cast("smallint"))
    table = warehouse.TABLES["logentries"]
    got = rows(table.build(events), F.unix_timestamp("logentry_time"), "logentry_data", "realtime_data")
    assert got == [(1700000000, "one", 0), (1700000001, "one", 0), (1700000002, "", 0)]


def test_spool(spark, tmp_path):
    chunk = session(state(1), state(2))
    (tmp_path / "spool").write_text(escape(chunk) + "\n")
    plain = archive.read_spool(spark, str(tmp_path / "spool"))
    assert plain.first().value == chunk
    assert dump.records(archive.read_spool_records(spark, str(tmp_path / "spool"))).count() == 2


def test_load_dump_builds_every_table(spark, tmp_path):
    path = dump_file(tmp_path / "d", "a.dump", session(state(1), record(213, (4, "1700000000.0"), (53, "h"), (114, "s"), (27, 2))))
    tables = warehouse.load_dump(spark, path, work_dir=str(tmp_path / "work"))
    assert tables["statehistory"].count() == 1 and tables["servicestatus"].count() == 1
    assert len(tables) == 60 - 2 + 1  # all but timedevents (on request) and dbversion, plus rejects
    assert tables["objects"].count() == 2
