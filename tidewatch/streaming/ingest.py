"""Continuous ingest: one streaming query feeds every table through ``foreachBatch``.

A dump file is always read whole by one micro-batch, so sessions, configuration dumps and parent ids
never cross a batch boundary and need no state of their own.  What does cross it - current rows, objects,
instances - is what the last commit left, folded with the batch by the same functions the batch build uses.

Several queries may feed one store, and a query may come back with a new checkpoint: every batch is a commit of its
writer (see :mod:`store`).  Records of history tables that come again, in a file sent twice or after a reconnect, are
recognised by their content and stored once.

The cutoff for stale records is read once, before the first batch after a start, from what was committed then,
and stays fixed; it is not a watermark.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import wire
from ..operators import aggregates, dimensions, filters, maintenance
from ..plans import history, warehouse
from ..plans.table import Context, Table, event_second
from ..sources import dump
from .store import CODEC, Conflict, State, Store

# tables written at the same time
JOBS = 8
# how a stored row of a folded table reads as an operation: extra column -> SQL
STORED_AS = {
    "comments": {"is_delete": "FALSE"},
    "scheduleddowntime": {
        "op": "1100", "op_time": "CAST(NULL AS TIMESTAMP)", "op_usec": "0", "cancelled": "CAST(0 AS SMALLINT)",
    },
    "timedeventqueue": {"op": "200", "purge_before": "CAST(NULL AS BIGINT)"},
    "programstatus": {"op": "CAST(NULL AS INT)"},
}
# what the operations on a folded table agree in, so that buckets can be folded by themselves; other folded tables
# are folded by instance
FOLDED_BY = {"comments": history.COMMENT_KEYS, "scheduleddowntime": ("object_id", "entry_time")}
#: content of stored records
KEYS = "record_keys"
#: sessions with replays that are sent to all workers; more are joined by a shuffle
SENT_REPLAYS = 200_000
#: batches that may hold rows of a closed day before its files are made one
DAY_FILES = 24


def start(
    spark: SparkSession,
    source_dir: str,
    root: str,
    checkpoint: str,
    max_files: int = 1000,
    options: int = -1,
    optional=(),
    available_now: bool = False,
    ages: dict[str, int] | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    trim_seconds: float = 60,
    buckets: int = 16,
    drop_replays: bool = True,
    by_time: bool = False,
):
    """Start the ingest query.  ``available_now`` drains what is there and stops.

    ``ages`` switches retention on (minutes by table, the default age for tables it leaves out, 0 keeps everything); it
    runs after a batch, at most once in ``trim_seconds``.  ``by_time`` puts the files of a batch in the order they were last
    written instead of that of their names.
    """
    store = Store(spark, root, buckets=buckets)
    store.writer = store.writer_of(checkpoint)
    cutoffs: list[DataFrame | None] = []
    trimmed = [float("-inf")]

    def run(frames: DataFrame, batch: int) -> None:
        if not cutoffs:
            cutoffs.append(stored_cutoff(store))
        process_batch(store, frames, batch, cutoffs[0], options, optional, drop_replays, by_time)
        if ages is not None and time.monotonic() - trimmed[0] >= trim_seconds:
            trimmed[0] = time.monotonic()
            maintain(store, clock(), ages)

    writer = dump.stream_frames(spark, source_dir, max_files).writeStream.foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored_cutoff(store: Store, as_of=None) -> DataFrame | None:
    """Cutoff per instance from what is committed now, pinned as local rows."""
    state, tables = store.state(), {}
    for name in aggregates.REALTIME_FIELDS:
        rows = store.snapshot(name, state)
        if rows is not None:
            tables[name] = rows
    if not tables:
        return None
    cutoff = aggregates.realtime_cutoff(tables, F.current_timestamp() if as_of is None else as_of)
    # at most 65,536 rows: instance ids are SMALLINT
    return store.spark.createDataFrame(cutoff.collect(), cutoff.schema)


def process_batch(store: Store, frames: DataFrame, batch: int, cutoff=None, options: int = -1, optional=(),
                  drop_replays: bool = True, by_time: bool = False) -> State:
    """All tables of one micro-batch, as one commit.

    A batch that is committed already is left alone; one that met another writer's batch of the same instances is
    computed anew from what that one left.
    """
    while True:
        base = store.state()
        if base.has(store.writer, batch):
            return base
        try:
            after = _commit_batch(store, base, frames, batch, cutoff, options, optional, drop_replays, by_time)
        except Conflict:
            continue
        store.drop_old()
        return after


def bucket_keys(table: Table) -> tuple[str, ...]:
    return table.keys if table.finish_with is None else FOLDED_BY.get(table.name, ())


def _cells_of(store: Store, rows: DataFrame, keys) -> set[str]:
    """Cells that rows fall into: at most instances x buckets."""
    hit = rows.select("instance_id", store.bucket(keys).alias("bucket")).distinct().collect()
    return {f"{r.instance_id}/{r.bucket}" for r in hit}


def _commit_batch(store: Store, base: State, frames: DataFrame, batch: int, cutoff, options: int, optional,
                  drop_replays: bool, by_time: bool) -> State:
    # commits are numbered over all writers, so arrivals order rows of different ones
    decoded = store.save_decoded(dump.decode(frames, batch=base.number + 1, by_time=by_time), batch)
    instances, added = _instances(store, base, decoded, batch)
    events = dimensions.assign_instance(dump.records(decoded), instances)
    if options >= 0:
        events = filters.class_filter(events, options)
    if drop_replays:
        events = first_deliveries(store, base, events, batch)
    # at most some fifty record types and 32,767 instances exist
    found = decoded.groupBy("rec_type").agg(F.collect_set("header.instance_name").alias("names")).collect()
    present = {r.rec_type for r in found}
    numbers = {r.instance_name: r.instance_id for r in instances.collect()}
    senders = sorted({numbers[n] for r in found for n in r.names if n in numbers})
    ctx = warehouse.context(events, cutoff)
    restarted = {str(r.instance_id) for r in ctx.restarts.select("instance_id").collect()} if 200 in present else set()
    if not restarted:
        ctx.restarts = None

    def cleared(name: str) -> set[str]:
        return {c for c in store._cells(base, name) if c.split("/")[0] in restarted} if restarted else set()

    def save(table: Table) -> tuple[str, dict[str, str]] | None:
        touched = bool(present & set(table.rec_types))
        if table.kind == "history":
            if touched:
                rows = table.rows(events, ctx)
                if table.name == "logentries" and 100 in present:
                    rows = history.unseen_lines(rows, _stored_lines(store, base, rows))
                store.append_history(table.name, rows, batch, table.date_column)
            return None
        keys = bucket_keys(table)
        cells = cleared(table.name) | (
            _cells_of(store, table.rows(events, ctx, ("instance_id", *keys)), keys) if touched else set())
        if not cells:
            return None
        rows = fold(table, store.snapshot(table.name, base, cells), events, ctx)
        return table.name, store.save_cells(table.name, rows, batch, keys, cells)

    def save_objects() -> tuple[str, dict[str, str]] | None:
        named = dimensions.get_or_insert_objects(dimensions.object_names(events, present, cutoff)).select("object_id", "instance_id")
        if present & set(dimensions.ACTIVATING_TYPES):
            on = dimensions.get_or_insert_objects(dimensions.activations(events, cutoff, present))
            named = named.unionByName(on.select("object_id", "instance_id"))
        cells = cleared("objects") | _cells_of(store, named, ("object_id",))
        if not cells:
            return None
        stored = store.snapshot("objects", base, cells)
        objects = dimensions.build_objects(events, cutoff, ctx.restarts, stored, rec_types=present)
        return "objects", store.save_cells("objects", objects, batch, ("object_id",), cells)

    def save_audit() -> None:
        store.append_history("conninfo", aggregates.session_audit(decoded, instances), batch, None)

    wanted = [t for n, t in warehouse.TABLES.items() if n not in history.OPTIONAL or n in optional]
    cells = dict(added)
    # the tables are independent jobs over the same decoded batch
    with ThreadPoolExecutor(JOBS) as pool:
        jobs = [pool.submit(save, table) for table in wanted]
        jobs += [pool.submit(save_objects), pool.submit(save_audit)]
        for job in jobs:
            if made := job.result():
                cells[made[0]] = made[1]
    return store.commit(base, batch, cells, senders, shared=tuple(added))


def _instances(store: Store, base: State, decoded: DataFrame, batch: int) -> tuple[DataFrame, dict]:
    """Instances with those the batch names first, and the cells written for these."""
    stored = read_instances(store, base)
    names = decoded.where(F.col("header.protocol") == wire.PROTOCOL_VERSION).select("header.instance_name")
    known = dimensions.get_or_insert_instances(names, stored)
    # at most 32,767 rows
    rows = known.collect()
    local = store.spark.createDataFrame(rows, known.schema)
    if stored is not None and len(rows) == stored.count():
        return local, {}
    # one cell for all of them
    one = local.select(F.lit(0).cast("smallint").alias("instance_id"), F.col("instance_id").alias("id"), "instance_name",
                       "instance_description").coalesce(1)
    return local, {"instances": store.save_cells("instances", one, batch, (), {"0/0"})}


def read_instances(store: Store, state: State | None = None) -> DataFrame | None:
    rows = store.snapshot("instances", state)
    return None if rows is None else rows.select(F.col("id").alias("instance_id"), "instance_name", "instance_description")


# ---- replays ------------------------------------------------------------------------------------
#: records of these types are stored once however often they are sent; archived lines have a rule of their own
KEYED_TYPES = sorted({t for table in history.HISTORY.values() for t in table.rec_types} - {100})


def _content_key(events: DataFrame) -> DataFrame:
    """The records of history tables with a key of what they say: sender, type and text."""
    said = F.concat_ws("\n", F.col("instance_id").cast("string"), F.col("rec_type").cast("string"), "body")
    return events.where(F.col("rec_type").isin(*KEYED_TYPES)).withColumn("key", F.unhex(F.md5(said.cast("binary"))))


def first_deliveries(store: Store, base: State, events: DataFrame, batch: int) -> DataFrame:
    """Events without records of history tables that an earlier session has delivered.

    Equal records of one session are told apart by their number: a session that sends a record n times brings
    those beyond the most that any session before it sent.  Counts are stored by day of the record, and only the
    days of the batch are read again.  Sessions that bring nothing new are left out as a whole; records are looked up
    one by one only in sessions that repeat some and bring others, and what these bring is written once.
    """
    # the files of one batch, at most ``max_files``, by number in their order; numbers stand for their names in the counts
    files = sorted(r[:] for r in events.select("arrival.rank", "arrival.file").distinct().collect())
    numbers = F.broadcast(store.spark.createDataFrame(
        [(i, file) for i, (_, file) in enumerate(files)], "file_no int, _name string"))
    keyed = _content_key(events).join(numbers, F.col("session.file") == F.col("_name")).withColumn("session_no", F.col("session.number"))
    session = ["file_no", "session_no"]
    counted = keyed.groupBy("key", *session).agg(
        F.count("*").alias("n"), F.min("arrival.offset").alias("first"), F.min(wire.from_epoch(event_second())).alias("_time"))
    store.append_history(KEYS, counted.withColumn("instant", F.col("_time")).drop("_time"), batch, "instant", spread=False)
    here = store.spark.read.schema(counted.drop("_time").schema).parquet(
        f"{store.root}/history/{KEYS}/writer={store.writer}/batch={batch}")
    days = store.days_of(KEYS, batch)
    earlier = store.history(KEYS, days=days, state=base)
    before = Window.partitionBy("key").orderBy("file_no", "first").rowsBetween(Window.unboundedPreceding, -1)
    counted = here.withColumn("_sent", F.coalesce(F.max("n").over(before), F.lit(0)))
    if earlier is not None:
        known = earlier.groupBy("key").agg(F.max("n").alias("_known"))
        counted = counted.join(known, "key", "left").withColumn("_sent", F.greatest("_sent", F.coalesce("_known", F.lit(0))))
    folder = f"{store.root}/decoded/writer={store.writer}"
    again = _saved(store, counted.where("_sent > 0").select("key", *session, "_sent", "n"), f"{folder}/replays={batch}")
    met = again.groupBy(*session).agg(F.count_if(F.col("n") <= F.col("_sent")).alias("_old"))
    met = met.join(here.groupBy(*session).agg(F.count("*").alias("_all")), session).join(numbers, "file_no").select(
        F.struct(F.col("_name").alias("file"), F.col("session_no").alias("number")).alias("session"),
        (F.col("_old") < F.col("_all")).alias("_mixed"))
    met = _saved(store, met, f"{folder}/replayed={batch}")
    kinds = {r["_mixed"]: r["count"] for r in met.groupBy("_mixed").count().collect()}
    if not kinds:
        return events
    sent = F.broadcast(met) if sum(kinds.values()) <= SENT_REPLAYS else met
    is_keyed = F.col("rec_type").isin(*KEYED_TYPES)
    kept = events.where(~is_keyed).unionByName(events.where(is_keyed).join(sent, "session", "left_anti").select(events.columns))
    if True not in kinds:
        return kept
    mixed = keyed.join(sent.where("_mixed"), "session", "left_semi")
    marked = mixed.join(again, ["key", *session], "left")
    # only where a session sends a record more often than before does it matter which ones are new
    nth = F.row_number().over(Window.partitionBy("key", *session).orderBy("arrival"))
    more = marked.where("_sent IS NOT NULL AND n > _sent").withColumn("_nth", nth).where("_nth > _sent")
    fresh = marked.where("_sent IS NULL").select(events.columns).unionByName(more.select(events.columns))
    return kept.unionByName(_saved(store, fresh, f"{folder}/fresh={batch}", "rec_type"))


def _saved(store: Store, rows: DataFrame, path: str, *by: str) -> DataFrame:
    rows.write.mode("overwrite").partitionBy(*by).parquet(path, compression=CODEC)
    return store.spark.read.schema(rows.schema).parquet(path).select(rows.columns)


def _stored_lines(store: Store, base: State, rows: DataFrame) -> DataFrame | None:
    """Stored log lines of the days that a batch's archived lines name."""
    if not store.has_history("logentries", base):
        return None
    named = rows.where("realtime_data = 0").select(F.to_date("entry_time").alias("day")).distinct().collect()
    return store.history("logentries", days=[r.day for r in named if r.day is not None], state=base)


def fold(table: Table, stored: DataFrame | None, events: DataFrame, ctx) -> DataFrame:
    """Snapshot of a table after a batch, with the arrival of each row."""
    rows = table.latest(events, ctx)
    if stored is not None:
        kept = maintenance.after_restart(stored, ctx.restarts)
        rows = rows.unionByName(as_operations(table, kept, rows), allowMissingColumns=True)
    elif table.late:
        return rows
    return table.finish(rows, keep_order=True).drop("chunk", "session")


def as_operations(table: Table, stored: DataFrame, like: DataFrame) -> DataFrame:
    """Stored rows as adds that arrived before everything in the batch.

    They are all adds, so their order among themselves does not matter and their chunks can be spread.
    """
    for name, text in STORED_AS.get(table.name, {}).items():
        stored = stored.withColumn(name, F.expr(text))
    spread = F.struct(F.lit("").alias("file"), F.pmod(F.xxhash64("arrival"), F.lit(1024)).alias("n"))
    if "chunk" in like.columns:
        stored = stored.withColumn("chunk", spread.cast(like.schema["chunk"].dataType))
    return stored


def read_table(store: Store, name: str, since=None, state: State | None = None) -> DataFrame:
    """A table as it stands: its cells, or the folded history rows."""
    if name == "instances":
        return read_instances(store, state)
    if name == "objects":
        return store.snapshot(name, state)
    if name == "conninfo":
        return store.history(name, state=state)
    table = warehouse.TABLES[name]
    if table.kind == "history":
        return table.finish(store.history(name, since, state=state))
    return store.snapshot(name, state).select(*table.column_names)


def read_tables(store: Store, names) -> dict[str, DataFrame]:
    """Tables as one commit left them, whatever is committed meanwhile."""
    state = store.state()
    return {name: read_table(store, name, state=state) for name in names}


# ---- retention ----------------------------------------------------------------------------------
def maintain(store: Store, as_of: datetime, ages: dict[str, int] | None = None) -> dict[str, list[str]]:
    """Apply retention to the stored histories and tidy closed days; gives the folders that were deleted.

    Days beyond a table's age are dropped whole, the day in which it ends is written anew without its older rows, and
    a day before yesterday that many batches wrote to becomes one folder.  Content keys go with the longest age.
    """
    state = store.state()
    changed: dict[str, dict[str, list]] = {}
    since: dict[str, str] = {}
    bounds = {}
    for name, (column, default) in maintenance.RETENTION.items():
        age = (ages or {}).get(name, default)
        if warehouse.TABLES[name].date_column == column and store.has_history(name, state):
            bounds[name] = (column, as_of - timedelta(minutes=age) if age else None)
    kept_all = any(not (ages or {}).get(n, d) for n, (_, d) in maintenance.RETENTION.items())
    if not kept_all and store.has_history(KEYS, state):
        longest = max((ages or {}).get(n, d) for n, (_, d) in maintenance.RETENTION.items())
        bounds[KEYS] = ("instant", as_of - timedelta(minutes=longest))
    closed = (as_of.date() - timedelta(days=1)).isoformat()
    for name, (column, bound) in bounds.items():
        days, first = store.stored_days(name, state), ""
        if bound is not None:
            first = bound.date().isoformat()
            if any(day < first for day in days):
                since[name] = first
        for day, batches in days.items():
            rows = store.history(name, days=[date.fromisoformat(day)], state=state)
            if bound is not None and day == first:
                old = F.col(column) < F.lit(bound)
                if rows.where(old).isEmpty() and len(batches) <= DAY_FILES:
                    continue
                rows = rows.where(~old)
            elif day < first or day >= closed or len(batches) <= DAY_FILES:
                continue
            changed.setdefault(name, {})[day] = store.make_day(name, day, rows, state)
    if changed or since:
        store.commit_days(changed, since)
    return {name: store.sweep_days(name) for name in bounds}


def trim_store(store: Store, as_of: datetime, minutes: dict[str, int] | None = None) -> dict[str, list[str]]:
    """:func:`maintain` under its older name."""
    return maintain(store, as_of, minutes)


def read_trimmed(store: Store, name: str, as_of: datetime, minutes: int | None = None) -> DataFrame:
    """A history without rows beyond its age, whether or not retention has run; days that are gone are not read."""
    age = maintenance.RETENTION[name][1] if minutes is None else minutes
    since = (as_of - timedelta(minutes=age)).date() if age else None
    return maintenance.trim(read_table(store, name, since), name, F.lit(as_of), minutes)
