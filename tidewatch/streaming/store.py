"""Tables of a continuously fed warehouse as plain Parquet folders that several ingest queries may share.

``decoded/writer=W/batch=N``            decoded records of one micro-batch, by record type
``history/<table>/writer=W/batch=N``    typed rows of one micro-batch, by event date; append only
``history/<table>/writer=_day/batch=T`` what is left of one day after retention, or a day's files made one
``current/<table>/commit=W.N``          the cells of a current or configuration table that a micro-batch touched
``current/<table>/commit=W.N/_cells``   the folder that holds each cell of the table after this batch
``commits/<S>``                         what stands after commit S: batches done, the cells of each table, replaced days

A writer is one ingest query; its id is kept in the query's checkpoint.  It only writes folders that carry its own id
and batch number, and nothing in them counts before a commit names the batch.  So a batch that failed half-way is simply
written again, one that was committed is not repeated, and a query with another checkpoint can't overwrite anything.

A cell is a bucket of an instance's rows.  A batch rewrites the cells its records touch; all others are carried on by
reference.  Commits are numbered, and a number can be taken once: a batch that finds its number taken is committed
under the next one if the other batches held records of other instances, and is computed anew otherwise.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from dataclasses import asdict, dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, ShortType, StringType, StructField, StructType

#: writer that holds days made anew by retention
DAY = "_day"
#: days of a batch named one by one in a filter; more are given as a range
NAMED_DAYS = 400

#: how stored files are compressed
CODEC = "zstd"
#: commits whose files are kept for readers and slow writers
KEPT = 8

#: a local file system replaces a file on renaming, so queries of one driver take turns
_TURN = threading.Lock()


class Conflict(Exception):
    """Another batch with records of the same instances was committed meanwhile."""


@dataclass
class State:
    """What a commit leaves: the last batch of each writer, each table's cells, and days that were replaced."""

    number: int = 0
    done: dict[str, int] = field(default_factory=dict)
    #: table -> folder whose ``_cells`` file lists its cells
    tables: dict[str, str] = field(default_factory=dict)
    #: history -> day -> (commit that made the day anew, last batch of each writer that went into it)
    days: dict[str, dict[str, list]] = field(default_factory=dict)
    #: history -> days before this one are gone
    since: dict[str, str] = field(default_factory=dict)
    #: instances whose records the committed batch held
    touched: list[int] = field(default_factory=list)

    def has(self, writer: str, batch: int) -> bool:
        return self.done.get(writer, -1) >= batch


class Store:
    def __init__(self, spark: SparkSession, root: str, writer: str = "main", buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.writer = writer
        self.buckets = buckets

    # ---- files ----------------------------------------------------------------------------------
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        fs, folder = self._fs(path), self._path(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def _read(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, path: str, text: str) -> None:
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _publish(self, path: str, text: str) -> bool:
        """Write a file that appears as a whole, or not at all if there is one of that name."""
        spare = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        self._write(spare, text)
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(path).toUri(), self.spark._jsc.hadoopConfiguration())
        plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        qualified = [files.makeQualified(self._path(p)) for p in (spare, path)]
        with _TURN:
            try:
                files.rename(*qualified, plain)
                return True
            except Py4JJavaError as error:
                if "FileAlreadyExistsException" not in str(error.java_exception):
                    raise
                self._delete(spare)
                return False

    def writer_of(self, checkpoint: str) -> str:
        """Id of the query with this checkpoint, made when the query starts for the first time."""
        path = f"{checkpoint.rstrip('/')}/writer"
        if not self._fs(path).exists(self._path(path)):
            self._fs(path).mkdirs(self._path(checkpoint))
            self._publish(path, f"w{uuid.uuid4().hex[:12]}")
        return self._read(path)

    # ---- commits --------------------------------------------------------------------------------
    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}"

    def commits(self) -> list[int]:
        return [int(n) for n in self._names(f"{self.root}/commits") if n.isdigit()]

    def state(self, number: int | None = None) -> State:
        if number is None:
            known = self.commits()
            if not known:
                return State()
            number = known[-1]
        return State(**json.loads(self._read(self._commit_path(number))))

    def commit(self, base: State, batch: int, cells: dict[str, dict[str, str]], touched: list[int], shared=()) -> State:
        """Make a batch count.  ``cells``: table -> cell -> folder, for the cells it wrote (an empty folder name clears one).

        ``shared`` names tables without an instance, which two batches must not both have written.
        """
        done, now = base.number, base
        while True:
            # what others committed since this batch was begun
            for number in [n for n in self.commits() if n > done]:
                if number != done + 1:
                    raise Conflict("the commits since this batch was begun are forgotten")
                now = self.state(number)
                clash = set(now.touched) & set(touched)
                if clash or any(now.tables.get(t) != base.tables.get(t) for t in shared):
                    raise Conflict(f"commit {number} holds records of instances {sorted(clash)}")
                done = number
            tables = {}
            for table, wrote in cells.items():
                tables[table] = f"{self.writer}.{batch}"
                listed = {**self._cells(now, table), **wrote}
                self._write(self._cells_path(table, tables[table]), json.dumps({c: f for c, f in listed.items() if f}))
            after = State(done + 1, {**now.done, self.writer: batch}, {**now.tables, **tables}, now.days, now.since, list(touched))
            if self._publish(self._commit_path(after.number), json.dumps(asdict(after))):
                return after

    def commit_days(self, changed: dict[str, dict[str, list]], since: dict[str, str]) -> State:
        """Replace days of histories, whatever other batches are committed meanwhile."""
        while True:
            now = self.state()
            days = {t: dict(d) for t, d in now.days.items()}
            for table, made in changed.items():
                days.setdefault(table, {}).update(made)
            for table, first in since.items():
                days[table] = {d: v for d, v in days.get(table, {}).items() if d >= first}
            after = State(now.number + 1, now.done, now.tables, days, {**now.since, **since}, [])
            if self._publish(self._commit_path(after.number), json.dumps(asdict(after))):
                return after

    def drop_old(self, keep: int = KEPT) -> None:
        """Forget all but the last ``keep`` commits, and delete the cells that none of these needs.

        Folders of batches that are not committed yet stay, since another writer may be at work on them.
        """
        numbers = self.commits()
        kept = [self.state(n) for n in numbers[-keep:]]
        if not kept:
            return
        for table in kept[-1].tables:
            needed = {s.tables[table] for s in kept if table in s.tables}
            needed |= {f for s in kept for f in self._cells(s, table).values()}
            for name in self._names(f"{self.root}/current/{table}"):
                writer, _, batch = name.removeprefix("commit=").rpartition(".")
                if batch.isdigit() and f"{writer}.{batch}" not in needed and kept[-1].has(writer, int(batch)):
                    self._delete(f"{self.root}/current/{table}/{name}")
        for number in numbers[:-keep]:
            self._delete(self._commit_path(number))

    # ---- current tables -------------------------------------------------------------------------
    def _cells_path(self, table: str, folder: str) -> str:
        return f"{self.root}/current/{table}/commit={folder}/_cells"

    def _cells(self, state: State, table: str) -> dict[str, str]:
        folder = state.tables.get(table)
        return json.loads(self._read(self._cells_path(table, folder))) if folder else {}

    def cells(self, table: str) -> dict[str, str]:
        """Cell (``instance/bucket``) -> the batch that wrote it last."""
        return self._cells(self.state(), table)

    def bucket(self, keys) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int") if keys else F.lit(0)

    def snapshot(self, table: str, state: State | None = None, cells: set[str] | None = None) -> DataFrame | None:
        """Rows of a table, or of some of its cells; None if the table was never written."""
        state = state or self.state()
        folder = state.tables.get(table)
        if folder is None:
            return None
        listed = self._cells(state, table)
        picked = listed if cells is None else {c: listed[c] for c in cells if c in listed}
        root = f"{self.root}/current/{table}"
        schema = StructType.fromJson(json.loads(self._read(f"{root}/_schema")))
        if not picked:
            return self.spark.createDataFrame([], schema)
        paths = []
        for cell, where in sorted(picked.items()):
            instance, number = cell.split("/")
            paths.append(f"{root}/commit={where}/instance_id={instance}/bucket={number}")
        parted = StructType([f for f in schema if f.name != "instance_id"] + [
            StructField("instance_id", ShortType()), StructField("bucket", IntegerType())])
        rows = self.spark.read.schema(parted).option("basePath", root).parquet(*paths)
        return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))

    def save_cells(self, table: str, rows: DataFrame, batch: int, keys, cells: set[str]) -> dict[str, str]:
        """Write the rows of some cells; gives each cell's folder, none for cells without rows."""
        folder, root = f"{self.writer}.{batch}", f"{self.root}/current/{table}"
        dealt = rows.withColumn("bucket", self.bucket(keys)).hint("rebalance", "instance_id", "bucket")
        dealt.write.mode("overwrite").partitionBy("instance_id", "bucket").parquet(f"{root}/commit={folder}", compression=CODEC)
        self._write(f"{root}/_schema", rows.schema.json())
        wrote = {
            f"{i.removeprefix('instance_id=')}/{b.removeprefix('bucket=')}"
            for i in self._names(f"{root}/commit={folder}") if i.startswith("instance_id=")
            for b in self._names(f"{root}/commit={folder}/{i}")
        }
        return {c: folder if c in wrote else "" for c in cells | wrote}

    def clear_instance(self, instance_id: int, tables=None, deactivate: DataFrame | None = None) -> State:
        """Empty an instance's rows in current and configuration tables: a commit that names none of its cells any more.

        Only this instance's objects are written, as not active; every other file stays as it is.
        """
        while True:
            base = self.state()
            batch = base.done.get(self.writer, -1) + 1
            own = lambda t: {c for c in self._cells(base, t) if c.split("/")[0] == str(instance_id)}
            wanted = [t for t in (tables or base.tables) if t not in ("instances", "objects")]
            cells = {t: {c: "" for c in own(t)} for t in wanted if t in base.tables}
            if "objects" in base.tables and own("objects"):
                rows = self.snapshot("objects", base, own("objects"))
                rows = rows.withColumn("is_active", F.lit(0).cast("smallint"))
                cells["objects"] = self.save_cells("objects", rows, batch, ("object_id",), own("objects"))
            try:
                return self.commit(base, batch, cells, [instance_id])
            except Conflict:
                continue

    # ---- records and histories ------------------------------------------------------------------
    def save_decoded(self, decoded: DataFrame, batch: int) -> DataFrame:
        path = f"{self.root}/decoded/writer={self.writer}/batch={batch}"
        # rows come from bounded splits, gathered where these are small, so they are written where they are
        decoded.write.mode("overwrite").partitionBy("rec_type").parquet(path, compression=CODEC)
        return self.spark.read.schema(decoded.schema).parquet(path)

    def append_history(self, table: str, rows: DataFrame, batch: int, date_column: str | None, spread: bool = True) -> None:
        """Write a batch's rows by day.  Rows that have been shuffled already need not be ``spread`` evenly."""
        path = f"{self.root}/history/{table}/writer={self.writer}/batch={batch}"
        self._write(f"{self.root}/history/{table}/_schema", rows.schema.json())
        if date_column is None:
            rows.write.mode("overwrite").parquet(path, compression=CODEC)
            return
        dated = rows.withColumn("event_date", F.coalesce(F.to_date(date_column), F.lit("1970-01-01").cast("date")))
        dated = dated.hint("rebalance", "event_date") if spread else dated
        dated.write.mode("overwrite").partitionBy("event_date").parquet(path, compression=CODEC)

    def _batches(self, table: str, state: State) -> list[tuple[str, int]]:
        root, out = f"{self.root}/history/{table}", []
        for name in self._names(root):
            if not name.startswith("writer="):
                continue
            writer = name.removeprefix("writer=")
            for batch in self._names(f"{root}/{name}"):
                number = int(batch.removeprefix("batch="))
                made = writer == DAY and any(v[0] == number for v in state.days.get(table, {}).values())
                if made or state.has(writer, number):
                    out.append((writer, number))
        return out

    def history(self, table: str, since=None, days=None, state: State | None = None, parts: bool = False) -> DataFrame | None:
        """Typed rows of all committed batches; ``since`` leaves out older days, ``days`` all others.

        Days and batches are partition columns, so what is left out is not read.
        """
        state = state or self.state()
        root = f"{self.root}/history/{table}"
        batches = self._batches(table, state)
        if not batches:
            return None
        schema = StructType.fromJson(json.loads(self._read(f"{root}/_schema")))
        schema = StructType(schema.fields + [
            StructField("writer", StringType()), StructField("batch", LongType()), StructField("event_date", DateType())])
        read = self.spark.read.schema(schema).option("basePath", root)
        rows = read.parquet(*[f"{root}/writer={w}/batch={b}" for w, b in batches])
        if any(self._names(f"{root}/writer={w}/batch={b}")[-1].startswith("event_date=") for w, b in batches):
            for test in self._visible(table, state):
                rows = rows.where(test)
            if since is not None:
                rows = rows.where(F.col("event_date") >= F.lit(since).cast("date"))
            if days is not None:
                rows = rows.where(on_days(days))
        return rows if parts else rows.drop("writer", "batch", "event_date")

    def _visible(self, table: str, state: State) -> list[Column]:
        """A replaced day is read from its new folder and from batches that came after."""
        tests = []
        if table in state.since:
            tests.append(F.col("event_date") >= F.lit(state.since[table]).cast("date"))
        writer, batch = F.col("writer"), F.col("batch")
        for day, (number, done) in sorted(state.days.get(table, {}).items()):
            old = F.lit(False)
            for name, last in done.items():
                old = old | ((writer == name) & (batch <= last))
            old = old | ((writer == DAY) & (batch != number))
            tests.append(~((F.col("event_date") == F.lit(day).cast("date")) & old))
        fresh = [number for number, _ in state.days.get(table, {}).values()]
        if fresh:
            # a folder of one day may hold no other
            by_day = F.lit(False)
            for day, (number, _) in state.days[table].items():
                by_day = by_day | ((batch == number) & (F.col("event_date") == F.lit(day).cast("date")))
            tests.append((writer != DAY) | by_day)
        return tests

    def has_history(self, table: str, state: State | None = None) -> bool:
        return bool(self._batches(table, state or self.state()))

    def days_of(self, table: str, batch: int) -> list[date]:
        """Days that a batch of this writer has written rows of."""
        names = self._names(f"{self.root}/history/{table}/writer={self.writer}/batch={batch}")
        return [date.fromisoformat(n.removeprefix("event_date=")) for n in names if n.startswith("event_date=")]

    def stored_days(self, table: str, state: State | None = None) -> dict[str, list[tuple[str, int]]]:
        """Day -> the batches that hold rows of it and still count."""
        state, out = state or self.state(), {}
        for writer, batch in self._batches(table, state):
            for name in self._names(f"{self.root}/history/{table}/writer={writer}/batch={batch}"):
                day = name.removeprefix("event_date=")
                if name == day or day < state.since.get(table, ""):
                    continue
                number, done = state.days.get(table, {}).get(day, (None, {}))
                if (batch == number) if writer == DAY else batch > done.get(writer, -1):
                    out.setdefault(day, []).append((writer, batch))
        return out

    def make_day(self, table: str, day: str, rows: DataFrame, state: State) -> list:
        """Write a day's rows, as read from ``state``, as one folder; gives its entry in the commit."""
        number = time.time_ns() // 1000
        rows = rows.drop("writer", "batch", "event_date").withColumn("event_date", F.lit(day).cast("date"))
        path = f"{self.root}/history/{table}/writer={DAY}/batch={number}"
        rows.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(path, compression=CODEC)
        return [number, dict(state.done)]

    def sweep_days(self, table: str, keep: int = KEPT) -> list[str]:
        """Delete the folders of days that none of the last commits reads; gives their names."""
        kept = [self.state(n) for n in self.commits()[-keep:]]
        needed = [{(d, w, b) for d, found in self.stored_days(table, s).items() for w, b in found} for s in kept]
        root, gone = f"{self.root}/history/{table}", []
        for name in self._names(root):
            if not name.startswith("writer="):
                continue
            writer = name.removeprefix("writer=")
            for folder in self._names(f"{root}/{name}"):
                batch = int(folder.removeprefix("batch="))
                # what is not committed may be somebody's work of this hour
                if not kept[-1].has(writer, batch) if writer != DAY else batch > (time.time() - 3600) * 1e6:
                    continue
                for entry in self._names(f"{root}/{name}/{folder}"):
                    day = entry.removeprefix("event_date=")
                    if entry != day and not any((day, writer, batch) in n for n in needed):
                        self._delete(f"{root}/{name}/{folder}/{entry}")
                        gone.append(f"{name}/{folder}/{entry}")
        return gone


def on_days(days: list[date]) -> Column:
    """Filter on ``event_date``: days one by one, or as a range if there are very many."""
    if not days:
        return F.lit(False)
    if len(days) <= NAMED_DAYS:
        return F.col("event_date").isin([F.lit(d) for d in sorted(days)])
    return F.col("event_date").between(F.lit(min(days)), F.lit(max(days)))
