"""Reading protocol dumps: rotated files of framed records, in batch or as a stream.

Every writer closes a record with ``\\n999\\n\\n`` and escapes newlines inside values, so that text is a
record separator Spark can split large files on.  What a record needs from earlier records (its
session header, the configuration dump it belongs to, its byte offset) is resolved in two levels:

* inside one input split, by a window over ``(file, split)`` - a group no larger than
  ``spark.sql.files.maxPartitionBytes``, however large the file is;
* across the splits of a file, from one summary row per split.

The byte offset of a record in its file is its arrival position.  It does not depend on how the file
was split, so ids and replays agree between runs.

Files follow one another by ``file_rank``: by name with numbers compared as numbers, so that ``f2`` comes before ``f10``,
or, where asked for, by the time they were last written first.  The rank orders and does not name: ids are made of path
and offset, so they don't change with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.enums import ENUMS

RECORD_END = "\n999\n\n"
END_BYTES = len(RECORD_END)
CHUNK_BYTES = 1 << 26
KNOWN_TYPES = sorted(ENUMS["record_type"])

# fixed values: session header line -> field
HEADER_FIELDS = {
    "PROTOCOL": "protocol",
    "INSTANCENAME": "instance_name",
    "AGENT": "agent",
    "AGENTVERSION": "agent_version",
    "DISPOSITION": "disposition",
    "CONNECTION": "connect_source",
    "CONNECTTYPE": "connect_type",
    "STARTTIME": "start_time",
}


def read_frames(spark: SparkSession, paths) -> DataFrame:
    """Raw frames with their place in the input."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return _place(spark.read.option("lineSep", RECORD_END).text(paths))


def stream_frames(spark: SparkSession, directory: str, max_files: int = 1000) -> DataFrame:
    """The same frames from files that keep landing in a directory."""
    reader = spark.readStream.format("text").schema("value STRING")
    reader = reader.option("lineSep", RECORD_END).option("maxFilesPerTrigger", max_files)
    return _place(reader.load(directory))


#: endings of files that are decompressed while they are read, so that their size says nothing of their text
_COMPRESSED = r"(?i)\.(gz|gzip|bz2|zst|zstd|lz4|snappy|deflate)$"


def _place(text: DataFrame) -> DataFrame:
    """``file_size`` is NULL where it is not the number of text bytes."""
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.when(~F.col("_metadata.file_path").rlike(_COMPRESSED), F.col("_metadata.file_size")).alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


#: digits that numbers in file names are brought to for comparison
_DIGITS = 18


def file_rank(path, time=None) -> Column:
    """Text that orders files by path with numbers compared as numbers (up to 18 digits), after ``time`` if given.

    Different paths have different ranks: names that differ in leading zeros only follow one another as they are.
    """
    path = wire.as_col(path)
    padded = F.regexp_replace(path, r"(\d+)", "0" * _DIGITS + "$1")
    natural = F.regexp_replace(padded, rf"\d+(\d{{{_DIGITS}}})(?!\d)", "$1")
    # 0x01 comes before whatever a longer path goes on with
    parts = [natural, F.lit("\x01"), path]
    if time is not None:
        parts.insert(0, F.lpad(F.coalesce(F.unix_micros(time), F.lit(0)).cast("string"), 20, "0"))
    return F.concat(*parts)


def parse_header(frame) -> Column:
    """Session header carried by a frame (its last one), NULL when there is none."""
    text = F.concat(F.lit("\n"), wire.as_col(frame))
    head = F.substring_index(F.substring_index(text, "\nHELLO\n", -1), "\nSTARTDATADUMP\n", 1)

    def field(name: str) -> Column:
        return F.regexp_extract(head, f"(?dm)^{name}: ?(.*)$", 1)

    columns = []
    for name, alias in HEADER_FIELDS.items():
        value = field(name)
        if alias == "protocol":
            value = wire.to_int(value)
        elif alias == "start_time":
            value = wire.from_epoch(wire.to_long(value))
        elif alias == "instance_name":
            value = F.coalesce(wire.null_if_empty(value), F.lit("default"))
        columns.append(value.alias(alias))
    return F.when(
        F.contains(text, F.lit("\nHELLO\n")) & F.contains(text, F.lit("\nSTARTDATADUMP\n")),
        F.struct(*columns),
    )


def parse_footer(frame) -> Column:
    """End time of the session a frame closes, NULL when it closes none."""
    text = F.concat(F.lit("\n"), wire.as_col(frame))
    before_next = F.substring_index(text, "\nHELLO\n", 1)
    return F.when(
        F.contains(F.concat(before_next, F.lit("\n")), F.lit("\n1000\n")),
        wire.from_epoch(wire.to_long(F.regexp_extract(before_next, r"(?dm)^ENDTIME: ?(.*)$", 1))),
    )


def record_text(frame) -> Column:
    """The part of a frame after any header or footer text."""
    text = F.concat(F.lit("\n"), wire.as_col(frame))
    return F.substring_index(text, "\nSTARTDATADUMP\n", -1)


def decode(frames: DataFrame, keep_types=None, batch: int = 0, instance_name: str | None = None,
           by_time: bool = False) -> DataFrame:
    """Frames -> one row per record.

    ``instance_name`` names the sender of records that come without a session header, as spooled ones do.  ``by_time``
    puts the files in the order they were last written, which rotated files keep unless they were copied.

    Columns: ``arrival`` (batch, rank of the file, file, offset), ``chunk`` (bounded run of arrivals), ``session`` (file, number
    of the session in its file), ``header``, ``config_type``, ``rec_type``, ``body``, ``bytes``,
    ``lines``, ``end_time`` and ``closes`` (set on the row that closes a session) and ``reject``, the
    reason why a row is not a usable record.  ``keep_types`` drops the text of other record types before the shuffle.
    """
    text = record_text("value")
    framed = (
        frames.withColumn("seq", F.monotonically_increasing_id())
        .withColumn("len", F.octet_length("value") + F.lit(END_BYTES))
        .withColumn("lines", F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit(""))) + 3)
        .withColumn("header", parse_header("value"))
        .withColumn("end_time", parse_footer("value"))
        .withColumn("rec_type", wire.frame_type(text))
        .withColumn("body", F.rtrim(F.concat(F.lit("\n"), _after_first_line(text)), F.lit("\n")))
        .withColumn("is_text", F.length(F.trim(F.replace(text, F.lit("\n"), F.lit("")))) > 0)
        .withColumn("hellos", F.when(F.col("header").isNotNull(), _count_hellos("value")).otherwise(0))
        .withColumn("dump", _dump_mark())
        .drop("value")
    )
    if keep_types is not None:
        kept = F.col("rec_type").isin(list(keep_types))
        framed = framed.withColumn("body", F.when(kept, F.col("body")))
    splits = _split_summary(framed, by_time)
    here = Window.partitionBy("file", "block").orderBy("seq")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    # what the split inherits is added behind the windows, so that it is neither shuffled nor sorted with every record
    carried = (
        framed.withColumn("_before", F.coalesce(F.sum("len").over(before), F.lit(0)))
        .withColumn("_hellos", F.sum("hellos").over(upto))
        .withColumn("_header", F.last("header", ignorenulls=True).over(upto))
        .withColumn("_dump", F.last("dump", ignorenulls=True).over(upto))
        .join(splits, ["file", "block"])
        .withColumn("offset", F.col("base") + F.col("_before"))
        .withColumn("number", F.col("hellos_in") + F.col("_hellos"))
        .withColumn("header", F.coalesce("_header", "header_in"))
        .withColumn("config_type", F.coalesce("_dump", "dump_in", F.lit(0)))
    )
    if instance_name is not None:
        header = {"protocol": F.lit(wire.PROTOCOL_VERSION), "instance_name": F.lit(instance_name)}
        fields = [header.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in carried.schema["header"].dataType]
        carried = carried.withColumn("header", F.coalesce("header", F.struct(*fields)))
    unterminated = F.coalesce(F.col("offset") + F.col("len") > F.col("file_size"), F.lit(False))
    reject = (
        F.when(F.col("header").isNull() & F.col("is_text"), "no session")
        .when(F.col("header.protocol") != wire.PROTOCOL_VERSION, "protocol")
        .when(F.col("rec_type").isNull() & F.col("is_text") & F.col("end_time").isNull(), "no type")
        .when(F.col("rec_type").isNotNull() & unterminated, "truncated")
        .when(~F.col("rec_type").isin(KNOWN_TYPES), "unknown type")
    )
    return carried.select(
        F.struct(F.lit(batch).cast("bigint").alias("batch"), "rank", "file", "offset").alias("arrival"),
        F.struct(F.col("rank").alias("file"), F.expr(f"offset div {CHUNK_BYTES}").alias("n")).alias("chunk"),
        F.struct("file", "number").alias("session"),
        "header",
        F.col("config_type").cast("smallint").alias("config_type"),
        "rec_type",
        "body",
        F.when(unterminated, F.col("len") - END_BYTES).otherwise(F.col("len")).alias("bytes"),
        F.when(unterminated, F.col("lines") - 3).otherwise(F.col("lines")).alias("lines"),
        "end_time",
        # the session this row closes, which is not its own when the next header is glued behind
        F.when(
            F.col("end_time").isNotNull(), F.struct("file", (F.col("number") - F.col("hellos")).alias("number"))
        ).alias("closes"),
        reject.alias("reject"),
    )


def _after_first_line(text: Column) -> Column:
    """Record text without blank lines and the type line in front."""
    text = F.ltrim(text, F.lit("\n"))
    return F.when(
        F.contains(text, F.lit("\n")),
        F.substring(text, F.length(F.substring_index(text, "\n", 1)) + 2, F.length(text)),
    ).otherwise(F.lit(""))


def _count_hellos(frame) -> Column:
    return F.size(F.regexp_extract_all(F.col(frame), F.lit(r"(?dm)^HELLO$"), F.lit(0)))


def _dump_mark() -> Column:
    """0 original, 1 retained at a dump start; a new session starts at 0 again."""
    kind = wire.raw_attr(245)
    return F.when(
        F.col("rec_type") == 900, F.when(kind == "RETAINED", 1).otherwise(0)
    ).when(F.col("header").isNotNull(), 0)


def _split_summary(framed: DataFrame, by_time: bool) -> DataFrame:
    """What each input split inherits from the splits before it: one row per split."""
    per_split = framed.groupBy("file", "block").agg(
        F.sum("len").alias("len"),
        F.sum("hellos").alias("hellos"),
        F.max_by("header", F.when(F.col("header").isNotNull(), F.col("seq"))).alias("header"),
        F.max_by("dump", F.when(F.col("dump").isNotNull(), F.col("seq"))).alias("dump"),
        *([F.max("file_time").alias("file_time")] if by_time else []),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return per_split.select(
        "file",
        "block",
        file_rank("file", F.col("file_time") if by_time else None).alias("rank"),
        F.coalesce(F.sum("len").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.sum("hellos").over(before), F.lit(0)).alias("hellos_in"),
        F.last("header", ignorenulls=True).over(before).alias("header_in"),
        F.last("dump", ignorenulls=True).over(before).alias("dump_in"),
    )


def read_dump(spark: SparkSession, paths, keep_types=None, by_time: bool = False) -> DataFrame:
    """All rows of some dump files, rejects included."""
    return decode(read_frames(spark, paths), keep_types, by_time=by_time)


def records(decoded: DataFrame) -> DataFrame:
    """Usable records only."""
    return decoded.where(F.col("reject").isNull() & F.col("rec_type").isNotNull() & F.col("body").isNotNull())


def rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reject").isNotNull()).select("arrival", "rec_type", "reject", "body")


def union_instances(*decoded: DataFrame) -> DataFrame:
    """Several senders side by side; rows stay apart by their session header."""
    out = decoded[0]
    for other in decoded[1:]:
        out = out.unionByName(other)
    return out


def write_dump(events: DataFrame, path: str, mode: str = "error", compression: str = "none") -> None:
    """Write records (``rec_type``, ``body``) back as a dump.

    With an ``instance_name`` column every (instance, chunk) becomes a session of its own, written in
    arrival order, and the files follow one another by chunk, so that a reader finds each instance's records in arrival
    order.  Without one, every output file is one session of the instance ``default``.
    """
    writer = framed(events).write.mode(mode).option("lineSep", RECORD_END).option("compression", compression)
    writer.text(path)


def framed(events: DataFrame) -> DataFrame:
    """Text frames of records; the first frame of each session carries the session header."""
    if "instance_name" in events.columns:
        name = F.col("instance_name")
        # the numbers of the output files are those of the ranges; a hash would put an instance's chunks in any order
        events = events.repartitionByRange("chunk", "instance_name")
        run = Window.partitionBy("chunk", "instance_name").orderBy("arrival")
        first = F.row_number().over(run) == 1
    else:
        name = F.lit("default")
        # the lower bits of the id count the rows of a partition
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    hello = F.concat(
        F.lit("\n\nHELLO\nPROTOCOL: 2\nAGENT: tidewatch\nAGENTVERSION: 1\nSTARTTIME: 0\n"),
        F.lit("DISPOSITION: ARCHIVED\nCONNECTION: FILE\nCONNECTTYPE: INITIAL\nINSTANCENAME: "),
        name,
        F.lit("\nSTARTDATADUMP\n\n"),
    )
    text = F.concat(F.lit("\n"), F.col("rec_type").cast("string"), F.lit(":"), F.col("body"))
    return events.select(F.when(first, F.concat(hello, text)).otherwise(text).alias("value"))
