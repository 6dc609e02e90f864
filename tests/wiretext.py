"""Helpers to write protocol text by hand."""

from pyspark.sql import functions as F


def escape(text):
    return text.replace("\\", "\\\\").replace("\t", "\\t").replace("\r", "\\r").replace("\n", "\\n")


def record(rec_type, *pairs):
    lines = "".join(f"{key}={value}\n" for key, value in pairs)
    return f"\n{rec_type}:\n{lines}999\n\n"


def session(*records, name="default", protocol=2, start=1700000000, end=1700009999, close=True):
    head = (
        f"\n\nHELLO\nPROTOCOL: {protocol}\nAGENT: A\nAGENTVERSION: 1\nSTARTTIME: {start}\nDISPOSITION: REALTIME\n"
        f"CONNECTION: FILE\nCONNECTTYPE: INITIAL\nINSTANCENAME: {name}\nSTARTDATADUMP\n\n"
    )
    foot = f"\n1000\nENDTIME: {end}\nGOODBYE\n\n" if close else ""
    return head + "".join(records) + foot


def dump_file(folder, name, *sessions):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(sessions))
    return str(path)


def events_of(spark, path):
    """Decoded records of a dump with instance ids 1, 2, ... in name order."""
    from tidewatch.operators import dimensions
    from tidewatch.sources import dump

    decoded = dump.read_dump(spark, path)
    names = decoded.where(F.col("header.protocol") == 2).select("header.instance_name")
    return dimensions.assign_instance(dump.records(decoded), dimensions.get_or_insert_instances(names))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
