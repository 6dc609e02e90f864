from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import enums, ids, wire

HARD = "tab\t nl\n cr\r slash\\ eq= co: se; ex! end\\"


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} STRING" for k in values)) if values else spark.range(1)
    return frame.select(column.alias("v")).first().v


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab\\\t\n\r=trn", max_size=12), min_size=1, max_size=20))
def test_escape_roundtrip(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for row in frame.select("t", wire.unescape(wire.escape("t")).alias("back")).collect():
        assert row.back == row.t


def test_unescape_is_left_to_right(spark):
    cases = {r"\\n": "\\n", r"\n": "\n", r"\\\n": "\\\n", r"\x": "x", "end\\": "end", r"\\\\": "\\\\", r"\t\r": "\t\r"}
    for coded, plain in cases.items():
        assert one(spark, wire.unescape("t"), t=coded) == plain
        assert spark.createDataFrame([(coded,)], "t STRING").selectExpr(wire.unescape_sql("t") + " AS v").first().v == plain


def test_attributes(spark):
    body = "\n53=h1\n53=h2\n114=\n95=a\\tb=c\n262=X:0:1\n262=Y:1:2:3\n2680=no\n1=5"
    frame = spark.createDataFrame([(body,)], "body STRING")
    row = frame.select(
        wire.attr(53).alias("host"), wire.attr(114).alias("service"), wire.attr(95).alias("output"),
        wire.attr(99).alias("missing"), wire.attrs(262).alias("vars"), wire.attrs(268).alias("none"),
        wire.has_attr(114).alias("has"), wire.has_attr(40).alias("has_not"), wire.code(1).alias("code"),
    ).first()
    assert row.host == "h2" and row.service == "" and row.output == "a\tb=c" and row.missing == ""
    assert row.vars == ["X:0:1", "Y:1:2:3"] and row.none == []
    assert row.has and not row.has_not and row.code == 5


def test_parse_kv(spark):
    body = "\n53=h1\n53=h2\n95=a\\tb\n262=X:0:1\n262=Y\n271=dropped\n7\n12345678901=dropped"
    kv = spark.createDataFrame([(body,)], "body STRING").select(wire.parse_kv().alias("kv")).first().kv
    assert kv == {53: ["h1", "h2"], 95: ["a\tb"], 262: ["X:0:1", "Y"], 7: [""]}


def test_encode_then_parse(spark):
    frame = spark.createDataFrame([(HARD, ["x\ty", "z"])], "t STRING, l ARRAY<STRING>")
    coded = frame.select(wire.encode_body((95, "t"), (262, "l"), (27, F.lit(3))).alias("body"))
    row = coded.select(wire.attr(95).alias("t"), wire.attrs(262).alias("l"), wire.code(27).alias("n"), wire.parse_kv().alias("kv")).first()
    assert row.t == HARD and row.l == ["x\ty", "z"] and row.n == 3
    back = coded.select(wire.encode_kv(wire.parse_kv()).alias("body")).select(wire.parse_kv().alias("kv")).first().kv
    assert back == row.kv


def test_numbers(spark):
    for text, want in {"12": 12, " 12x": 12, "-5.9": -5, "": 0, "x1": 0, "99999999999": 2147483647, "-3000000000x": -2147483648, "+7": 7}.items():
        assert one(spark, wire.to_int("t"), t=text) == want
        assert spark.createDataFrame([(text,)], "t STRING").selectExpr(wire.number_sql("t", "int") + " AS v").first().v == want
    for text, want in {"1.5": 1.5, "1.5s": 1.5, "": 0.0, "-.5": -0.5, "1e3": 1000.0, "z": 0.0}.items():
        assert one(spark, wire.to_double("t"), t=text) == want
    assert one(spark, wire.to_long("t"), t="4294967296") == 4294967296
    for text, want in {"9" * 20: 2**63 - 1, "-" + "9" * 60 + "x": -(2**63), "9" * 18: int("9" * 18)}.items():
        assert one(spark, wire.to_long("t"), t=text) == want
        assert spark.createDataFrame([(text,)], "t STRING").selectExpr(wire.number_sql("t", "bigint") + " AS v").first().v == want
    # seconds and fractions no timestamp holds end at its range instead of failing
    assert one(spark, wire.from_epoch(wire.to_long("t")).cast("string"), t="9" * 20).startswith("+294247")
    assert one(spark, wire.to_timeval("t").cast("string"), t="99999999999999.12345678901234").startswith("+29424")
    assert one(spark, wire.clamp(wire.to_long("t"), "smallint"), t="40000") == 32767


def test_timeval_is_decimal(spark):
    assert one(spark, wire.timeval_usec("t"), t="1700000000.000123") == 123
    assert one(spark, wire.timeval_usec("t"), t="1700000000") == 0
    assert one(spark, wire.to_timeval("t"), t="1700000000.000123") == datetime(2023, 11, 14, 22, 13, 20, 123)
    assert one(spark, wire.format_timeval(wire.to_timeval("t")), t="1700000000.000123") == "1700000000.000123"


def test_split_pieces(spark):
    assert tuple(one(spark, wire.split_command("t"), t="a!!b!c")) == ("a", "!b!c")
    assert tuple(one(spark, wire.split_command("t"), t="!a")) == ("a", "")
    assert tuple(one(spark, wire.split_service_ref("t"), t="h;s;x")) == ("h", "s;x")
    assert tuple(one(spark, wire.split_customvar("t"), t="N:1:a:b\nrest")) == ("N", 1, "a:b")
    assert tuple(one(spark, wire.split_customvar("t"), t="N:0")) == ("N", 0, "")
    assert one(spark, wire.split_customvar("t"), t="N") is None
    assert tuple(one(spark, wire.split_timerange("t"), t="3:10-20")) == (3, 10, 20)
    assert one(spark, wire.split_timerange("t"), t="3:10") is None
    assert tuple(one(spark, wire.split_address("t"), t="2:sms:1")) == (2, "sms:1")
    assert one(spark, wire.split_address("t"), t="2") is None
    assert tuple(one(spark, wire.split_var("t"), t="a=b=c")) == ("a", "b=c")


def test_log_split(spark):
    assert tuple(one(spark, wire.log_split("t"), t="[1700000000] text] more\n\n")) == (1700000000, "text] more")
    assert tuple(one(spark, wire.log_split("t"), t="[1700000000] ")) == (1700000000, "")
    assert one(spark, wire.log_split("t"), t="no bracket") is None
    assert one(spark, wire.log_split("t"), t="[x] text") is None
    assert one(spark, wire.log_split("t"), t="[5]") is None


def test_flags_and_enums(spark):
    assert one(spark, wire.raw_check_flag(F.lit(802))) == 1 and one(spark, wire.raw_check_flag(F.lit(801))) == 0
    assert one(spark, wire.cancelled_flag(F.lit(2))) == 1
    assert one(spark, enums.decode_enum(F.lit(1), "downtime_type")) == "SERVICE"
    assert one(spark, enums.decode_enum(F.lit(1), "comment_type")) == "HOST"
    assert one(spark, enums.encode_enum(F.lit("STATECHANGE_END"), "event_type")) == 1801
    assert one(spark, enums.map_objecttype(F.lit(402))) == 2
    assert enums.enum_table(spark, "object_type").count() == 12


def test_ids(spark):
    def oid(kind, a, b=None):
        return one(spark, ids.object_id(F.lit(1), kind, F.lit(a), F.lit(b)))

    assert oid(2, "h", "s") != oid(2, "s", "h") != oid(2, "hs", "")
    assert oid(1, "Host") != oid(1, "host")
    assert oid(1, None) == oid(1, "") == 0
    assert oid(2, "", "x") != 0 and oid(1, "h", None) == oid(1, "h", "")
