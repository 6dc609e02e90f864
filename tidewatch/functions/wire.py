"""Column functions over the text of one protocol record.

A record body is kept as the lines after its type line, each preceded by a newline:
``"\\n1=1202\\n53=host1\\n262=A:0:x"``.  Values never hold a raw newline (the writer escapes them), so
one attribute can be cut out with two native ``substring_index`` calls; nothing here leaves the JVM.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values of the protocol -------------------------------------------------------------
PROTOCOL_VERSION = 2
MAX_KEY = 270
# Attributes whose text is escaped by the writer.
ESCAPED_KEYS = frozenset([
    5, 6, 10, 11, 13, 14, 15, 17, 37, 49, 50, 53, 72, 95, 99, 104, 105, 107, 114, 125, 126, 127, 128,
    129, 130, 131, 132, 133, 134, 136, 137, 138, 158, 159, 160, 162, 163, 166, 170, 171, 172, 174, 175,
    177, 179, 180, 186, 187, 198, 200, 207, 209, 210, 211, 214, 218, 219, 220, 222, 224, 236, 237, 238,
    262, 264, 268,
])
# Attributes that may occur several times in one record.
LIST_KEYS = frozenset([22, 23, 112, 128, 130, 132, 171, 175, 200, 219, 222, 238, 262, 264, 268])
# -----------------------------------------------------------------------------------------------

_NUL = "\u0000"  # cannot occur inside a value, so it is a safe stand-in
_BACKSLASH = "\\"
_BITS = {"smallint": 15, "int": 31}
_CLEAN = {
    "int": r"^[+-]?[0-9]{1,9}$",
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?[0-9]{1,300}([.][0-9]*)?$",
}
_ENDS = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}
#: seconds whose microseconds fit into a timestamp
_SECONDS = 9_223_372_036_854
_PATTERNS = {
    # as many digits as a decimal holds: with more the number is out of range all the same
    "int": r"^\s*([+-]?\d{1,38})",
    "bigint": r"^\s*([+-]?\d{1,38})",
    "double": r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)",
}


def as_col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def escape(value) -> Column:
    """Backslash first, then the three control characters."""
    out = as_col(value)
    for plain, coded in ((_BACKSLASH, r"\\"), ("\t", r"\t"), ("\r", r"\r"), ("\n", r"\n")):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(value) -> Column:
    r"""Left-to-right inverse of :func:`escape`; an unknown ``\x`` becomes ``x``.

    Pairs of backslashes are parked on NUL first, so the remaining replacements cannot see half a
    pair.  Text without a backslash skips all of it.
    """
    text = as_col(value)
    out = F.replace(text, F.lit(r"\\"), F.lit(_NUL))
    for coded, plain in ((r"\t", "\t"), (r"\r", "\r"), (r"\n", "\n")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    out = F.replace(out, F.lit(_BACKSLASH), F.lit(""))
    out = F.replace(out, F.lit(_NUL), F.lit(_BACKSLASH))
    return F.when(F.contains(text, F.lit(_BACKSLASH)), out).otherwise(text)


# ---- SQL text ---------------------------------------------------------------------------------
# Wide tables cut out some fifty attributes.  Their expressions are assembled as SQL text and parsed in
# one call each, which keeps building a plan cheap.
def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def raw_sql(key: int, body: str = "body") -> str:
    mark = literal(f"\n{key}=")
    newline = literal("\n")
    return f"substring_index(substring_index({body}, {mark}, -1), {newline}, 1)"


def unescape_sql(text: str) -> str:
    """SQL text of :func:`unescape`."""
    slash, nul = literal(_BACKSLASH), literal(_NUL)
    out = f"replace({text}, {literal(_BACKSLASH * 2)}, {nul})"
    for coded, plain in ((r"\t", "\t"), (r"\n", "\n"), (r"\r", "\r")):
        out = f"replace({out}, {literal(coded)}, {literal(plain)})"
    out = f"replace(replace({out}, {slash}, ''), {nul}, {slash})"
    return f"CASE WHEN contains({text}, {slash}) THEN {out} ELSE {text} END"


def attr_sql(key: int, body: str = "body") -> str:
    text = raw_sql(key, body)
    return f"({unescape_sql(text)})" if key in ESCAPED_KEYS else text


def number_sql(text: str, kind: str) -> str:
    """Leading number of a text, 0 when there is none; beyond its type's range it is the nearest end of it.

    Absent and clean values take a plain cast; a failing ``try_cast`` raises and catches inside the JVM,
    so it is only reached by text that starts like a number and goes on differently.
    """
    zero = f"CAST({'0D' if kind == 'double' else '0'} AS {kind})"
    prefix = f"nullif(regexp_extract(v, {literal(_PATTERNS[kind])}, 1), '')"
    if kind == "double":
        other = f"coalesce(try_cast({prefix} AS double), {zero})"
    else:
        low, high = _ENDS[kind]
        other = f"greatest({low}BD, least({high}BD, coalesce(try_cast({prefix} AS decimal(38,0)), 0BD)))"
        other = f"CAST({other} AS {kind})"
    # bound as ``v`` the rare case stays out of the generated code, which else outgrows what the JVM loads as one method
    return (
        f"CASE WHEN {text} = '' THEN {zero} WHEN {text} RLIKE {literal(_CLEAN[kind])} THEN CAST({text} AS {kind}) "
        f"ELSE transform(array({text}), v -> {other})[0] END"
    )


def clamp_sql(value: str, kind: str) -> str:
    top = 2 ** _BITS[kind]
    return f"CAST(greatest(-{top}, least({top - 1}, {value})) AS {kind})"


def whole_part_sql(text: str) -> str:
    return f"substring_index({text}, '.', 1)"


def fraction_sql(text: str) -> str:
    return f"IF(contains({text}, '.'), substring_index({text}, '.', -1), '0')"


def seconds_sql(text: str) -> str:
    return number_sql(whole_part_sql(text), "bigint")


def micros_sql(text: str) -> str:
    return number_sql(fraction_sql(text), "int")


def command_sql(text: str) -> tuple[str, str]:
    """Name and arguments of a raw ``name!args`` text; marks are never escaped, so it splits before unescaping."""
    text = f"ltrim('!', {text})"
    name = f"substring_index({text}, '!', 1)"
    return name, f"substr({text}, length({name}) + 2)"


# ---- attributes -------------------------------------------------------------------------------
def raw_attr(key: int, body: str = "body") -> Column:
    """Text of the last occurrence of a scalar attribute, '' when it is absent."""
    return F.expr(raw_sql(key, body))


def attr(key: int, body: str = "body") -> Column:
    return F.expr(attr_sql(key, body))


def code(key: int, body: str = "body") -> Column:
    """Integer attribute."""
    return F.expr(number_sql(raw_sql(key, body), "int"))


def has_attr(key: int, body="body") -> Column:
    return F.contains(as_col(body), F.lit(f"\n{key}="))


def attrs(key: int, body="body") -> Column:
    """All occurrences of a list attribute, in order."""
    found = F.regexp_extract_all(as_col(body), F.lit(f"(?dm)^{key}=(.*)$"), F.lit(1))
    return F.transform(found, unescape) if key in ESCAPED_KEYS else found


def parse_kv(body: str = "body") -> Column:
    """MAP<INT, ARRAY<STRING>> of a whole body, for ad hoc access to any attribute.

    The lines are parsed once (bound as ``es``); a body without repeated keys, the common case, becomes
    the map directly, otherwise the values of each key are gathered in order.
    """
    name = "substring_index(x, '=', 1)"
    value = f"substr(x, length({name}) + 2)"
    key = number_sql(name, "int")
    escaped = f"array({', '.join(str(k) for k in sorted(ESCAPED_KEYS))})"
    coded = f"contains(x, {literal(_BACKSLASH)}) AND array_contains({escaped}, {key})"
    # eleven and more digits are no key; number_sql would read them as 0
    lines = f"filter(split({body}, {literal(chr(10))}), x -> x RLIKE '^[0-9]{{1,9}}([^0-9]|$)')"
    parsed = (
        f"filter(transform({lines}, x -> named_struct('k', {key}, 'v', "
        f"IF({coded}, {unescape_sql(value)}, {value}))), e -> e.k <= {MAX_KEY})"
    )
    keys = "transform(es, e -> e.k)"
    plain = f"map_from_arrays({keys}, transform(es, e -> array(e.v)))"
    gathered = (
        f"map_from_arrays(array_distinct({keys}), transform(array_distinct({keys}), "
        "k -> transform(filter(es, e -> e.k = k), e -> e.v)))"
    )
    unique = f"size(array_distinct({keys})) = size(es)"
    return F.expr(f"transform(array({parsed}), es -> IF({unique}, {plain}, {gathered}))[0]")


def scalar(kv, key: int) -> Column:
    return F.element_at(F.element_at(as_col(kv), F.lit(key)), F.lit(-1))


def frame_type(frame) -> Column:
    """Record type of a frame, NULL when its first line is not ``NNN:``."""
    return F.regexp_extract(as_col(frame), r"^\s*(\d{1,9}):", 1).try_cast("int")


# ---- text to numbers and times ----------------------------------------------------------------
def _number(text: Column, kind: str) -> Column:
    zero = F.lit(0).cast(kind)
    prefix = F.nullif(F.regexp_extract(text, _PATTERNS[kind], 1), F.lit(""))
    other = F.coalesce(prefix.try_cast(kind), zero)
    if kind != "double":
        low, high = (F.lit(Decimal(end)).cast("decimal(38,0)") for end in _ENDS[kind])
        whole = F.coalesce(prefix.try_cast("decimal(38,0)"), F.lit(Decimal(0)).cast("decimal(38,0)"))
        other = F.greatest(low, F.least(high, whole)).cast(kind)
    return (
        F.when(text.isNull() | (text == ""), zero)
        .when(text.rlike(_CLEAN[kind]), text.cast(kind))
        .otherwise(other)
    )


def to_int(text) -> Column:
    """Leading integer of the text, 0 when there is none."""
    return _number(as_col(text), "int")


def to_long(text) -> Column:
    return _number(as_col(text), "bigint")


def to_double(text) -> Column:
    return _number(as_col(text), "double")


def clamp(value: Column, kind: str) -> Column:
    """Fit a number into a narrower column type instead of failing on overflow."""
    top = 2 ** _BITS[kind]
    return F.greatest(F.lit(-top), F.least(F.lit(top - 1), value)).cast(kind)


def timeval_sec(text) -> Column:
    return to_long(F.substring_index(as_col(text), ".", 1))


def timeval_usec(text) -> Column:
    """Microseconds after the point, read as decimal digits; 0 without a point."""
    text = as_col(text)
    part = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise(F.lit("0"))
    return to_int(part)


def to_timeval(text) -> Column:
    seconds = F.greatest(F.lit(-_SECONDS + 2147), F.least(F.lit(_SECONDS - 2148), timeval_sec(text)))
    return F.timestamp_micros(seconds * F.lit(1000000) + timeval_usec(text))


def from_epoch(seconds) -> Column:
    """Time of an epoch second; seconds beyond the range of a timestamp give its nearest end."""
    return F.timestamp_seconds(F.greatest(F.lit(-_SECONDS), F.least(F.lit(_SECONDS), as_col(seconds))))


def from_epoch_sql(seconds: str) -> str:
    """SQL text of :func:`from_epoch`."""
    return f"timestamp_seconds(greatest(-{_SECONDS}L, least({_SECONDS}L, {seconds})))"


def to_epoch(stamp) -> Column:
    return F.unix_timestamp(as_col(stamp))


def std_elements(body="body") -> list[Column]:
    return [
        to_int(raw_attr(1, body)).alias("neb_type"),
        to_int(raw_attr(2, body)).alias("neb_flags"),
        to_int(raw_attr(3, body)).alias("neb_attr"),
        to_timeval(raw_attr(4, body)).alias("event_ts"),
    ]


def float5(value) -> Column:
    """Five decimals, as numbers are written on the wire."""
    return F.format_string("%.5f", as_col(value))


def format_timeval(stamp) -> Column:
    micros = F.unix_micros(as_col(stamp))
    return F.concat(
        F.floor(micros / 1000000).cast("string"),
        F.lit("."),
        F.lpad((micros % 1000000).cast("string"), 6, "0"),
    )


# ---- composite values -------------------------------------------------------------------------
def _pieces(text: Column, mark: str) -> tuple[Column, Column]:
    """First piece and the rest; marks in front of the first piece are skipped."""
    text = F.ltrim(text, F.lit(mark))
    head = F.substring_index(text, mark, 1)
    return head, F.substring(text, F.length(head) + 2, F.length(text))


def split_command(text) -> Column:
    """``cmd!args``; further marks stay in the arguments."""
    name, args = _pieces(as_col(text), "!")
    return F.struct(name.alias("name"), args.alias("args"))


def split_service_ref(text) -> Column:
    host, service = _pieces(as_col(text), ";")
    return F.struct(host.alias("host"), service.alias("service"))


def split_customvar(text) -> Column:
    """``name:modified:value`` as a struct, NULL when the first two parts are not there."""
    text = F.ltrim(as_col(text), F.lit(":"))
    pattern = r"^([^:]+):+([^:]+)(?::\n*([^\n]*))?"
    return F.when(
        text.rlike(r"^[^:]+:+[^:]"),
        F.struct(
            F.regexp_extract(text, pattern, 1).alias("name"),
            to_int(F.regexp_extract(text, pattern, 2)).alias("modified"),
            F.regexp_extract(text, pattern, 3).alias("value"),
        ),
    )


def split_timerange(text) -> Column:
    """``day:start-end`` as a struct, NULL when a part is missing."""
    text = as_col(text)
    pattern = r"^:*([^:]+):-*([^-]+)-(.+)$"
    return F.when(
        text.rlike(pattern),
        F.struct(
            *[to_int(F.regexp_extract(text, pattern, i + 1)).alias(name)
              for i, name in enumerate(("day", "start_sec", "end_sec"))]
        ),
    )


def split_address(text) -> Column:
    """``n:address`` as a struct, NULL when a part is missing."""
    text = as_col(text)
    pattern = r"(?s)^:*([^:]+):(.+)$"
    return F.when(
        text.rlike(pattern),
        F.struct(
            to_int(F.regexp_extract(text, pattern, 1)).alias("number"),
            F.regexp_extract(text, pattern, 2).alias("address"),
        ),
    )


def split_var(text) -> Column:
    """``name=value``."""
    name, value = _pieces(as_col(text), "=")
    return F.struct(name.alias("name"), value.alias("value"))


def log_split(line) -> Column:
    """``[epoch] text`` as (time, text) without trailing newlines, NULL when malformed."""
    line = as_col(line)
    pattern = r"(?s)^\]*.(\s*\d+)[^\]]*\](.+)$"
    return F.when(
        line.rlike(pattern),
        F.struct(
            to_long(F.regexp_extract(line, pattern, 1)).alias("epoch"),
            F.rtrim(F.substring(F.regexp_extract(line, pattern, 2), 2, 2147483647), F.lit("\n")).alias("text"),
        ),
    )


def null_if_empty(value) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def fit_varchar(value, width: int) -> Column:
    return F.substring(as_col(value), 1, width)


def raw_check_flag(neb_type) -> Column:
    return as_col(neb_type).isin(802, 803).cast("smallint")


def cancelled_flag(neb_attr) -> Column:
    return F.when(as_col(neb_attr) == 2, 1).otherwise(0).cast("smallint")


# ---- writing ----------------------------------------------------------------------------------
def encode_attr(key: int, value) -> Column:
    value = F.coalesce(as_col(value).cast("string"), F.lit(""))
    return F.concat(F.lit(f"\n{key}="), escape(value) if key in ESCAPED_KEYS else value)


def encode_list(key: int, values) -> Column:
    """One line per element of an array column."""
    lines = F.transform(
        as_col(values),
        lambda item: F.concat(F.lit(f"\n{key}="), escape(item) if key in ESCAPED_KEYS else item),
    )
    return F.array_join(F.coalesce(lines, F.array().cast("array<string>")), "")


def encode_body(*parts) -> Column:
    """Body text from (key, column) pairs; list attributes take an array column."""
    return F.concat(*[encode_list(k, v) if k in LIST_KEYS else encode_attr(k, v) for k, v in parts])


def encode_kv(kv) -> Column:
    """Body text from a MAP<INT, ARRAY<STRING>>."""
    escaped = F.array(*[F.lit(k) for k in sorted(ESCAPED_KEYS)])
    lines = F.flatten(
        F.transform(
            F.map_entries(as_col(kv)),
            lambda entry: F.transform(
                entry["value"],
                lambda text: F.concat(
                    F.lit("\n"),
                    entry["key"].cast("string"),
                    F.lit("="),
                    F.when(F.array_contains(escaped, entry["key"]), escape(text)).otherwise(text),
                ),
            ),
        )
    )
    return F.array_join(lines, "")
