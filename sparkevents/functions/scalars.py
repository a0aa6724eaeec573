"""Scalar rules of the event model: identifiers, clocks, addresses, ports, hashes and text templates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the clock conversion: 100 ns ticks per millisecond, milliseconds from 1601 to 1970.
TICKS_PER_MS = 10000
EPOCH_SHIFT_MS = 11644473600000

GUID_FORMAT = "%08x-%04x-%04x-%04x-%04x%08x"


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("bigint"))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def upper(text: Column) -> Column:
    """Upper case. Spark takes a byte-wise path for plain ASCII, which hashes are, by itself."""
    return F.upper(text)


def lower_hex(number: Column) -> Column:
    return F.translate(F.hex(number), "ABCDEF", "abcdef")


def make_guid(sensor: Column, pid: Column, create_time: Column) -> Column:
    """Process identifier text of a 32-bit sensor id, a 32-bit pid and a 64-bit create time."""
    sensor, pid, ct = (c.cast("bigint") for c in (sensor, pid, create_time))
    return F.format_string(
        GUID_FORMAT,
        sensor.bitwiseAND(0xFFFFFFFF),
        F.shiftright(pid, 16).bitwiseAND(0xFFFF),
        pid.bitwiseAND(0xFFFF),
        F.shiftright(ct, 48).bitwiseAND(0xFFFF),
        F.shiftright(ct, 32).bitwiseAND(0xFFFF),
        ct.bitwiseAND(0xFFFFFFFF),
    )


def unix_seconds(ticks: Column) -> Column:
    """Whole unix seconds of a tick count; a missing or zero clock stays zero."""
    t = or_zero(ticks.cast("bigint"))
    return F.when(t == 0, t).otherwise(_div(_div(t, TICKS_PER_MS) - F.lit(EPOCH_SHIFT_MS), 1000))


def unix_seconds_float(ticks: Column) -> Column:
    """Fractional unix seconds of a tick count; a missing or zero clock stays zero."""
    t = F.coalesce(ticks.cast("double"), F.lit(0.0))
    return F.when(t == 0, t).otherwise((t / F.lit(float(TICKS_PER_MS)) - F.lit(float(EPOCH_SHIFT_MS))) / F.lit(1000.0))


def _octets(value: Column, shifts: tuple[int, ...]) -> Column:
    v = value.cast("bigint")
    return F.concat_ws(".", *[F.shiftright(v, n).bitwiseAND(255).cast("string") for n in shifts])


def ipv4_little_endian(value: Column) -> Column:
    """Dotted quad of an address whose first octet is the lowest byte (sensor events)."""
    return F.when(value.isNotNull(), _octets(value, (0, 8, 16, 24)))


def ipv4_big_endian(value: Column) -> Column:
    """Dotted quad of a signed 32-bit address whose first octet is the highest byte (JSON hits)."""
    return F.when(value.isNotNull(), _octets(value, (24, 16, 8, 0)))


def unsigned_bits(value: Column) -> Column:
    """Bit pattern, as BIGINT, of an unsigned 64-bit number held in DECIMAL(20,0)."""
    number = lambda n: F.lit(str(n)).cast("decimal(20,0)")
    v = F.coalesce(value.cast("decimal(20,0)"), number(0))
    return F.when(v >= number(1 << 63), v - number(1 << 64)).otherwise(v).cast("bigint")


def ipv6_text(high: Column, low: Column, scope: Column) -> Column:
    """Shortest text of an IPv6 address given as two little-endian halves, with an optional ``%scope``.

    The longest run of two or more zero groups becomes ``::`` (the first one when runs tie), and an IPv4-mapped
    address prints as a dotted quad.
    """
    def text_of(halves: Column) -> Column:
        groups = [
            F.shiftright(halves[h], 16 * k).bitwiseAND(255) * 256 + F.shiftright(halves[h], 16 * k + 8).bitwiseAND(255)
            for h in (0, 1)
            for k in range(4)
        ]
        joined = F.concat(F.lit(":"), F.concat_ws(":", *[lower_hex(g) for g in groups]), F.lit(":"))
        mapped = (halves[0] == 0) & (halves[1].bitwiseAND(0xFFFFFFFF) == F.lit(0xFFFF0000))
        return F.when(mapped, _octets(halves[1], (32, 40, 48, 56))).otherwise(let(joined, shorten))

    def shorten(joined: Column) -> Column:
        text = F.regexp_replace(joined, "^:|:$", "")
        for run in range(2, 9):
            # The first of the longest runs; one colon of each neighbour goes with it.
            zeros = "^(.*?)" + ":0" * run + ":(.*)$"
            found = F.regexp_replace(F.regexp_replace(joined, zeros, "$1::$2"), "^:(?!:)|(?<!:):$", "")
            text = F.when(F.instr(joined, F.lit(":0" * run + ":")) > 0, found).otherwise(text)
        return text

    text = let(F.array(unsigned_bits(high), unsigned_bits(low)), text_of)
    return F.when(scope.isNotNull(), F.concat(text, F.lit("%"), scope)).otherwise(text)


def ip_address(ip: Column) -> Column:
    """Text of an address struct that is either IPv4 or IPv6; a missing struct reads as 0.0.0.0."""
    return F.when(
        or_false(ip["bIsIpv6"]), ipv6_text(ip["ipv6High"], ip["ipv6Low"], ip["ipv6Scope"])
    ).otherwise(ipv4_little_endian(or_zero(ip["ipv4Address"])))


def ntohs(port: Column) -> Column:
    """Byte swap of the low 16 bits."""
    p = port.cast("bigint")
    return F.shiftright(p, 8).bitwiseAND(255).bitwiseOR(F.shiftleft(p, 8).bitwiseAND(65280))


def hex_digest(raw: Column) -> Column:
    """Upper-case hex of a binary hash, '' when missing."""
    return or_empty(F.hex(raw))


def utf8_text(raw: Column) -> Column:
    return or_empty(raw.cast("string"))


def body_md5(body: Column) -> Column:
    return upper(F.md5(body))


def is_gzip(content: Column) -> Column:
    return F.startswith(content, F.lit(bytes.fromhex("1f8b08")))


def header_int(headers: Column, key: str) -> Column:
    """A header number given as an integer or as decimal text; NULL when absent or not a number."""
    text = headers[key]
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def first_query_value(query: Column, name: str) -> Column:
    """First value of a parameter in url-encoded text; NULL when it is absent or any escape is malformed."""
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")
    malformed = F.exists(pieces, lambda p: F.try_url_decode(p).isNull() | p.contains(";"))
    hit = F.get(F.filter(pieces, lambda p: F.try_url_decode(F.substring_index(p, "=", 1)) == name), F.lit(0))
    return F.when(~malformed, F.try_url_decode(F.regexp_replace(hit, "^[^=]*=?", "")))


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def base64_text(raw: Column) -> Column:
    """Base64 on one line; Spark may break long output into lines of 76 characters."""
    return F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))


def event_text(text: Column, as_base64: bool = False) -> Column:
    """Event text as sent in a request body, optionally base64 encoded."""
    return base64_text(text.cast("binary")) if as_base64 else text


def fill_template(template: str, **values: Column) -> Column:
    """Column that fills ``{name}`` placeholders of a driver-side template with column values."""
    pieces: list[Column] = []
    rest = template
    while rest:
        hits = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not hits:
            pieces.append(F.lit(rest))
            break
        at, name = min(hits)
        if at:
            pieces.append(F.lit(rest[:at]))
        pieces.append(values[name].cast("string"))
        rest = rest[at + len(name) + 2 :]
    return F.concat(*pieces) if pieces else F.lit("")
