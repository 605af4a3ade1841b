"""Cleaning, parsing and fingerprints of source text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track visitors.
TRACKING = ["fbclid", "gclid", "dclid", "msclkid", "twclid", "igshid", "mc_cid", "mc_eid", "ref", "referer", "referrer", "from", "feature", "spm", "share", "sfnsn", "oc"]
# Text that stands for a missing value.
MISSING = ["", "-", "--", "N/A", "n/a", "null", "None", "休市"]
SEPARATORS = r"\s*[/／、,，;；\n]\s*"


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.isin(MISSING), None).otherwise(t)


def first_filled(*cols: Column) -> Column:
    """The first alias that holds anything."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def number(c: Column, kind: str = "double") -> Column:
    """A number with thousands commas, percent signs and blanks; null for anything else."""
    return F.regexp_replace(blank_to_null(c.cast("string")), "[,%\\s]", "").try_cast(kind)


def sentinel(c: Column, least: float, inclusive: bool = True) -> Column:
    """Null for values at or below the feed's own sentinel."""
    return F.when(c <= least if inclusive else c < least, None).otherwise(c)


def metric(c: Column) -> Column:
    """struct<i, d, t>: the integer, else the decimal, else the text of a cell."""
    n = F.regexp_replace(blank_to_null(c), "[,%]", "")
    i, d = n.try_cast("long"), n.try_cast("double")
    return F.struct(i.alias("i"), F.when(i.isNull(), d).alias("d"), F.when(d.isNull(), blank_to_null(c)).alias("t"))


def normal_name(c: Column) -> Column:
    """One of two variant characters, for joins by name."""
    return F.translate(F.trim(c), "台", "臺")


def tokens(c: Column) -> Column:
    """Non-empty parts between mixed separators."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), SEPARATORS), lambda x: F.trim(x)), lambda x: x != "")


def strip_html(c: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(c, "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "<[^>]+>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(out, "\\s+", " "))


def normal_url(c: Column) -> Column:
    """Lower-cased scheme and host, no fragment, tracking parameters or trailing slash; null without a host."""
    url = F.regexp_replace(F.trim(c), "#.*$", "")
    scheme, host = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(url, "://([^/?]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, "://[^/?]*([^?]*)", 1), "/+$", "")
    wanted = F.filter(F.split(F.regexp_extract(url, "\\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.lower(p).rlike("^(utm_[^=]*|" + "|".join(TRACKING) + ")(=|$)"))
    query = F.when(F.size(wanted) > 0, F.concat(F.lit("?"), F.array_join(wanted, "&"))).otherwise("")
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, path, query))


def redirect_target(c: Column) -> Column:
    """The address inside a base64 token of a redirect link, behind a mark and its length in one or two bytes; else null."""
    token = F.translate(F.regexp_extract(c, "/articles/([A-Za-z0-9_-]+)", 1), "-_", "+/")
    padded = F.rpad(token, (F.ceil(F.length(token) / 4) * 4).cast("int"), F.lit("="))
    raw = F.unhex(F.regexp_replace(F.hex(F.when(token != "", F.try_to_binary(padded, F.lit("base64")))), "D20100$", ""))
    byte = lambda at: F.conv(F.hex(F.substring(raw, at, 1)), 16, 10).cast("int")
    size = F.when(byte(4) < 128, byte(4)).otherwise(byte(4) - 128 + byte(5) * 128)
    body = F.substring(raw, F.when(byte(4) < 128, 5).otherwise(6), size)
    # bytes that are no UTF-8 would become a replacement mark
    address = F.when(F.hex(F.substring(raw, 1, 3)) == "081322", F.decode(body, "UTF-8"))
    return F.when(address.rlike("^https?://"), address)


#: Signs before the outlet's name that ends a title.
OUTLET_SIGNS = "-|｜–—"


def clean_title(c: Column) -> Column:
    """Letters and digits of a title in lower case, without the outlet behind its last sign; null is empty."""
    outlet = f"\\s+[{OUTLET_SIGNS}]\\s*[^{OUTLET_SIGNS}]{{1,20}}$"
    bare = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), outlet, "")
    return F.translate(F.lower(F.regexp_replace(bare, "[^\\p{L}\\p{N}]", "")), "台", "臺")


def simhash64(c: Column) -> Column:
    """Signed 64-bit fingerprint by majority over the first 8 bytes of the MD5 of character pairs; 0 for no text."""
    n = F.length(c)
    grams = F.when(n == 1, F.array(c)).when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substr(c, i, F.lit(2))))
    # the hash's high and low halves as longs, for bit arithmetic
    halves = F.transform(grams, lambda g: F.struct(F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long").alias("h"), F.conv(F.substring(F.md5(g), 9, 8), 16, 10).cast("long").alias("l")))

    def votes(part: str) -> Column:
        zero = F.array_repeat(F.lit(0), 32)
        return F.aggregate(halves, zero, lambda acc, x: F.transform(acc, lambda v, i: v + (x[part].bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0).cast("int")))

    def packed(part: str) -> Column:
        return F.aggregate(F.transform(votes(part), lambda v, i: F.when(v * 2 > F.size(grams), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return F.when(F.coalesce(n, F.lit(0)) == 0, F.lit(0).cast("long")).otherwise(F.shiftleft(packed("h"), 32).bitwiseOR(packed("l")))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def to_signed(u: Column) -> Column:
    """Unsigned 64-bit (as decimal) to two's complement."""
    return F.when(u >= F.lit("9223372036854775808").cast("decimal(20,0)"), u - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(u).cast("long")


def to_unsigned(s: Column) -> Column:
    wide = s.cast("decimal(20,0)")
    return F.when(s < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def row_key(*cols: Column, digits: int = 5) -> Column:
    """MD5 over the parts, numbers with fixed digits."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def fixed(c: Column, digits: int = 5) -> Column:
    return F.format_string(f"%.{digits}f", c.cast("double"))


def hash_id(c: Column) -> Column:
    """A positive 60-bit id from the first 15 hex digits of the MD5."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("long")


def canonical_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 of the JSON of all fields in the order of their names, nulls included."""
    s = F.struct(*[fields[k].alias(k) for k in sorted(fields)])
    return F.sha2(F.to_json(s, {"ignoreNullFields": "false"}), 256)


def entity_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), "[\\s　]", ""))


def first_name_in(c: Column, names: list[str]) -> Column:
    """The first of ``names``, in their order, that the text holds."""
    out = F.lit(None).cast("string")
    for n in reversed(names):
        out = F.when(F.contains(c, F.lit(n)), n).otherwise(out)
    return out


def without_share(c: Column) -> Column:
    """A name in capitals without the battery or load percentage at its end; a name that is nothing else stays."""
    name = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(name, "[\\s\\-_]*[0-9]{1,4}\\s*%$", "")), F.lit("")), name)


def is_vessel_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[2-7][0-9]{8}$"), F.lit(False))


def is_mojibake(*cols: Column) -> Column:
    """Whether any text holds Cyrillic, which these feeds only show when decoded wrongly."""
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(c.rlike("[\\u0400-\\u04FF]"), F.lit(False))
    return out


def labelled(c: Column, labels: dict[str, str], fallback: str | None = None) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, c.cast("string")), F.lit(fallback) if fallback is not None else c.cast("string"))


def human_bytes(c: Column) -> Column:
    """Bytes to one place in the unit that fits; halves go to the even digit."""
    v = c.cast("double")
    out = F.format_string("%.1f B", v)
    for k, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(v >= 1024**k, F.format_string(f"%.1f {unit}", F.bround(v / 1024**k, 1))).otherwise(out)
    return out


#: Numerals in the names of roads, and directions.
ROAD_NUMERALS = {"一": "1", "二": "2", "三": "3", "四": "4", "五": "5", "六": "6", "七": "7", "八": "8", "九": "9", "十": "10"}
DIRECTIONS = {"北": "N", "南": "S", "東": "E", "西": "W", "北向": "N", "南向": "S", "東向": "E", "西向": "W", "雙向": "B"}


def road_name(c: Column) -> Column:
    """A road's class and number: each numeral as its digits, without the words for number and line; null is empty."""
    out = F.coalesce(c, F.lit(""))
    for numeral, digits in ROAD_NUMERALS.items():
        out = F.replace(out, F.lit(numeral), F.lit(digits))
    return F.trim(F.translate(out, "號線", ""))


def road_direction(c: Column) -> Column:
    """One letter for a direction word; other text in capitals, null empty."""
    word = F.trim(F.coalesce(c, F.lit("")))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in DIRECTIONS.items() for x in pair]), word), F.upper(word))


def kilometre(c: Column) -> Column:
    """``12K+345`` and ``12+345`` as kilometres; null for any other form."""
    part = lambda k: F.nullif(F.regexp_extract(F.trim(c), "^([0-9]+)K?\\+([0-9]+)", k), F.lit("")).try_cast("double")
    return part(1) + part(2) / F.lit(1000.0)


def report_count(text: Column, pattern: str) -> Column:
    """The number in a report by its pattern; null where the report doesn't name it, never zero."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")


def intensity_rank(c: Column) -> Column:
    """Ordinal of a shaking intensity: weak and strong halves of 5 and 6 are apart, the old 5 and 6 are the weak halves; null for other text."""
    order = ["0級", "1級", "2級", "3級", "4級", "5弱", "5強", "6弱", "6強", "7級"]
    name = F.regexp_replace(F.trim(c), "^([56])級$", "$1弱")
    return (F.nullif(F.array_position(F.array(*map(F.lit, order)), name), F.lit(0).cast("long")) - 1).cast("int")


def encoded_base64(c: Column) -> Column:
    """Base64 of bytes in one line; Spark's own breaks lines after 76 signs."""
    return F.regexp_replace(F.base64(c), "[\\r\\n]", "")


def as_list(json: Column) -> Column:
    """The values of a JSON field that holds a list, a single value or nothing."""
    bare = F.regexp_extract(json, '^"(.*)"$', 1)
    one = F.when(bare != "", bare).otherwise(json)
    return F.when(json.isNull() | (json == "null"), F.array().cast("array<string>")).when(json.startswith("["), F.from_json(json, "array<string>")).otherwise(F.array(one))
