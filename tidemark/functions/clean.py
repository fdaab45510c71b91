"""Column expressions for cleaning keys, dates, numbers and text."""

from __future__ import annotations

import html
import json
from functools import lru_cache
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

GENERAL = "GENERAL"

# Date layouts that occur in price, news and forum files.
TIME_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "EEE, d MMM yyyy HH:mm:ss Z",
    "EEE, d MMM yyyy HH:mm:ss z",
)
# Fixed values end.


def to_day(text: Column) -> Column:
    """Day key of an ISO date or timestamp text."""
    return F.substring(text, 1, 10)


def _parse(text: Column, layout: str) -> Column:
    # Weekday names are not part of the value and Spark's formatter does not parse them.
    if layout.startswith("EEE, "):
        text, layout = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", ""), layout[5:]
    return F.try_to_timestamp(text, F.lit(layout))


def _may_be(text: Column, layout: str) -> Column:
    """Whether a text has the separators of a layout, in either case. A layout that is tried and fails costs much more than this."""
    upper = F.upper(text)
    found = F.contains(text, F.lit(":")) if ":" in layout else ~F.contains(text, F.lit(":"))
    if "'T'" in layout:
        found &= F.contains(upper, F.lit("T"))
        return found & (F.contains(text, F.lit(".")) if "." in layout else ~F.contains(text, F.lit(".")))
    return found & F.contains(text, F.lit(" ")) if " " in layout else found


def to_naive_ts(text: Column, layouts: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Tolerant timestamp parse: zones are converted to UTC, failures are NULL."""
    return F.coalesce(*[F.when(_may_be(text, layout), _parse(text, layout)) for layout in layouts])


def to_date_key(text: Column) -> Column:
    return F.to_date(to_naive_ts(text))


def norm_key(text: Column) -> Column:
    return F.upper(F.trim(text))


def clean_symbol(symbol: Column) -> Column:
    for suffix in (".NS", ".BO"):
        symbol = F.replace(symbol, F.lit(suffix), F.lit(""))
    return norm_key(symbol)


def exchange_of(symbol: Column) -> Column:
    return F.when(F.endswith(symbol, F.lit(".NS")), "NSE").otherwise("BSE")


def number(text: Column) -> Column:
    """Double, or NULL where the text is no number."""
    return text.try_cast("double")


def joined_text(*parts: Column) -> Column:
    return F.trim(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def has_value(text: Column) -> Column:
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


#: What counts as a character reference, as in HTML: decimal, hexadecimal or by name, the semicolon optional.
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACED = "\ufffd"


@lru_cache(maxsize=1)
def _entities() -> tuple[str, str, str]:
    """Names with their characters and code points below 0xA0 as the standard library decodes them, in JSON, and a pattern of the names
    that need no semicolon, the longest first."""
    open_names = sorted((n for n in entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    low = {str(n): html.unescape(f"&#{n};") for n in range(0xA0)}
    return json.dumps(entities.html5), json.dumps(low), "^(" + "|".join(open_names) + ")"


def _code_point(n: Column) -> Column:
    """The character of a code point given as decimal(38, 0); null is one too large to be held."""
    low = F.try_element_at(F.from_json(F.lit(_entities()[1]), "map<string,string>"), n.cast("string"))
    own = F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")
    nothing = n.between(0xFDD0, 0xFDEF) | ((n % 0x10000) >= 0xFFFE)
    return (F.when(n.isNull() | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), REPLACED).when(n < 0xA0, low)
            .when(nothing, "").otherwise(own))


def _decoded(reference: Column) -> Column:
    """One character reference as text; a name that is unknown stays as it is."""
    names = F.from_json(F.lit(_entities()[0]), "map<string,string>")
    name = F.substring(reference, 2, 40)
    digits = F.regexp_extract(reference, r"^&#([0-9]+)", 1)
    # Leading zeros do not make a number too large.
    hexadecimal = F.regexp_extract(reference, r"^&#[xX]0*([0-9a-fA-F]*)", 1)
    of_hex = F.when(F.length(hexadecimal) <= 8, F.conv(F.concat(F.lit("0"), hexadecimal), 16, 10).cast("decimal(38,0)"))
    start = F.regexp_extract(name, _entities()[2], 1)
    by_start = F.concat(F.try_element_at(names, start), F.substr(name, F.length(start) + 1))
    return (F.when(digits != "", _code_point(F.concat(F.lit("0"), F.regexp_replace(digits, "^0+", "")).try_cast("decimal(38,0)")))
            .when(reference.rlike("^&#[xX]"), _code_point(of_hex))
            .otherwise(F.coalesce(F.try_element_at(names, name), F.when(start != "", by_start), reference)))


def decode_references(text: Column) -> Column:
    """Text with its character references decoded: what stands between them and what they stand for, in turn."""
    between, found = F.split(text, REFERENCE, -1), F.regexp_extract_all(text, F.lit(REFERENCE), 0)
    joined = F.transform(between, lambda part, k: F.concat(part, F.coalesce(F.get(F.transform(F.slice(found, k + 1, 1), _decoded), 0), F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(joined, "")).otherwise(text)


def clean_html(markup: Column) -> Column:
    """Drop tags, decode entities, strip surrounding white space."""
    return F.regexp_replace(decode_references(F.regexp_replace(markup, r"<[^>]+>", "")), r"^\s+|\s+$", "")


def sanitize_text(text: Column, limit: int) -> Column:
    """First `limit` characters on one line without commas."""
    return F.translate(F.substring(text, 1, limit), "\n,", "  ")


def epoch_to_iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def epoch_ms_text(millis: Column) -> Column:
    """Readable time of an epoch that may be in seconds or milliseconds."""
    ms = F.when(millis > 1_000_000_000_000, F.floor(millis / 1000)).otherwise(millis)
    return F.date_format(F.timestamp_seconds(ms), "dd MMM yyyy HH:mm:ss")


def fmt_duration(millis: Column) -> Column:
    """`1h 02m 03s`, or `2m 03s` below an hour."""
    sec = F.floor(millis / 1000).cast("int")
    hours, minutes, rest = F.floor(sec / 3600).cast("int"), F.floor(sec % 3600 / 60).cast("int"), sec % 60
    return F.when(hours > 0, F.format_string("%dh %02dm %02ds", hours, minutes, rest)).otherwise(
        F.format_string("%dm %02ds", minutes, rest)
    )


def or_general(tickers: Column) -> Column:
    """Joined ticker list of an array, the catch-all key when it is empty."""
    return F.when(F.size(tickers) > 0, F.array_join(tickers, ",")).otherwise(GENERAL)
