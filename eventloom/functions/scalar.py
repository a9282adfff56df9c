"""Text, time, id and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# At least one character that is not Unicode white space; the separators
# U+001C to U+001F count as white space too.
VISIBLE_TEXT = r"(?U)[^\s\x1c-\x1f]"


def is_blank(text: Column) -> Column:
    return ~text.rlike(VISIBLE_TEXT)


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text)


def interval(length: str) -> Column:
    """``interval("24 hours")`` as a literal."""
    return F.expr(f"INTERVAL {length}")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact difference in seconds, with microsecond digits."""
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text without a zone, as producers write it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_iso(text: Column) -> Column:
    """Timestamp from ISO text with or without zone and fraction; NULL if bad."""
    return text.try_cast("timestamp")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; 0 when there is nothing to divide by."""
    share = F.try_divide(part.cast("double") * 100, whole.cast("double"))
    return F.round(F.coalesce(share, F.lit(0.0)), 2)


def user_label(number: Column) -> Column:
    return F.format_string("user_%05d", number)


def hashed_id(prefix: str, length: int, *parts: Column) -> Column:
    """Id derived from a row's content, so that a retried task makes the same one."""
    text = F.concat_ws("|", *[part.cast("string") for part in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|\d?\d)"


def is_ipv4(text: Column) -> Column:
    return text.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$")


def codes(*found: Column) -> Column:
    """List of the codes that are not null.

    Joined and split again rather than filtered: a filter over an array is evaluated
    by the interpreter together with everything inside the array.
    """
    text = F.concat_ws(",", *found)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def money(amount: Column) -> Column:
    return amount.cast("decimal(15,2)")


def total_money(amount: Column) -> Column:
    """Sum of two-decimal amounts, wide enough for trillions of rows."""
    return F.coalesce(F.sum(money(amount)), F.lit(0)).cast("decimal(25,2)")
