"""Scalar expressions. All are plain column expressions and stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_digits(content: Column, head: int = 4, tail: int = 4) -> Column:
    """Hide the middle of a digit string. Other or too short text is kept, null becomes ''."""
    hidden = F.repeat(F.lit("*"), F.length(content) - head - tail)
    masked = F.regexp_replace(
        content, F.lit(rf"^(\d{{{head}}})\d+(\d{{{tail}}})$"),
        F.concat(F.lit("$1"), hidden, F.lit("$2")))
    return F.coalesce(masked, F.lit(""))


def from_epoch(value: Column, unit: str = "s") -> Column:
    """Epoch seconds or milliseconds to a timestamp."""
    return F.timestamp_seconds(value) if unit == "s" else F.timestamp_millis(value)


def local_day(ts: Column, zone_hours: int = 8) -> Column:
    """Start of the day in a fixed zone, given as that zone's wall clock."""
    return F.date_trunc("day", ts + F.expr(f"interval {zone_hours} hours"))


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def web_log_fields(line: Column) -> dict[str, Column]:
    """The used fields of a space-separated access log line."""
    part = F.split(line, " ")
    return {
        "ip": part[0],
        "user_id": part[1],
        "ts": F.to_timestamp(part[3], "dd/MM/yyyy:HH:mm:ss"),
        "method": part[5],
        "url": part[6],
    }


def key_text(parts: Sequence[Column], delimiter: str = "_") -> Column:
    """Several values as one text, different for different values.

    A null part is \\N. A backslash in a part is doubled, and a delimiter in any part but the first has
    a backslash before it: so of the delimiters without one, the last ones are those between the parts.
    """
    def part(value: Column, inner: bool) -> Column:
        text = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
        if inner:
            text = F.replace(text, F.lit(delimiter), F.lit("\\" + delimiter))
        return F.coalesce(text, F.lit("\\N"))

    return F.concat_ws(delimiter, *[part(p, i > 0) for i, p in enumerate(parts)])


def composite_key(*parts: Column, delimiter: str = "_") -> Column:
    return key_text(parts, delimiter)
