"""Text expressions for reports and log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters a line is stripped of (Unicode white space).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def truncate(text: Column, limit: int, keep: int) -> Column:
    """Texts longer than ``limit`` are cut to ``keep`` characters and marked."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(keep)), F.lit("..."))).otherwise(text)


def padded_name(prefix: Column, index: Column) -> Column:
    return F.format_string("%s_%04d.png", prefix, index.cast("long"))


def bar(filled: Column, width: int) -> Column:
    """Text bar of ``width`` characters; a fractional fill is cut to its whole part."""
    filled = F.floor(filled).cast("int")
    return F.concat(F.repeat(F.lit("#"), filled), F.repeat(F.lit("-"), F.lit(width) - filled))


def duration_text(seconds: Column) -> Column:
    """``1h 2m 3s``. Seconds are rounded half to even on their own, so 60s can appear."""
    return F.format_string(
        "%dh %dm %ds",
        F.floor(seconds / 3600),
        F.floor((seconds % 3600) / 60),
        F.bround(seconds % 60, 0).cast("long"),
    )


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def fixed(value: Column, digits: int) -> Column:
    """Rounded number; turn it into text only when a report is exported."""
    return F.round(value, digits)


def fixed_text(value: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", value.cast("double"))


def percent_text(share: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", share.cast("double") * 100)


def thousands_text(value: Column) -> Column:
    return F.format_string("%,d", value.cast("long"))


def explode_lines(df: DataFrame, text: str, line: str = "line", number: str = "line_no") -> DataFrame:
    """One row per line, numbered from 0 within its text."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(F.split(F.col(text), "\n")).alias(number, line))


def to_json_text(config: Column) -> Column:
    return F.to_json(config)


def from_json_text(text: Column, schema) -> Column:
    return F.from_json(text, schema)
