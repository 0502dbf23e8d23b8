"""Parsing and formatting of the two time-stamp formats news feeds carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted formats, compact and ISO-like.
COMPACT = "yyyyMMddHHmmss"
ISO_LIKE = "yyyyMMdd'T'HHmmss'Z'"


def parse_seen_time(value: Column | str, *, on_error: str = "raise") -> Column:
    """``timestamp_ntz`` from either format; blank or null gives null.

    ``on_error="raise"`` fails on any other text; ``"null"`` returns null so that callers can
    divert such rows.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    text = F.trim(F.col(value) if isinstance(value, str) else value)
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit(COMPACT)).cast("timestamp_ntz"),
        F.try_to_timestamp(text, F.lit(ISO_LIKE)).cast("timestamp_ntz"),
    )
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit("unsupported time format: "), text))
        parsed = F.when(
            parsed.isNull() & text.isNotNull() & (text != ""), bad.cast("timestamp_ntz")
        ).otherwise(parsed)
    return parsed


def parse_day(value: Column | str) -> Column:
    """``yyyy-MM-dd`` text to date."""
    return F.to_date(F.col(value) if isinstance(value, str) else value, "yyyy-MM-dd")


def compact_time(day: Column | str) -> Column:
    """Date to ``yyyyMMddHHmmss``."""
    return F.date_format(F.col(day) if isinstance(day, str) else day, COMPACT)


def day_start_arg(day: Column | str) -> Column:
    return F.concat(
        F.date_format(F.col(day) if isinstance(day, str) else day, "yyyyMMdd"), F.lit("T0000")
    )


def day_end_arg(day: Column | str) -> Column:
    return F.concat(
        F.date_format(F.col(day) if isinstance(day, str) else day, "yyyyMMdd"), F.lit("T2359")
    )
