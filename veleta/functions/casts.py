"""Casts that give NULL instead of an error (FN-CAST, FN-DT, SEM3), whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_int(c: Column) -> Column:
    """Text such as '45.5' goes through double, so decimals are cut rather than lost."""
    return c.try_cast("double").try_cast("int")


def to_long(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def to_bool(c: Column) -> Column:
    """true/false text first, then numbers, where anything but zero is true."""
    text = c.cast("string")
    return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)


def to_text(c: Column) -> Column:
    return c.cast("string")


def parse_time(c: Column) -> Column:
    """ISO text to timestamp; text without a zone is read in the session zone (UTC here)."""
    return F.try_to_timestamp(c.cast("string"))


CASTS = {
    "double": to_double,
    "int": to_int,
    "long": to_long,
    "boolean": to_bool,
    "string": to_text,
    "timestamp": parse_time,
}
