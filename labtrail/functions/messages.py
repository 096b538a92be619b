"""Tests that end in a flag. A flag is null when there is nothing to say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def triggered(flag: Column) -> Column:
    """A flag counts when it is neither null nor blank."""
    return flag.isNotNull() & (F.trim(flag) != "")


def join_messages(*checks: tuple[Column, str], sep: str = "; ") -> Column:
    """The messages of all conditions that hold, joined; null if none does."""
    said = [F.when(condition, F.lit(message)) for condition, message in checks]
    return F.nullif(F.concat_ws(sep, *said), F.lit(""))


def any_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def outside(value: Column, low: float, high: float) -> Column:
    """Outside `[low, high]`; unknown when the value is null."""
    return ~value.between(low, high)


def exceeds(value: Column, limit: Column) -> Column:
    return value > limit


def rpd(a: Column, b: Column) -> Column:
    """Relative percent difference to two digits; 0 when both are 0, null when it is undefined."""
    spread = F.try_divide(F.abs(a - b), (a + b) / 2) * 100
    return F.round(F.when((a == 0) & (b == 0), F.lit(0.0)).otherwise(spread), 2)
