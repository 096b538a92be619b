"""Dates that arrive in several spellings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shape(pattern: str) -> str:
    """The shape of every text of this date pattern, digits as 9: `dd/MM/yyyy HH:mm` -> `99/99/9999 99:99`.

    Fractions of a second may be shorter than written, so they are left out of shapes.
    """
    out, quoted = "", False
    for c in re.sub(r"\.S+", "", pattern):
        if c == "'":
            quoted = not quoted
        else:
            out += "9" if c.isalpha() and not quoted else c
    return out


def parse_timestamp(raw: Column, formats: Sequence[str]) -> Column:
    """The first format that reads the text wins; null when none does.

    A failing parse is dear, so the shape of a text (its digits all 9, a fraction left out) is worked out once
    and only the formats of that shape are tried. Mostly there is one.
    """
    tried: dict[str, list[str]] = {}
    for fmt in formats:
        tried.setdefault(_shape(fmt), []).append(fmt)
    digits = F.translate(raw, "012345678", "999999999")
    if any("S" in f for f in formats):
        digits = F.regexp_replace(digits, r"\.9+", "")

    def read(shape: Column) -> Column:
        out = F.lit(None).cast("timestamp")
        for known, some in reversed(tried.items()):
            out = F.when(shape == known, F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in some])).otherwise(out)
        return out

    return F.transform(F.array(digits), read)[0]


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Calendar days between two instants; the time of day does not count."""
    return F.datediff(later, earlier)


def week_window(reference: Column) -> tuple[Column, Column]:
    """The last full week before `reference`: `[start, end)`, Sunday to Sunday, as dates."""
    end = F.date_sub(F.next_day(F.to_date(reference), "SUN"), 7)
    return F.date_sub(end, 7), end


def period_text(batch: Column) -> Column:
    """`dd/MM/yyyy a dd/MM/yyyy` from a batch named `<source>_<yyyyMMdd>_<yyyyMMdd>_...`."""
    name = r"^[^_]+_(\d{8})_(\d{8})(?:_|$)"
    first, last = (
        F.date_format(
            F.try_to_timestamp(F.regexp_extract(batch, name, i), F.lit("yyyyMMdd")), "dd/MM/yyyy"
        )
        for i in (1, 2)
    )
    return F.coalesce(F.concat(first, F.lit(" a "), last), F.lit("Nao disponivel"))
