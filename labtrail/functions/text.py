"""Names and codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space at the ends of a cell, the non-breaking and typographic kinds included.
BLANKS = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean_sample_name(raw: Column) -> Column:
    """Underscore to hyphen, point to comma, white space out, and the `-Terc` marker out.

    One `translate` covers the single characters: those without a counterpart are deleted.
    """
    return F.replace(F.translate(raw, "_. \t\n\x0b\f\r", "-,"), F.lit("-Terc"), F.lit(""))


def depth_from_name(name: Column) -> Column:
    """The number a sample name ends with, as a double."""
    return F.translate(F.regexp_extract(name, r"([\d,]+)$", 1), ",", ".").try_cast("double")


def fold_value(value: Column, spelling: str, replacement: str) -> Column:
    """Replace one value, whatever its upper and lower case."""
    return F.when(F.lower(value) == spelling.lower(), F.lit(replacement)).otherwise(value)


def map_codes(code: Column, mapping: Mapping[str, str]) -> Column:
    """Translate known codes and leave the others as they are."""
    if not mapping:
        return code
    known = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(known[code], code)


def base_parameter(name: Column, words: tuple[str, ...] = ("total", "dissolvido")) -> Column:
    """A parameter name without the words that tell its fractions apart."""
    return F.trim(F.regexp_replace(name, f"(?i)({'|'.join(words)})", ""))


def first_int(text: Column) -> Column:
    """The first whole number in a text (`14 dias` -> 14), else null."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("int")


def custody_label(label: Column) -> Column:
    """A custody label as a column-safe name: blanks, slashes and hyphens to `_`, colons out."""
    return F.concat(F.lit("CC_"), F.translate(F.btrim(F.coalesce(label, F.lit("")), F.lit(BLANKS)), " /-:", "___"))
