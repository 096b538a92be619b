"""Reading laboratory results that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labtrail.functions.text import BLANKS

_QUALIFIED = r"(?U)^[<>]\s*[^\n]+$"
_NUMBER = r"(?U)^(?:[<>]\s*)?(-?[0-9]+(?:[.,][0-9]+)?)$"


def parse_result(raw: Column) -> Column:
    """Split a result such as `< 0,0030` into `struct(qualifier, numeric, text)`.

    `numeric` keeps the digits as written. `numeric` and `text` exclude each other: what is not a number
    goes to `text` as a whole, qualifier included. A null result gives three nulls.
    """
    text = F.btrim(raw, F.lit(BLANKS))
    number = F.regexp_extract(text, _NUMBER, 1)
    return F.struct(
        F.when(text.rlike(_QUALIFIED), F.substring(text, 1, 1)).alias("qualifier"),
        F.when(number != "", number).alias("numeric"),
        F.when(number == "", text).alias("text"),
    )


def decimal_comma(raw: Column) -> Column:
    """Text with a decimal comma or point as a double; anything else is null.

    The last character keeps out what a cast would accept but a laboratory does not mean (`NaN`,
    `Infinity`, `12.5d`).
    """
    ends_in = F.substring(F.rtrim(raw), -1, 1)
    return F.when(
        ends_in.isin(*"0123456789.,"), F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")
    )


def quantification_limit(raw: Column) -> Column:
    """A limit of `-` means that none applies; it reads as null like any other text."""
    return decimal_comma(raw)
