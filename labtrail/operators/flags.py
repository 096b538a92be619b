"""Dates, mandatory fields and flag accounting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtrail.functions import any_blank, join_messages, parse_timestamp, triggered
from labtrail.rules import DATE_COLUMNS, NO_FLAGS, RESULT_DATE_FORMATS, SHEET_DATE_FORMATS


def parse_dates(
    df: DataFrame,
    columns: Sequence[str] = DATE_COLUMNS,
    formats: Sequence[str] = RESULT_DATE_FORMATS,
    flag_missing: bool = True,
) -> DataFrame:
    """Add `<c>_valida` (timestamp) and `flag_<c>` for each date column.

    flag_missing: flag a null date as well; switch it off for sources that lack a column by design.
    """
    parsed = {f"{c}_valida": parse_timestamp(F.col(c), formats) for c in columns}
    flags = {}
    for c in columns:
        failed = F.col(f"{c}_valida").isNull()
        if not flag_missing:
            failed = failed & F.col(c).isNotNull()
        flags[f"flag_{c}"] = F.when(failed, F.lit(f"falha na conversao de {c}"))
    return df.withColumns(parsed).withColumns(flags)


def parse_dates_in_place(
    df: DataFrame,
    columns: Sequence[str],
    formats: Sequence[str] = SHEET_DATE_FORMATS,
    flag: str = "flag_fail_datehour_conversion",
) -> DataFrame:
    """Replace date columns by timestamps; list in `flag` the columns whose text could not be read.

    The parsed values come into columns of their own first, so the flag sees the text and its value, and
    not the replacement. Columns that are absent are skipped, and an existing flag is extended.
    """
    present = [c for c in columns if c in df.columns]
    parsed = {f"_parsed_{c}": parse_timestamp(F.trim(F.col(c)), formats) for c in present}
    failed = [(F.col(c).isNotNull() & F.col(f"_parsed_{c}").isNull(), c) for c in present]
    replaced = {c: F.col(f"_parsed_{c}") for c in present}
    return _extend_list(df.withColumns(parsed), flag, failed, replaced).drop(*parsed)


def flag_missing(
    df: DataFrame, columns: Sequence[str], flag: str = "flag_missing_mandatory_field"
) -> DataFrame:
    """List in `flag` the mandatory columns that are null or blank."""
    blank = [(any_blank(F.col(c)), c) for c in columns if c in df.columns]
    return _extend_list(df, flag, blank)


def _extend_list(
    df: DataFrame,
    flag: str,
    checks: Sequence[tuple[Column, str]],
    replaced: Mapping[str, Column] | None = None,
) -> DataFrame:
    listed = join_messages(*checks, sep=";")
    if flag in df.columns:
        listed = F.nullif(F.concat_ws(";", F.col(flag), listed), F.lit(""))
    return df.withColumns({**(replaced or {}), flag: listed})


def fail_summary(
    clean: DataFrame, failed: DataFrame, execution: str, table: str, flags: Mapping[str, str]
) -> DataFrame:
    """Valid and failed rows per flag over the clean and the failed rows of one table, in one aggregate.

    flags: flag column of `failed` -> name it is reported under.
    """
    nothing = [F.lit(None).cast("string").alias(f) for f in flags]
    every = clean.select(*nothing).union(failed.select(*flags))
    counted = every.agg(
        F.count("*").alias("total"), *[F.count(F.col(f)).alias(f) for f in flags]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(execution).alias("execution"),
                F.lit(table).alias("table"),
                F.lit(name).alias("flag"),
                (F.col("total") - F.col(f)).alias("valid_rows"),
                F.col(f).alias("failed_rows"),
            )
            for f, name in flags.items()
        ]
    )
    return counted.select(F.inline(entries))


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("flag_")]


def flag_counts(df: DataFrame, flags: Sequence[str] | None = None) -> DataFrame:
    """`(flag, n)` for every flag column, counted in a single pass."""
    names = list(flags if flags is not None else flag_columns(df))
    counted = df.agg(*[F.count_if(F.coalesce(triggered(F.col(f)), F.lit(False))).alias(f) for f in names])
    return counted.unpivot([], names, "flag", "n")


def flag_text(df: DataFrame, flags: Sequence[str] | None = None) -> DataFrame:
    """All triggered flags in one text, `name(n); name(n)`, or a dash; one row."""
    names = list(flags if flags is not None else flag_columns(df))
    counted = df.agg(*[F.count_if(F.coalesce(triggered(F.col(f)), F.lit(False))).alias(f) for f in names])
    said = [F.when(F.col(f) > 0, F.concat(F.lit(f + "("), F.col(f), F.lit(")"))) for f in names]
    text = F.nullif(F.concat_ws("; ", *said), F.lit(""))
    return counted.select(F.coalesce(text, F.lit(NO_FLAGS)).alias("flags"))


def date_failures(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Rows, failures summed over the date columns, and the step status; one row."""
    failures = reduce(
        lambda a, b: a + b, [F.count(F.col(f"flag_{c}")) for c in columns]
    ).alias("failures")
    return df.agg(F.count("*").alias("rows_read"), failures).withColumn(
        "status", status_of(F.col("failures"))
    )


def status_of(problems: Column) -> Column:
    return F.when(problems == 0, F.lit("Sucesso")).otherwise(F.lit("Aviso"))


def unmapped(df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
    """Distinct values of the rows a mapping step flagged."""
    return df.where(F.col(flag).isNotNull()).select(*columns).distinct()
