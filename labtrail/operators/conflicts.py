"""One sample must not report one parameter with two results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.operators.joins import attach

SAMPLE_PARAMETER = ("nomeAmostra", "parametroOriginal")


def exclude_conflicts(
    df: DataFrame, keys: Sequence[str] = SAMPLE_PARAMETER, value: str = "resultadoOriginal"
) -> DataFrame:
    """Drop all rows of a key that has different results. Rows with a null key stay.

    The smallest and the largest result of a key differ exactly when there are several. The verdicts go back to
    the rows by `attach`, with the count of each key as its weight, so a hot key's rows spread over the tasks.
    """
    verdicts = df.groupBy(*keys).agg(
        F.when(F.min(value) != F.max(value), F.lit(True)).alias("_conflict"), F.count("*").alias("_rows")
    )
    judged = attach(df, verdicts, keys, weight="_rows").where(F.col("_conflict").isNull())
    return judged.select(*[F.col(f"`{c}`") for c in df.columns])


def conflict_report(
    df: DataFrame, keys: Sequence[str] = SAMPLE_PARAMETER, value: str = "resultadoOriginal"
) -> DataFrame:
    """The conflicting keys with the number of different results and of rows."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count_distinct(value).alias("distinct_results"), F.count("*").alias("rows"))
        .where("distinct_results > 1")
    )
