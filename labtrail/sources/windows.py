"""Extraction windows: date blocks and what they delivered."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.rules import NO_FLAGS

BLOCK_DAYS = 60


def plan_blocks(spark: SparkSession, start: date, end: date, days: int = BLOCK_DAYS) -> DataFrame:
    """Disjoint blocks of at most `days` days that cover `[start, end]`, both ends included."""
    n = (end - start).days // days + 1
    first = F.date_add(F.lit(start), (F.col("id") * days).cast("int"))
    return spark.range(n).select(
        F.col("id").alias("block"),
        first.alias("block_start"),
        F.least(F.date_add(first, days - 1), F.lit(end)).alias("block_end"),
    )


def block_coverage(
    df: DataFrame,
    ts: str,
    start: date,
    end: date,
    days: int = BLOCK_DAYS,
    failed: Sequence[int] = (),
) -> DataFrame:
    """Rows and outcome of every block. `failed` names blocks whose extraction broke off.

    Blocks are equally long, so the block of a row is arithmetic: rows are counted per block number before
    they meet the block table, instead of being joined to it by range.
    """
    day = F.to_date(ts)
    counted = (
        df.where(day.between(F.lit(start), F.lit(end)))
        .groupBy(F.floor(F.datediff(day, F.lit(start)) / days).cast("bigint").alias("block"))
        .agg(F.count("*").alias("n_rows"))
    )
    rows = F.coalesce("n_rows", F.lit(0))
    status = F.when(rows == 0, F.lit("Sem amostras")).otherwise(F.lit("Sucesso"))
    if failed:
        status = F.when(F.col("block").isin(*failed), F.lit("Erro")).otherwise(status)
    return (
        plan_blocks(df.sparkSession, start, end, days)
        .join(counted, "block", "left")
        .select("block", "block_start", "block_end", rows.alias("n_rows"), status.alias("status"))
    )


def extraction_status(blocks: DataFrame) -> DataFrame:
    """The outcome of the whole extraction: an error when blocks failed and nothing came."""
    totals = blocks.agg(
        F.count("*").alias("blocks"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col("status") == "Erro").alias("failed"),
        F.count_if(F.col("status") == "Sem amostras").alias("empty"),
    )
    noted = F.concat(
        F.lit("blocos_com_erro("), "failed", F.lit("); blocos_sem_amostras("), "empty", F.lit(")")
    )
    return totals.withColumns(
        {
            "status": F.when((F.col("failed") > 0) & (F.col("n_rows") == 0), F.lit("Erro"))
            .when(F.col("failed") > 0, F.lit("Aviso"))
            .otherwise(F.lit("Sucesso")),
            "flags": F.when(F.col("failed") + F.col("empty") > 0, noted).otherwise(F.lit(NO_FLAGS)),
        }
    )
