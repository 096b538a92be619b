"""Batches: one partition of a table per extraction run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "batch_id"


def read_batches(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """All batches of a table; `batch_id` is a partition column, so a filter on it skips folders.

    With a schema no file is opened for it, and columns that older batches lack are null. Without one it has the
    columns of all batches, for which the end of each file is read.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)).load(path)


def list_batches(df: DataFrame) -> DataFrame:
    """The batches there are, in order. Reads the partition column only."""
    return df.select(BATCH).distinct().orderBy(BATCH)


def source_prefix(batch: Column) -> Column:
    """The source a batch name starts with: `siteA_20260901_1530` -> `siteA`."""
    return F.regexp_extract(batch, "^[A-Za-z]+", 0)


def saved_at(batch: Column) -> Column:
    """The save time a batch name ends with (`yyyyMMdd` or `yyyyMMdd_HHmm`); it orders batches."""
    stamp = F.regexp_extract(batch, r"(\d{8}(?:_\d{4})?)$", 1)
    return F.when(stamp == "", F.lit("00000000_0000")).otherwise(stamp)


def newest_batches(batches: DataFrame, by: Sequence[Column] = (), before: str | None = None) -> DataFrame:
    """The newest batch (per `by`), ordered by save time and then name; `before` looks strictly earlier."""
    if before is not None:
        batches = batches.where(F.col(BATCH) < before)
    order = F.struct(saved_at(F.col(BATCH)), F.col(BATCH))
    return batches.groupBy(*by).agg(F.max_by(BATCH, order).alias(BATCH))


def batch_names(spark: SparkSession, path: str) -> DataFrame:
    """The batches of a table that Spark writes in folders, from the names of its folders alone.

    Files are listed when the plan runs and none is opened.
    """
    folder = F.regexp_extract("path", f"/{BATCH}=([^/]+)/", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # a folder name has its special characters as %XX; a plus sign stands for itself
    name = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return files.where(folder != "").select(name.alias(BATCH)).distinct()


def latest_batch(
    df: DataFrame, by: Sequence[Column] = (), before: str | None = None, names: DataFrame | None = None
) -> DataFrame:
    """The rows of the newest batch (per `by`). Nothing runs before the plan does.

    The newest names, one for each group of `by`, are a subquery within the filter on `batch_id`. Spark runs it first,
    and where `batch_id` is a partition column only the folders that pass are read.

    names: the batches there are (`batch_names`). Without it they are read from `df`, whose other columns are left
    out but whose files are opened all the same.
    """
    batches = df.select(BATCH).distinct() if names is None else names
    newest = newest_batches(batches, by, before).agg(F.collect_set(BATCH))
    return df.where(F.array_contains(newest.scalar(), F.col(BATCH)))


def read_latest(
    spark: SparkSession,
    path: str,
    by: Sequence[Column] = (),
    before: str | None = None,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """The newest batch (per `by`) of a table, without reading the others. Give a schema, as in `read_batches`."""
    return latest_batch(read_batches(spark, path, fmt, schema), by, before, batch_names(spark, path))
