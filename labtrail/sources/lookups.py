"""Rule tables and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from labtrail.schemas import STATION_CODE
from labtrail.sources.paths import exists
from labtrail.sources.sheets import read_sheet, require_columns, resolve_columns


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed table without rows, for an input that is not there."""
    return spark.createDataFrame([], schema)


def for_project(df: DataFrame, project: str | None, column: str = "source_project") -> DataFrame:
    """Rows of this project, and rows without a project, which hold for all."""
    if column not in df.columns:
        return df
    return df.where(F.coalesce(F.trim(column), F.lit("")).isin("", project or ""))


def read_lookup(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, Sequence[str]],
    target: str | None = None,
    project: str | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """A rule table under its canonical column names (key -> accepted headers).

    target: keep only rows that say what to map to. project: keep the rows of this project.
    """
    sheet = read_sheet(spark, path, fmt)
    if project is not None:
        sheet = for_project(sheet, project)
    rules = resolve_columns(sheet, columns)
    return rules.where(F.col(target).isNotNull()) if target else rules


def read_rules(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, Sequence[str]],
    optional: Mapping[str, Sequence[str]] = {},
    target: str | None = None,
    project: str | None = None,
    types: Mapping[str, str] = {},
    fmt: str = "csv",
) -> DataFrame:
    """A landed rule table that may not be there: the same columns and types whether it is or not.

    A path that does not exist, a file without anything in it and a sheet of headers alone all give a table
    without rows, so the plan that uses it keeps its shape. A sheet that has headers must have those of all
    `columns`; what is missing is named. `types` casts columns, others are text; a cell that does not read as its
    type is null.
    """
    names = (*columns, *optional)
    schema = StructType([StructField(n, _parse_datatype_string(types.get(n, "string"))) for n in names])
    sheet = _landed(spark, path, fmt)
    if sheet is None or not sheet.columns:
        return empty(spark, schema)
    if project is not None:
        sheet = for_project(sheet, project)
    rules = resolve_columns(require_columns(sheet, columns, path), columns, optional)
    typed = rules.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
    return typed.where(F.col(target).isNotNull()) if target else typed


def _landed(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    """The sheet at a path, None if there is none."""
    if not exists(spark, path):
        return None
    try:
        return read_sheet(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def station_dim(stations: DataFrame, samples: DataFrame, source_project: str) -> DataFrame:
    """Sample names with their station, for one project.

    stations: ID, Name, alternate_name, source_project. samples: Name, Station, quality_code.
    The project filter reaches the scan of `stations`, also when that is a JDBC table.
    """
    mine = stations.where(F.col("source_project") == source_project).select(
        F.col("ID").alias("Station"), F.col("Name").alias(STATION_CODE), "alternate_name"
    )
    return (
        samples.select("Station", F.col("Name").alias("SampleName"), "quality_code")
        .join(mine, "Station")
        .select("SampleName", STATION_CODE, "alternate_name", F.col("quality_code").alias("codigoQualidade"))
    )


def read_station_dim(
    spark: SparkSession, jdbc: Mapping[str, str], source_project: str, tables=("station", "SYS_Sample")
) -> DataFrame:
    """The same from a database; join and filter are left to the optimizer and the database."""
    station, sample = (spark.read.format("jdbc").options(**jdbc, dbtable=t).load() for t in tables)
    return station_dim(station, sample, source_project)
