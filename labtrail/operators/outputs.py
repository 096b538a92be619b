"""Shaping and writing what a run delivers."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from labtrail.functions import triggered
from labtrail.operators.parameters import UNMAPPED
from labtrail.schemas import DELIVERED
from labtrail.sources.batches import BATCH
from labtrail.sources.paths import exists, remove, replace

FORMAT = "parquet"
# --- fixed values: the outputs of a validated batch -----------------------------------------------------
OUTPUTS = ("api_validado", "parametro_extra", "metodo", "holding", "erro_mapeamento", "erro_sampleName")


def project_output(
    df: DataFrame, spec: Sequence[tuple[str, str | None]] = DELIVERED, fill: str | None = ""
) -> DataFrame:
    """Select `(output column, source column)` pairs; a source that is absent becomes `fill`."""
    absent = F.lit(fill).cast("string")
    return df.select(
        *[(F.col(f"`{src}`") if src in df.columns else absent).alias(out) for out, src in spec]
    )


def sanitize(df: DataFrame, replacement: str = "_") -> DataFrame:
    """Column names without the characters table formats reject."""
    return df.toDF(*[re.sub(r"[ ,;{}()\n\t=]", replacement, c) for c in df.columns])


def output_tags() -> Column:
    """Which outputs a validated row belongs to; every row has at least one.

    Rows of an unmapped parameter go to their own output only, since no other check applies to them.
    """
    mapped = ~F.col("flag_padronizacao").eqNullSafe(UNMAPPED)
    station = F.col("flag_station_sem_mapeamento").isNull()
    rules = (
        mapped & station,
        mapped & triggered(F.col("flag_parametro_fora_escopo")),
        mapped & triggered(F.col("flag_metodo")),
        mapped & triggered(F.col("flag_holding_time")),
        ~mapped,
        mapped & ~station,
    )
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in zip(OUTPUTS, rules)]))


def route(df: DataFrame) -> DataFrame:
    """One row per (row, output it belongs to), in column `output`."""
    return df.select("*", F.explode(output_tags()).alias("output"))


def batch_folder(path: str, batch_id: str) -> str:
    """The folder of one batch of the table at `path`."""
    return f"{path}/batch_id={quote(batch_id, safe='')}"


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: str,
    partitions: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = FORMAT,
) -> None:
    """Write one batch as a folder of the table at `path`, replacing all of that batch and nothing else.

    Outputs that an earlier run of the batch had and this one has not are gone afterwards. Rows are
    rebalanced by the partition columns first: Spark then writes files of an even size and cuts a large
    output into several, instead of one small file per task and output.
    """
    tagged = sanitize(df)
    if partitions:
        tagged = tagged.hint("rebalance", *[F.col(k) for k in partitions])
    (
        tagged.write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .save(batch_folder(path, batch_id))
    )


def write_table(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Replace a whole table, its columns included."""
    sanitize(df).write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)


def write_counted(df: DataFrame, path: str, fmt: str = FORMAT, flags: Sequence[str] = ()) -> dict[str, int]:
    """Write a table unless there is nothing to write; returns its `rows` and raised flags as counted on the way.

    The plan runs once: it is written beside `path` and counted while it is, and then takes the place of what was
    there, or, without a row, is withdrawn and leaves `path` as it was.
    """
    spark, watched = df.sparkSession, Observation(f"write-{uuid.uuid4().hex[:12]}")
    counts = [F.count_if(F.coalesce(triggered(F.col(f"`{f}`")), F.lit(False))).alias(f) for f in flags]
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        write_table(df.observe(watched, F.count(F.lit(1)).alias("rows"), *counts), beside, fmt)
        counted = {"rows": 0, **dict.fromkeys(flags, 0), **watched.get}
        if counted["rows"]:
            replace(spark, beside, path)
    finally:
        remove(spark, beside)
    return counted


def write_if_any(df: DataFrame, path: str, fmt: str = FORMAT) -> bool:
    """`write_counted`, and whether it wrote."""
    return write_counted(df, path, fmt)["rows"] > 0


def export_bundle(members: Mapping[str, DataFrame], path: str, fmt: str = FORMAT) -> list[str]:
    """Write every non-empty member into a folder of its own; returns the names written.

    For members that come from different plans; each runs once. The views of one checked table are written by
    `export_views`, which reads it once.
    """
    return [n for n, df in members.items() if write_if_any(df, f"{path}/{n}", fmt)]


def append_new(df: DataFrame, path: str, keys: Sequence[str], batch_id: str, fmt: str = FORMAT) -> None:
    """Append the rows whose key no other batch of the table at `path` lists yet, as the batch `batch_id`.

    A run that is repeated replaces what it appended itself and so adds nothing; a key that one project has
    listed is not listed again by another. Rows whose key has a null in it are never known and are appended.
    """
    spark, fresh = df.sparkSession, df
    if exists(spark, path):
        schema = StructType([*df.schema.fields, StructField(BATCH, StringType())])
        listed = spark.read.format(fmt).schema(schema).load(path)
        others = listed.where(F.col(BATCH) != batch_id).select(*keys)
        fresh = df.join(others, list(keys), "left_anti").select(*df.columns)
    write_batch(fresh, path, batch_id, fmt=fmt)


def export_views(df: DataFrame, flags: Sequence[str], path: str, fmt: str = FORMAT) -> dict[str, int]:
    """Write the flagged rows of all checks as one table with a folder per check; returns the rows of each.

    One pass: rows are counted while they are written, and a check without rows has no folder.
    """
    watched = Observation("views")
    raised = F.array(*[F.when(triggered(F.col(f"`{f}`").cast("string")), F.lit(f)) for f in flags])
    tagged = df.select("*", F.explode(F.array_compact(raised)).alias("check"))
    hits = [F.count_if(F.col("check") == f).alias(f"n{i}") for i, f in enumerate(flags)]
    rows = sanitize(tagged.observe(watched, *hits)).hint("rebalance", F.col("check"))
    rows.write.format(fmt).mode("overwrite").partitionBy("check").save(path)
    return {f: watched.get[f"n{i}"] for i, f in enumerate(flags)}


def flag_views(df: DataFrame, flags: Sequence[str]) -> dict[str, DataFrame]:
    """The flagged rows of each check, under the flag's name."""
    return {f: df.where(triggered(F.col(f))) for f in flags}


def union_sources(sources: Mapping[str, DataFrame], tag: str = "fonte_qaqc") -> DataFrame:
    """All sources by column name, tagged with where they come from; absent columns become null."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
