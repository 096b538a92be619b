"""Sample names: to stations, with manual corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.functions import clean_sample_name
from labtrail.operators.joins import unique_lookup
from labtrail.operators.outputs import append_new
from labtrail.schemas import STATION_CODE
from labtrail.sources.paths import scratch_folder

NO_STATION = "Amostra sem correspondencia em df_station"
NAME = "descricaoAmostra"


def clean_names(df: DataFrame) -> DataFrame:
    return df.withColumn(NAME, clean_sample_name(F.col(NAME)))


def map_samples(
    df: DataFrame, station: DataFrame, corrections: DataFrame, on_duplicate: str = "first"
) -> DataFrame:
    """Resolve station code, station name and quality code from the cleaned sample name.

    Priority: the name as delivered, then the corrected name, then the manual values of the correction
    (the quality code has no manual value). Station and quality code of the source are replaced.

    Stations and corrections are resolved by name first, without the rows, which are then read and shuffled once. The
    resolved names come out of a full join, so both sides of the last join come plainly out of a shuffle, and
    adaptive execution splits the rows of a hot name.
    """
    taken = (STATION_CODE, "codigoQualidade", "alternate_name")
    stations = unique_lookup(
        station.select(F.col("SampleName").alias(NAME), *taken), [NAME], on_duplicate
    )
    manual = corrections.select(
        F.col("descricaoAmostra_de").alias(NAME),
        F.col("descricaoAmostra_para").alias("_target"),
        F.col(STATION_CODE).alias("_manual_code"),
        F.col("alternate_name").alias("_manual_name"),
    )
    corrected = stations.select(
        F.col(NAME).alias("_target"),
        F.col(STATION_CODE).alias("_code"),
        F.col("alternate_name").alias("_name"),
        F.col("codigoQualidade").alias("_quality"),
    )
    targets = unique_lookup(manual.join(corrected, "_target", "left"), [NAME], on_duplicate)
    resolved = stations.join(targets, NAME, "full").select(
        NAME,
        F.coalesce(STATION_CODE, "_code", "_manual_code").alias(STATION_CODE),
        F.coalesce("alternate_name", "_name", "_manual_name").alias("alternate_name"),
        F.coalesce("codigoQualidade", "_quality").alias("codigoQualidade"),
        "_target",
    )
    rows = df.drop(*taken)
    final = F.coalesce("_target", NAME).alias("descricaoAmostra_final")
    mapped = rows.join(resolved, NAME, "left").select(
        *[F.col(f"`{c}`") for c in rows.columns], STATION_CODE, "alternate_name", "codigoQualidade", final
    )
    return mapped.withColumn(
        "flag_station_sem_mapeamento", F.when(F.col("alternate_name").isNull(), F.lit(NO_STATION))
    )


def unmapped_to_append(unmapped: DataFrame, listed: DataFrame, project: str | None) -> DataFrame:
    """Unmapped (sample, matrix) pairs whose sample the correction table does not list yet."""
    known = listed.select(F.col("descricaoAmostra_de").alias(NAME))
    fresh = unmapped.select(NAME, "matriz").distinct().join(known, NAME, "left_anti")
    return fresh.select(
        F.col(NAME).alias("descricaoAmostra_de"),
        F.lit(None).cast("string").alias("descricaoAmostra_para"),
        "matriz",
        F.lit(project).cast("string").alias("source_project"),
    )


def append_unmapped(unmapped: DataFrame, path: str, project: str | None, batch_id: str) -> None:
    """Append the samples without a station to the correction table at `path`, each name once; see `append_new`."""
    nothing = unmapped.select(F.lit(None).cast("string").alias("descricaoAmostra_de")).limit(0)
    rows = unmapped_to_append(unmapped.where(F.col(NAME).isNotNull()), nothing, project)
    append_new(rows, path, ["descricaoAmostra_de"], batch_id)


def first_samples(df: DataFrame, name: str = "sample_name", parent: str = "parent") -> DataFrame:
    """Each sample that names a parent, with the first sample of its chain and the steps to it.

    `name`, `first`, `steps` and `cycle`: a sample whose parents lead back to one another has `cycle` true and
    no first sample. A sample that names itself, nothing or a blank starts a chain and is not listed; one that names
    several parents counts with the least. A parent that is no sample itself is the first of its chain.

    Chains are followed by doubling: each round joins what every sample points to with what that one points to,
    so a chain of a thousand samples takes ten rounds. Only links travel, and each round is written to the
    cluster's shared folder. A chain holds samples at every distance from its first, so some arrive in each round until
    all have; when a round brings nobody there, whoever still points on is in or behind a cycle.
    """
    spark, own = df.sparkSession, F.col(f"`{name}`")
    links = (
        df.where((F.trim(f"`{parent}`") != "") & (F.col(f"`{parent}`") != own))
        .groupBy(own.alias("name"))
        .agg(F.min(f"`{parent}`").alias("to"))
    )

    def written(rows: DataFrame) -> DataFrame:
        folder = scratch_folder(spark, "chains")
        rows.write.parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)

    now = written(links.select("name", "to", F.lit(1).cast("long").alias("steps"), F.lit(True).alias("open")))
    travelling, before = now.count(), 0
    while travelling and travelling != before:
        ahead = now.select(F.col("name").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        met = now.join(ahead, "to", "left")
        now = written(met.select(
            "name", F.coalesce("_to", "to").alias("to"),
            (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.col("_to").isNotNull().alias("open"),
        ))
        travelling, before = now.where("open").count(), travelling
    loops = F.col("open")
    return now.select(
        F.col("name").alias(name), F.when(~loops, F.col("to")).alias("first"), F.when(~loops, F.col("steps")).alias("steps"),
        loops.alias("cycle"),
    )
