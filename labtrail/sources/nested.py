"""Nested sample documents to one row per (sample, parameter)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.functions import custody_label
from labtrail.functions.text import BLANKS
from labtrail.schemas import (
    CUSTODY_FIELDS,
    PARAMETER_FIELDS,
    PARAMETER_RENAMES,
    SAMPLE_FIELDS,
    SAMPLE_RENAMES,
    STATION_CODE,
    nested_schema,
)


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    samples_field: str = "amostras",
    station_field: str = STATION_CODE,
    multiline: bool = True,
) -> DataFrame:
    """Landed documents, all files in one scan. Use `multiline=False` for one document per line: such files
    are split among tasks."""
    schema = nested_schema(samples_field, station_field)
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def flatten_samples(documents: DataFrame, samples_field: str = "amostras") -> DataFrame:
    """One row per sample, its fields as columns, lists still nested."""
    return documents.select(F.explode(samples_field).alias("s")).select("s.*")


def custody_labels(notes: Column) -> Column:
    """The site notes of a sample as a map from column-safe label to its values, joined by ` | `.

    Null and blank values are left out. When a label repeats, its last entry stays.
    """
    entries = F.transform(
        notes,
        lambda n: F.named_struct(
            F.lit("key"),
            custody_label(n["label"]),
            F.lit("value"),
            F.array_join(
                F.filter(F.coalesce(n["value"], F.array()), lambda v: F.btrim(v, F.lit(BLANKS)) != ""), " | "
            ),
        ),
    )
    return F.aggregate(
        entries,
        F.create_map().cast("map<string,string>"),
        lambda seen, e: F.map_concat(
            F.map_filter(seen, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])
        ),
    )


def flatten_results(
    documents: DataFrame,
    origin: str,
    samples_field: str = "amostras",
    station_field: str = STATION_CODE,
    labels: Sequence[str] = (),
) -> DataFrame:
    """One row per (sample, parameter), all text, sample and custody fields repeated.

    A sample without parameters gives no row. The site notes are one map column `custodia`, so a label
    that only some samples carry is kept; `labels` names those to deliver as columns as well.
    """
    info = F.col("cadeiaDeCustodia.informacoes")
    notes = custody_labels(F.col("cadeiaDeCustodia.avaliacoesDoLocal"))
    sample = [F.col(station_field).alias(STATION_CODE)] + [
        F.col(f).alias(SAMPLE_RENAMES.get(f, f)) for f in SAMPLE_FIELDS
    ]
    custody = [info[f].alias(f"CC_{f}") for f in CUSTODY_FIELDS]
    flat = flatten_samples(documents, samples_field).select(
        *sample, *custody, notes.alias("custodia"), F.explode("parametros").alias("p")
    )
    kept = [c for c in flat.columns if c != "p"]
    return flat.select(
        *kept,
        *[F.col(f"p.{f}").alias(PARAMETER_RENAMES.get(f, f)) for f in PARAMETER_FIELDS],
        *[F.col("custodia")[label].alias(label) for label in labels],
        F.lit(origin).alias("OrigemArquivo"),
    )


def read_nested_results(spark: SparkSession, path: str | list[str], origin: str, **layout) -> DataFrame:
    """Read and flatten; `layout` holds the field names and `multiline`, as above."""
    names = {k: layout[k] for k in ("samples_field", "station_field") if k in layout}
    documents = read_documents(
        spark, path, **names, **({"multiline": layout["multiline"]} if "multiline" in layout else {})
    )
    return flatten_results(documents, origin, **names, labels=layout.get("labels", ()))
