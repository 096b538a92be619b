"""Stage 2: canonical rows to dates, stations, standard parameters and units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.functions import decimal_comma, depth_from_name, fold_value, quantification_limit
from labtrail.operators.flags import parse_dates
from labtrail.operators.parameters import convert_units, map_parameters
from labtrail.operators.samples import clean_names, map_samples
from labtrail.rules import GROUNDWATER, GROUNDWATER_ACCENTED


def normalise_matrix(df: DataFrame) -> DataFrame:
    return df.withColumn("matriz", fold_value(F.col("matriz"), GROUNDWATER_ACCENTED, GROUNDWATER))


def read_numbers(df: DataFrame) -> DataFrame:
    """Depth from the final sample name, result and limit from text."""
    return df.withColumns(
        {
            "profInicial": depth_from_name(F.col("descricaoAmostra_final")),
            "resultadoNumerico": decimal_comma(F.col("resultadoNumerico")),
            "limiteQuantificacao": quantification_limit(F.col("limiteQuantificacao")),
        }
    )


def clean(
    df: DataFrame,
    station: DataFrame,
    corrections: DataFrame,
    parameters: DataFrame,
    factors: DataFrame,
    flag_missing_dates: bool = True,
) -> DataFrame:
    """Canonical rows to cleaned rows. The number of rows does not change."""
    return (
        df.transform(parse_dates, flag_missing=flag_missing_dates)
        .transform(normalise_matrix)
        .transform(clean_names)
        .transform(map_samples, station, corrections)
        .transform(read_numbers)
        .transform(map_parameters, parameters)
        .transform(convert_units, factors)
    )
