"""Parameter names and units."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.operators.joins import lookup_join

UNMAPPED = "Parametro nao mapeado"
CONVERTED = {
    "resultadoNumerico": "resultadoCorrigido",
    "limiteQuantificacao": "limiteQuantificacaoCorrigido",
}


def map_parameters(df: DataFrame, lookup: DataFrame, on_duplicate: str = "first") -> DataFrame:
    """Standard parameter name and unit by (parameter, matrix); what has no target is flagged.

    The delivered name stays beside the standard one.
    """
    keys = ["parametroOriginal", "matriz"]
    rules = lookup.select(
        F.col("parametro_de").alias("parametroOriginal"),
        F.col("matriz_de").alias("matriz"),
        F.col("parametro_para").alias("parametroCorrigido"),
        "unidade_para",
    )
    target = F.col("parametroCorrigido")
    return lookup_join(df, rules, keys, on_duplicate).withColumns(
        {
            "parametroCorrigido_original": F.col("parametroOriginal"),
            "flag_padronizacao": F.when(target.isNull() | (target == ""), F.lit(UNMAPPED)),
        }
    )


def split_unmapped(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped, unmapped); together they are the whole input, null flags included."""
    is_unmapped = F.col("flag_padronizacao").eqNullSafe(UNMAPPED)
    return df.where(~is_unmapped), df.where(is_unmapped)


def convert_units(
    df: DataFrame,
    factors: DataFrame,
    values: Mapping[str, str] = CONVERTED,
    unit_from: str = "unidadeOriginal",
    unit_to: str = "unidade_para",
    digits: int = 4,
) -> DataFrame:
    """Convert value columns (source -> result) by the factor of their unit pair.

    Units compare exactly. Equal or unknown units leave the value as it is; a pair without a factor counts
    as 1 and is flagged. All value columns share one lookup, so a limit follows its result.
    """
    rules = factors.select(
        F.col("unit_from").alias(unit_from), F.col("unit_to").alias(unit_to), "factor"
    )
    source, target, factor = F.col(unit_from), F.col(unit_to), F.col("factor")
    differs = source != target
    converted = {
        out: F.when(differs, F.round(F.col(c) * F.coalesce(factor, F.lit(1.0)), digits)).otherwise(F.col(c))
        for c, out in values.items()
    }
    flags = {
        "flag_conversao": F.when(
            differs & factor.isNotNull(),
            F.concat(F.lit("Valor convertido de "), source, F.lit(" para "), target),
        ),
        "flag_fator_nao_encontrado": F.when(
            differs & factor.isNull(),
            F.concat(F.lit("Fator de conversao nao encontrado: "), source, F.lit(" -> "), target),
        ),
    }
    return lookup_join(df, rules, [unit_from, unit_to]).withColumns({**converted, **flags}).drop("factor")
