"""Stage 3: cleaned rows against the contracted scope."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.operators.outputs import output_tags, project_output
from labtrail.operators.parameters import UNMAPPED
from labtrail.operators.scope import (
    SAMPLE,
    coverage,
    flag_holding,
    flag_method,
    flag_scope,
    planned_parameters,
    sample_summary,
    unpivot_plan,
)
from labtrail.rules import GROUNDWATER, SOIL, ProjectRules
from labtrail.schemas import DELIVERED
from labtrail.sources.lookups import empty

SUMMARY_SCHEMA = (
    "Station string, Matriz string, Amostra string, parametros_extras string,"
    " parametros_faltantes string, parametros_fora_do_escopo string, qtd_parametros_total int,"
    " qtd_extras int, qtd_faltantes int, qtd_fora_do_escopo int"
)


@dataclass(frozen=True)
class Scope:
    """The contract of a project: scope rows and the planned groups per station."""

    rows: DataFrame
    plan: DataFrame


def build_scope(
    rules: ProjectRules,
    scope: DataFrame | None,
    soil_plan: DataFrame | None = None,
    groundwater_plan: DataFrame | None = None,
    groundwater_station: str = "Poço",
) -> Scope | None:
    """Scope and both planning sheets as one contract; None when the project has no scope yet."""
    if scope is None or not rules.has_scope():
        return None
    parts = []
    if soil_plan is not None:
        parts.append(unpivot_plan(soil_plan, SOIL, rules.soil_groups))
    if groundwater_plan is not None:
        parts.append(
            unpivot_plan(
                groundwater_plan, GROUNDWATER, rules.groundwater_groups, station=groundwater_station
            )
        )
    if not parts:
        return None
    plan = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return Scope(scope, plan)


def check_scope(df: DataFrame, scope: Scope | None) -> DataFrame:
    """Scope, method and holding-time flags. Rows of unmapped parameters pass with null flags."""
    checked = (
        df.transform(flag_scope, scope.rows if scope else None)
        .transform(flag_method)
        .transform(flag_holding)
    )
    mapped = ~F.col("flag_padronizacao").eqNullSafe(UNMAPPED)
    scoped = (
        "metodo",
        "prazo",
        "prazo_dias",
        "diasDecorridos",
        "flag_parametro_fora_escopo",
        "flag_metodo",
        "flag_holding_time",
    )
    return checked.withColumns({c: F.when(mapped, F.col(c)) for c in scoped})


def summarise(checked: DataFrame, scope: Scope | None) -> DataFrame:
    """The per-sample report, ordered for reading; empty without a scope."""
    if scope is None:
        return empty(checked.sparkSession, SUMMARY_SCHEMA)
    mapped = checked.where(~F.col("flag_padronizacao").eqNullSafe(UNMAPPED))
    planned = planned_parameters(scope.plan, scope.rows)
    return sample_summary(coverage(mapped, planned)).orderBy(*SAMPLE)


def deliver(checked: DataFrame, more: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """The delivered columns with the outputs each row belongs to, one row per output.

    One plan feeds all outputs: writing it partitioned by `output` reads the results once.

    more: columns besides the delivered ones, as (output, source), such as `PARENT` for the replica check.
    """
    spec = (*DELIVERED, *more, ("flag_fator_nao_encontrado", "flag_fator_nao_encontrado"))
    tagged = checked.withColumn("output", F.explode(output_tags()))
    return project_output(tagged, (*spec, ("output", "output")))
