"""Planned against delivered."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.lab import LAB, PLAN, SCOPE, lab, plan_table, scope_table
from labtrail.catalog.registry import query
from labtrail.operators.scope import (
    coverage,
    extra_parameters,
    flag_holding,
    flag_method,
    flag_scope,
    groups_without_scope,
    missing_parameters,
    planned_parameters,
    sample_summary,
    unpivot_plan,
    validation_totals,
)
from labtrail.rules import GROUNDWATER, SOIL

GROUNDWATER_GROUPS = {"G1": "G1", "G2": "G2", "G3": "G1", "G4": "G4"}

# Both planning sheets: soil as marked; groundwater with group G3 planned under the name G1.
LONG_PLAN = (
    PLAN
    + """,
    long AS (
      SELECT station, cast(planned_total AS integer) AS planned_total, grp AS g, 'Solo' AS matriz
      FROM (UNPIVOT plan ON G1, G2, G3, G4 INTO NAME grp VALUE mark)
      UNION ALL
      SELECT station, cast(planned_total AS integer), CASE grp WHEN 'G3' THEN 'G1' ELSE grp END, 'Agua Subterranea'
      FROM (UNPIVOT plan ON G1, G2, G3, G4 INTO NAME grp VALUE mark)),
    planned AS (
      SELECT station, long.matriz, planned_total, g, parametro
      FROM long LEFT JOIN scope ON g = planejamento AND long.matriz = scope.matriz)"""
)

FLAGGED = f"""
    WITH {LAB}, {SCOPE}, {LONG_PLAN},
    f0 AS (
      SELECT lab.*, s.metodo, s.prazo, try_cast(nullif(regexp_extract(s.prazo, '(\\d+)', 1), '') AS integer) AS prazo_dias,
             date_diff('day', cast(sampled_at AS date), cast(received_at AS date)) AS dias,
             CASE WHEN no_station IS NULL AND parameter NOT IN (SELECT parametro FROM scope)
                  THEN 'Parametro fora do escopo contratado' END AS fora
      FROM (SELECT *, row_number() OVER () AS nr FROM lab) lab
      LEFT JOIN scope s ON parameter = s.parametro AND matrix = s.matriz
      QUALIFY row_number() OVER (PARTITION BY nr ORDER BY coalesce(method = s.metodo, false) DESC, s.metodo DESC,
        try_cast(nullif(regexp_extract(s.prazo, '(\\d+)', 1), '') AS integer) DESC) = 1),
    f AS (
      SELECT *, CASE WHEN no_station IS NULL AND fora IS NULL AND method <> metodo THEN 'Metodo diferente do escopo' END AS fm,
             CASE WHEN no_station IS NULL AND fora IS NULL AND dias > prazo_dias THEN 'Holding time fora do prazo' END AS fh
      FROM f0)"""

SETS = (
    FLAGGED
    + """,
    expected AS (
      SELECT DISTINCT f.station, f.matrix, f.sample_name, p.parametro
      FROM f JOIN planned p ON f.station = p.station AND f.matrix = p.matriz
      WHERE no_station IS NULL AND p.parametro IS NOT NULL),
    delivered AS (
      SELECT DISTINCT station, matrix, sample_name, parameter AS parametro FROM f
      WHERE no_station IS NULL AND fora IS NULL),
    missing AS (SELECT * FROM expected ANTI JOIN delivered USING (station, matrix, sample_name, parametro)),
    extra AS (SELECT * FROM delivered ANTI JOIN expected USING (station, matrix, sample_name, parametro))"""
)

_ROWS = ("sample_id", "sample_name", "station", "matrix", "parameter", "method")


def lab_rows(spark, sf_dir, *more):
    """The lab view under the names of cleaned rows."""
    return lab(spark, sf_dir, *_ROWS, "no_station", "sampled_at", "received_at", *more).withColumnsRenamed(
        {
            "sample_name": "descricaoAmostra_final",
            "station": "alternate_name",
            "matrix": "matriz",
            "parameter": "parametroCorrigido",
            "method": "metodoAnalise",
            "no_station": "flag_station_sem_mapeamento",
            "sampled_at": "dataHoraAmostragem_valida",
            "received_at": "dataRecebLab_valida",
        }
    )


def flagged_rows(spark, sf_dir, *more, scope=True):
    rows = lab_rows(spark, sf_dir, *more)
    return flag_holding(flag_method(flag_scope(rows, scope_table(spark) if scope else None)))


def long_plan(spark, sf_dir):
    sheet = plan_table(spark, sf_dir)
    names = {"station": "station", "total": "planned_total"}
    soil = unpivot_plan(sheet, SOIL, ["G1", "G2", "G3", "G4"], **names)
    return soil.unionByName(unpivot_plan(sheet, GROUNDWATER, GROUNDWATER_GROUPS, **names))


def planned(spark, sf_dir):
    return planned_parameters(long_plan(spark, sf_dir), scope_table(spark))


def covered(spark, sf_dir):
    """Coverage needs names and scope only, so neither methods nor dates are read."""
    rows = lab(
        spark, sf_dir, "sample_name", "station", "matrix", "parameter", "no_station"
    ).withColumnsRenamed(
        {
            "sample_name": "descricaoAmostra_final",
            "station": "alternate_name",
            "matrix": "matriz",
            "parameter": "parametroCorrigido",
            "no_station": "flag_station_sem_mapeamento",
        }
    )
    return coverage(flag_scope(rows, scope_table(spark)), planned(spark, sf_dir))


@query(
    "plan_unpivot",
    f"""
    WITH {SCOPE}, {LONG_PLAN}
    SELECT station AS "Station", planned_total AS "totalAmostrasPlanejado", g AS "Planejamento", matriz AS "Matriz" FROM long
    """,
)
def plan_unpivot(spark, sf_dir):
    return long_plan(spark, sf_dir)


@query(
    "planned_parameters",
    f"""
    WITH {SCOPE}, {LONG_PLAN}
    SELECT station AS "Station", matriz AS "Matriz", planned_total AS "totalAmostrasPlanejado", g AS "Planejamento",
           parametro AS "Parametro" FROM planned
    """,
)
def planned_parameters_query(spark, sf_dir):
    return planned(spark, sf_dir)


@query(
    "groups_without_scope",
    f"""
    WITH {SCOPE}, {LONG_PLAN}
    SELECT DISTINCT matriz AS "Matriz", g AS "Planejamento" FROM planned WHERE parametro IS NULL
    """,
)
def groups_without_scope_query(spark, sf_dir):
    return groups_without_scope(planned(spark, sf_dir))


@query(
    "scope_flags",
    f"""
    {FLAGGED}
    SELECT sample_id, matrix AS matriz, parameter AS "parametroCorrigido", method AS "metodoAnalise", metodo, prazo_dias,
           dias AS "diasDecorridos", fora AS flag_parametro_fora_escopo, fm AS flag_metodo, fh AS flag_holding_time
    FROM f
    """,
)
def scope_flags(spark, sf_dir):
    return flagged_rows(spark, sf_dir).select(
        *("sample_id", "matriz", "parametroCorrigido", "metodoAnalise", "metodo"),
        F.col("prazo_dias"),
        F.col("diasDecorridos").cast("bigint").alias("diasDecorridos"),
        *("flag_parametro_fora_escopo", "flag_metodo", "flag_holding_time"),
    )


@query(
    "missing_parameters",
    f"""
    {SETS}
    SELECT station AS "Station", matrix AS "Matriz", sample_name AS "Amostra", parametro AS "Parametro" FROM missing
    """,
)
def missing_parameters_query(spark, sf_dir):
    return missing_parameters(covered(spark, sf_dir))


@query(
    "extra_parameters",
    f"""
    {SETS}
    SELECT station AS "Station", matrix AS "Matriz", sample_name AS "Amostra", parametro AS "Parametro" FROM extra
    """,
)
def extra_parameters_query(spark, sf_dir):
    return extra_parameters(covered(spark, sf_dir))


@query(
    "sample_summary",
    f"""
    {SETS},
    tagged AS (
      SELECT station, matrix, sample_name, parametro, 'x' AS kind FROM extra
      UNION ALL SELECT station, matrix, sample_name, parametro, 'm' FROM missing
      UNION ALL SELECT DISTINCT station, matrix, sample_name, parameter, 'o' FROM f WHERE no_station IS NULL AND fora IS NOT NULL
      UNION ALL SELECT DISTINCT station, matrix, sample_name, parameter, 't' FROM f WHERE no_station IS NULL)
    SELECT station AS "Station", matrix AS "Matriz", sample_name AS "Amostra",
           string_agg(parametro, '; ' ORDER BY parametro) FILTER (kind = 'x') AS parametros_extras,
           string_agg(parametro, '; ' ORDER BY parametro) FILTER (kind = 'm') AS parametros_faltantes,
           string_agg(parametro, '; ' ORDER BY parametro) FILTER (kind = 'o') AS parametros_fora_do_escopo,
           cast(count(*) FILTER (kind = 't') AS integer) AS qtd_parametros_total,
           cast(count(*) FILTER (kind = 'x') AS integer) AS qtd_extras,
           cast(count(*) FILTER (kind = 'm') AS integer) AS qtd_faltantes,
           cast(count(*) FILTER (kind = 'o') AS integer) AS qtd_fora_do_escopo
    FROM tagged GROUP BY station, matrix, sample_name
    """,
)
def sample_summary_query(spark, sf_dir):
    return sample_summary(covered(spark, sf_dir)).orderBy("Station", "Matriz", "Amostra")


@query(
    "scope_absent",
    f"""
    WITH {LAB}
    SELECT matrix AS matriz, count(*) AS results, cast(0 AS bigint) AS outside, cast(0 AS bigint) AS method,
           cast(0 AS bigint) AS late,
           cast(sum(date_diff('day', cast(sampled_at AS date), cast(received_at AS date))) AS bigint) AS days
    FROM lab GROUP BY matrix
    """,
)
def scope_absent(spark, sf_dir):
    """Without a scope no check speaks up, and elapsed days are still there."""
    rows = flagged_rows(spark, sf_dir, scope=False)
    return rows.groupBy("matriz").agg(
        F.count("*").alias("results"),
        F.count("flag_parametro_fora_escopo").alias("outside"),
        F.count("flag_metodo").alias("method"),
        F.count("flag_holding_time").alias("late"),
        F.sum("diasDecorridos").alias("days"),
    )


@query(
    "validation_totals",
    f"""
    {FLAGGED}
    SELECT count(DISTINCT station) AS stations, count(DISTINCT sample_name) AS samples, count(*) AS results,
           count(fh) AS late, count(fora) AS outside, count(fm) AS method
    FROM f
    """,
)
def validation_totals_query(spark, sf_dir):
    return validation_totals(flagged_rows(spark, sf_dir))
