"""Delivered tables and run logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.lab import LAB
from labtrail.catalog.mapping import FACTORS, LOOKUP, lookup_table
from labtrail.catalog.registry import query, table
from labtrail.catalog.scope import FLAGGED, flagged_rows
from labtrail.operators.outputs import project_output, route, sanitize
from labtrail.operators.parameters import convert_units, map_parameters
from labtrail.operators.runlog import COUNT_STEPS, MAPPING_STEP, delivery_summary, latest_step
from labtrail.plans.clean import normalise_matrix, read_numbers
from labtrail.catalog.lab import lab
from labtrail.functions import parse_result
from labtrail.rules import unit_factors

SPEC = (
    ("sample_id", "sample_id"),
    ("sample_name", "descricaoAmostra_final"),
    ("samp_matrix", "matriz"),
    ("chemical (name)", "parametroCorrigido"),
    ("metodo planejado", "metodo"),
    ("frequency", "frequencia"),
    ("flag;metodo", "flag_metodo"),
)


@query(
    "output_projection",
    f"""
    {FLAGGED}
    SELECT sample_id, sample_name, matrix AS samp_matrix, parameter AS chemical__name_, metodo AS metodo_planejado,
           '' AS frequency, fm AS flag_metodo FROM f
    """,
)
def output_projection(spark, sf_dir):
    """Renamed columns, an absent one as empty text, and names a table format accepts."""
    return sanitize(project_output(flagged_rows(spark, sf_dir), SPEC))


@query(
    "routed_counts",
    f"""
    {FLAGGED}, {LOOKUP}, r AS (
      SELECT f.*, coalesce(parametro_para, '') = '' AS sem
      FROM f LEFT JOIN lookup ON parameter = parametro_de AND matrix = matriz_de)
    SELECT 'api_validado' AS output, count(*) AS n FROM r WHERE NOT sem AND no_station IS NULL
    UNION ALL SELECT 'parametro_extra', count(*) FROM r WHERE NOT sem AND fora IS NOT NULL
    UNION ALL SELECT 'metodo', count(*) FROM r WHERE NOT sem AND fm IS NOT NULL
    UNION ALL SELECT 'holding', count(*) FROM r WHERE NOT sem AND fh IS NOT NULL
    UNION ALL SELECT 'erro_mapeamento', count(*) FROM r WHERE sem
    UNION ALL SELECT 'erro_sampleName', count(*) FROM r WHERE NOT sem AND no_station IS NOT NULL
    """,
)
def routed_counts(spark, sf_dir):
    """Rows per output; one pass over the checked rows feeds all of them."""
    rows = flagged_rows(spark, sf_dir).withColumn("parametroOriginal", F.col("parametroCorrigido"))
    mapped = map_parameters(rows.drop("parametroCorrigido"), lookup_table(spark))
    return route(mapped).groupBy("output").agg(F.count("*").alias("n"))


@query(
    "cleaned_results",
    f"""
    WITH {LAB}, {LOOKUP}, {FACTORS}, n AS (
      SELECT *, CASE WHEN result_text = 'Ausente' THEN NULL
                     ELSE cast(replace(replace(result_text, '< ', ''), ',', '.') AS double) END AS num,
             try_cast(replace(lq_text, ',', '.') AS double) AS lim FROM lab)
    SELECT parametro_para AS "parametroCorrigido", matrix AS matriz, unidade_para, count(*) AS results,
           count(num) AS numbers, count(lim) AS limits,
           max(CASE WHEN n.unit_from <> unidade_para THEN round(num * coalesce(factor, 1.0::double), 4) ELSE num END) AS largest,
           max(CASE WHEN n.unit_from <> unidade_para THEN round(lim * coalesce(factor, 1.0::double), 4) ELSE lim END) AS largest_limit,
           count(*) FILTER (n.unit_from <> unidade_para AND factor IS NOT NULL) AS converted,
           max(try_cast(replace(regexp_extract(sample_name, '([\\d,]+)$', 1), ',', '.') AS double)) AS deepest
    FROM n LEFT JOIN lookup ON parameter = parametro_de AND matrix = matriz_de
    LEFT JOIN factors f ON n.unit_from = f.unit_from AND unidade_para = f.unit_to
    GROUP BY ALL
    """,
)
def cleaned_results(spark, sf_dir):
    """Result text to standard parameter and unit: parse, normalise, map, convert."""
    rows = lab(
        spark, sf_dir, "sample_name", "matrix", "parameter", "result_text", "lq_text", "unit_from"
    ).withColumnsRenamed(
        {
            "sample_name": "descricaoAmostra_final",
            "matrix": "matriz",
            "parameter": "parametroOriginal",
            "lq_text": "limiteQuantificacao",
            "unit_from": "unidadeOriginal",
        }
    )
    parsed = rows.withColumn("resultadoNumerico", parse_result(F.col("result_text"))["numeric"])
    mapped = map_parameters(read_numbers(normalise_matrix(parsed)), lookup_table(spark))
    return (
        convert_units(mapped, unit_factors(spark))
        .groupBy("parametroCorrigido", "matriz", "unidade_para")
        .agg(
            F.count("*").alias("results"),
            F.count("resultadoNumerico").alias("numbers"),
            F.count("limiteQuantificacao").alias("limits"),
            F.max("resultadoCorrigido").alias("largest"),
            F.max("limiteQuantificacaoCorrigido").alias("largest_limit"),
            F.count("flag_conversao").alias("converted"),
            F.max("profInicial").alias("deepest"),
        )
    )


# Events read as a run log: a user is a project, an event type a step.
STEPS = {
    "view": MAPPING_STEP,
    "click": COUNT_STEPS["qtd_amostras"],
    "signup": COUNT_STEPS["qtd_resultados"],
    "purchase": COUNT_STEPS["qtd_stations"],
    "error": COUNT_STEPS["qtd_holding_fora_prazo"],
}
_STEP_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STEPS.items()) + " END"
_LOG_COLUMNS = {
    "projeto": "concat('P', cast(user_id AS string))",
    "etapa": _STEP_SQL,
    "batch_ts": "ts",
    "ordem": "event_id",
    "status": "CASE WHEN value > 10 THEN 'Aviso' ELSE 'Sucesso' END",
    "registros_escritos": "cast(event_id % 1000 AS bigint)",
    "observacoes": "props",
}
_LOG = "log AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _LOG_COLUMNS.items()) + " FROM events)"
_NEWEST = (
    _LOG
    + ", newest AS (SELECT * FROM log QUALIFY row_number() OVER"
    " (PARTITION BY projeto, etapa ORDER BY batch_ts DESC, ordem DESC) = 1)"
)


def event_log(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        *[F.expr(e).alias(c) for c, e in _LOG_COLUMNS.items()]
    )


@query("latest_step", f"WITH {_NEWEST} SELECT * FROM newest")
def latest_step_query(spark, sf_dir):
    return latest_step(event_log(spark, sf_dir))


def _figure(column: str, step: str, default: str) -> str:
    return f"coalesce(max({column}) FILTER (etapa = '{step}'), {default})"


@query(
    "delivery_summary",
    f"""
    WITH {_NEWEST}
    SELECT projeto, {_figure("status", MAPPING_STEP, "'Nao encontrado'")} AS mapeamento_status,
           {_figure("observacoes", MAPPING_STEP, "'Etapa de mapeamento nao encontrada no log'")} AS mapeamento_detalhe,
           {", ".join(f"{_figure('registros_escritos', s, 'cast(0 AS bigint)')} AS {c}" for c, s in COUNT_STEPS.items())},
           '23/08/2026 a 30/08/2026' AS periodo_execucao
    FROM newest GROUP BY projeto
    """,
)
def delivery_summary_query(spark, sf_dir):
    return delivery_summary(event_log(spark, sf_dir), "site_20260823_20260830_20260831_0700")
