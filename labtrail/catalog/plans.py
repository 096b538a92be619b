"""Whole stages as a user calls them, from a delivery to routed outputs, reports and tallies."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.checks import EXCLUDED, lab_rows, pairs_of_orders
from labtrail.catalog.intake import flat_sheet, pair_sheets
from labtrail.catalog.lab import LAB, scope_table
from labtrail.catalog.mapping import LOOKUP, lookup_table
from labtrail.catalog.registry import query
from labtrail.catalog.scope import FLAGGED, SETS, long_plan
from labtrail.catalog.scope import lab_rows as scope_rows
from labtrail.operators.parameters import map_parameters
from labtrail.plans.checks import quality_checks, quality_summary
from labtrail.plans.intake import intake_flat, intake_pair
from labtrail.plans.validate import Scope, check_scope, deliver, summarise
from labtrail.rules import PENDING_STATUS, ProjectRules

RULES = ProjectRules(campaigns=("HIGH", "URGENT"), excluded_samples=EXCLUDED, surrogates=("ECONOMY Total (mg/L)",))


@query(
    "plan_intake_flat",
    f"""
    WITH {LAB}, own AS (
      SELECT * FROM lab WHERE (campaign LIKE '%HIGH%' OR campaign LIKE '%URGENT%') AND situation <> 'P'),
    k AS (SELECT sample_name, parameter FROM own GROUP BY ALL HAVING count(DISTINCT result_text) > 1)
    SELECT campaign AS campanha, cast(sample_id AS varchar) AS "idAmostra", matrix AS matriz,
           parameter AS "parametroOriginal", result_text AS "resultadoOriginal", situation AS "dataLiberacao",
           CASE WHEN result_text LIKE '<%' THEN '<' END AS qualifier, 'LAB_SITE' AS "OrigemArquivo"
    FROM own ANTI JOIN k USING (sample_name, parameter)
    """,
)
def plan_intake_flat(spark, sf_dir):
    """Orders of status P are pending."""
    status = F.when(F.col("Situacao da Amostra") == "P", PENDING_STATUS).otherwise(F.col("Situacao da Amostra"))
    sheet = flat_sheet(spark, sf_dir).withColumn("Situacao da Amostra", status)
    return intake_flat(sheet, RULES, "LAB", "LAB_SITE").select(
        "campanha", "idAmostra", "matriz", "parametroOriginal", "resultadoOriginal", "dataLiberacao", "qualifier",
        "OrigemArquivo",
    )


@query(
    "plan_intake_pair",
    f"""
    WITH {LAB}, own AS (SELECT * FROM lab WHERE campaign LIKE '%HIGH%' OR campaign LIKE '%URGENT%'),
    k AS (SELECT sample_name, parameter FROM own GROUP BY ALL HAVING count(DISTINCT result_text) > 1)
    SELECT campaign AS campanha, sample_name AS "nomeAmostra", parameter AS "parametroOriginal",
           result_text AS "resultadoOriginal", method AS "metodoAnalise", lq_text AS "limiteQuantificacao"
    FROM own ANTI JOIN k USING (sample_name, parameter)
    """,
)
def plan_intake_pair(spark, sf_dir):
    return intake_pair(*pair_sheets(spark, sf_dir), RULES, "LAB", "LAB_MAIL").select(
        "campanha", "nomeAmostra", "parametroOriginal", "resultadoOriginal", "metodoAnalise", "limiteQuantificacao"
    )


def checked_rows(spark, sf_dir):
    """The lab rows against the scope, parameters marked as mapped or not."""
    rows = scope_rows(spark, sf_dir).withColumnRenamed("parametroCorrigido", "parametroOriginal")
    marked = map_parameters(rows, lookup_table(spark)).withColumn("parametroCorrigido", F.col("parametroOriginal"))
    return check_scope(marked, Scope(scope_table(spark), long_plan(spark, sf_dir)))


@query(
    "plan_deliver",
    f"""
    {FLAGGED}, {LOOKUP}, r AS (
      SELECT f.*, coalesce(parametro_para, '') = '' AS sem
      FROM f LEFT JOIN lookup ON parameter = parametro_de AND matrix = matriz_de),
    o AS (
      SELECT *, unnest(list_filter([
               CASE WHEN NOT sem AND no_station IS NULL THEN 'api_validado' END,
               CASE WHEN NOT sem AND fora IS NOT NULL THEN 'parametro_extra' END,
               CASE WHEN NOT sem AND fm IS NOT NULL THEN 'metodo' END,
               CASE WHEN NOT sem AND fh IS NOT NULL THEN 'holding' END,
               CASE WHEN sem THEN 'erro_mapeamento' END,
               CASE WHEN NOT sem AND no_station IS NOT NULL THEN 'erro_sampleName' END], lambda x: x IS NOT NULL)) AS output
      FROM r)
    SELECT output, station AS alternate_name, sample_name, matrix AS samp_matrix, method AS analysis_method,
           CASE WHEN NOT sem THEN metodo END AS metodo_planejado, CASE WHEN NOT sem THEN prazo END AS hodlgin_time_planejado,
           CASE WHEN NOT sem THEN fora END AS flag_parametro_fora_escopo, CASE WHEN NOT sem THEN fm END AS flag_metodo,
           CASE WHEN NOT sem THEN fh END AS flag_holding_time
    FROM o
    """,
)
def plan_deliver(spark, sf_dir):
    """Every row once per output it belongs to, under the delivered names."""
    return deliver(checked_rows(spark, sf_dir)).select(
        "output", "alternate_name", "sample_name", "samp_matrix", "analysis_method", "metodo_planejado",
        "hodlgin_time_planejado", "flag_parametro_fora_escopo", "flag_metodo", "flag_holding_time",
    )


@query(
    "plan_summarise",
    f"""
    {SETS.replace("FROM lab) lab", "FROM lab JOIN maps ON parameter = parametro_de AND matrix = matriz_de) lab").replace("f0 AS (", LOOKUP + ", maps AS (SELECT * FROM lookup WHERE parametro_para <> ''), f0 AS (", 1)},
    counted AS (
      SELECT station, matrix, sample_name, 'x' AS kind FROM extra
      UNION ALL SELECT station, matrix, sample_name, 'm' FROM missing
      UNION ALL SELECT DISTINCT station, matrix, sample_name, 'o' || parameter FROM f WHERE no_station IS NULL AND fora IS NOT NULL
      UNION ALL SELECT DISTINCT station, matrix, sample_name, 't' || parameter FROM f WHERE no_station IS NULL)
    SELECT station AS "Station", matrix AS "Matriz", sample_name AS "Amostra",
           cast(count(*) FILTER (kind LIKE 't%') AS integer) AS qtd_parametros_total,
           cast(count(*) FILTER (kind = 'x') AS integer) AS qtd_extras,
           cast(count(*) FILTER (kind = 'm') AS integer) AS qtd_faltantes,
           cast(count(*) FILTER (kind LIKE 'o%') AS integer) AS qtd_fora_do_escopo
    FROM counted GROUP BY station, matrix, sample_name
    """,
)
def plan_summarise(spark, sf_dir):
    """The report of each sample, over the rows of mapped parameters."""
    scope = Scope(scope_table(spark), long_plan(spark, sf_dir))
    return summarise(checked_rows(spark, sf_dir), scope).select(
        "Station", "Matriz", "Amostra", "qtd_parametros_total", "qtd_extras", "qtd_faltantes", "qtd_fora_do_escopo"
    )


@query(
    "plan_quality_checks",
    f"""
    WITH {LAB},
    v AS (SELECT sample_id, chemical_name, min(value) AS value FROM lab GROUP BY ALL),
    rd AS (
      SELECT DISTINCT unnest([a.sample_id, b.sample_id]) AS id, a.chemical_name
      FROM v a JOIN v b ON a.chemical_name = b.chemical_name AND b.sample_id = a.sample_id + 1
      JOIN orders ON o_orderkey = a.sample_id
      WHERE round(abs(a.value - b.value) / ((a.value + b.value) / 2) * 100, 2) > 20),
    base AS (
      SELECT lab.*, trim(regexp_replace(chemical_name, '(?i)(total|dissolvido)', '', 'g')) AS base,
             matrix IN ('Agua Subterranea', 'Fase livre')
               AND sample_name NOT IN ({", ".join(f"'{n}'" for n in EXCLUDED)}) AS wet FROM lab),
    td AS (
      SELECT sample_name, base FROM base WHERE wet GROUP BY ALL
      HAVING max(value) FILTER (chemical_name LIKE '%Dissolvido%') > min(value) FILTER (chemical_name LIKE '%Total%')),
    rows AS (
      SELECT b.*, td.base IS NOT NULL AND wet AS td_hit, rd.id IS NOT NULL AS rd_hit
      FROM base b LEFT JOIN td ON td.sample_name = b.sample_name AND td.base = b.base
      LEFT JOIN rd ON rd.id = b.sample_id AND rd.chemical_name = b.chemical_name),
    t AS (
      SELECT 'Surrogate' AS "check", count(*) FILTER (chemical_name = 'ECONOMY Total (mg/L)') AS examined,
             count(*) FILTER (chemical_name = 'ECONOMY Total (mg/L)' AND value NOT BETWEEN 80 AND 120) AS flagged FROM rows
      UNION ALL SELECT 'Totais_Dissolvidos', count(*) FILTER (wet), count(*) FILTER (td_hit) FROM rows
      UNION ALL SELECT 'DBO_DQO', 0, 0
      UNION ALL SELECT 'Cromo', 0, 0
      UNION ALL SELECT 'Branco', count(quality_code),
             count(*) FILTER (quality_code IS NOT NULL AND value > quantification_limit) FROM rows
      UNION ALL SELECT 'RPD_Replica',
             count(*) FILTER (sample_id IN (SELECT unnest([o_orderkey, o_orderkey + 1]) FROM orders)),
             count(*) FILTER (rd_hit) FROM rows)
    SELECT "check", examined, flagged, CASE WHEN flagged = 0 THEN 'Sucesso' ELSE 'Aviso' END AS status FROM t
    """,
)
def plan_quality_checks(spark, sf_dir):
    """The project's own checks and their tally; these rows have no oxygen demand and no chromium."""
    rows = lab_rows(spark, sf_dir, "quality_code", "quantification_limit")
    return quality_summary(quality_checks(rows, RULES, pairs_of_orders(spark, sf_dir)), RULES)
