"""Dates, stations, parameters, units."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.lab import LAB, lab, values
from labtrail.catalog.registry import query, table
from labtrail.operators.flags import (
    date_failures,
    fail_summary,
    flag_counts,
    flag_missing,
    flag_text,
    parse_dates,
    parse_dates_in_place,
    unmapped,
)
from labtrail.operators.parameters import convert_units, map_parameters, split_unmapped
from labtrail.operators.samples import clean_names, map_samples, unmapped_to_append
from labtrail.rules import UNIT_FACTORS, rule_table, unit_factors
from labtrail.sources.lookups import for_project, station_dim

_PARSED = """
    coalesce(try_strptime(date_text, '%d/%m/%Y %H:%M'), try_strptime(date_text, '%Y-%m-%d %H:%M:%S'))
"""


@query(
    "dates_multi_format",
    f"""
    WITH {LAB}
    SELECT sample_id, date_text, {_PARSED} AS date_text_valida,
           CASE WHEN {_PARSED} IS NULL THEN 'falha na conversao de date_text' END AS flag_date_text
    FROM lab
    """,
)
def dates_multi_format(spark, sf_dir):
    parsed = parse_dates(lab(spark, sf_dir, "sample_id", "date_text"), ["date_text"])
    return parsed.withColumn("date_text_valida", F.col("date_text_valida").cast("timestamp_ntz"))


@query(
    "date_failure_totals",
    f"""
    WITH {LAB}
    SELECT count(*) AS rows_read,
           count(*) FILTER ({_PARSED} IS NULL) + count(*) FILTER (quality_code IS NOT NULL OR quality_code IS NULL) AS failures,
           'Aviso' AS status
    FROM lab
    """,
)
def date_failure_totals(spark, sf_dir):
    """Failures summed over two date columns; a quality code never reads as a date."""
    rows = lab(spark, sf_dir, "date_text", "quality_code")
    columns = ["date_text", "quality_code"]
    return date_failures(parse_dates(rows, columns), columns)


@query(
    "dates_inplace_flags",
    f"""
    WITH {LAB}, t AS (
      SELECT sample_id, date_text AS a, quality_code AS c,
             make_timestamp(2000 + year(sampled_at) % 100, month(sampled_at), day(sampled_at), 0, 0, 0) AS b FROM lab)
    SELECT sample_id,
           coalesce(try_strptime(a, '%d/%m/%Y %H:%M'), try_strptime(a, '%Y-%m-%d %H:%M:%S')) AS a,
           b, cast(NULL AS timestamp) AS c,
           nullif(concat_ws(';', CASE WHEN coalesce(try_strptime(a, '%d/%m/%Y %H:%M'),
                                                    try_strptime(a, '%Y-%m-%d %H:%M:%S')) IS NULL THEN 'a' END,
                                 CASE WHEN c IS NOT NULL THEN 'c' END), '') AS flag_fail_datehour_conversion
    FROM t
    """,
)
def dates_inplace_flags(spark, sf_dir):
    """Three columns replaced at once: mixed formats, two-digit years (2000 to 2099), codes that are no dates."""
    rows = lab(spark, sf_dir, "sample_id", "date_text", "sampled_at", "quality_code").select(
        "sample_id",
        F.concat(F.lit(" "), "date_text").alias("a"),
        F.date_format("sampled_at", "dd/MM/yy").alias("b"),
        F.col("quality_code").alias("c"),
    )
    parsed = parse_dates_in_place(rows, ["a", "b", "c", "absent"])
    return parsed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in "abc"})


# Stations of all orders but one campaign's; manual corrections for part of that campaign.
_PROJECT = "CASE WHEN o_totalprice < 100000 THEN 'OTHER' WHEN o_totalprice < 200000 THEN ' ' ELSE 'P' END"


def stations(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ID"),
        F.expr("concat('ST-', cast(n_nationkey AS string))").alias("Name"),
        F.col("n_name").alias("alternate_name"),
        F.lit("P").alias("source_project"),
    )
    orders = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'")
    samples = orders.join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    ).select(
        F.expr("concat('S-', cast(o_orderkey AS string))").alias("Name"),
        F.col("c_nationkey").alias("Station"),
        F.col("o_orderstatus").alias("quality_code"),
    )
    return station_dim(nation, samples, "P")


def corrections(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderpriority = '5-LOW' AND o_orderstatus <> 'P'")
    listed = orders.select(
        F.expr("concat('S-', cast(o_orderkey AS string))").alias("descricaoAmostra_de"),
        F.expr("concat('S-', cast(o_orderkey + 1 AS string))").alias("descricaoAmostra_para"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'MC' END").alias("codigoEstacao"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'MANUAL' END").alias("alternate_name"),
        F.expr(_PROJECT).alias("source_project"),
    )
    return for_project(listed, "P")


_DIMENSIONS = f"""
    station AS (
      SELECT 'S-' || cast(o_orderkey AS varchar) AS name, 'ST-' || cast(n_nationkey AS varchar) AS code,
             n_name AS alt, o_orderstatus AS quality
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      WHERE o_orderpriority <> '5-LOW'),
    corrections AS (
      SELECT 'S-' || cast(o_orderkey AS varchar) AS de, 'S-' || cast(o_orderkey + 1 AS varchar) AS para,
             CASE WHEN o_orderstatus = 'F' THEN 'MC' END AS code, CASE WHEN o_orderstatus = 'F' THEN 'MANUAL' END AS alt
      FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P' AND trim({_PROJECT}) IN ('', 'P'))
"""


def mapped_rows(spark, sf_dir):
    rows = lab(spark, sf_dir, "sample_id", "matrix").select(
        F.expr("concat('S_', cast(sample_id AS string), ' -Terc')").alias("descricaoAmostra"),
        F.col("matrix").alias("matriz"),
        F.lit("from source").alias("codigoEstacao"),
        F.lit("from source").alias("codigoQualidade"),
    )
    return map_samples(clean_names(rows), stations(spark, sf_dir), corrections(spark, sf_dir))


@query(
    "station_mapping",
    f"""
    WITH {LAB}, {_DIMENSIONS}, r AS (
      SELECT l.sample_name, l.matrix, coalesce(k.para, l.sample_name) AS final,
             coalesce(s.code, t.code, k.code) AS code, coalesce(s.alt, t.alt, k.alt) AS alt,
             coalesce(s.quality, t.quality) AS quality
      FROM lab l LEFT JOIN station s ON l.sample_name = s.name LEFT JOIN corrections k ON l.sample_name = k.de
      LEFT JOIN station t ON t.name = coalesce(k.para, l.sample_name))
    SELECT sample_name AS "descricaoAmostra", final AS "descricaoAmostra_final", code AS "codigoEstacao",
           alt AS alternate_name, quality AS "codigoQualidade",
           CASE WHEN alt IS NULL THEN 'Amostra sem correspondencia em df_station' END AS flag_station_sem_mapeamento,
           count(*) AS n
    FROM r GROUP BY ALL
    """,
)
def station_mapping(spark, sf_dir):
    return (
        mapped_rows(spark, sf_dir)
        .groupBy(
            "descricaoAmostra",
            "descricaoAmostra_final",
            "codigoEstacao",
            "alternate_name",
            "codigoQualidade",
            "flag_station_sem_mapeamento",
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "unmapped_feedback",
    f"""
    WITH {LAB}, {_DIMENSIONS}, u AS (
      SELECT DISTINCT sample_name, matrix FROM lab WHERE campaign = '5-LOW')
    SELECT sample_name AS "descricaoAmostra_de", cast(NULL AS varchar) AS "descricaoAmostra_para",
           matrix AS matriz, 'P' AS source_project
    FROM u ANTI JOIN corrections ON sample_name = de
    """,
)
def unmapped_feedback(spark, sf_dir):
    """Samples without a station that the correction table does not list yet."""
    rows = lab(spark, sf_dir, "sample_name", "matrix", "no_station").select(
        F.col("sample_name").alias("descricaoAmostra"), F.col("matrix").alias("matriz"), "no_station"
    )
    fresh = unmapped(rows, ["descricaoAmostra", "matriz"], "no_station")
    return unmapped_to_append(fresh, corrections(spark, sf_dir), "P")


LOOKUP_ROWS = (
    ("ECONOMY", "Solo", "Ferro", "mg/kg"),
    ("ECONOMY", "Agua Subterranea", "Ferro Total", "mg/L"),
    ("ECONOMY", "Fase livre", "Ferro Livre", "mg/L"),
    ("SMALL", "Solo", "Chumbo", "mg/Kg"),
    ("SMALL", "Agua Subterranea", "Chumbo Total", "µg/L"),
    ("SMALL", "Fase livre", "", "mg/L"),
    ("MEDIUM", "Solo", "Zinco", "mg/kg"),
    ("MEDIUM", "Agua Subterranea", "Zinco Total", "mg/L"),
    ("MEDIUM", "Fase livre", None, None),
    ("STANDARD", "Solo", "Cobre", None),
    ("STANDARD", "Agua Subterranea", "Cobre Total", "mg/L"),
    ("STANDARD", "Fase livre", "Cobre Livre", "mg/L"),
    ("LARGE", "Solo", "Benzeno", "mg/kg"),
    ("LARGE", "Agua Subterranea", "Benzeno", "µg/L"),
    ("LARGE", "Fase livre", "Benzeno", "mg/L"),
    ("PROMO", "Solo", "Tolueno", "mg/kg"),
)
LOOKUP = (
    f"lookup AS (SELECT * FROM (VALUES {values(LOOKUP_ROWS)})"
    " AS t(parametro_de, matriz_de, parametro_para, unidade_para))"
)


def lookup_table(spark):
    columns = ("parametro_de", "matriz_de", "parametro_para", "unidade_para")
    return rule_table(spark, columns, LOOKUP_ROWS)


def standard_rows(spark, sf_dir, *columns):
    rows = lab(spark, sf_dir, "parameter", "matrix", *columns).withColumnsRenamed(
        {"parameter": "parametroOriginal", "matrix": "matriz"}
    )
    return map_parameters(rows, lookup_table(spark))


@query(
    "parameter_mapping",
    f"""
    WITH {LAB}, {LOOKUP}
    SELECT parameter AS "parametroOriginal", matrix AS matriz, parametro_para AS "parametroCorrigido", unidade_para,
           CASE WHEN coalesce(parametro_para, '') = '' THEN 'Parametro nao mapeado' END AS flag_padronizacao,
           count(*) AS n
    FROM lab LEFT JOIN lookup ON parameter = parametro_de AND matrix = matriz_de GROUP BY ALL
    """,
)
def parameter_mapping(spark, sf_dir):
    mapped, other = split_unmapped(standard_rows(spark, sf_dir))
    return (
        mapped.unionByName(other)
        .groupBy(
            "parametroOriginal", "matriz", "parametroCorrigido", "unidade_para", "flag_padronizacao"
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "unmapped_parameters",
    f"""
    WITH {LAB}, {LOOKUP}
    SELECT DISTINCT parameter AS "parametroCorrigido_original", matrix AS matriz
    FROM lab LEFT JOIN lookup ON parameter = parametro_de AND matrix = matriz_de
    WHERE coalesce(parametro_para, '') = ''
    """,
)
def unmapped_parameters(spark, sf_dir):
    return unmapped(
        standard_rows(spark, sf_dir), ["parametroCorrigido_original", "matriz"], "flag_padronizacao"
    )


FACTORS = f"factors AS (SELECT * FROM (VALUES {values(UNIT_FACTORS)}) AS t(unit_from, unit_to, factor))"
CONVERTED_SQL = """
    SELECT lab.*, factor,
           CASE WHEN lab.unit_from <> lab.unit_to THEN round(value * coalesce(factor, 1.0::double), 4) ELSE value END AS converted,
           CASE WHEN lab.unit_from <> lab.unit_to THEN round(quantification_limit * coalesce(factor, 1.0::double), 4)
                ELSE quantification_limit END AS limit_converted,
           CASE WHEN lab.unit_from <> lab.unit_to AND factor IS NOT NULL
                THEN 'Valor convertido de ' || lab.unit_from || ' para ' || lab.unit_to END AS flag_conversao,
           CASE WHEN lab.unit_from <> lab.unit_to AND factor IS NULL
                THEN 'Fator de conversao nao encontrado: ' || lab.unit_from || ' -> ' || lab.unit_to END AS flag_fator_nao_encontrado
    FROM lab LEFT JOIN factors f ON lab.unit_from = f.unit_from AND lab.unit_to = f.unit_to
"""


def converted_rows(spark, sf_dir, *columns):
    rows = lab(spark, sf_dir, *columns, "value", "quantification_limit", "unit_from", "unit_to")
    return convert_units(
        rows,
        unit_factors(spark),
        {"value": "converted", "quantification_limit": "limit_converted"},
        unit_from="unit_from",
        unit_to="unit_to",
    )


@query(
    "unit_conversion",
    f"""
    WITH {LAB}, {FACTORS}, c AS ({CONVERTED_SQL})
    SELECT sample_id, parameter, value, unit_from, unit_to, quantification_limit, converted, limit_converted,
           flag_conversao, flag_fator_nao_encontrado FROM c
    """,
)
def unit_conversion(spark, sf_dir):
    return converted_rows(spark, sf_dir, "sample_id", "parameter")


@query(
    "lab_overview",
    f"""
    WITH {LAB}, {FACTORS}, c AS ({CONVERTED_SQL})
    SELECT matrix, parameter, count(*) AS results, count(*) FILTER (result_text LIKE '<%') AS qualified,
           count(flag_conversao) AS converted, count(flag_fator_nao_encontrado) AS without_factor,
           max(converted) AS largest, count(*) FILTER (result_text = 'Ausente') AS text_results
    FROM c GROUP BY ALL
    """,
)
def lab_overview(spark, sf_dir):
    """Per matrix and parameter: results, qualified and text results, converted and unconvertible units."""
    from labtrail.functions import parse_result

    rows = converted_rows(spark, sf_dir, "matrix", "parameter", "result_text")
    parsed = rows.withColumn("r", parse_result(F.col("result_text")))
    return parsed.groupBy("matrix", "parameter").agg(
        F.count("*").alias("results"),
        F.count("r.qualifier").alias("qualified"),
        F.count("flag_conversao").alias("converted"),
        F.count("flag_fator_nao_encontrado").alias("without_factor"),
        F.max("converted").alias("largest"),
        F.count("r.text").alias("text_results"),
    )


@query(
    "flag_counts",
    f"""
    WITH {LAB}, {FACTORS}, c AS ({CONVERTED_SQL})
    SELECT 'flag_conversao' AS flag, count(flag_conversao) AS n FROM c
    UNION ALL SELECT 'flag_fator_nao_encontrado', count(flag_fator_nao_encontrado) FROM c
    UNION ALL SELECT 'flag_date_text', count(*) FILTER ({_PARSED} IS NULL) FROM c
    UNION ALL SELECT 'flag_vazio', 0 FROM c WHERE false
    UNION ALL SELECT 'flag_vazio', cast(0 AS bigint)
    """,
)
def flag_counts_query(spark, sf_dir):
    """Every flag counted in one pass; a blank flag does not count."""
    rows = parse_dates(converted_rows(spark, sf_dir, "date_text"), ["date_text"])
    return flag_counts(rows.withColumn("flag_vazio", F.lit(" ")))


@query(
    "flag_text",
    f"""
    WITH {LAB}, {FACTORS}, c AS ({CONVERTED_SQL})
    SELECT 'flag_conversao(' || cast(count(flag_conversao) AS varchar) || '); flag_fator_nao_encontrado('
           || cast(count(flag_fator_nao_encontrado) AS varchar) || ')' AS flags FROM c
    """,
)
def flag_text_query(spark, sf_dir):
    return flag_text(converted_rows(spark, sf_dir))


_CUSTOMER = {
    "c_custkey": "c_custkey",
    "c_name": "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END",
    "c_mktsegment": "CASE WHEN c_acctbal < 0 THEN '  ' ELSE c_mktsegment END",
}
_CUSTOMER_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _CUSTOMER.items()) + " FROM customer"


def _checked_customers(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(*[F.expr(e).alias(c) for c, e in _CUSTOMER.items()])
    return flag_missing(rows, ["c_name", "c_mktsegment", "absent"])


@query(
    "mandatory_fields",
    f"""
    WITH c AS ({_CUSTOMER_SQL})
    SELECT *, nullif(concat_ws(';', CASE WHEN c_name IS NULL THEN 'c_name' END,
                                    CASE WHEN trim(c_mktsegment) = '' THEN 'c_mktsegment' END), '')
              AS flag_missing_mandatory_field
    FROM c
    """,
)
def mandatory_fields(spark, sf_dir):
    return _checked_customers(spark, sf_dir)


@query(
    "fail_summary",
    f"""
    WITH c AS ({_CUSTOMER_SQL})
    SELECT '20260901_0700' AS execution, 'customer' AS "table", 'mandatory_col' AS flag,
           count(*) FILTER (c_name IS NOT NULL AND trim(c_mktsegment) <> '') AS valid_rows,
           count(*) FILTER (c_name IS NULL OR trim(c_mktsegment) = '') AS failed_rows
    FROM c
    """,
)
def fail_summary_query(spark, sf_dir):
    rows = _checked_customers(spark, sf_dir)
    failed = F.col("flag_missing_mandatory_field").isNotNull()
    return fail_summary(
        rows.where(~failed),
        rows.where(failed),
        "20260901_0700",
        "customer",
        {"flag_missing_mandatory_field": "mandatory_col"},
    )


