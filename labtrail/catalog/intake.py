"""Deliveries: nested documents, custody notes, sheets, filters, conflicts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from labtrail.catalog.lab import LAB, lab
from labtrail.catalog.registry import query, table
from labtrail.functions import (
    clean_sample_name,
    decimal_comma,
    depth_from_name,
    fold_value,
    map_codes,
    parse_result,
    quantification_limit,
    week_window,
)
from labtrail.operators.conflicts import conflict_report, exclude_conflicts
from labtrail.operators.flags import status_of
from labtrail.operators.outputs import union_sources
from labtrail.rules import GROUNDWATER, GROUNDWATER_ACCENTED, MATRIX_CODES
from labtrail.schemas import nested_schema
from labtrail.sources.nested import custody_labels, flatten_results
from labtrail.sources.sheets import (
    canonical_from_flat,
    canonical_from_pair,
    drop_pending,
    filter_campaign,
    join_pair,
    resolve_flat,
    resolve_pair,
    unmapped_codes,
)
from labtrail.sources.windows import block_coverage, extraction_status

START, END = date(1995, 1, 1), date(2001, 12, 31)


@query(
    "nested_results_flat",
    r"""
    SELECT cast(conv_id AS varchar) AS "idAmostra", role AS matriz, 'C-' || cast(turn AS varchar) AS campanha,
           'L' || cast(i AS varchar) AS "parametroOriginal", lines[i] AS "resultadoTexto",
           'conversas' AS "OrigemArquivo"
    FROM (SELECT conv_id, turn, role, lines, unnest(range(1, len(lines) + 1)) AS i
          FROM (SELECT *, string_split(text, chr(10)) AS lines FROM conversations))
    """,
)
def nested_results_flat(spark, sf_dir):
    """Each turn is a sample document whose parameters are the lines of its text."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.concat(F.lit("L"), i + 1).alias("parametroOriginal"), line.alias("resultadoTexto")
        ),
    )
    sample = F.struct(
        F.col("conv_id").alias("idAmostra"),
        F.col("role").alias("matriz"),
        F.concat(F.lit("C-"), "turn").alias("campanha"),
        lines.alias("parametros"),
    )
    landed = table(spark, sf_dir, "conversations").select(
        F.to_json(F.struct(F.array(sample).alias("amostras"))).alias("json")
    )
    documents = landed.select(F.from_json("json", nested_schema()).alias("d")).select("d.*")
    return flatten_results(documents, "conversas").select(
        "idAmostra", "matriz", "campanha", "parametroOriginal", "resultadoTexto", "OrigemArquivo"
    )


@query(
    "custody_labels",
    """
    WITH e AS (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_id, 'CC_Odor___cor' AS label,
           CASE WHEN event_id % 2 = 0 THEN cast(event_id % 7 AS varchar) ELSE event_type || ' | ' || k END AS value
    FROM e
    UNION ALL SELECT event_id, 'CC_' || event_type || '_nivel_1', k FROM e
    UNION ALL SELECT event_id, 'CC_Extra', cast(event_id % 7 AS varchar) FROM e WHERE event_id % 2 = 1
    """,
)
def custody_labels_query(spark, sf_dir):
    """Site notes with blanks, awkward labels and a label that repeats on every other event."""
    k = F.get_json_object("props", "$.k")
    last = F.when(F.col("event_id") % 2 == 0, F.lit("Odor / cor")).otherwise(F.lit("Extra"))
    notes = F.array(
        F.struct(
            F.lit("Odor / cor:").alias("label"),
            F.array(F.col("event_type"), F.lit(None).cast("string"), F.lit(" "), k).alias("value"),
        ),
        F.struct(
            F.concat(F.col("event_type"), F.lit(": nivel-1")).alias("label"), F.array(k).alias("value")
        ),
        F.struct(
            last.alias("label"), F.array((F.col("event_id") % 7).cast("string")).alias("value")
        ),
    )
    events = table(spark, sf_dir, "events")
    return events.select("event_id", F.explode(custody_labels(notes)).alias("label", "value"))


_BLOCKS = """
    b AS (SELECT cast(i AS bigint) AS block, cast(DATE '1995-01-01' + cast(i * 60 AS integer) AS date) AS block_start
          FROM (SELECT unnest(range(0, 43)) AS i)),
    c AS (SELECT block, block_start,
                 least(cast(block_start + 59 AS date), DATE '2001-12-31') AS block_end FROM b),
    blocks AS (
      SELECT block, block_start, block_end, count(o_orderkey) AS n_rows
      FROM c LEFT JOIN orders ON cast(o_orderdate AS date) BETWEEN block_start AND block_end
      GROUP BY ALL)
"""


@query(
    "extraction_blocks",
    f"""
    WITH {_BLOCKS}
    SELECT *, CASE WHEN block IN (3, 5) THEN 'Erro' WHEN n_rows = 0 THEN 'Sem amostras' ELSE 'Sucesso' END AS status
    FROM blocks
    """,
)
def extraction_blocks(spark, sf_dir):
    return block_coverage(
        table(spark, sf_dir, "orders"), "o_orderdate", START, END, failed=(3, 5)
    )


@query(
    "extraction_status",
    f"""
    WITH {_BLOCKS}
    SELECT count(*) AS blocks, cast(sum(n_rows) AS bigint) AS n_rows, cast(2 AS bigint) AS failed,
           count(*) FILTER (n_rows = 0 AND block NOT IN (3, 5)) AS empty, 'Aviso' AS status,
           'blocos_com_erro(2); blocos_sem_amostras(' ||
             cast(count(*) FILTER (n_rows = 0 AND block NOT IN (3, 5)) AS varchar) || ')' AS flags
    FROM blocks
    """,
)
def extraction_status_query(spark, sf_dir):
    return extraction_status(extraction_blocks(spark, sf_dir))


@query(
    "week_windows",
    """
    SELECT week_end - 7 AS week_start, week_end, count(*) AS n_orders FROM (
      SELECT cast(cast(o_orderdate AS date) - cast(dayofweek(o_orderdate) AS integer) AS date) AS week_end FROM orders)
    GROUP BY ALL
    """,
)
def week_windows(spark, sf_dir):
    """The weekly window each order date would extract, and how many orders ask for it."""
    start, end = week_window(F.col("o_orderdate"))
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(start.alias("week_start"), end.alias("week_end")).agg(
        F.count("*").alias("n_orders")
    )


_PARSED = r"""
    CASE WHEN result_text LIKE '< %' THEN '<' END AS qualifier,
    CASE WHEN result_text <> 'Ausente' THEN replace(result_text, '< ', '') END AS "resultadoNumerico",
    CASE WHEN result_text = 'Ausente' THEN result_text END AS "resultadoTexto"
"""


def flat_sheet(spark, sf_dir):
    """The results as a flat sheet."""
    return lab(
        spark,
        sf_dir,
        *("campaign", "sample_name", "matrix", "sample_id", "date_text", "situation"),
        *("parameter", "result_text", "unit_from"),
    ).select(
        F.col("campaign").alias("Proposta Comercial"),
        F.col("sample_name").alias("Identificação"),
        F.col("matrix").alias("Tipo de Amostra"),
        F.col("sample_id").cast("string").alias("Codigo da Amostra"),
        F.col("date_text").alias("Data de Coleta"),
        F.col("date_text").alias("Data de Recebimento"),
        F.col("situation").alias("Data de Publicação"),
        F.col("situation").alias("Situacao da Amostra"),
        F.col("parameter").alias("Identificação da Análise"),
        F.col("result_text").alias("Resultado da Análise"),
        F.col("unit_from").alias("Unidade de Medida da Análise"),
    )


def pair_sheets(spark, sf_dir, **written):
    """The results as a sample sheet and an analysis sheet.

    written: columns of the sample sheet that are written otherwise, from those of `orders`.
    """
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    # the matrix belongs to the result here, so a sample key is (order, matrix)
    code = F.col("matrix_code")
    analysis_sheet = lab(
        spark, sf_dir, *("sample_id", "matrix_code", "parameter", "result_text"),
        *("unit_from", "date_text", "method", "lq_text"),
    ).select(
        F.concat(F.col("sample_id").cast("string"), F.lit("/"), code).alias("Cod Amostra Lab"),
        F.col("parameter").alias("Cod Parametro"),
        F.col("result_text").alias("Resultado Original"),
        F.col("unit_from").alias("Unidade Original"),
        F.col("date_text").alias("Data e Hora Analise"),
        F.col("method").alias("Metodo Analise"),
        F.lit("Inicial").alias("Tipo Analise"),
        F.col("lq_text").alias("LQ"),
    )
    codes = F.explode(F.array(F.lit("SO"), F.lit("ASUB"), F.lit("LNAPL")))
    # an order's cells are worked out once and then repeated for each of its matrices
    cells = {
        "Codigo Ponto": F.concat(F.lit("P-"), F.col("o_custkey")),
        "Nome Amostra": F.concat(F.lit("S-"), F.col("o_orderkey")),
        "Data Coleta": day,
        "Data Recebimento Lab": day,
        "Proposta Comercial": F.col("o_orderpriority"),
    } | written
    sample_sheet = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", *[v.alias(c) for c, v in cells.items()])
        .withColumn("matrix_code", codes)
        .select(
            "Codigo Ponto",
            "Nome Amostra",
            F.concat(F.col("o_orderkey"), F.lit("/"), code).alias("Cod Amostra Lab"),
            "Data Coleta",
            code.alias("Matriz Monit"),
            "Data Recebimento Lab",
            "Proposta Comercial",
        )
    )
    return sample_sheet, analysis_sheet


@query(
    "layout_canonical",
    f"""
    WITH {LAB}, own AS (SELECT *, {_PARSED} FROM lab WHERE campaign LIKE '%HIGH%' OR campaign LIKE '%URGENT%')
    SELECT 'site' AS fonte_qaqc, campaign AS campanha, cast(sample_id AS varchar) AS "idAmostra",
           matrix AS matriz, parameter AS "parametroOriginal", qualifier, "resultadoNumerico", "resultadoTexto",
           date_text AS "dataRecebLab", cast(NULL AS varchar) AS "metodoAnalise",
           cast(NULL AS varchar) AS "limiteQuantificacao", situation AS "dataLiberacao",
           'LAB' AS laboratorio, 'LAB_SITE' AS "OrigemArquivo"
    FROM own
    UNION ALL
    SELECT 'mail', campaign, cast(sample_id AS varchar),
           CASE matrix_code WHEN 'SO' THEN 'Solo' WHEN 'ASUB' THEN 'Água Subterrânea' ELSE matrix_code END,
           parameter, qualifier, "resultadoNumerico", "resultadoTexto",
           strftime(sampled_at, '%d/%m/%Y'), method, lq_text, NULL, 'LAB', 'LAB_MAIL'
    FROM own
    """,
)
def layout_canonical(spark, sf_dir):
    """The same results delivered as a flat sheet and as a sample/analysis pair, both made canonical."""
    wanted = ("HIGH", "URGENT")
    flat = filter_campaign(resolve_flat(flat_sheet(spark, sf_dir)), "proposta", contains=wanted)

    samples, analyses = resolve_pair(*pair_sheets(spark, sf_dir))
    pair = join_pair(filter_campaign(samples, "proposta", contains=wanted), analyses)

    both = union_sources(
        {
            "site": canonical_from_flat(flat, "LAB", "LAB_SITE"),
            "mail": canonical_from_pair(pair, "LAB", "LAB_MAIL"),
        }
    )
    return both.select(
        "fonte_qaqc",
        "campanha",
        F.substring_index("idAmostra", "/", 1).alias("idAmostra"),
        *("matriz", "parametroOriginal", "qualifier", "resultadoNumerico", "resultadoTexto"),
        *("dataRecebLab", "metodoAnalise", "limiteQuantificacao", "dataLiberacao"),
        *("laboratorio", "OrigemArquivo"),
    )


@query(
    "campaign_filter",
    """
    SELECT o_orderpriority AS campanha, o_orderstatus AS situacao, count(*) AS n
    FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderpriority LIKE '%SPEC%' GROUP BY ALL
    """,
)
def campaign_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    own = filter_campaign(orders, "o_orderpriority", names=["1-URGENT"], contains=["SPEC"])
    return own.groupBy(
        F.col("o_orderpriority").alias("campanha"), F.col("o_orderstatus").alias("situacao")
    ).agg(F.count("*").alias("n"))


@query(
    "campaign_counts",
    """
    SELECT count(*) AS registros_lidos, count(*) FILTER (o_orderpriority = '1-URGENT') AS registros_escritos,
           count(*) FILTER (o_orderpriority <> '1-URGENT') AS descartados, 'Aviso' AS status
    FROM orders
    """,
)
def campaign_counts(spark, sf_dir):
    """Rows before and after a filter in one pass, with the rows it drops."""
    kept = F.col("o_orderpriority").isin("1-URGENT")
    return (
        table(spark, sf_dir, "orders")
        .agg(
            F.count("*").alias("registros_lidos"),
            F.count_if(F.coalesce(kept, F.lit(False))).alias("registros_escritos"),
        )
        .withColumn("descartados", F.col("registros_lidos") - F.col("registros_escritos"))
        .withColumn("status", status_of(F.col("descartados")))
    )


@query(
    "pending_filter",
    """
    SELECT nullif(o_orderstatus, 'P') AS situacao, o_orderpriority AS campanha, count(*) AS n
    FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F' GROUP BY ALL
    """,
)
def pending_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("situacao"),
        F.col("o_orderpriority").alias("campanha"),
    )
    return drop_pending(orders, "situacao", "F").groupBy("situacao", "campanha").agg(
        F.count("*").alias("n")
    )


_KEYS = ("sample_name", "parameter", "matrix")


@query(
    "conflict_exclusion",
    f"""
    WITH {LAB}, k AS (SELECT sample_name, parameter, matrix FROM lab GROUP BY ALL
                      HAVING count(DISTINCT result_text) > 1)
    SELECT sample_name, parameter, matrix, result_text, method FROM lab ANTI JOIN k USING (sample_name, parameter, matrix)
    """,
)
def conflict_exclusion(spark, sf_dir):
    rows = lab(spark, sf_dir, *_KEYS, "result_text", "method")
    return exclude_conflicts(rows, _KEYS, "result_text")


@query(
    "conflict_report",
    f"""
    WITH {LAB}
    SELECT sample_name, parameter, matrix, count(DISTINCT result_text) AS distinct_results, count(*) AS "rows"
    FROM lab GROUP BY ALL HAVING count(DISTINCT result_text) > 1
    """,
)
def conflict_report_query(spark, sf_dir):
    return conflict_report(lab(spark, sf_dir, *_KEYS, "result_text"), _KEYS, "result_text")


@query(
    "result_parse",
    rf"""
    WITH {LAB}, t AS (
      SELECT sample_id, parameter, result_text, nullif(regexp_extract(result_text, '^([<>])\s*(.+)$', 1), '') AS q,
             CASE WHEN regexp_matches(result_text, '^[<>]\s*.+$')
                  THEN trim(regexp_extract(result_text, '^([<>])\s*(.+)$', 2)) ELSE result_text END AS v
      FROM lab)
    SELECT sample_id, parameter, result_text, q AS qualifier,
           CASE WHEN regexp_matches(v, '^-?\d+([.,]\d+)?$') THEN v END AS "numeric",
           CASE WHEN NOT regexp_matches(v, '^-?\d+([.,]\d+)?$') THEN result_text END AS "text",
           CASE WHEN regexp_matches(v, '^-?\d+([.,]\d+)?$') THEN cast(replace(v, ',', '.') AS double) END AS value
    FROM t
    """,
)
def result_parse(spark, sf_dir):
    rows = lab(spark, sf_dir, "sample_id", "parameter", "result_text")
    parsed = rows.withColumn("r", parse_result(F.col("result_text")))
    return parsed.select(*rows.columns, "r.*", decimal_comma(F.col("r.numeric")).alias("value"))


@query(
    "quantification_limit",
    f"""
    WITH {LAB}
    SELECT sample_id, lq_text, try_cast(replace(lq_text, ',', '.') AS double) AS quantification_limit FROM lab
    """,
)
def quantification_limit_query(spark, sf_dir):
    return lab(spark, sf_dir, "sample_id", "lq_text").withColumn(
        "quantification_limit", quantification_limit(F.col("lq_text"))
    )


@query(
    "sample_name_clean",
    rf"""
    WITH {LAB}, n AS (SELECT DISTINCT sample_raw || '-Terc' AS sample_raw FROM lab), c AS (
      SELECT sample_raw,
             replace(replace(regexp_replace(replace(sample_raw, '_', '-'), '\s+', '', 'g'), '.', ','), '-Terc', '') AS name
      FROM n)
    SELECT sample_raw, name, try_cast(replace(regexp_extract(name, '([\d,]+)$', 1), ',', '.') AS double) AS depth FROM c
    """,
)
def sample_name_clean(spark, sf_dir):
    raw = lab(spark, sf_dir, "sample_raw").select(
        F.concat("sample_raw", F.lit("-Terc")).alias("sample_raw")
    )
    named = raw.distinct().withColumn("name", clean_sample_name(F.col("sample_raw")))
    return named.withColumn("depth", depth_from_name(F.col("name")))


@query(
    "matrix_normalise",
    f"""
    WITH {LAB}
    SELECT matrix_code AS code,
           CASE matrix_code WHEN 'SO' THEN 'Solo' WHEN 'ASUB' THEN 'Agua Subterranea' ELSE matrix_code END AS matriz,
           count(*) AS n FROM lab GROUP BY ALL
    """,
)
def matrix_normalise(spark, sf_dir):
    named = map_codes(F.col("matrix_code"), MATRIX_CODES)
    plain = fold_value(named, GROUNDWATER_ACCENTED, GROUNDWATER)
    return (
        lab(spark, sf_dir, "matrix_code")
        .groupBy(F.col("matrix_code").alias("code"), plain.alias("matriz"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "matrix_codes_unknown",
    f"WITH {LAB} SELECT DISTINCT matrix_code FROM lab WHERE matrix_code NOT IN ('SO', 'ASUB')",
)
def matrix_codes_unknown(spark, sf_dir):
    return unmapped_codes(lab(spark, sf_dir, "matrix_code"), "matrix_code")
