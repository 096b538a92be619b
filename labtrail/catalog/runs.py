"""Whole runs over landed tables: cleaning, the run ledger, correction feedback, rule files, quarantine, chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.checks import EXCLUDED
from labtrail.catalog.intake import pair_sheets
from labtrail.catalog.lab import LAB, lab, values
from labtrail.catalog.mapping import _DIMENSIONS, _PARSED, FACTORS, LOOKUP, corrections, lookup_table, stations
from labtrail.catalog.registry import query, table
from labtrail.operators.flags import parse_dates_in_place
from labtrail.operators.ledger import Ledger
from labtrail.operators.outputs import write_counted
from labtrail.operators.quality import replica_differences
from labtrail.operators.runlog import COUNT_STEPS, MAPPING_STEP, delivery_summary, read_log
from labtrail.operators.samples import append_unmapped, first_samples
from labtrail.plans.checks import newest_quality_checks, quality_summary
from labtrail.plans.clean import clean
from labtrail.plans.intake import canonical_pair, intake_pair
from labtrail.plans.run import Tables, run_delivery
from labtrail.plans.validate import Scope
from labtrail.rules import CHROMIUM, ProjectRules, rule_table, unit_factors
from labtrail.schemas import CORRECTIONS, PARAMETER_LOOKUP, STATION
from labtrail.sources import quarantine
from labtrail.sources.batches import batch_names, read_batches, read_latest, source_prefix
from labtrail.sources.lookups import read_rules
from labtrail.sources.nested import flatten_results
from labtrail.sources.paths import scratch_folder

RULES = ProjectRules(campaigns=("HIGH", "LOW"))
RUN_SCOPE = (
    ("Ferro", "Solo", "G1", "M-0", "7 dias"),
    ("Ferro Total", "Agua Subterranea", "G1", "M-1", "30 dias"),
    ("Chumbo", "Solo", "G1", "M-1", "14 dias"),
    ("Zinco", "Solo", "G2", "M-2", "20 dias"),
    ("Benzeno", "Agua Subterranea", "G2", None, "10 dias"),
    ("Benzeno", "Solo", "G2", "M-0", "-"),
)
# Sampling times are written in one of five formats, by the number of the sample.
_SAMPLED = ("dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss", "dd-MM-yy HH:mm", "MM-dd-yy HH:mm", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def delivery(spark, sf_dir):
    """The two sheets of a delivery: names to clean, sampling times in all formats, some days until reception."""
    key = F.col("o_orderkey").cast("long")
    day = F.date_trunc("day", "o_orderdate")
    at = day + F.expr("INTERVAL '10:30' HOUR TO MINUTE")
    written = F.lit(None).cast("string")
    for i, fmt in enumerate(_SAMPLED):
        written = F.when(key % 5 == i, F.date_format(at, fmt)).otherwise(written)
    received = F.date_format(F.date_add(day, (key % 40).cast("int")), "dd/MM/yyyy 08:15")
    return pair_sheets(spark, sf_dir, **{
        "Nome Amostra": F.concat(F.lit("S_"), key, F.lit(" -Terc")),
        "Data Coleta": written,
        "Data Recebimento Lab": received,
    })


def canonical(spark, sf_dir):
    return intake_pair(*delivery(spark, sf_dir), RULES, "LAB", "LAB_MAIL")


# The first format that reads a text wins, so months that could be days are read as days where years are short.
_CLEAN = f"""
    WITH {LAB}, {_DIMENSIONS}, {LOOKUP}, {FACTORS},
    own AS (
      SELECT *, sample_id || '/' || matrix_code AS id,
             CASE matrix_code WHEN 'SO' THEN 'Solo' WHEN 'ASUB' THEN 'Agua Subterranea' ELSE matrix_code END AS matriz,
             CASE WHEN result_text <> 'Ausente' THEN cast(replace(replace(result_text, '< ', ''), ',', '.') AS double) END AS num,
             try_cast(replace(lq_text, ',', '.') AS double) AS lim,
             CASE WHEN sample_id % 5 IN (0, 1, 4)
                    THEN make_timestamp(year(sampled_at), month(sampled_at), day(sampled_at), 10, 30, 0)
                  WHEN sample_id % 5 = 3 AND day(sampled_at) <= 12
                    THEN make_timestamp(2000 + year(sampled_at) % 100, day(sampled_at), month(sampled_at), 10, 30, 0)
                  ELSE make_timestamp(2000 + year(sampled_at) % 100, month(sampled_at), day(sampled_at), 10, 30, 0) END AS coleta,
             cast(cast(sampled_at AS date) + cast(sample_id % 40 AS integer) AS timestamp) + INTERVAL '8 hours 15 minutes' AS receb,
             {_PARSED} AS analise
      FROM lab WHERE campaign LIKE '%HIGH%' OR campaign LIKE '%LOW%'),
    k AS (SELECT sample_name, parameter FROM own GROUP BY ALL HAVING count(DISTINCT result_text) > 1),
    kept AS (SELECT * FROM own ANTI JOIN k USING (sample_name, parameter)),
    placed AS (
      SELECT l.*, coalesce(c.para, l.sample_name) AS final, coalesce(s.code, t.code, c.code) AS code,
             coalesce(s.alt, t.alt, c.alt) AS alt, coalesce(s.quality, t.quality) AS quality
      FROM kept l LEFT JOIN station s ON l.sample_name = s.name LEFT JOIN corrections c ON l.sample_name = c.de
      LEFT JOIN station t ON t.name = coalesce(c.para, l.sample_name)),
    cleaned AS (
      SELECT p.*, parametro_para, unidade_para, coalesce(parametro_para, '') = '' AS sem, p.unit_from <> unidade_para AS other,
             factor, try_cast(replace(regexp_extract(final, '([\\d,]+)$', 1), ',', '.') AS double) AS depth
      FROM placed p LEFT JOIN lookup ON parameter = parametro_de AND matriz = matriz_de
      LEFT JOIN factors f ON p.unit_from = f.unit_from AND unidade_para = f.unit_to)
"""
_CLEAN_COLUMNS = """
    SELECT id AS "idAmostra", sample_name AS "descricaoAmostra", final AS "descricaoAmostra_final", matriz,
           coleta AS "dataHoraAmostragem_valida", receb AS "dataRecebLab_valida", analise AS "dataHoraAnalise_valida",
           CASE WHEN analise IS NULL THEN 'falha na conversao de dataHoraAnalise' END AS "flag_dataHoraAnalise",
           code AS "codigoEstacao", alt AS alternate_name, quality AS "codigoQualidade",
           CASE WHEN alt IS NULL THEN 'Amostra sem correspondencia em df_station' END AS flag_station_sem_mapeamento,
           depth AS "profInicial", num AS "resultadoNumerico", lim AS "limiteQuantificacao", parameter AS "parametroOriginal",
           parametro_para AS "parametroCorrigido", unidade_para,
           CASE WHEN sem THEN 'Parametro nao mapeado' END AS flag_padronizacao,
           CASE WHEN other THEN round(num * coalesce(factor, 1.0::double), 4) ELSE num END AS "resultadoCorrigido",
           CASE WHEN other THEN round(lim * coalesce(factor, 1.0::double), 4) ELSE lim END AS "limiteQuantificacaoCorrigido",
           CASE WHEN other AND factor IS NOT NULL
                THEN 'Valor convertido de ' || unit_from || ' para ' || unidade_para END AS flag_conversao,
           CASE WHEN other AND factor IS NULL
                THEN 'Fator de conversao nao encontrado: ' || unit_from || ' -> ' || unidade_para END AS flag_fator_nao_encontrado
    FROM cleaned
"""
_CLEANED = (
    "idAmostra", "descricaoAmostra", "descricaoAmostra_final", "matriz", "dataHoraAmostragem_valida", "dataRecebLab_valida",
    "dataHoraAnalise_valida", "flag_dataHoraAnalise", "codigoEstacao", "alternate_name", "codigoQualidade",
    "flag_station_sem_mapeamento", "profInicial", "resultadoNumerico", "limiteQuantificacao", "parametroOriginal",
    "parametroCorrigido", "unidade_para", "flag_padronizacao", "resultadoCorrigido", "limiteQuantificacaoCorrigido",
    "flag_conversao", "flag_fator_nao_encontrado",
)


def _cleaned(df):
    plain = {c: F.col(c).cast("timestamp_ntz") for c in _CLEANED if c.endswith("_valida")}
    return df.select(*_CLEANED).withColumns(plain)


@query("plan_clean", _CLEAN + _CLEAN_COLUMNS)
def plan_clean(spark, sf_dir):
    """Dates, stations, numbers, parameters and units of a whole delivery."""
    rows = canonical(spark, sf_dir)
    tables = stations(spark, sf_dir), corrections(spark, sf_dir), lookup_table(spark), unit_factors(spark)
    return _cleaned(clean(rows, *tables))


# ---------------------------------------------------------------- rule tables from files


@query(
    "landed_rules_clean",
    _CLEAN.replace("LEFT JOIN corrections c ON", "LEFT JOIN (SELECT * FROM corrections WHERE false) c ON") + _CLEAN_COLUMNS,
)
def landed_rules_clean(spark, sf_dir):
    """The same with rule tables read from files: one of headers and rows, one without a row, one that is not there."""
    folder = scratch_folder(spark, "rules")
    sheets = {
        "stations": stations(spark, sf_dir).withColumnRenamed("SampleName", "Nome da Amostra"),
        "parameters": lookup_table(spark),
        "factors": unit_factors(spark),
    }
    for name, df in sheets.items():
        df.write.option("header", True).csv(f"{folder}/{name}")
    own = lambda schema: {f.name: [f.name] for f in schema}
    station = read_rules(spark, f"{folder}/stations", own(STATION) | {"SampleName": ["Sample", "Nome da Amostra"]})
    parameters = read_rules(spark, f"{folder}/parameters", own(PARAMETER_LOOKUP))
    units = {c: [c] for c in ("unit_from", "unit_to", "factor")}
    factors = read_rules(spark, f"{folder}/factors", units, types={"factor": "double"})
    absent = read_rules(spark, f"{folder}/corrections", own(CORRECTIONS), target="descricaoAmostra_para", project="P")
    return _cleaned(clean(canonical(spark, sf_dir), station, absent, parameters, factors))


# ---------------------------------------------------------------- run and ledger

BATCH_ID = "site_20260823_20260830_20260831_0700"
_RUN = (
    _CLEAN
    + f""",
    scope AS (SELECT * FROM (VALUES {values(RUN_SCOPE)}) AS t(parametro, matriz, planejamento, metodo, prazo)),
    judged AS (
      SELECT c.*, alt IS NOT NULL AND NOT sem AS ok,
             alt IS NOT NULL AND NOT sem AND parametro_para NOT IN (SELECT parametro FROM scope) AS fora,
             method <> s.metodo AS other_method,
             date_diff('day', cast(coleta AS date), cast(receb AS date))
               > try_cast(nullif(regexp_extract(s.prazo, '(\\d+)', 1), '') AS integer) AS late
      FROM cleaned c LEFT JOIN scope s ON parametro_para = s.parametro AND c.matriz = s.matriz),
    f AS (SELECT *, coalesce(ok AND NOT fora AND other_method, false) AS fm, coalesce(ok AND NOT fora AND late, false) AS fh FROM judged)
"""
)


def _ran(spark, sf_dir):
    """A run from the landed sheets to the outputs; the path of its log."""
    folder = scratch_folder(spark, "run")

    def landed(name, df):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    contract = rule_table(spark, ("parametro", "matriz", "planejamento", "metodo", "prazo"), RUN_SCOPE)
    tables = Tables(
        landed("station", stations(spark, sf_dir)), landed("corrections", corrections(spark, sf_dir)), lookup_table(spark),
        unit_factors(spark), Scope(contract, spark.createDataFrame([], "Station string")),
    )
    samples, analyses = delivery(spark, sf_dir)
    rows = canonical_pair(landed("samples", samples), landed("analyses", analyses), "LAB", "LAB_MAIL")
    run_delivery(rows, RULES, tables, f"{folder}/silver", BATCH_ID, Ledger("P", "run"), f"{folder}/log")
    return f"{folder}/log"


@query(
    "run_delivery_summary",
    _RUN
    + f"""
    SELECT 'P' AS projeto, CASE WHEN count(*) FILTER (sem) > 0 THEN 'Aviso' ELSE 'Sucesso' END AS mapeamento_status,
           CASE WHEN count(*) FILTER (sem) = 0 THEN 'Todos os parametros mapeados com sucesso'
                ELSE 'Parametros nao mapeados (' || count(*) FILTER (sem) || ' registros): '
                     || array_to_string(list_sort(list(DISTINCT parameter) FILTER (sem)), ', ') END AS mapeamento_detalhe,
           count(DISTINCT final) AS qtd_amostras, count(*) FILTER (ok) AS qtd_resultados, count(DISTINCT alt) AS qtd_stations,
           count(*) FILTER (fh) AS qtd_holding_fora_prazo, count(*) FILTER (fora) AS qtd_parametro_extra,
           count(*) FILTER (fm) AS qtd_metodo_divergente, '23/08/2026 a 30/08/2026' AS periodo_execucao
    FROM f
    """,
)
def run_delivery_summary(spark, sf_dir):
    """The figures of the notification, from the log that the run itself has written."""
    return delivery_summary(read_log(spark, _ran(spark, sf_dir), "P"), BATCH_ID)


def _flags(*flags: str) -> str:
    said = ", ".join(f"CASE WHEN count(*) FILTER ({rule}) > 0 THEN '{f}(' || count(*) FILTER ({rule}) || ')' END" for f, rule in (x.split("|") for x in flags))
    return f"coalesce(nullif(concat_ws('; ', {said}), ''), '—')"


def _step(number: int, name: str, read: str, written: str, flags: str = "'—'", frm: str = "f") -> str:
    status = f"CASE WHEN {flags} = '—' THEN 'Sucesso' ELSE 'Aviso' END"
    return (
        f"SELECT {number} AS ordem, '{name}' AS etapa, {status} AS status, {read} AS registros_lidos,"
        f" {written} AS registros_escritos, {flags} AS flags FROM {frm}"
    )


_ALL, _OWN, _N = "(SELECT count(*) FROM lab)", "(SELECT count(*) FROM own)", "count(*)"
_OUT = "count(*) FILTER (ok) + count(*) FILTER (fora) + count(*) FILTER (fm) + count(*) FILTER (fh) + count(*) FILTER (NOT ok)"


@query(
    "run_ledger",
    _RUN
    + " UNION ALL ".join((
        _step(0, "Leitura da entrega", _ALL, _ALL, frm="(SELECT 1)"),
        _step(1, "Filtro de campanha", _ALL, _OWN, frm="(SELECT 1)"),
        _step(2, "Resultados conflitantes", _OWN, _N),
        _step(3, "Conversao de datas", _N, _N, _flags(
            "flag_dataEnvioLab|true", "flag_dataHoraAnalise|analise IS NULL", "flag_dataLiberacao|true")),
        _step(4, "Mapeamento de amostras", _N, _N, _flags("flag_station_sem_mapeamento|alt IS NULL")),
        _step(5, "Conversao de unidades", _N, _N, _flags(
            "flag_conversao|other AND factor IS NOT NULL", "flag_fator_nao_encontrado|other AND factor IS NULL")),
        _step(6, "Validacao de escopo", _N, _N, _flags(
            "flag_parametro_fora_escopo|fora", "flag_metodo|fm", "flag_holding_time|fh", "flag_padronizacao|sem")),
        _step(7, "Saidas", _OUT, _OUT),
        _step(8, MAPPING_STEP, _N, _N, _flags("flag_padronizacao|sem")),
        _step(9, COUNT_STEPS["qtd_amostras"], "count(*) FILTER (ok)", "count(DISTINCT final)"),
        _step(10, COUNT_STEPS["qtd_resultados"], "count(*) FILTER (ok)", "count(*) FILTER (ok)"),
        _step(11, COUNT_STEPS["qtd_stations"], "count(*) FILTER (ok)", "count(DISTINCT alt)"),
        _step(12, COUNT_STEPS["qtd_holding_fora_prazo"], "count(*) FILTER (ok)", "count(*) FILTER (fh)"),
        _step(13, COUNT_STEPS["qtd_parametro_extra"], "count(*) FILTER (ok)", "count(*) FILTER (fora)"),
        _step(14, COUNT_STEPS["qtd_metodo_divergente"], "count(*) FILTER (ok)", "count(*) FILTER (fm)"),
        _step(15, "Gravacao - parametro_extra", _OUT, "count(*) FILTER (fora)"),
        _step(16, "Gravacao - metodo", _OUT, "count(*) FILTER (fm)"),
        _step(17, "Gravacao - holding", _OUT, "count(*) FILTER (fh)"),
        _step(18, "Gravacao - erro_mapeamento", _OUT, "count(*) FILTER (sem)"),
        _step(19, "Gravacao - erro_sampleName", _OUT, "count(*) FILTER (NOT sem AND alt IS NULL)"),
    )),
)
def run_ledger(spark, sf_dir):
    """Rows and flags of every step of the run, as counted during its write."""
    steps = read_log(spark, _ran(spark, sf_dir), "P")
    return steps.select("ordem", "etapa", "status", "registros_lidos", "registros_escritos", "flags")


# ---------------------------------------------------------------- correction feedback


@query(
    "unmapped_appended",
    f"""
    WITH {LAB}, u AS (SELECT DISTINCT sample_name, matrix, sample_id FROM lab WHERE campaign = '5-LOW'),
    names AS (SELECT DISTINCT sample_name, matrix, sample_id % 3 <> 0 AS p FROM u)
    SELECT sample_name AS "descricaoAmostra_de", matrix AS matriz, CASE WHEN p THEN 'P' ELSE 'Q' END AS source_project
    FROM names
    """,
)
def unmapped_appended(spark, sf_dir):
    """Two projects append their samples without a station, one of them twice; Q also meets the names of P."""
    rows = lab(spark, sf_dir, "sample_id", "sample_name", "matrix", "no_station").where("no_station IS NOT NULL")
    names = rows.select(F.col("sample_name").alias("descricaoAmostra"), F.col("matrix").alias("matriz"), "sample_id")
    path = scratch_folder(spark, "corrections")
    first = names.where("sample_id % 3 <> 0")
    for unmapped, project, batch in ((first, "P", "p1"), (first, "P", "p1"), (first, "P", "p2"), (names, "Q", "q1")):
        append_unmapped(unmapped, path, project, batch)
    listed = read_batches(spark, path)
    return listed.select("descricaoAmostra_de", "matriz", "source_project")


@query(
    "written_unless_empty",
    """
    SELECT 'newest' AS member, count(*) AS counted, count(*) AS "rows" FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'kept', 0, count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'absent', 0, NULL
    """,
)
def written_unless_empty(spark, sf_dir):
    """What is written over, what an empty result leaves as it was, and what an empty result does not make."""
    orders, folder = table(spark, sf_dir, "orders"), scratch_folder(spark, "members")
    nothing = orders.where("o_orderkey < 0")
    for name in ("newest", "kept"):
        write_counted(orders.where("o_orderstatus = 'O'"), f"{folder}/{name}")
    counted = {"newest": write_counted(orders.where("o_orderstatus = 'F'"), f"{folder}/newest")}
    counted |= {name: write_counted(nothing, f"{folder}/{name}") for name in ("kept", "absent")}
    members = rule_table(spark, ("member", "counted"), [(n, c["rows"]) for n, c in counted.items()])
    written = spark.read.schema(orders.schema).parquet(folder + "/*").select(
        F.regexp_extract("_metadata.file_path", r"/([a-z]+)/[^/]+$", 1).alias("member")
    )
    return members.join(written.groupBy("member").agg(F.count("*").alias("rows")), "member", "left")


# ---------------------------------------------------------------- newest batches

_SOURCE = "CASE WHEN l_suppkey % 2 = 0 THEN 'site' ELSE 'mail' END"
_NAMES = {
    ("ECONOMY", "F"): "DBO (mg/L)",
    ("ECONOMY", "O"): "DQO (mg/L)",
    ("SMALL", "F"): CHROMIUM["total"],
    ("SMALL", "O"): CHROMIUM["dissolved"],
    ("LARGE", "F"): CHROMIUM["hexavalent"],
    ("LARGE", "O"): CHROMIUM["hexavalent_dissolved"],
    ("MEDIUM", "F"): "Teor de Tolueno-d8 (%)",
}
_CHEMICAL = (
    "CASE "
    + " ".join(f"WHEN p_type = '{t}' AND l_linestatus = '{s}' THEN '{n}'" for (t, s), n in _NAMES.items())
    + " ELSE concat(p_type, CASE l_linestatus WHEN 'F' THEN ' Total' ELSE ' Dissolvido' END, ' (mg/L)') END"
)
# Samples of ten orders, so that fractions and species of one sample meet.
_LANDED = {
    "sample_name": "concat('S-', cast(l_orderkey - l_orderkey % 10 AS string))",
    "chemical_name": _CHEMICAL,
    "samp_matrix": "CASE l_returnflag WHEN 'A' THEN 'Agua Subterranea' WHEN 'N' THEN 'Fase livre' ELSE 'Solo' END",
    "value": "l_quantity",
    "quality_code": "CASE l_linenumber WHEN 1 THEN 'BC' WHEN 2 THEN 'BV' WHEN 3 THEN 'BE' END",
    "quantification_limit": "cast(p_size AS double)",
    "batch_id": f"concat({_SOURCE}, '_', cast(year(l_shipdate) AS string), '0101_0700')",
}
_LANDED_SQL = (
    "landed AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _LANDED.items())
    + " FROM lineitem JOIN part ON l_partkey = p_partkey),"
    " newest AS (SELECT regexp_extract(batch_id, '^[A-Za-z]+') AS s, max(batch_id) AS batch_id FROM landed GROUP BY 1)"
)


def landed(spark, sf_dir):
    """Results landed in a folder for each batch: a source and a year."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    rows = rows.select(*[F.expr(e).alias(c) for c, e in _LANDED.items()])
    path = scratch_folder(spark, "landed")
    rows.hint("rebalance", F.col("batch_id")).write.partitionBy("batch_id").parquet(path)
    return path, rows.schema


@query("landed_newest_batch", f"WITH {_LANDED_SQL} SELECT landed.* FROM landed SEMI JOIN newest USING (batch_id)")
def landed_newest_batch(spark, sf_dir):
    """All rows of the newest batch of each source; the folders of the others are not read."""
    path, schema = landed(spark, sf_dir)
    return read_latest(spark, path, by=[source_prefix(F.col("batch_id"))], schema=schema)


_WET = "samp_matrix IN ('Agua Subterranea', 'Fase livre')"
_KEPT = f"{_WET} AND sample_name NOT IN ({', '.join(repr(n) for n in EXCLUDED)})"
_FRACTION = f"{_KEPT} AND chemical_name NOT LIKE 'Cromo%' AND (lower(chemical_name) LIKE '%total%' OR lower(chemical_name) LIKE '%dissolvido%')"
_CR = ", ".join(f"'{n}'" for n in CHROMIUM.values())


@query(
    "newest_quality_checks",
    f"""
    WITH {_LANDED_SQL},
    q AS (SELECT landed.*, trim(regexp_replace(chemical_name, '(?i)(total|dissolvido)', '', 'g')) AS base
          FROM landed SEMI JOIN newest USING (batch_id)),
    td AS (SELECT sample_name, base FROM q WHERE {_FRACTION} GROUP BY ALL
           HAVING max(value) FILTER (chemical_name LIKE '%Dissolvido%') > min(value) FILTER (chemical_name LIKE '%Total%')),
    od AS (SELECT sample_name FROM q WHERE {_WET} GROUP BY ALL
           HAVING max(value) FILTER (chemical_name LIKE 'DBO%') > min(value) FILTER (chemical_name LIKE 'DQO%')),
    sp AS (SELECT sample_name, {", ".join(f"min(value) FILTER (chemical_name = '{n}') AS {s}" for s, n in CHROMIUM.items())}
           FROM q WHERE {_KEPT} GROUP BY ALL),
    cr AS (SELECT sample_name FROM sp WHERE hexavalent_dissolved > hexavalent OR dissolved > total
           OR hexavalent_dissolved > dissolved OR hexavalent > total),
    v AS (SELECT sample_name, chemical_name, min(value) AS value FROM q GROUP BY ALL),
    pairs AS (SELECT DISTINCT 'S-' || (o_orderkey - o_orderkey % 20) AS a, 'S-' || (o_orderkey - o_orderkey % 20 + 10) AS b FROM orders),
    rd AS (SELECT DISTINCT unnest([a, b]) AS sample_name, x.chemical_name FROM pairs
           JOIN v x ON x.sample_name = a JOIN v y ON y.sample_name = b AND x.chemical_name = y.chemical_name
           WHERE round(abs(x.value - y.value) / ((x.value + y.value) / 2) * 100, 2) > 20),
    t AS (
      SELECT 'Surrogate' AS "check", count(*) FILTER (chemical_name = 'Teor de Tolueno-d8 (%)') AS examined,
             count(*) FILTER (chemical_name = 'Teor de Tolueno-d8 (%)' AND value NOT BETWEEN 80 AND 120) AS flagged FROM q
      UNION ALL SELECT 'Totais_Dissolvidos', count(*) FILTER ({_FRACTION}),
             (SELECT count(*) FROM q JOIN td USING (sample_name, base) WHERE {_FRACTION}) FROM q
      UNION ALL SELECT 'DBO_DQO', count(*) FILTER ({_WET} AND (chemical_name LIKE 'DBO%' OR chemical_name LIKE 'DQO%')),
             (SELECT count(*) FROM q JOIN od USING (sample_name)
              WHERE {_WET} AND (chemical_name LIKE 'DBO%' OR chemical_name LIKE 'DQO%')) FROM q
      UNION ALL SELECT 'Cromo', count(*) FILTER ({_KEPT} AND chemical_name IN ({_CR})),
             (SELECT count(*) FROM q JOIN cr USING (sample_name) WHERE chemical_name IN ({_CR})) FROM q
      UNION ALL SELECT 'Branco', count(quality_code),
             count(*) FILTER (quality_code IS NOT NULL AND value > quantification_limit) FROM q
      UNION ALL SELECT 'RPD_Replica', count(*) FILTER (sample_name IN (SELECT unnest([a, b]) FROM pairs)),
             (SELECT count(*) FROM q JOIN rd USING (sample_name, chemical_name)) FROM q)
    SELECT "check", examined, flagged, CASE WHEN flagged = 0 THEN 'Sucesso' ELSE 'Aviso' END AS status FROM t
    """,
)
def newest_quality(spark, sf_dir):
    """All six checks over the newest batch of each source: oxygen demand, chromium species and replicas included."""
    path, schema = landed(spark, sf_dir)
    rules = ProjectRules(campaigns=(), excluded_samples=EXCLUDED)
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") - F.col("o_orderkey") % 20).alias("k")).distinct()
    pairs = orders.select(F.expr("concat('S-', k)").alias("original"), F.expr("concat('S-', k + 10)").alias("replica"))
    rows = read_batches(spark, path, schema=schema)
    checked = newest_quality_checks({"landed": rows}, rules, pairs, names={"landed": batch_names(spark, path)})
    return quality_summary(checked, rules)


# ---------------------------------------------------------------- quarantine


@query(
    "quarantined_documents",
    """
    WITH t AS (SELECT conv_id, turn, string_split(text, chr(10)) AS lines,
                      CASE WHEN conv_id % 7 = 3 THEN 'documento ilegivel' WHEN conv_id % 7 = 5 THEN 'documento sem amostras' END AS why
               FROM conversations)
    SELECT coalesce(why, 'lido') AS reason, cast(sum(CASE WHEN why IS NULL THEN len(lines) ELSE 1 END) AS bigint) AS n_rows
    FROM t GROUP BY ALL
    """,
)
def quarantined_documents(spark, sf_dir):
    """Documents landed as lines of JSON, some cut short, some without samples; results of the others."""
    lines = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(F.concat(F.lit("L"), i + 1).alias("parametroOriginal"), line.alias("resultadoTexto"))
    )
    sample = F.struct(F.col("conv_id").alias("idAmostra"), lines.alias("parametros"))
    whole = F.to_json(F.struct(F.array(sample).alias("amostras")))
    kind = F.col("conv_id") % 7
    text = F.when(kind == 3, F.substring(whole, 1, 20)).when(kind == 5, F.lit('{"lotes":[]}')).otherwise(whole)
    path = scratch_folder(spark, "documents")
    table(spark, sf_dir, "conversations").select(text.alias("value")).write.text(path)
    good, bad = quarantine.read_documents(spark, path, multiline=False)
    read = flatten_results(good, "conversas").agg(F.lit("lido").alias("reason"), F.count("*").alias("n_rows"))
    return read.union(quarantine.lane_summary(bad).select("reason", F.col("records").alias("n_rows")))


@query(
    "quarantined_cells",
    """
    SELECT CASE WHEN o_orderkey % 50 IN (7, 11) THEN 'numero de celulas diferente do cabecalho' ELSE 'lido' END AS reason,
           count(*) AS n_rows, cast(sum(CASE WHEN o_orderkey % 50 NOT IN (7, 11) THEN o_custkey END) AS bigint) AS cells
    FROM orders GROUP BY ALL
    """,
)
def quarantined_cells(spark, sf_dir):
    """A sheet in which some rows have a cell too many and some one too few."""
    orders = table(spark, sf_dir, "orders")
    key, cells = F.col("o_orderkey"), [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")]
    row = F.when(key % 50 == 7, F.concat_ws(",", *cells, F.lit("x"))).when(key % 50 == 11, F.concat_ws(",", *cells[:2]))
    path = scratch_folder(spark, "sheet")
    orders.select(row.otherwise(F.concat_ws(",", *cells)).alias("pedido,cliente,status")).write.option("header", True).option(
        "quote", "").csv(path)
    good, bad = quarantine.read_sheet(spark, path, multiline=False)
    read = good.agg(
        F.lit("lido").alias("reason"), F.count("*").alias("n_rows"), F.sum(F.col("cliente").cast("long")).alias("cells")
    )
    kept_out = quarantine.lane_summary(bad).select("reason", F.col("records").alias("n_rows"), F.lit(None).cast("long").alias("cells"))
    return read.union(kept_out)


@query(
    "quarantined_batches",
    """
    SELECT event_type || '_' || strftime(ts, '%Y%m%d') AS batch_id, count(*) AS n_rows, 'lido' AS reason
    FROM events WHERE strftime(ts, '%Y%m%d') <> '20240110' GROUP BY ALL
    UNION ALL
    SELECT DISTINCT event_type || '_20240110', 0, 'arquivo ilegivel' FROM events WHERE strftime(ts, '%Y%m%d') = '20240110'
    """,
)
def quarantined_batches(spark, sf_dir):
    """Batches of events, in which those of one day are no Parquet files."""
    path = scratch_folder(spark, "batches")
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", F.concat("event_type", F.lit("_"), F.date_format("ts", "yyyyMMdd")).alias("batch_id")
    )
    spoilt = F.endswith("batch_id", F.lit("_20240110"))
    events.where(~spoilt).hint("rebalance", F.col("batch_id")).write.partitionBy("batch_id").parquet(path)
    # what is no Parquet file, landed in the folders of those batches
    junk = events.where(spoilt).select("batch_id", F.col("event_id").cast("string"))
    junk.hint("rebalance", F.col("batch_id")).write.mode("append").partitionBy("batch_id").csv(path)
    good, bad = quarantine.read_batches(spark, path, events.schema)
    read = good.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.lit("lido").alias("reason"))
    name = F.regexp_extract("file", "/batch_id=([^/]+)/", 1)
    return read.union(bad.select(name, F.lit(0).cast("long"), "reason").distinct())


# ---------------------------------------------------------------- dates, chains

_SHEET = {
    "dd/MM/yy HH:mm": "hm", "dd/MM/yyyy HH:mm": "hm", "dd/MM/yyyy HH:mm:ss": "hms", "dd/MM/yy": "", "dd/MM/yyyy": "",
    "dd-MM-yy HH:mm": "hm", "dd-MM-yyyy HH:mm:ss": "hms", "dd-MM-yy": "", "dd-MM-yyyy": "", "yyyy-MM-dd HH:mm:ss": "hms",
    "yyyy-MM-dd": "",
}
_SHORT = ", ".join(str(i) for i, f in enumerate(_SHEET) if "yyyy" not in f)
_HOURS = ", ".join(str(i) for i, t in enumerate(_SHEET.values()) if t)


@query(
    "dates_sheet_formats",
    f"""
    SELECT l_orderkey, l_linenumber,
           make_timestamp(CASE WHEN k IN ({_SHORT}) THEN 2000 + year(l_shipdate) % 100 ELSE year(l_shipdate) END,
             month(l_shipdate), day(l_shipdate), CASE WHEN k IN ({_HOURS}) THEN 14 ELSE 0 END,
             CASE WHEN k IN ({_HOURS}) THEN 5 ELSE 0 END, 0) AS at,
           cast(NULL AS varchar) AS flag_fail_datehour_conversion
    FROM (SELECT *, (l_orderkey + l_linenumber) % {len(_SHEET)} AS k FROM lineitem)
    """,
)
def dates_sheet_formats(spark, sf_dir):
    """Shipping dates written in all formats a sheet may have, read in place."""
    key = (F.col("l_orderkey") + F.col("l_linenumber")) % len(_SHEET)
    at = F.col("l_shipdate").cast("timestamp") + F.expr("INTERVAL '14:05' HOUR TO MINUTE")
    written = F.lit(None).cast("string")
    for i, fmt in enumerate(_SHEET):
        written = F.when(key == i, F.date_format(at, fmt)).otherwise(written)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", written.alias("at"))
    return parse_dates_in_place(rows, ["at"]).withColumn("at", F.col("at").cast("timestamp_ntz"))


_CHAINED = """
    chained AS (
      SELECT l_orderkey AS id, CASE WHEN l_orderkey % 8 IN (1, 2, 3) THEN l_orderkey - 1 WHEN l_orderkey % 8 = 4 THEN l_orderkey + 1
                                    WHEN l_orderkey % 8 = 5 THEN l_orderkey - 1 WHEN l_orderkey % 8 = 6 THEN l_orderkey END AS up,
             p_type AS chemical_name, l_quantity AS value
      FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


@query(
    "qc_replica_chains",
    f"""
    WITH RECURSIVE {_CHAINED}, links AS (SELECT DISTINCT id, up FROM chained WHERE up IS NOT NULL AND up <> id),
    walk AS (SELECT id, up AS node, 1 AS steps FROM links
             UNION ALL SELECT walk.id, links.up, steps + 1 FROM walk JOIN links ON links.id = walk.node WHERE steps < 20),
    ends AS (SELECT id, arg_max(node, steps) AS root, max(steps) AS steps FROM walk GROUP BY id),
    v AS (SELECT id, chemical_name, min(value) AS value FROM chained GROUP BY ALL),
    sides AS (SELECT e.id, e.steps, e.root, v.chemical_name, v.value AS vb, cast(NULL AS double) AS va FROM ends e JOIN v ON v.id = e.id WHERE steps < 20
              UNION ALL SELECT e.id, e.steps, e.root, v.chemical_name, NULL, v.value FROM ends e JOIN v ON v.id = e.root WHERE steps < 20),
    wide AS (SELECT id, root, steps, chemical_name, min(va) AS va, min(vb) AS vb FROM sides GROUP BY ALL)
    SELECT 'S-' || id AS sample_name, 'S-' || root AS first, cast(steps AS bigint) AS steps, false AS "cycle", chemical_name,
           va AS value_original, vb AS value_replica, round(abs(va - vb) / ((va + vb) / 2) * 100, 2) AS rpd FROM wide
    UNION ALL
    SELECT 'S-' || id, NULL, NULL, true, NULL, NULL, NULL, NULL FROM ends WHERE steps >= 20
    """,
)
def qc_replica_chains(spark, sf_dir):
    """Replicas of replicas against the first sample of their chain, up to three steps away; circles are reported."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    kind, key = F.col("l_orderkey") % 8, F.col("l_orderkey")
    up = F.when(kind.isin(1, 2, 3, 5), key - 1).when(kind == 4, key + 1).when(kind == 6, key)
    named = rows.select(
        F.concat(F.lit("S-"), key).alias("sample_name"), F.concat(F.lit("S-"), up).alias("parent"),
        F.col("p_type").alias("chemical_name"), F.col("l_quantity").alias("value"),
    )
    chains = first_samples(named)
    pairs = chains.where(~F.col("cycle")).select(F.col("first").alias("original"), F.col("sample_name").alias("replica"))
    differences = replica_differences(named, pairs).withColumnRenamed("replica", "sample_name").drop("original")
    return chains.join(differences, "sample_name", "left").select(
        "sample_name", "first", "steps", "cycle", "chemical_name", "value_original", "value_replica", "rpd"
    )
