"""Quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from labtrail.catalog.lab import LAB, lab
from labtrail.catalog.registry import query, table
from labtrail.operators.quality import (
    blank,
    cross_checks,
    examined,
    flagged,
    oxygen_demand,
    pair_order_check,
    replica_differences,
    replica_rpd,
    species_check,
    summary,
    surrogate,
    total_dissolved,
)

LISTED = ("ECONOMY Total (mg/L)", "SMALL Dissolvido (mg/L)", "PROMO Total (mg/L)")
# Samples left out of the checks that compare fractions.
EXCLUDED = ("S-1", "S-2", "S-3", "S-5", "S-8")
SPECIES = {
    "dissolved": "SMALL Dissolvido (mg/L)",
    "hexavalent_dissolved": "LARGE Dissolvido (mg/L)",
    "hexavalent": "LARGE Total (mg/L)",
    "total": "SMALL Total (mg/L)",
}

_LISTED_SQL = ", ".join(f"'{n}'" for n in LISTED)
_EXCLUDED_SQL = ", ".join(f"'{n}'" for n in EXCLUDED)
_SPECIES_SQL = ", ".join(f"'{n}'" for n in SPECIES.values())
_WATER = "matrix IN ('Agua Subterranea', 'Fase livre')"

# Every check as its own CTE, joined back to the rows by key.
_CHECKS = f"""
    WITH {LAB},
    base AS (SELECT *, trim(regexp_replace(chemical_name, '(?i)(total|dissolvido)', '', 'g')) AS base FROM lab),
    td AS (
      SELECT DISTINCT t.sample_name, t.base FROM base t JOIN base d USING (sample_name, base)
      WHERE t.chemical_name LIKE '%Total%' AND d.chemical_name LIKE '%Dissolvido%' AND d.value > t.value
        AND t.{_WATER} AND d.{_WATER} AND t.sample_name NOT IN ({_EXCLUDED_SQL})),
    od AS (
      SELECT DISTINCT a.sample_name FROM lab a JOIN lab b USING (sample_name)
      WHERE a.chemical_name LIKE 'ECONOMY%' AND b.chemical_name LIKE 'SMALL%' AND a.value > b.value
        AND a.{_WATER} AND b.{_WATER}),
    sp AS (
      SELECT sample_name, min(value) FILTER (chemical_name = '{SPECIES["dissolved"]}') AS d,
             min(value) FILTER (chemical_name = '{SPECIES["hexavalent_dissolved"]}') AS hd,
             min(value) FILTER (chemical_name = '{SPECIES["hexavalent"]}') AS h,
             min(value) FILTER (chemical_name = '{SPECIES["total"]}') AS t
      FROM lab WHERE {_WATER} AND sample_name NOT IN ({_EXCLUDED_SQL}) GROUP BY sample_name),
    spf AS (
      SELECT sample_name, nullif(concat_ws('; ', CASE WHEN hd > h THEN 'Hexav Dissolvido > Hexavalente' END,
             CASE WHEN d > t THEN 'Dissolvido > Total' END, CASE WHEN hd > d THEN 'Hexav Dissolvido > Dissolvido' END,
             CASE WHEN h > t THEN 'Hexavalente > Total' END), '') AS msg FROM sp),
    v AS (SELECT sample_id, chemical_name, min(value) AS value FROM lab GROUP BY ALL),
    rd AS (
      SELECT a.sample_id AS a, b.sample_id AS b, chemical_name, a.value AS va, b.value AS vb,
             round(CASE WHEN a.value = 0 AND b.value = 0 THEN 0 ELSE abs(a.value - b.value) / ((a.value + b.value) / 2) * 100 END, 2) AS rpd
      FROM v a JOIN v b USING (chemical_name) WHERE b.sample_id = a.sample_id + 1),
    rf AS (
      SELECT DISTINCT unnest([a, b]) AS rf_id, chemical_name AS rf_name FROM rd WHERE rpd > 20),
    checked AS (
      SELECT base.*,
        CASE WHEN chemical_name IN ({_LISTED_SQL}) AND value NOT BETWEEN 10 AND 40 THEN 'Resultado fora da faixa de 10 a 40' END AS flag_surrogate,
        CASE WHEN td.sample_name IS NOT NULL AND {_WATER} AND base.sample_name NOT IN ({_EXCLUDED_SQL}) THEN 'Dissolvido maior que Total' END AS flag_totais_dissolvido,
        CASE WHEN od.sample_name IS NOT NULL AND {_WATER} AND (chemical_name LIKE 'ECONOMY%' OR chemical_name LIKE 'SMALL%') THEN 'ECONOMY maior que SMALL' END AS flag_dbo_dqo,
        CASE WHEN chemical_name IN ({_SPECIES_SQL}) THEN spf.msg END AS flag_cromo,
        CASE WHEN quality_code IN ('BC', 'BV', 'BE') AND value > quantification_limit THEN 'Acima_LQ' END AS flag_branco,
        CASE WHEN rf_id IS NOT NULL THEN 'RPD > 20%' END AS flag_rpd
      FROM base LEFT JOIN td ON td.sample_name = base.sample_name AND td.base = base.base
      LEFT JOIN od ON od.sample_name = base.sample_name LEFT JOIN spf ON spf.sample_name = base.sample_name
      LEFT JOIN rf ON rf_id = base.sample_id AND rf_name = base.chemical_name)
"""


def _result(*columns: str) -> str:
    return f"{_CHECKS} SELECT sample_name, chemical_name, matrix AS samp_matrix, {', '.join(columns)} FROM checked"


def lab_rows(spark, sf_dir, *more):
    rows = lab(spark, sf_dir, "sample_name", "chemical_name", "matrix", "value", *more)
    return rows.withColumnRenamed("matrix", "samp_matrix")


def pairs_of_orders(spark, sf_dir):
    """Every order and the next one as original and replica."""
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('S-', cast(o_orderkey AS string))").alias("original"),
        F.expr("concat('S-', cast(o_orderkey + 1 AS string))").alias("replica"),
    )


def _surrogate(df):
    return surrogate(df, LISTED, 10, 40)


def _demand(df, mode="pair"):
    return oxygen_demand(df, "ECONOMY", "SMALL", mode=mode)


def _species(df):
    return species_check(df, SPECIES, excluded_samples=EXCLUDED)


@query("qc_surrogate", _result("value", "flag_surrogate"))
def qc_surrogate(spark, sf_dir):
    return _surrogate(lab_rows(spark, sf_dir))


@query("qc_total_dissolved", _result("value", "flag_totais_dissolvido"))
def qc_total_dissolved(spark, sf_dir):
    return total_dissolved(lab_rows(spark, sf_dir), EXCLUDED)


@query(
    "qc_total_dissolved_rows",
    f"""{_CHECKS}
    SELECT base.sample_name, chemical_name, matrix AS samp_matrix, value,
           CASE WHEN td.sample_name IS NOT NULL THEN 'Dissolvido maior que Total' END AS flag_totais_dissolvido
    FROM base LEFT JOIN td USING (sample_name, base)""",
)
def qc_total_dissolved_rows(spark, sf_dir):
    """The flag on every row that shares sample and parameter, whatever its matrix."""
    return total_dissolved(lab_rows(spark, sf_dir), EXCLUDED, mode="rows")


@query("qc_pair_by_sample", _result("value", "flag_dbo_dqo"))
def qc_pair_by_sample(spark, sf_dir):
    return _demand(lab_rows(spark, sf_dir))


@query("qc_species", _result("value", "flag_cromo"))
def qc_species(spark, sf_dir):
    return _species(lab_rows(spark, sf_dir))


@query("qc_blank", _result("quality_code", "value", "quantification_limit", "flag_branco"))
def qc_blank(spark, sf_dir):
    return blank(lab_rows(spark, sf_dir, "quality_code", "quantification_limit"))


@query("qc_replica_rpd", _result("value", "flag_rpd"))
def qc_replica_rpd(spark, sf_dir):
    return replica_rpd(lab_rows(spark, sf_dir), pairs_of_orders(spark, sf_dir))


@query(
    "qc_replica_differences",
    f"""
    WITH {LAB},
    v AS (SELECT sample_id, chemical_name, min(value) AS value FROM lab GROUP BY ALL),
    sides AS (
      SELECT o_orderkey AS a, chemical_name, value, true AS first FROM orders JOIN v ON sample_id = o_orderkey
      UNION ALL
      SELECT o_orderkey, chemical_name, value, false FROM orders JOIN v ON sample_id = o_orderkey + 1),
    wide AS (
      SELECT a, chemical_name, min(value) FILTER (first) AS va, min(value) FILTER (NOT first) AS vb FROM sides GROUP BY ALL)
    SELECT 'S-' || cast(a AS varchar) AS original, 'S-' || cast(a + 1 AS varchar) AS replica, chemical_name,
           va AS value_original, vb AS value_replica,
           round(CASE WHEN va = 0 AND vb = 0 THEN 0 ELSE abs(va - vb) / ((va + vb) / 2) * 100 END, 2) AS rpd
    FROM wide""",
)
def qc_replica_differences(spark, sf_dir):
    """Every parameter that at least one sample of a pair reports."""
    return replica_differences(lab_rows(spark, sf_dir), pairs_of_orders(spark, sf_dir))


_FLAGS = (
    "flag_surrogate",
    "flag_totais_dissolvido",
    "flag_dbo_dqo",
    "flag_cromo",
    "flag_branco",
    "flag_rpd",
)


def all_checks(spark, sf_dir):
    rows = lab_rows(spark, sf_dir, "quality_code", "quantification_limit")
    return cross_checks(
        blank(_surrogate(rows)),
        EXCLUDED,
        demand=("ECONOMY", "SMALL"),
        species=SPECIES,
        pairs=pairs_of_orders(spark, sf_dir),
    )


_EXAMINED = {
    "Surrogate": ("flag_surrogate", f"chemical_name IN ({_LISTED_SQL})"),
    "Totais_Dissolvidos": (
        "flag_totais_dissolvido",
        f"{_WATER} AND sample_name NOT IN ({_EXCLUDED_SQL})",
    ),
    "DBO_DQO": (
        "flag_dbo_dqo",
        f"{_WATER} AND (chemical_name LIKE 'ECONOMY%' OR chemical_name LIKE 'SMALL%')",
    ),
    "Cromo": (
        "flag_cromo",
        f"{_WATER} AND sample_name NOT IN ({_EXCLUDED_SQL}) AND chemical_name IN ({_SPECIES_SQL})",
    ),
    "Branco": ("flag_branco", "quality_code IN ('BC', 'BV', 'BE')"),
    "RPD_Replica": (
        "flag_rpd",
        "sample_id IN (SELECT unnest([o_orderkey, o_orderkey + 1]) FROM orders)",
    ),
}


@query(
    "qc_summary",
    _CHECKS
    + " UNION ALL ".join(
        f"SELECT '{k}' AS \"check\", count(*) FILTER ({rows}) AS examined, count({flag}) AS flagged,"
        f" CASE WHEN count({flag}) = 0 THEN 'Sucesso' ELSE 'Aviso' END AS status FROM checked"
        for k, (flag, rows) in _EXAMINED.items()
    ),
)
def qc_summary(spark, sf_dir):
    """All six checks and their tally."""
    looks_at = examined(LISTED, EXCLUDED, demand=("ECONOMY", "SMALL"), species=SPECIES)
    return summary(all_checks(spark, sf_dir), looks_at)


@query(
    "qc_flagged_rows",
    _CHECKS
    + " UNION ALL ".join(
        f"SELECT '{flag}' AS \"check\", sample_name, chemical_name, value, {flag} AS message"
        f" FROM checked WHERE {flag} IS NOT NULL"
        for flag in _FLAGS
    ),
)
def qc_flagged_rows(spark, sf_dir):
    """The flagged rows of all checks as one table, once per flag."""
    message = F.coalesce(*[F.when(F.col("check") == f, F.col(f)) for f in _FLAGS])
    return flagged(all_checks(spark, sf_dir), _FLAGS).select(
        "check", "sample_name", "chemical_name", "value", message.alias("message")
    )


@query(
    "qc_pair_custom",
    f"""
    WITH {LAB}, k AS (
      SELECT sample_name, matrix FROM lab GROUP BY ALL
      HAVING max(value) FILTER (method = 'M-0') > min(value) FILTER (method = 'M-1'))
    SELECT sample_name, method, matrix AS samp_matrix, value,
           CASE WHEN k.sample_name IS NOT NULL AND method <> 'M-2' THEN 'M-0 maior que M-1' END AS flag_pair
    FROM lab LEFT JOIN k USING (sample_name, matrix)
    """,
)
def qc_pair_custom(spark, sf_dir):
    """The pair check on sides and keys of one's own."""
    rows = lab(spark, sf_dir, "sample_name", "method", "matrix", "value").withColumnRenamed(
        "matrix", "samp_matrix"
    )
    return pair_order_check(
        rows,
        "flag_pair",
        "M-0 maior que M-1",
        part=F.col("method") == "M-0",
        whole=F.col("method") == "M-1",
        keys={"sample": F.col("sample_name"), "matrix": F.col("samp_matrix")},
    )
