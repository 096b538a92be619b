"""The star schema read as laboratory results: one row per sample × parameter.

An order is a sample, a line item a result, a part type the parameter and a nation the station.
The column expressions are plain SQL that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.catalog.registry import table
from labtrail.rules import rule_table

# column -> (expression, tables it needs besides lineitem)
COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "sample_id": ("l_orderkey", ()),
    "sample_raw": (
        "concat('S_', cast(l_orderkey AS string), ' - 0.', cast(l_linenumber AS string))",
        (),
    ),
    "sample_name": ("concat('S-', cast(l_orderkey AS string))", ()),
    "station": ("n_name", ("orders", "customer", "nation")),
    "matrix": (
        "CASE l_returnflag WHEN 'A' THEN 'Agua Subterranea' WHEN 'N' THEN 'Fase livre' ELSE 'Solo' END",
        (),
    ),
    "matrix_code": ("CASE l_returnflag WHEN 'A' THEN 'ASUB' WHEN 'N' THEN 'LNAPL' ELSE 'SO' END", ()),
    "parameter": ("p_type", ("part",)),
    "chemical_name": (
        "concat(p_type, CASE l_linestatus WHEN 'F' THEN ' Total' ELSE ' Dissolvido' END, ' (mg/L)')",
        ("part",),
    ),
    "result_text": (
        "CASE WHEN l_linenumber <= 4 THEN concat('< ', replace(cast(l_quantity AS string), '.', ',')) "
        "WHEN l_linenumber <= 6 THEN replace(cast(l_quantity AS string), '.', ',') ELSE 'Ausente' END",
        (),
    ),
    "value": ("l_quantity", ()),
    "lq_text": (
        "CASE WHEN l_linenumber = 7 THEN '-' ELSE concat(cast(p_size AS string), ',50') END",
        ("part",),
    ),
    "quantification_limit": ("cast(p_size AS double)", ("part",)),
    "unit_from": (
        "CASE p_size % 5 WHEN 0 THEN 'µg/L' WHEN 1 THEN '%' WHEN 2 THEN 'mg/dm³' WHEN 3 THEN 'mg/L' "
        "ELSE 'dag/Kg' END",
        ("part",),
    ),
    "unit_to": ("CASE l_returnflag WHEN 'R' THEN 'mg/kg' ELSE 'mg/L' END", ()),
    "quality_code": ("CASE l_linenumber WHEN 1 THEN 'BC' WHEN 2 THEN 'BV' WHEN 3 THEN 'BE' END", ()),
    "method": ("concat('M-', cast(l_suppkey % 3 AS string))", ()),
    "campaign": ("o_orderpriority", ("orders",)),
    "situation": ("o_orderstatus", ("orders",)),
    "sampled_at": ("o_orderdate", ("orders",)),
    "received_at": ("l_shipdate", ()),
    "date_text": (
        "CASE l_linenumber % 3 "
        "WHEN 0 THEN concat(lpad(cast(day(l_shipdate) AS string),2,'0'),'/',"
        "lpad(cast(month(l_shipdate) AS string),2,'0'),'/',cast(year(l_shipdate) AS string),' 10:30') "
        "WHEN 1 THEN concat(cast(year(l_shipdate) AS string),'-',"
        "lpad(cast(month(l_shipdate) AS string),2,'0'),'-',"
        "lpad(cast(day(l_shipdate) AS string),2,'0'),' 10:30:00') "
        "ELSE concat('sem data ', cast(l_linenumber AS string)) END",
        (),
    ),
    # samples of this campaign have no station
    "no_station": (
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'Amostra sem correspondencia em df_station' END",
        ("orders",),
    ),
}

_JOINS = {
    "part": ("l_partkey", "p_partkey"),
    "orders": ("l_orderkey", "o_orderkey"),
    "customer": ("o_custkey", "c_custkey"),
    "nation": ("c_nationkey", "n_nationkey"),
}

LAB = (
    "lab AS (SELECT "
    + ", ".join(f"{e} AS {c}" for c, (e, _) in COLUMNS.items())
    + " FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"
    " JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"
)

SCOPE_ROWS = (
    ("ECONOMY", "Solo", "G1", "M-0", "7 dias"),
    ("ECONOMY", "Agua Subterranea", "G1", "M-1", "30 dias"),
    ("SMALL", "Solo", "G1", "M-1", "14 dias"),
    ("SMALL", "Agua Subterranea", "G1", "M-2", "-"),
    ("MEDIUM", "Solo", "G2", "M-2", "30 dias"),
    ("MEDIUM", "Fase livre", "G2", "M-0", "180 dias"),
    ("STANDARD", "Agua Subterranea", "G2", "M-0", "7 dias"),
    ("LARGE", "Fase livre", "G3", "M-1", "60 dias"),
    ("ECONOMY", "Solo", "G2", "M-1", "3 dias"),
    ("MEDIUM", "Solo", "G1", "M-2", "20 dias"),
)


def values(rows) -> str:
    """Rows as the body of a VALUES list; None becomes a typed null."""

    def cell(v) -> str:
        if v is None:
            return "cast(null AS varchar)"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


SCOPE = (
    f"scope AS (SELECT * FROM (VALUES {values(SCOPE_ROWS)})"
    " AS t(parametro, matriz, planejamento, metodo, prazo))"
)

PLAN_COLUMNS = {
    "station": "n_name",
    "planned_total": "cast(n_nationkey + 1 AS string)",
    "G1": "CASE WHEN n_nationkey % 2 = 0 THEN 'x' END",
    "G2": "CASE WHEN n_nationkey % 3 = 0 THEN 'x' END",
    "G3": "CASE WHEN n_nationkey % 5 = 0 THEN 'x' END",
    "G4": "CASE WHEN n_nationkey % 7 = 0 THEN 'x' END",
}
PLAN = "plan AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in PLAN_COLUMNS.items()) + " FROM nation)"


def lab(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The lab view, joined only with the tables its columns need.

    The small chain orders-customer-nation is built first, so line items are shuffled once per large key.
    Large sides are joined without hints: Spark broadcasts what it measures to be small.
    """
    wanted = columns or tuple(COLUMNS)
    needed = {t for c in wanted for t in COLUMNS[c][1]}
    rows = table(spark, sf_dir, "lineitem")
    if "part" in needed:
        rows = rows.join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
    if "orders" in needed:
        samples = table(spark, sf_dir, "orders")
        for name in ("customer", "nation"):
            if name in needed:
                left, right = _JOINS[name]
                samples = samples.join(table(spark, sf_dir, name), F.expr(f"{left} = {right}"))
        rows = rows.join(samples, F.expr("l_orderkey = o_orderkey"))
    return rows.select(*[F.expr(COLUMNS[c][0]).alias(c) for c in wanted])


def scope_table(spark: SparkSession) -> DataFrame:
    return rule_table(spark, ("parametro", "matriz", "planejamento", "metodo", "prazo"), SCOPE_ROWS)


def plan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(*[F.expr(e).alias(c) for c, e in PLAN_COLUMNS.items()])
