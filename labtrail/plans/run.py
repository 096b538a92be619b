"""A whole run: canonical rows to written outputs, with every step in the log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.operators.conflicts import SAMPLE_PARAMETER, exclude_conflicts
from labtrail.operators.flags import parse_dates
from labtrail.operators.ledger import Ledger
from labtrail.operators.outputs import OUTPUTS, batch_folder, write_batch
from labtrail.operators.parameters import convert_units, map_parameters
from labtrail.operators.runlog import MAPPING_STEP, step, total_steps
from labtrail.operators.samples import clean_names, map_samples
from labtrail.plans.clean import normalise_matrix, read_numbers
from labtrail.plans.validate import Scope, check_scope, deliver
from labtrail.rules import DATE_COLUMNS, ProjectRules
from labtrail.sources.sheets import filter_campaign

READ_STEP, CAMPAIGN_STEP, CONFLICT_STEP = "Leitura da entrega", "Filtro de campanha", "Resultados conflitantes"
# Every row is in exactly one of these outputs.
WHOLE = ("api_validado", "erro_mapeamento", "erro_sampleName")


@dataclass(frozen=True)
class Tables:
    """The lookups a run needs."""

    station: DataFrame
    corrections: DataFrame
    parameters: DataFrame
    factors: DataFrame
    scope: Scope | None = None


def run_delivery(
    rows: DataFrame, rules: ProjectRules, tables: Tables, path: str, batch_id: str, ledger: Ledger, log_path: str,
    flag_missing_dates: bool = True,
) -> DataFrame:
    """Canonical rows to the written outputs of one batch, which are returned as read back.

    The rows are read once: filters, mappings, checks and outputs are counted by the ledger during the one write.
    Distinct names cannot be counted in passing; they and the names of unmapped parameters come from the written
    batch, of which only these columns are read. Then all steps are appended to the log.
    """
    spark = rows.sparkSession
    watched = ledger.watch(rows, READ_STEP)
    own = ledger.filtered(
        watched, CAMPAIGN_STEP,
        lambda df: filter_campaign(df, "campanha", contains=(*rules.campaigns, *rules.proposal_numbers)), READ_STEP,
    )
    sound = ledger.filtered(
        own, CONFLICT_STEP, lambda df: exclude_conflicts(df, SAMPLE_PARAMETER, "resultadoOriginal"), CAMPAIGN_STEP
    )
    dated = parse_dates(sound, flag_missing=flag_missing_dates)
    dated = ledger.watch(dated, "Conversao de datas", [f"flag_{c}" for c in DATE_COLUMNS])
    placed = dated.transform(normalise_matrix).transform(clean_names).transform(
        map_samples, tables.station, tables.corrections
    )
    placed = ledger.watch(placed, "Mapeamento de amostras", ["flag_station_sem_mapeamento"])
    named = placed.transform(read_numbers).transform(map_parameters, tables.parameters)
    converted = convert_units(named, tables.factors)
    converted = ledger.watch(converted, "Conversao de unidades", ["flag_conversao", "flag_fator_nao_encontrado"])
    checks = ["flag_parametro_fora_escopo", "flag_metodo", "flag_holding_time"]
    checked = ledger.watch(check_scope(converted, tables.scope), "Validacao de escopo", [*checks, "flag_padronizacao"])
    out = ledger.watch(deliver(checked), "Saidas", by=("output", OUTPUTS))
    write_batch(out, path, batch_id, ["output"])

    # from here on only what is written is read
    written = spark.read.schema(out.schema).parquet(batch_folder(path, batch_id))
    found = written.where(F.col("output").isin(*WHOLE)).agg(
        F.count_distinct("alternate_name").alias("stations"),
        F.count_distinct("sample_name").alias("samples"),
        F.array_sort(F.collect_set(F.when(F.col("output") == "erro_mapeamento", F.col("original_parameter")))).alias("unmapped"),
    ).first()
    counted = ledger.counts()
    flags, rows_out = counted["Validacao de escopo"], counted["Saidas"]
    lost = flags.get("flag_padronizacao", 0)
    detail = f"Parametros nao mapeados ({lost} registros): {', '.join(found['unmapped'])}"
    mapping = step(
        MAPPING_STEP, flags["rows"], flags={"flag_padronizacao": lost},
        note=detail if lost else "Todos os parametros mapeados com sucesso",
    )
    totals = {
        "samples": found["samples"], "stations": found["stations"], "results": rows_out.get("api_validado", 0),
        "late": flags.get("flag_holding_time", 0), "outside": flags.get("flag_parametro_fora_escopo", 0),
        "method": flags.get("flag_metodo", 0),
    }
    per_output = [
        step(f"Gravacao - {o}", rows_out["rows"], rows_out.get(o, 0)) for o in OUTPUTS if o != "api_validado"
    ]
    ledger.append(spark, log_path, [mapping, *total_steps(totals), *per_output])
    return written
