"""Run log: what each step read, wrote and flagged."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labtrail.functions import period_text, triggered
from labtrail.operators.flags import flag_columns
from labtrail.rules import NO_FLAGS
from labtrail.schemas import LOG

# --- fixed values: step names the delivery summary reads -------------------------------------------------
MAPPING_STEP = "Mapeamento de parametros"
COUNT_STEPS = {
    "qtd_amostras": "Amostras distintas (sample_name)",
    "qtd_resultados": "Gravacao Silver - API Validado",
    "qtd_stations": "Totais de validacao - Qtd Stations Executadas",
    "qtd_holding_fora_prazo": "Totais de validacao - Qtd Holding Time Fora do Prazo",
    "qtd_parametro_extra": "Totais de validacao - Qtd Parametros Extras",
    "qtd_metodo_divergente": "Totais de validacao - Qtd Metodos Divergentes",
}


def observe_counts(
    df: DataFrame, name: str, flags: Sequence[str] | None = None
) -> tuple[DataFrame, Observation]:
    """Count rows and flags while the data passes: no extra job, the write itself fills the numbers."""
    watched = Observation(name)
    names = list(flags if flags is not None else flag_columns(df))
    counts = [F.count_if(F.coalesce(triggered(F.col(f)), F.lit(False))).alias(f) for f in names]
    return df.observe(watched, F.count(F.lit(1)).alias("rows"), *counts), watched


def step(
    name: str,
    read: int = 0,
    written: int | None = None,
    flags: Mapping[str, int] | None = None,
    note: str = "",
    status: str | None = None,
) -> dict:
    """One step record. Without a status it is `Aviso` when a flag was raised, else `Sucesso`."""
    raised = {f: n for f, n in (flags or {}).items() if n > 0}
    return {
        "etapa": name,
        "status": status or ("Aviso" if raised else "Sucesso"),
        "registros_lidos": read,
        "registros_escritos": read if written is None else written,
        "flags": "; ".join(f"{f}({n})" for f, n in raised.items()) or NO_FLAGS,
        "observacoes": note,
    }


def observed_step(name: str, watched: Observation, **more) -> dict:
    """The step record of an observed write, after it has run."""
    counts = dict(watched.get)
    rows = counts.pop("rows")
    return step(name, read=rows, flags=counts, **more)


def filter_step(name: str, before: int, after: int, note: str = "") -> dict:
    """The step record of a filter: a warning when nothing is left."""
    dropped = note or f"{before - after} registros descartados"
    return step(name, before, after, note=dropped, status="Sucesso" if after else "Aviso")


def step_rows(
    spark: SparkSession, steps: Iterable[dict], project: str, stage: str, batch_ts: str | None = None
) -> DataFrame:
    """Step records of one run as log rows."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [
        {
            **s,
            "batch_ts": batch_ts or now,
            "projeto": project,
            "notebook": stage,
            "ordem": i,
            "ts_registro": now,
        }
        for i, s in enumerate(steps)
    ]
    return spark.createDataFrame([tuple(r[f] for f in LOG.fieldNames()) for r in rows], LOG)


def append_log(log: DataFrame, path: str, fmt: str = "parquet", strict: bool = False) -> bool:
    """Append to the log table; one folder per project, so that reading one project skips the others.

    A run is not lost for its log: unless `strict`, a failure is a warning and the answer False.
    """
    try:
        # a few rows come out as one file, a large log as several
        log.hint("rebalance", F.col("projeto")).write.format(fmt).mode("append").partitionBy("projeto").save(path)
    except Exception as error:
        if strict:
            raise
        warnings.warn(f"run log not written to {path}: {error}", stacklevel=2)
        return False
    return True


def read_log(spark: SparkSession, path: str, project: str, fmt: str = "parquet") -> DataFrame:
    """The log of one project, older rows with fewer columns included."""
    return spark.read.format(fmt).schema(LOG).load(path).where(F.col("projeto") == project)


def latest_step(
    log: DataFrame, by: Sequence[str] = ("projeto", "etapa"), order: Sequence[str] = ("batch_ts", "ordem")
) -> DataFrame:
    """The newest row of every step, all steps in one aggregate. Ties are settled by the other columns."""
    others = [c for c in log.columns if c not in by]
    ranked = [*order, *[c for c in others if c not in order]]
    newest = F.max(F.struct(*[F.col(c) for c in ranked])).alias("_newest")
    return log.groupBy(*by).agg(newest).select(*by, *[F.col(f"_newest.{c}").alias(c) for c in others])


def delivery_summary(log: DataFrame, batch: str | None = None) -> DataFrame:
    """The figures of the notification, one row per project; steps not logged count as 0."""
    newest = latest_step(log)

    def pick(column: str, step_name: str):
        return F.max(F.when(F.col("etapa") == step_name, F.col(column)))

    figures = newest.groupBy("projeto").agg(
        F.coalesce(pick("status", MAPPING_STEP), F.lit("Nao encontrado")).alias("mapeamento_status"),
        F.coalesce(
            pick("observacoes", MAPPING_STEP), F.lit("Etapa de mapeamento nao encontrada no log")
        ).alias("mapeamento_detalhe"),
        *[
            F.coalesce(pick("registros_escritos", s), F.lit(0)).alias(name)
            for name, s in COUNT_STEPS.items()
        ],
    )
    return figures.withColumn("periodo_execucao", period_text(F.lit(batch).cast("string")))


def total_steps(totals: Mapping[str, int]) -> list[dict]:
    """Log steps for the totals of a validation run (see `validation_totals`)."""
    source = {
        "qtd_amostras": "samples",
        "qtd_resultados": "results",
        "qtd_stations": "stations",
        "qtd_holding_fora_prazo": "late",
        "qtd_parametro_extra": "outside",
        "qtd_metodo_divergente": "method",
    }
    return [step(COUNT_STEPS[k], totals["results"], totals[c]) for k, c in source.items()]
