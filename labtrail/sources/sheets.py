"""Flat and two-table deliveries to the canonical columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtrail.functions import map_codes, parse_result
from labtrail.rules import MATRIX_CODES, PENDING_STATUS
from labtrail.schemas import (
    FLAT_COLUMNS,
    PAIR_ANALYSIS_COLUMNS,
    PAIR_ANALYSIS_OPTIONAL,
    PAIR_SAMPLE_COLUMNS,
    PAIR_SAMPLE_OPTIONAL,
    SHEET_CANONICAL,
)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_sheet(spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = True) -> DataFrame:
    """One landed sheet, all columns text, headers trimmed. CSV is UTF-8 with a header line.

    `multiline=False` for sheets without line breaks in cells: such files are split among tasks.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("encoding", "UTF-8").option("multiLine", multiline)
    return as_strings(trim_headers(reader.load(path)))


def read_pair(
    spark: SparkSession, sample_path: str, analysis_path: str, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """The sample sheet and the analysis sheet of one delivery."""
    return read_sheet(spark, sample_path, fmt), read_sheet(spark, analysis_path, fmt)


def _found(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> dict[str, str | None]:
    return {key: next((h for h in headers if h in df.columns), None) for key, headers in wanted.items()}


def require_columns(df: DataFrame, wanted: Mapping[str, Sequence[str]], layout: str) -> DataFrame:
    """Fail with every missing column at once; nothing is read for it."""
    missing = [" / ".join(wanted[k]) for k, header in _found(df, wanted).items() if header is None]
    if missing:
        raise ValueError(f"{layout}: columns not found: {missing}")
    return df


def resolve_columns(
    df: DataFrame, wanted: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]] = {}
) -> DataFrame:
    """Select columns by the first accepted header, under their key; absent optional ones are null."""
    require_columns(df, wanted, "resolve_columns")
    headers = {**_found(df, wanted), **_found(df, optional)}
    return df.select(
        *[
            (F.col(f"`{h}`") if h else F.lit(None)).cast("string").alias(key)
            for key, h in headers.items()
        ]
    )


def filter_campaign(
    df: DataFrame, column: str, names: Sequence[str] = (), contains: Sequence[str] = ()
) -> DataFrame:
    """Keep rows whose campaign equals one of `names` or contains one of `contains`; null is out."""
    value = F.col(column)
    tests = [F.contains(value, F.lit(c)) for c in contains]
    if names:
        tests.append(value.isin(*names))
    if not tests:
        raise ValueError("filter_campaign needs names or contains")
    return df.where(reduce(lambda a, b: a | b, tests))


def drop_pending(df: DataFrame, column: str, status: str = PENDING_STATUS) -> DataFrame:
    """Leave out rows still without a result. A null status is not pending and stays."""
    return df.where(~F.col(column).eqNullSafe(status))


def unmapped_codes(df: DataFrame, column: str, mapping: Mapping[str, str] = MATRIX_CODES) -> DataFrame:
    """Codes the mapping does not know, sorted."""
    return df.where(~F.col(column).isin(*mapping)).select(column).distinct().orderBy(column)


def _canonical(df: DataFrame, given: Mapping[str, Column]) -> DataFrame:
    """The canonical columns in order; the layout's own where given, else null."""
    result = parse_result(F.col("resultado"))
    columns = {
        "campanha": F.col("proposta"),
        "idAmostra": F.col("codigo"),
        "nomeAmostra": F.col("nome"),
        "descricaoAmostra": F.col("nome"),
        "matriz": F.col("tipo"),
        "dataHoraAmostragem": F.col("coleta"),
        "dataRecebLab": F.col("recebimento"),
        "parametroOriginal": F.col("parametro"),
        "resultadoOriginal": F.col("resultado"),
        "unidadeOriginal": F.col("unidade"),
        "resultadoNumerico": F.col("_result.numeric"),
        "resultadoTexto": F.col("_result.text"),
        "qualifier": F.col("_result.qualifier"),
        **given,
    }
    return df.withColumn("_result", result).select(
        *[columns.get(c, F.lit(None)).cast("string").alias(c) for c in SHEET_CANONICAL]
    )


def canonical_from_flat(flat: DataFrame, laboratory: str, origin: str) -> DataFrame:
    """Resolved flat sheet to the canonical columns. This layout has no laboratory column of its own."""
    return _canonical(
        flat,
        {
            "dataLiberacao": F.col("publicacao"),
            "laboratorio": F.lit(laboratory),
            "OrigemArquivo": F.lit(origin),
        },
    )


def join_pair(sample: DataFrame, analysis: DataFrame) -> DataFrame:
    """Analyses with their sample; analyses of samples that were filtered away drop out.

    Both sides come straight from their scans, so adaptive execution can split a lab code with very many
    analyses.
    """
    return analysis.join(sample, "codigo")


def canonical_from_pair(pair: DataFrame, laboratory: str, origin: str) -> DataFrame:
    """Resolved and joined pair to the canonical columns."""
    return _canonical(
        pair,
        {
            "dataEnvioLab": F.col("envio"),
            "dataHoraAnalise": F.col("analise"),
            "codigoQualidade": F.col("qualidade"),
            "metodoAnalise": F.col("metodo"),
            "limiteQuantificacao": F.col("limite"),
            "tipoAnalise": F.col("tipo_analise"),
            "comentario_parametro": F.col("comentario_parametro"),
            "comentario_amostra": F.col("comentario_amostra"),
            "laboratorio": F.lit(laboratory),
            "OrigemArquivo": F.lit(origin),
        },
    )


def resolve_flat(df: DataFrame) -> DataFrame:
    require_columns(df, FLAT_COLUMNS, "flat layout")
    return resolve_columns(df, FLAT_COLUMNS)


def resolve_pair(sample: DataFrame, analysis: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sheets checked and resolved, short matrix codes written out."""
    missing = []
    for df, wanted in ((sample, PAIR_SAMPLE_COLUMNS), (analysis, PAIR_ANALYSIS_COLUMNS)):
        missing += [h for h, found in zip(wanted.values(), _found(df, wanted).values()) if found is None]
    if missing:
        raise ValueError(f"pair layout: columns not found: {missing}")
    samples = resolve_columns(sample, PAIR_SAMPLE_COLUMNS, PAIR_SAMPLE_OPTIONAL)
    analyses = resolve_columns(analysis, PAIR_ANALYSIS_COLUMNS, PAIR_ANALYSIS_OPTIONAL)
    return samples.withColumn("tipo", map_codes(F.col("tipo"), MATRIX_CODES)), analyses
