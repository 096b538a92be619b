"""Contracted scope: what was planned, what arrived, and whether it arrived as agreed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtrail.functions import elapsed_days, first_int, triggered
from labtrail.operators.joins import lookup_join

OUT_OF_SCOPE = "Parametro fora do escopo contratado"
OTHER_METHOD = "Metodo diferente do escopo"
TOO_LATE = "Holding time fora do prazo"
SAMPLE = ("Station", "Matriz", "Amostra")


def unpivot_plan(
    plan: DataFrame,
    matrix: str,
    groups: Sequence[str] | Mapping[str, str],
    station: str = "Sondagem",
    total: str = "Total de Amostras",
) -> DataFrame:
    """A planning sheet (one column per group, marked when planned) as one row per station and group.

    groups: the group columns, or a mapping from column to the name the scope uses; a column mapped to
            nothing gives a null group.
    """
    long = plan.select(
        F.col(f"`{station}`").alias("Station"),
        F.col(f"`{total}`").try_cast("int").alias("totalAmostrasPlanejado"),
        *[F.col(f"`{g}`").cast("string").alias(g) for g in groups],
    ).unpivot(["Station", "totalAmostrasPlanejado"], list(groups), "_group", "_mark")
    name = F.col("_group")
    if isinstance(groups, Mapping) and groups:
        name = F.create_map(*[F.lit(x) for pair in groups.items() for x in pair])[name]
    return long.where(F.col("_mark").isNotNull()).select(
        "Station",
        "totalAmostrasPlanejado",
        name.alias("Planejamento"),
        F.lit(matrix).alias("Matriz"),
    )


def planned_parameters(plan: DataFrame, scope: DataFrame) -> DataFrame:
    """One row per station, matrix, group and planned parameter.

    A planned group the scope does not know keeps one row with a null parameter.
    """
    contracted = scope.select(
        F.col("planejamento").alias("Planejamento"),
        F.col("matriz").alias("Matriz"),
        F.col("parametro").alias("Parametro"),
    )
    return plan.join(contracted, ["Planejamento", "Matriz"], "left").select(
        "Station", "Matriz", "totalAmostrasPlanejado", "Planejamento", "Parametro"
    )


def groups_without_scope(planned: DataFrame) -> DataFrame:
    """Planned groups for which the scope lists no parameter."""
    return planned.where(F.col("Parametro").isNull()).select("Matriz", "Planejamento").distinct()


def _checked(message: str, failed: Column, *skips: str) -> Column:
    """A flag that stays null for rows an earlier flag already rules out."""
    skipped = F.lit(False)
    for s in skips:
        skipped = skipped | F.col(s).isNotNull()
    return F.when(~skipped & failed, F.lit(message))


def flag_scope(df: DataFrame, scope: DataFrame | None, method: str = "metodoAnalise") -> DataFrame:
    """Add planned method and holding time, and flag parameters the scope does not know at all.

    Method and holding time go by (parameter, matrix), the flag by parameter alone: a parameter contracted
    for another matrix is in scope, without a planned method. A parameter contracted in several groups of
    one matrix does not multiply rows: a row gets the contract with its own method, the longest holding time
    first; if none has it, one that leaves the method open; else the one with the greatest method. Without a
    scope all three are null.
    """
    if scope is None:
        unknown = F.lit(None).cast("string")
        return df.withColumns(dict.fromkeys(("metodo", "prazo", "flag_parametro_fora_escopo"), unknown))
    contract = F.struct("metodo", first_int(F.col("prazo")).alias("days"), "prazo")
    agreed = (
        scope.dropna(subset=["parametro", "matriz"])
        .groupBy(F.col("parametro").alias("parametroCorrigido"), "matriz")
        .agg(F.sort_array(F.collect_set(contract), asc=False).alias("_contracts"))
    )
    known = scope.select(F.col("parametro").alias("parametroCorrigido"), F.lit(True).alias("_known"))
    joined = lookup_join(df.join(agreed, ["parametroCorrigido", "matriz"], "left"), known, ["parametroCorrigido"])
    contracts, own = F.col("_contracts"), F.col(method) if method in df.columns else F.lit(None)
    chosen = F.coalesce(
        F.get(F.filter(contracts, lambda c: c["metodo"] == own), F.lit(0)),
        F.get(F.filter(contracts, lambda c: own.isNotNull() & c["metodo"].isNull()), F.lit(0)),
        F.get(contracts, F.lit(0)),
    )
    flag = _checked(OUT_OF_SCOPE, F.col("_known").isNull(), "flag_station_sem_mapeamento")
    return (
        joined.withColumn("_chosen", chosen)
        .withColumns(
            {"metodo": F.col("_chosen.metodo"), "prazo": F.col("_chosen.prazo"), "flag_parametro_fora_escopo": flag}
        )
        .drop("_known", "_contracts", "_chosen")
    )


def flag_method(df: DataFrame) -> DataFrame:
    """No contract has the analysis method; unknown methods, analysed or contracted, are not flagged."""
    differs = F.col("metodoAnalise") != F.col("metodo")
    return df.withColumn(
        "flag_metodo",
        _checked(OTHER_METHOD, differs, "flag_station_sem_mapeamento", "flag_parametro_fora_escopo"),
    )


def flag_holding(
    df: DataFrame,
    received: str = "dataRecebLab_valida",
    sampled: str = "dataHoraAmostragem_valida",
) -> DataFrame:
    """Days from sampling to reception, and a flag when they exceed the agreed holding time."""
    days = df.withColumns(
        {
            "prazo_dias": first_int(F.col("prazo")),
            "diasDecorridos": elapsed_days(F.col(received), F.col(sampled)),
        }
    )
    late = F.col("diasDecorridos") > F.col("prazo_dias")
    return days.withColumn(
        "flag_holding_time",
        _checked(TOO_LATE, late, "flag_station_sem_mapeamento", "flag_parametro_fora_escopo"),
    )


def delivered_sets(df: DataFrame) -> DataFrame:
    """Per sample with a station: its distinct parameters, in and out of scope.

    One aggregate over the rows; the sets combine before the shuffle and hold parameter names only, so
    their size follows the vocabulary and not the number of results.
    """
    outside = F.col("flag_parametro_fora_escopo").isNotNull()
    parameter = F.col("parametroCorrigido")
    return (
        df.where(F.col("flag_station_sem_mapeamento").isNull())
        .groupBy(
            F.col("alternate_name").alias("Station"),
            F.col("matriz").alias("Matriz"),
            F.col("descricaoAmostra_final").alias("Amostra"),
        )
        .agg(
            F.collect_set(F.when(~outside, parameter)).alias("delivered"),
            F.collect_set(F.when(outside, parameter)).alias("outside"),
        )
    )


def coverage(df: DataFrame, planned: DataFrame) -> DataFrame:
    """Per sample: `delivered`, `outside`, and what is `missing` or `extra` against the plan, sorted.

    The planned parameters of a station come to the sample as one array, so expected and delivered sets
    are compared inside a row: no expected-by-delivered table and no anti-join.
    """
    plans = (
        planned.dropna(subset=["Station", "Matriz", "Parametro"])
        .groupBy("Station", "Matriz")
        .agg(F.collect_set("Parametro").alias("planned"))
    )
    samples = delivered_sets(df)
    keys = ["Station", "Matriz"]
    joined = samples.join(plans, keys, "left")
    expected = F.coalesce("planned", F.array().cast("array<string>"))
    return joined.select(
        *SAMPLE,
        "delivered",
        F.sort_array("outside").alias("outside"),
        F.sort_array(F.array_except(expected, "delivered")).alias("missing"),
        F.sort_array(F.array_except("delivered", expected)).alias("extra"),
    )


def missing_parameters(covered: DataFrame) -> DataFrame:
    """One row per sample and planned parameter that did not arrive."""
    return covered.select(*SAMPLE, F.explode("missing").alias("Parametro"))


def extra_parameters(covered: DataFrame) -> DataFrame:
    """One row per sample and parameter that arrived in scope but not planned for its station."""
    return covered.select(*SAMPLE, F.explode("extra").alias("Parametro"))


def sample_summary(covered: DataFrame) -> DataFrame:
    """The delivered report: names and counts of extra, missing and out-of-scope parameters per sample."""

    def listed(c: str) -> Column:
        return F.when(F.size(c) > 0, F.concat_ws("; ", c))

    return covered.select(
        *SAMPLE,
        listed("extra").alias("parametros_extras"),
        listed("missing").alias("parametros_faltantes"),
        listed("outside").alias("parametros_fora_do_escopo"),
        F.size(F.array_union("delivered", "outside")).alias("qtd_parametros_total"),
        F.size("extra").alias("qtd_extras"),
        F.size("missing").alias("qtd_faltantes"),
        F.size("outside").alias("qtd_fora_do_escopo"),
    )


def validation_totals(df: DataFrame) -> DataFrame:
    """Stations, samples and flagged results of a run; one row, one pass.

    Distinct names are counted on one row per (sample, station), not on every result.
    """
    def hits(c: str) -> Column:
        return F.count_if(F.coalesce(triggered(F.col(c)), F.lit(False)))

    per_sample = df.groupBy("descricaoAmostra_final", "alternate_name").agg(
        F.count("*").alias("results"),
        hits("flag_holding_time").alias("late"),
        hits("flag_parametro_fora_escopo").alias("outside"),
        hits("flag_metodo").alias("method"),
    )
    return per_sample.agg(
        F.count_distinct("alternate_name").alias("stations"),
        F.count_distinct("descricaoAmostra_final").alias("samples"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("results", "late", "outside", "method")
        ],
    )
