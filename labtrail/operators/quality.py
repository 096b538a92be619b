"""Quality checks across rows: surrogates, pairs of fractions, species, blanks and replicas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtrail.functions import base_parameter, exceeds, join_messages, outside, rpd
from labtrail.operators.flags import status_of
from labtrail.operators.joins import attach
from labtrail.rules import (
    BLANK_CODES,
    CHROMIUM,
    CHROMIUM_RULES,
    RPD_LIMIT,
    SURROGATE_RANGE,
    SURROGATES,
    WATER_MATRICES,
)


def _name() -> Column:
    return F.trim("chemical_name")


def mentions(word: str) -> Column:
    """The parameter name holds the word, whatever its case."""
    return F.contains(F.lower("chemical_name"), F.lit(word.lower()))


def begins(word: str) -> Column:
    return F.startswith(F.lower("chemical_name"), F.lit(word.lower()))


def surrogate(
    df: DataFrame,
    names: Sequence[str] = SURROGATES,
    low: float = SURROGATE_RANGE[0],
    high: float = SURROGATE_RANGE[1],
) -> DataFrame:
    """Flag surrogate recoveries outside `[low, high]`; a null value is not flagged."""
    off = _name().isin(*names) & outside(F.col("value"), low, high)
    return df.withColumn(
        "flag_surrogate", F.when(off, F.lit(f"Resultado fora da faixa de {low} a {high}"))
    )


def blank(df: DataFrame, codes: Sequence[str] = BLANK_CODES) -> DataFrame:
    """Flag blanks above their quantification limit."""
    above = F.col("quality_code").isin(*codes) & exceeds(F.col("value"), F.col("quantification_limit"))
    return df.withColumn("flag_branco", F.when(above, F.lit("Acima_LQ")))


def in_water(excluded_samples: Sequence[str] = (), matrices: Sequence[str] = WATER_MATRICES) -> Column:
    """Rows of the water matrices, without the excluded samples."""
    rows = F.col("samp_matrix").isin(*matrices)
    return rows & ~F.col("sample_name").isin(*excluded_samples) if excluded_samples else rows


def pair_order_check(
    df: DataFrame,
    flag: str,
    message: str,
    part: Column,
    whole: Column,
    keys: Mapping[str, Column],
    mode: str = "pair",
) -> DataFrame:
    """Flag keys where some `part` result exceeds some `whole` result.

    part, whole: which rows are the two sides. keys: what pairs them (name -> expression).
    mode: `pair` flags the rows of the two sides, `rows` every row that shares the key.

    The largest part against the smallest whole tells whether any pair fails, so pairs are never formed. The
    verdicts go back to the rows by `attach`, which spreads the rows of hot keys.
    """
    names = [f"_key_{k}" for k in keys]
    keyed = df.withColumns({"_is_part": part, "_is_whole": whole, **dict(zip(names, keys.values()))})
    side = F.col("_is_part") | F.col("_is_whole")
    verdicts = keyed.groupBy(*names).agg(
        F.max(F.when(F.col("_is_part"), F.col("value"))).alias("_part"),
        F.min(F.when(F.col("_is_whole"), F.col("value"))).alias("_whole"),
        F.count("*").alias("_rows"),
    )
    fails = F.when(exceeds(F.col("_part"), F.col("_whole")), F.lit(True)).alias("_fails")
    raised = F.col("_fails") & side if mode == "pair" else F.col("_fails")
    told = attach(keyed, verdicts.select(*names, fails, "_rows"), names, weight="_rows")
    checked = told.withColumn(flag, F.when(raised, F.lit(message)))
    return checked.select(*[F.col(f"`{c}`") for c in df.columns], flag)


def total_dissolved(df: DataFrame, excluded_samples: Sequence[str] = (), mode: str = "pair") -> DataFrame:
    """The dissolved fraction must not exceed the total of the same sample and parameter."""
    eligible = in_water(excluded_samples) & ~mentions("cromo")
    return pair_order_check(
        df,
        "flag_totais_dissolvido",
        "Dissolvido maior que Total",
        part=eligible & mentions("dissolvido"),
        whole=eligible & mentions("total"),
        keys={"sample": F.col("sample_name"), "base": base_parameter(F.col("chemical_name"))},
        mode=mode,
    )


def oxygen_demand(
    df: DataFrame,
    part: str = "DBO",
    whole: str = "DQO",
    excluded_samples: Sequence[str] = (),
    mode: str = "pair",
) -> DataFrame:
    """The biochemical oxygen demand of a sample must not exceed the chemical one."""
    eligible = in_water(excluded_samples)
    return pair_order_check(
        df,
        "flag_dbo_dqo",
        f"{part} maior que {whole}",
        part=eligible & begins(part),
        whole=eligible & begins(whole),
        keys={"sample": F.col("sample_name")},
        mode=mode,
    )


def species_check(
    df: DataFrame,
    species: Mapping[str, str] = CHROMIUM,
    rules: Sequence[tuple[str, str, str]] = CHROMIUM_RULES,
    excluded_samples: Sequence[str] = (),
    flag: str = "flag_cromo",
) -> DataFrame:
    """Compare the species of one sample; a row of a species lists every broken rule of its sample.

    A species reported more than once counts with its smallest value.
    """
    listed = _name().isin(*species.values())
    counts = in_water(excluded_samples) & listed
    per_sample = df.groupBy("sample_name").agg(
        *[F.min(F.when(counts & (_name() == n), F.col("value"))).alias(f"_s_{s}") for s, n in species.items()],
        F.count("*").alias("_rows"),
    )
    broken = [(F.col(f"_s_{a}") > F.col(f"_s_{b}"), message) for a, b, message in rules]
    verdicts = per_sample.select("sample_name", join_messages(*broken).alias("_broken"), "_rows")
    checked = attach(df, verdicts, ["sample_name"], weight="_rows").withColumn(flag, F.when(listed, F.col("_broken")))
    return checked.select(*[F.col(f"`{c}`") for c in df.columns], flag)


def replica_pairs(df: DataFrame, parent: str = "parent") -> DataFrame:
    """(original, replica) sample names, read from a column that names the original."""
    return (
        df.where((F.trim(parent) != "") & (F.col(parent) != F.col("sample_name")))
        .select(F.col(parent).alias("original"), F.col("sample_name").alias("replica"))
        .distinct()
    )


def replica_differences(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Relative percent difference per (original, replica) pair and parameter.

    Values are first reduced to one per sample and parameter; the pair table meets only those.
    """
    values = df.groupBy("sample_name", "chemical_name").agg(F.min("value").alias("value"))
    return _differences(_profiles(values), pairs, "left")


def _profiles(per_parameter: DataFrame) -> DataFrame:
    """One row per sample with all of `per_parameter` in an array, `found`: an entry for each parameter it reports.

    All columns are kept together, so whoever reads them shares the shuffles up to here.
    """
    entry = F.struct(*[c for c in per_parameter.columns if c != "sample_name"])
    return per_parameter.groupBy("sample_name").agg(F.collect_list(entry).alias("found"))


def _counts(profiles: DataFrame) -> DataFrame:
    """The rows behind each sample, as `attach` asks for them; the entries count them as `rows`."""
    rows = F.aggregate("found", F.lit(0).cast("long"), lambda n, entry: n + entry["rows"])
    return profiles.select("sample_name", rows.alias("_n"))


def _differences(profiles: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """A pair travels once with all that its original reports, and meets its replica where that already lies.

    how: `left` keeps what only one sample of a pair reports, `inner` leaves out pairs with a sample that reports nothing.
    """
    # names and values only: the other entries of a profile need not travel
    entries = F.arrays_zip("found.chemical_name", "found.value")
    first, second = (profiles.select(F.col("sample_name").alias(s), entries.alias(f"_{s}")) for s in ("original", "replica"))
    met = _with_originals(pairs.select("original", "replica"), first, how).join(second, "replica", how)
    if how == "inner":
        # of pairs that share no parameter nothing can differ, and there may be many of them
        met = met.where(F.arrays_overlap("_original.chemical_name", "_replica.chemical_name"))
    nothing = F.lit(None).cast(profiles.schema["found"].dataType.elementType["value"].dataType)

    def side(found: str) -> Column:
        return F.transform(found, lambda x: F.struct(
            x["chemical_name"].alias("chemical_name"),
            (x["value"] if found == "_original" else nothing).alias("value_original"),
            (x["value"] if found == "_replica" else nothing).alias("value_replica"),
        ))

    both = F.flatten(F.array_compact(F.array(side("_original"), side("_replica"))))
    wide = (
        met.select("original", "replica", F.inline(both))
        .groupBy("original", "replica", "chemical_name")
        .agg(F.min("value_original").alias("value_original"), F.min("value_replica").alias("value_replica"))
    )
    return wide.withColumn("rpd", rpd(F.col("value_original"), F.col("value_replica")))


def _with_originals(pairs: DataFrame, first: DataFrame, how: str) -> DataFrame:
    """The pairs with what their originals report; `first` stays where it lies, but for the largest few originals.

    Those, as many as there are shuffle partitions, may have very many replicas. `attach` spreads these pairs, and only
    their originals' entries are copied to the places they go to.
    """
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = pairs.where(F.col("original").isNotNull()).groupBy("original").agg(F.count("*").alias("_n"))
    hot = F.broadcast(counts.orderBy(F.desc("_n"), "original").limit(parts).select("original"))
    spread = attach(pairs.join(hot, "original", "left_semi"), first.join(hot, "original", "left_semi"), ["original"])
    if how == "inner":
        spread = spread.where(F.col("_original").isNotNull())
    return pairs.join(hot, "original", "left_anti").join(first, "original", how).unionByName(spread)


def replica_rpd(df: DataFrame, pairs: DataFrame, limit: float = RPD_LIMIT) -> DataFrame:
    """Flag the rows of both samples of a pair whose values differ by more than `limit` percent."""
    profiles = _profiles(
        df.groupBy("sample_name", "chemical_name").agg(F.min("value").alias("value"), F.count("*").alias("rows"))
    )
    failing = _failing_replicas(profiles, pairs, limit).withColumnRenamed("replicas", "_replicas")
    told = attach(df, failing, ["sample_name"], counts=_counts(profiles))
    flag = F.when(F.array_contains("_replicas", F.col("chemical_name")), F.lit(f"RPD > {limit:g}%"))
    return told.select(*[F.col(f"`{c}`") for c in df.columns], flag.alias("flag_rpd"))


def _failing_replicas(profiles: DataFrame, pairs: DataFrame, limit: float) -> DataFrame:
    """Per sample the parameters (`replicas`) that differ too much in some pair it belongs to."""
    side = F.explode(F.array("original", "replica")).alias("sample_name")
    wide = _differences(profiles, pairs, "inner").where(F.col("rpd") > limit)
    return wide.select(side, "chemical_name").groupBy("sample_name").agg(F.collect_set("chemical_name").alias("replicas"))


def sample_profiles(df: DataFrame) -> DataFrame:
    """What each sample reports: per parameter the least and greatest value in water, the least of all, and the rows."""
    value, water = F.col("value"), in_water()
    return _profiles(df.groupBy("sample_name", "chemical_name").agg(
        F.min(F.when(water, value)).alias("low"),
        F.max(F.when(water, value)).alias("high"),
        F.min(value).alias("value"),
        F.count("*").alias("rows"),
    ))


def sample_verdicts(
    profiles: DataFrame,
    excluded_samples: Sequence[str] = (),
    demand: tuple[str, str] = ("DBO", "DQO"),
    species: Mapping[str, str] = CHROMIUM,
    rules: Sequence[tuple[str, str, str]] = CHROMIUM_RULES,
    pairs: DataFrame | None = None,
    limit: float = RPD_LIMIT,
) -> DataFrame:
    """What the cross-row checks say about each sample of `sample_profiles`.

    All checks compare values of one sample, so they share one chain of aggregates: per parameter, which combines
    before its shuffle, then, with the parameters of a sample together, per parameter without its fraction and per
    sample. Failing fractions and replicas are listed by name, at most once per parameter.
    """
    part, whole = demand
    chemical, low, high = F.col("chemical_name"), F.col("low"), F.col("high")
    kept = ~F.col("sample_name").isin(*excluded_samples) if excluded_samples else F.lit(True)
    fraction = kept & ~mentions("cromo")
    # the entries of a sample lie together now, so neither of these two is shuffled
    per_base = profiles.select("sample_name", F.inline("found")).groupBy("sample_name", base_parameter(chemical).alias("base")).agg(
        F.max(F.when(fraction & mentions("dissolvido"), high)).alias("_dissolved"),
        F.min(F.when(fraction & mentions("total"), low)).alias("_total"),
        F.max(F.when(begins(part), high)).alias("_part"),
        F.min(F.when(begins(whole), low)).alias("_whole"),
        *[F.min(F.when(kept & (_name() == n), low)).alias(f"_s_{s}") for s, n in species.items()],
    )
    per_sample = per_base.groupBy("sample_name").agg(
        F.collect_set(F.when(F.col("_dissolved") > F.col("_total"), F.col("base"))).alias("bases"),
        F.max("_part").alias("_part"),
        F.min("_whole").alias("_whole"),
        *[F.min(f"_s_{s}").alias(f"_s_{s}") for s in species],
    )
    if pairs is None:
        names, paired = F.lit(None).cast("array<string>"), F.lit(None).cast("boolean")
        per_sample = per_sample.withColumns({"replicas": names, "in_replica_pair": paired})
    else:
        paired = pairs.select(F.explode(F.array("original", "replica")).alias("sample_name")).distinct()
        per_sample = per_sample.join(_failing_replicas(profiles, pairs, limit), "sample_name", "left").join(
            paired.withColumn("in_replica_pair", F.lit(True)), "sample_name", "left"
        )
    too_much = exceeds(F.col("_part"), F.col("_whole"))
    broken = [(F.col(f"_s_{a}") > F.col(f"_s_{b}"), m) for a, b, m in rules]
    return per_sample.select(
        "sample_name",
        F.when(F.size("bases") > 0, F.col("bases")).alias("bases"),
        "replicas",
        F.when(too_much, F.lit(f"{part} maior que {whole}")).alias("demand"),
        join_messages(*broken).alias("species"),
        "in_replica_pair",
    )


def cross_checks(
    df: DataFrame,
    excluded_samples: Sequence[str] = (),
    demand: tuple[str, str] = ("DBO", "DQO"),
    species: Mapping[str, str] = CHROMIUM,
    rules: Sequence[tuple[str, str, str]] = CHROMIUM_RULES,
    pairs: DataFrame | None = None,
    limit: float = RPD_LIMIT,
    mode: str = "pair",
) -> DataFrame:
    """`total_dissolved`, `oxygen_demand`, `species_check` and `replica_rpd` together.

    The same flags as the four checks one after another, for one shuffle of the rows instead of four: the
    verdicts are joined into one row per sample with something to tell and attached once. `in_replica_pair`
    says which rows belong to a sample of a pair (null: none).
    """
    profiles = sample_profiles(df)
    verdicts = sample_verdicts(profiles, excluded_samples, demand, species, rules, pairs, limit)
    chemical = F.col("chemical_name")
    water, kept = in_water(), in_water(excluded_samples)
    fraction = kept & ~mentions("cromo") & (mentions("total") | mentions("dissolvido"))
    measured = water & (begins(demand[0]) | begins(demand[1]))
    if mode == "rows":
        fraction = measured = F.lit(True)
    told = attach(df, verdicts, ["sample_name"], counts=_counts(profiles))
    flags = {
        "flag_totais_dissolvido": F.when(
            fraction & F.array_contains("bases", base_parameter(chemical)),
            F.lit("Dissolvido maior que Total"),
        ),
        "flag_dbo_dqo": F.when(measured, F.col("demand")),
        "flag_cromo": F.when(_name().isin(*species.values()), F.col("species")),
        "flag_rpd": F.when(F.array_contains("replicas", chemical), F.lit(f"RPD > {limit:g}%")),
    }
    return told.withColumns(flags).drop("demand", "species", "bases", "replicas")


def examined(
    surrogates: Sequence[str] = SURROGATES,
    excluded_samples: Sequence[str] = (),
    demand: tuple[str, str] = ("DBO", "DQO"),
    species: Mapping[str, str] = CHROMIUM,
    blanks: Sequence[str] = BLANK_CODES,
) -> dict[str, tuple[str, Column]]:
    """Per check its flag column and which rows it looks at, for the tally of `cross_checks` and the others."""
    water = in_water(excluded_samples)
    return {
        "Surrogate": ("flag_surrogate", _name().isin(*surrogates)),
        "Totais_Dissolvidos": (
            "flag_totais_dissolvido",
            water & ~mentions("cromo") & (mentions("total") | mentions("dissolvido")),
        ),
        "DBO_DQO": ("flag_dbo_dqo", in_water() & (begins(demand[0]) | begins(demand[1]))),
        "Cromo": ("flag_cromo", water & _name().isin(*species.values())),
        "Branco": ("flag_branco", F.col("quality_code").isin(*blanks)),
        "RPD_Replica": ("flag_rpd", F.col("in_replica_pair")),
    }


def summary(df: DataFrame, checks: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Rows examined, rows flagged and status per check, in one pass.

    checks: name -> (flag column, which rows the check looks at).
    """
    tallies = df.agg(
        *[F.count_if(F.coalesce(rows, F.lit(False))).alias(f"_seen_{k}") for k, (_, rows) in checks.items()],
        *[F.count(F.col(flag)).alias(f"_hit_{k}") for k, (flag, _) in checks.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("check"),
                F.col(f"_seen_{k}").alias("examined"),
                F.col(f"_hit_{k}").alias("flagged"),
            )
            for k in checks
        ]
    )
    return tallies.select(F.inline(entries)).withColumn("status", status_of(F.col("flagged")))


def flagged(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """The flagged rows of all checks as one table, tagged with the check; a row appears once per flag."""
    raised = F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in flags])
    any_raised = reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in flags])
    return df.where(any_raised).select("*", F.explode(F.array_compact(raised)).alias("check"))
