"""Stage 5: quality checks over the newest batch of every source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtrail.operators.outputs import union_sources
from labtrail.operators.quality import blank, cross_checks, examined, summary, surrogate
from labtrail.rules import ProjectRules
from labtrail.sources.batches import BATCH, latest_batch, source_prefix

FLAGS = (
    "flag_surrogate",
    "flag_totais_dissolvido",
    "flag_dbo_dqo",
    "flag_cromo",
    "flag_branco",
    "flag_rpd",
)


def quality_checks(
    df: DataFrame, rules: ProjectRules, pairs: DataFrame | None = None, mode: str = "pair"
) -> DataFrame:
    """All checks; every one adds a flag column and none changes the number of rows.

    pairs: (original, replica) sample names; without it the replica flag stays null.
    """
    return (
        df.transform(surrogate, rules.surrogates)
        .transform(blank)
        .transform(cross_checks, rules.excluded_samples, pairs=pairs, mode=mode)
    )


def quality_summary(checked: DataFrame, rules: ProjectRules) -> DataFrame:
    """Rows examined and flagged, and the status of every check."""
    return summary(checked, examined(rules.surrogates, rules.excluded_samples))


def newest_quality_checks(
    sources: Mapping[str, DataFrame], rules: ProjectRules, pairs: DataFrame | None = None, mode: str = "pair",
    names: Mapping[str, DataFrame] = {},
) -> DataFrame:
    """All checks over the newest batch of each source (tables with `batch_id`), as one plan.

    names: the batches of a source (`batch_names`), so that the folders of older ones are not read.
    """
    prefix = [source_prefix(F.col(BATCH))]
    newest = {name: latest_batch(df, prefix, names=names.get(name)) for name, df in sources.items()}
    return quality_checks(union_sources(newest), rules, pairs, mode)
