"""Stage 1: a delivery to canonical rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from labtrail.operators.conflicts import SAMPLE_PARAMETER, exclude_conflicts
from labtrail.rules import ProjectRules
from labtrail.sources.nested import flatten_results
from labtrail.sources.sheets import (
    canonical_from_flat,
    canonical_from_pair,
    drop_pending,
    filter_campaign,
    join_pair,
    resolve_flat,
    resolve_pair,
)


def intake_nested(
    documents: DataFrame, rules: ProjectRules, origin: str, selection: tuple[str, ...] = (), **layout
) -> DataFrame:
    """Nested documents of the accepted campaigns, one row per (sample, parameter)."""
    rows = flatten_results(documents, origin, **layout)
    return filter_campaign(rows, "campanha", names=rules.accepted_campaigns(selection))


def intake_flat(sheet: DataFrame, rules: ProjectRules, laboratory: str, origin: str) -> DataFrame:
    """A flat sheet: own proposals, without pending rows and conflicting results."""
    proposals = (*rules.campaigns, *rules.proposal_numbers)
    own = filter_campaign(resolve_flat(sheet), "proposta", contains=proposals)
    return canonical_from_flat(drop_pending(own, "situacao"), laboratory, origin).transform(
        exclude_conflicts, SAMPLE_PARAMETER, "resultadoOriginal"
    )


def canonical_pair(sample: DataFrame, analysis: DataFrame, laboratory: str, origin: str) -> DataFrame:
    """All rows of a two-table delivery, of whatever campaign."""
    return canonical_from_pair(join_pair(*resolve_pair(sample, analysis)), laboratory, origin)


def intake_pair(
    sample: DataFrame, analysis: DataFrame, rules: ProjectRules, laboratory: str, origin: str
) -> DataFrame:
    """A two-table delivery: own samples with their analyses, without conflicting results."""
    samples, analyses = resolve_pair(sample, analysis)
    proposals = (*rules.campaigns, *rules.proposal_numbers)
    own = filter_campaign(samples, "proposta", contains=proposals)
    return canonical_from_pair(join_pair(own, analyses), laboratory, origin).transform(
        exclude_conflicts, SAMPLE_PARAMETER, "resultadoOriginal"
    )
