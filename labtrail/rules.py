"""Rules a project brings along: fixed value lists and the per-project settings.

The lists below are data. Operators take them as arguments (or as rule tables), so a project with other
rules passes its own instead of editing code.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# --- fixed values: date formats, tried in this order -------------------------------------------------
RESULT_DATE_FORMATS = (
    "dd/MM/yyyy HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yy HH:mm",
    "MM-dd-yy HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
)
SHEET_DATE_FORMATS = (
    "dd/MM/yy HH:mm",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yy",
    "dd/MM/yyyy",
    "dd-MM-yy HH:mm",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yy",
    "dd-MM-yyyy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)
DATE_COLUMNS = (
    "dataHoraAmostragem",
    "dataRecebLab",
    "dataEnvioLab",
    "dataHoraAnalise",
    "dataLiberacao",
)

# --- fixed values: matrices --------------------------------------------------------------------------
MATRIX_CODES = {"SO": "Solo", "ASUB": "Água Subterrânea"}
GROUNDWATER_ACCENTED = "Água Subterrânea"
GROUNDWATER = "Agua Subterranea"
SOIL = "Solo"
WATER_MATRICES = ("Agua Subterranea", "Fase livre")

PENDING_STATUS = "Recebida"

# --- fixed values: unit factors (from, to, factor); units compare exactly, case included ---------------
UNIT_FACTORS = (
    ("%", "mg/kg", 10000.0),
    ("dag/Kg", "mg/kg", 10000.0),
    ("dag/Kg", "mg/Kg", 10000.0),
    ("mg/dm³", "mg/kg", 1.0),
    ("mg/dm³", "mg/Kg", 1.0),
    ("-", "unit", 1.0),
    ("µg/L", "mg/L", 0.001),
    ("µg/L", "µg/L", 1.0),
    ("mg CaCO3/L", "mg/L", 1.0),
    ("NMP/100mL", "P/A", 1.0),
    ("mgO2/L", "mg/L", 1.0),
)

# --- fixed values: quality checks ----------------------------------------------------------------------
SURROGATES = (
    "Teor de Dibromofluorometano (%)",
    "Teor de Nitrobenzeno-d5 (%)",
    "Teor de Terfenil-d14 (%)",
    "Teor de 2-Fluorobifenil (%)",
    "Teor de 2.4.6-Tribromofenol (%)",
    "Teor de 4-Bromofluorbenzeno (VOC) (%)",
    "Teor de 1.2-Dicloroetano (%)",
    "Teor de Tolueno-d8 (%)",
    "2.6-Dibromofenol (%)",
)
SURROGATE_RANGE = (80, 120)
BLANK_CODES = ("BC", "BV", "BE")
CHROMIUM = {
    "dissolved": "Cromo Dissolvido (mg/L)",
    "hexavalent_dissolved": "Cromo Hexav Dissolvido (mg/L)",
    "hexavalent": "Cromo Hexavalente (mg/L)",
    "total": "Cromo Total (mg/L)",
}
# (species that must not exceed, the other species, message when it does)
CHROMIUM_RULES = (
    ("hexavalent_dissolved", "hexavalent", "Hexav Dissolvido > Hexavalente"),
    ("dissolved", "total", "Dissolvido > Total"),
    ("hexavalent_dissolved", "dissolved", "Hexav Dissolvido > Dissolvido"),
    ("hexavalent", "total", "Hexavalente > Total"),
)
RPD_LIMIT = 20

NO_FLAGS = "—"


@dataclass(frozen=True)
class ProjectRules:
    """What differs between projects. Only `campaigns` is needed; the rest switches features on."""

    campaigns: tuple[str, ...]
    extra_campaigns: tuple[str, ...] = ()
    proposal_numbers: tuple[str, ...] = ()
    source_project: str | None = None
    soil_groups: tuple[str, ...] = ()
    groundwater_groups: dict[str, str] = field(default_factory=dict)
    excluded_samples: tuple[str, ...] = ()
    surrogates: tuple[str, ...] = SURROGATES

    def accepted_campaigns(self, selection: tuple[str, ...] = ()) -> tuple[str, ...]:
        """An explicit selection replaces the configured campaigns."""
        return tuple(selection) or self.campaigns + self.extra_campaigns

    def has_scope(self) -> bool:
        """Scope checks need the planning groups of both matrices."""
        return bool(self.soil_groups and self.groundwater_groups)


def rule_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """A few rows of rules as a table. It comes by Arrow, so Spark holds it as local data of known size."""
    cells = list(zip(*rows))
    return spark.createDataFrame(pa.table({c: list(v) for c, v in zip(columns, cells)}))


def unit_factors(spark: SparkSession, rows=UNIT_FACTORS) -> DataFrame:
    """The conversion factors as a rule table `(unit_from, unit_to, factor)`."""
    return rule_table(spark, ("unit_from", "unit_to", "factor"), rows)
