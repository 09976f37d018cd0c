"""Rule set for quarterly household labour-survey microdata."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldbook.functions import is_finite
from fieldbook.learning.features import FeatureSpec
from fieldbook.operators.funnel import Criterion
from fieldbook.operators.harmonise import CodeRule, DurationRule, HarmoniseRules
from fieldbook.operators.splits import TemporalSplit
from fieldbook.sources.spec import SourceSpec

# --- Fixed values of the survey: columns, dictionaries, periods and sizes -------------

SOURCE_COLUMNS = (
    "NUM_HOGAR",
    "NUM_PERSONA",
    "FACTOR",
    "ANIO",
    "TRIMESTRE",
    "P02A03",
    "OCUPADOS",
    "P05C16",
    "P05D01",
    "P05C07A",
    "P05C07B",
    "P05H01A",
    "P03A03A",
    "DOMINIO",
)

EDUCATION = {
    "0": "Ninguno",
    "1": "Preprimaria",
    "2": "Primaria",
    "3": "Basico",
    "4": "Diversificado",
    "5": "Superior",
    "6": "Maestria",
    "7": "Doctorado",
}
OCCUPATION = {
    "1": "Empleado de gobierno",
    "2": "Empleado de empresa privada",
    "3": "Jornalero o peon",
    "4": "Servicio domestico",
}
AREA = {
    "1": "Urbano Metropolitano",
    "2": "Resto Urbano",
    "3": "Rural Nacional",
}

# period: (year, quarter, rows, columns)
PERIODS = {
    "2025T1": (2025, 1, 51_588, 270),
    "2025T2": (2025, 2, 51_167, 270),
    "2025T3": (2025, 3, 51_583, 270),
    "2025T4": (2025, 4, 49_338, 302),
    "2026T1": (2026, 1, 49_843, 270),
}

SPLIT = TemporalSplit(
    train=("2025T1", "2025T2", "2025T3"), validation=("2025T4",), test=("2026T1",)
)
KEYS = ("period", "NUM_HOGAR", "NUM_PERSONA")

# --- Rules ----------------------------------------------------------------------------

RULES = HarmoniseRules(
    numbers={
        "age": "P02A03",
        "employed": "OCUPADOS",
        "monthly_pay": "P05D01",
        "tenure_years": "P05C07A",
        "tenure_months": "P05C07B",
        "weekly_hours": "P05H01A",
        "weight": "FACTOR",
    },
    codes=(
        CodeRule("P03A03A", "education_code", "education", EDUCATION),
        CodeRule("P05C16", "occupation_code", "occupation", OCCUPATION),
        CodeRule("DOMINIO", "area_code", "area", AREA),
    ),
    durations=(DurationRule("tenure", "tenure_years", "tenure_months"),),
)

FEATURES = FeatureSpec(
    numeric=("age", "tenure", "weekly_hours"),
    categorical=("education", "occupation", "area"),
    label="monthly_pay",
)
PROFILED = ("monthly_pay", "age", "tenure", "weekly_hours")
CLUSTER_FEATURE_SETS = {
    "work": ("age", "tenure", "weekly_hours"),
    "work_and_pay": ("age", "tenure", "weekly_hours", "monthly_pay"),
}


def eligibility(
    age: str = "age",
    active: str = "employed",
    job_code: str = "occupation_code",
    pay: str = "monthly_pay",
    years: str = "tenure_years",
    months: str = "tenure_months",
    tenure: str = "tenure",
    hours: str = "weekly_hours",
    job_codes: tuple[str, ...] = tuple(OCCUPATION),
) -> list[Criterion]:
    """The seven ordered criteria of the eligible wage-earning population."""
    # NaN and infinity fail "in 0..11" and "at most 168", so these need no finite test.
    return [
        Criterion("age finite and at least 15", is_finite(age) & (F.col(age) >= 15)),
        Criterion("employed", F.col(active) == 1),
        Criterion("wage-earning job code", F.col(job_code).isin(*job_codes)),
        Criterion("pay finite and positive", is_finite(pay) & (F.col(pay) > 0)),
        Criterion(
            "tenure parts valid",
            is_finite(years)
            & (F.col(years) >= 0)
            & F.col(months).isin(*[float(month) for month in range(12)]),
        ),
        Criterion("tenure within age", F.col(tenure) <= F.col(age)),
        Criterion("weekly hours in (0, 168]", (F.col(hours) > 0) & (F.col(hours) <= 168)),
    ]


def sources(root: str, extension: str = "csv", format: str = "csv") -> list[SourceSpec]:
    """Contracts of the five quarterly sources, as ``<root>/<period>.<extension>``."""
    return [
        SourceSpec(
            path=f"{root}/{period}.{extension}",
            period=period,
            expected_rows=rows,
            expected_columns=columns,
            format=format,
            provenance={"file_year": year, "calendar_quarter": quarter},
        )
        for period, (year, quarter, rows, columns) in PERIODS.items()
    ]
