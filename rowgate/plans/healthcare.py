"""Contracts for seven tables of clinical records.

Dates are stored as ISO text and booleans as ``True`` / ``False`` text.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import (
    affirmative,
    age_in_years,
    category_or_default,
    category_or_upper,
    clamp,
    date_text,
    fahrenheit_to_celsius,
    flag,
    flag_text,
    has_operator_prefix,
    money,
    over_limit,
    parse_date,
    parse_timestamp,
    strip_operator_prefix,
    strip_trailing_punctuation,
    title_case,
    to_double,
)
from ..operators.checks import (
    DateBetween,
    HasParent,
    NoOutliers,
    NotNull,
    NumberBetween,
    Pattern,
    UniqueKey,
)
from ..operators.enrich import Dimension
from ..operators.histogram import Axis
from ..operators.rules import Matches, NotAfter, Required, Within
from .contract import NotOutlying, References, TableContract, Unique


def _flag(c):
    return flag_text(flag(c))


def _each(rule, *names):
    return dict.fromkeys(names, rule)


def _not_null(*names):
    return [Required(f"null {name}", name) for name in names]


def _parsed_date(name):
    return Required(f"unparseable date in {name}", name)


def _adherence(c):
    return clamp(to_double(c), *fixed.ADHERENCE_RANGE)


def _overcap(c):
    return over_limit(to_double(c), fixed.ADHERENCE_RANGE[1])


def _range_and_outliers(label, column, low, high):
    return [
        NumberBetween(f"{label}_range", column, low, high),
        NoOutliers(f"{label}_zscore_outliers", column),
    ]


def healthcare(
    as_of: date,
    first_by: Mapping[str, tuple[str, ...]] | None = None,
    upper_provider_reference: bool = False,
) -> dict[str, TableContract]:
    """The contracts, in report order.

    ``as_of`` is today for ages and future dates. ``first_by`` names per table the columns
    that decide which copy of a key comes first; without it, scan order does.
    Provider ids are upper-cased among providers but not in encounters, so an id in lower
    case there has no parent; ``upper_provider_reference=True`` upper-cases both.
    """
    first_by = first_by or {}
    today = as_of.isoformat()

    def unique(table, key):
        return Unique((key,), tuple(first_by.get(table, ())))

    of_encounter = References("encounter_id", "encounters")
    provider_reference = _each(F.upper, "provider_id") if upper_provider_reference else {}
    contracts = [
        TableContract(
            "patients",
            "patient_id",
            columns={
                **_each(F.upper, "patient_id"),
                **_each(date_text, "date_of_birth", "registration_date"),
                "gender": lambda c: category_or_default(c, fixed.GENDERS, fixed.GENDER_OTHER),
                "active": _flag,
            },
            derived={"age": ("date_of_birth", lambda c: age_in_years(parse_date(c), as_of))},
            rules=[
                *_not_null("patient_id"),
                _parsed_date("date_of_birth"),
                NotAfter("future date_of_birth", "date_of_birth", as_of),
                unique("patients", "patient_id"),
            ],
            checks=[
                NotNull("null_patient_id", "patient_id"),
                DateBetween("future_dob", "date_of_birth", latest=today),
                DateBetween("dob_before_1900", "date_of_birth", earliest=fixed.OLDEST_DATE),
                UniqueKey("duplicate_pk", "patient_id"),
            ],
        ),
        TableContract(
            "encounters",
            "encounter_id",
            columns={
                **_each(F.upper, "encounter_id", "patient_id"),
                **provider_reference,
                "encounter_date": date_text,
                **_each(money, "total_charge_usd", "insurance_paid_usd", "patient_paid_usd"),
                "follow_up_required": _flag,
            },
            rules=[
                *_not_null("encounter_id", "patient_id"),
                _parsed_date("encounter_date"),
                unique("encounters", "encounter_id"),
                References("patient_id", "patients"),
                References("provider_id", "providers"),
            ],
            checks=[
                NotNull("null_encounter_id", "encounter_id"),
                DateBetween("future_encounter_date", "encounter_date", latest=today),
                DateBetween(
                    "encounter_date_before_1900", "encounter_date", earliest=fixed.OLDEST_DATE
                ),
                HasParent("fk_patient_id", "patient_id", "patients"),
                HasParent("fk_provider_id", "provider_id", "providers"),
                UniqueKey("duplicate_pk", "encounter_id"),
            ],
        ),
        TableContract(
            "diagnoses",
            "diagnosis_id",
            columns={
                **_each(F.upper, "diagnosis_id", "encounter_id", "icd10_code"),
                "onset_date": date_text,
                **_each(_flag, "resolved", "chronic", "confirmed"),
            },
            rules=[
                *_not_null("diagnosis_id", "encounter_id", "icd10_code"),
                Matches("malformed icd10_code", "icd10_code", fixed.ICD10),
                unique("diagnoses", "diagnosis_id"),
                of_encounter,
            ],
            checks=[
                NotNull("null_diagnosis_id", "diagnosis_id"),
                DateBetween("onset_date_before_1900", "onset_date", earliest=fixed.OLDEST_DATE),
                HasParent("fk_encounter_id", "encounter_id", "encounters"),
                Pattern("icd10_format", "icd10_code", fixed.ICD10),
                UniqueKey("duplicate_pk", "diagnosis_id"),
            ],
        ),
        TableContract(
            "lab_results",
            "lab_id",
            columns={
                **_each(F.upper, "lab_id", "encounter_id", "patient_id"),
                "result_value": strip_operator_prefix,
                **_each(parse_timestamp, "collection_datetime", "result_datetime"),
                **_each(_flag, "abnormal_flag", "critical_flag", "fasting"),
            },
            derived={"result_operator_flag": ("result_value", has_operator_prefix)},
            rules=[
                *_not_null("lab_id", "encounter_id", "patient_id"),
                unique("lab_results", "lab_id"),
                of_encounter,
            ],
            checks=[
                NotNull("null_lab_id", "lab_id"),
                HasParent("fk_encounter_id", "encounter_id", "encounters"),
                HasParent("fk_patient_id", "patient_id", "patients"),
                UniqueKey("duplicate_pk", "lab_id"),
            ],
        ),
        TableContract(
            "medications",
            "medication_id",
            columns={
                **_each(F.upper, "medication_id", "encounter_id", "patient_id"),
                "dosage": strip_trailing_punctuation,
                "route": lambda c: category_or_upper(c, fixed.ROUTES),
                "adherence_rate_pct": _adherence,
                "status": title_case,
                "adverse_reaction": _flag,
                **_each(date_text, "start_date", "end_date"),
            },
            derived={"adherence_overcap_flag": ("adherence_rate_pct", _overcap)},
            rules=[
                *_not_null("medication_id", "encounter_id", "patient_id"),
                unique("medications", "medication_id"),
                NotOutlying(("adherence_rate_pct",)),
                of_encounter,
            ],
            checks=[
                NotNull("null_medication_id", "medication_id"),
                HasParent("fk_encounter_id", "encounter_id", "encounters"),
                HasParent("fk_patient_id", "patient_id", "patients"),
                NumberBetween("adherence_rate_range", "adherence_rate_pct", *fixed.ADHERENCE_RANGE),
                NoOutliers("adherence_rate_zscore", "adherence_rate_pct"),
                UniqueKey("duplicate_pk", "medication_id"),
            ],
        ),
        TableContract(
            "providers",
            "provider_id",
            columns={
                **_each(F.upper, "provider_id", "state"),
                "board_certified": lambda c: flag_text(affirmative(c)),
                "accepting_patients": _flag,
            },
            rules=[
                *_not_null("provider_id", "npi"),
                unique("providers", "provider_id"),
            ],
            checks=[
                NotNull("null_provider_id", "provider_id"),
                UniqueKey("duplicate_pk", "provider_id"),
            ],
        ),
        TableContract(
            "vitals",
            "vitals_id",
            columns={
                **_each(F.upper, "vitals_id", "encounter_id", "recorded_by"),
                "recorded_datetime": parse_timestamp,
                "temperature_celsius": lambda c: fahrenheit_to_celsius(to_double(c)),
                **_each(to_double, *fixed.VITAL_RANGES),
            },
            rules=[
                *_not_null("vitals_id", "encounter_id"),
                unique("vitals", "vitals_id"),
                Within(fixed.OUT_OF_RANGE_VITAL, fixed.VITAL_RANGES),
                NotOutlying(fixed.VITAL_OUTLIER_ORDER),
                of_encounter,
            ],
            checks=[
                NotNull("null_vitals_id", "vitals_id"),
                HasParent("fk_encounter_id", "encounter_id", "encounters"),
                *_range_and_outliers("spo2", "spo2_pct", *fixed.VITAL_RANGES["spo2_pct"]),
                *_range_and_outliers(
                    "heart_rate", "heart_rate_bpm", *fixed.VITAL_RANGES["heart_rate_bpm"]
                ),
                *_range_and_outliers(
                    "temperature", "temperature_celsius", *fixed.TEMPERATURE_RANGE
                ),
                *_range_and_outliers(
                    "systolic_bp", "systolic_bp_mmhg", *fixed.VITAL_RANGES["systolic_bp_mmhg"]
                ),
                *_range_and_outliers(
                    "diastolic_bp", "diastolic_bp_mmhg", *fixed.VITAL_RANGES["diastolic_bp_mmhg"]
                ),
                UniqueKey("duplicate_pk", "vitals_id"),
            ],
        ),
    ]
    return {contract.name: contract for contract in contracts}


FACT = "encounters"
FACT_DIMENSIONS = [
    Dimension(
        "patients",
        "patient_id",
        {"date_of_birth": "date_of_birth", "gender": "gender", "insurance": "insurance"},
    ),
    Dimension(
        "providers",
        "provider_id",
        {"specialty": "provider_specialty", "board_certified": "provider_board_certified"},
    ),
]
CHARTS = [
    Axis("vitals", "spo2_pct", *fixed.VITAL_RANGES["spo2_pct"]),
    Axis("vitals", "heart_rate_bpm", *fixed.VITAL_RANGES["heart_rate_bpm"]),
    Axis("vitals", "temperature_celsius", *fixed.TEMPERATURE_RANGE),
    Axis("vitals", "systolic_bp_mmhg", *fixed.VITAL_RANGES["systolic_bp_mmhg"]),
    Axis("vitals", "diastolic_bp_mmhg", *fixed.VITAL_RANGES["diastolic_bp_mmhg"]),
    Axis("medications", "adherence_rate_pct", *fixed.ADHERENCE_RANGE),
]
SOURCE_FILES = {
    name: f"messy_{name}.csv"
    for name in (
        "patients", "providers", "encounters", "diagnoses", "lab_results", "medications", "vitals",
    )
}
