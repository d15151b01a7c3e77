"""Values that have to be exactly these for results to agree."""

# --- Fixed values: strings that stand for "no value" (compared in lower case).
SENTINELS = ("", "-", "n/a", "not provided", "null")

# --- Fixed values: spellings of true and false (compared in lower case).
TRUE_WORDS = ("true", "yes", "y", "1", "t")
FALSE_WORDS = ("false", "no", "n", "0", "f")
AFFIRMATIVE_WORDS = ("y", "yes", "true", "1")

# --- Fixed values: date layouts, first match wins.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "M/d/yyyy",
    "MM/dd/yy",
    "M/d/yy",
    "dd-MM-yyyy",
    "d-M-yyyy",
    "yyyy/MM/dd",
    "MMMM dd, yyyy",
    "MMMM d, yyyy",
)

# --- Fixed values: timestamp layouts, first match wins.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "MM/dd/yy hh:mm a",
    "M/d/yy h:mm a",
    "MM/dd/yy HH:mm",
    "yyyy/MM/dd",
    "dd-MM-yyyy",
    "MM/dd/yy",
    "M/d/yy",
    "yyyy-MM-dd",
)

# --- Fixed values: category spellings (compared in lower case).
GENDERS = {
    "male": "Male",
    "m": "Male",
    "female": "Female",
    "f": "Female",
    "woman": "Female",
    "non-binary": "Non-binary",
    "nonbinary": "Non-binary",
    "non binary": "Non-binary",
}
GENDER_OTHER = "Other"
ROUTES = {
    "p.o.": "PO",
    "po": "PO",
    "oral": "PO",
    "iv": "IV",
    "im": "IM",
    "sq": "SQ",
    "topical": "TOPICAL",
    "inhaled": "INHALED",
}

# --- Fixed values: patterns.
ICD10 = r"^[A-Z][0-9]{2}(\.[A-Z0-9]{1,4})?$"
OPERATOR_PREFIX = r"^[><=!]"
OPERATOR_PREFIX_RUN = r"^[><=!]+\s*"
TRAILING_PUNCTUATION = r"[\s.]+$"
NOT_MONEY = r"[^\d.]"

# --- Fixed values: numbers.
DAYS_PER_YEAR = 365.25
Z_THRESHOLD = 3.0
FAHRENHEIT_ABOVE = 50
CRITICAL_SHARE = 0.05
SAMPLE_SIZE = 5
HISTOGRAM_BINS = 50
OLDEST_DATE = "1900-01-01"
VITAL_RANGES = {
    "spo2_pct": (0.0, 100.0),
    "heart_rate_bpm": (20.0, 300.0),
    "systolic_bp_mmhg": (50.0, 250.0),
    "diastolic_bp_mmhg": (30.0, 150.0),
}
TEMPERATURE_RANGE = (34.0, 42.0)
ADHERENCE_RANGE = (0.0, 100.0)
VITAL_OUTLIER_ORDER = (
    "spo2_pct",
    "heart_rate_bpm",
    "temperature_celsius",
    "systolic_bp_mmhg",
    "diastolic_bp_mmhg",
)

# --- Fixed values: rejection reasons.
DUPLICATE_KEY = "duplicate primary key"
OUT_OF_RANGE_VITAL = "out-of-range vital sign"

# --- Fixed values: severity of a failed check.
CRITICAL_CHECKS = ("duplicate_pk", "icd10_format")
CRITICAL_PREFIXES = ("null_", "fk_")

# --- Fixed values: verdict texts (format strings, so a percent sign is doubled).
WHY_NULL = "null primary key."
WHY_DUPLICATE = "duplicate primary keys."
WHY_ORPHAN = "foreign key violation — referential integrity broken."
WHY_PATTERN = "malformed ICD-10 code."
WHY_SHARE = "exceeds 5%% failure threshold (%s of table)."
CRITICAL_CAUSE = "%s: %d rows (%s) — CRITICAL: %s"
MINOR_CAUSE = "%s: %d rows — MINOR: low count, no referential integrity impact."
CRITICAL_ADVICE = "Investigate and resolve %s before re-running the pipeline."
MINOR_ADVICE = "Review %s — acceptable to publish with monitoring."
SUMMARY_OVERALL_PASS = "All quality checks passed with no failures detected across all tables."
SUMMARY_NOTHING_FAILED = "All quality checks passed — data is safe to publish to the Gold layer."
SUMMARY_MINOR = (
    "%d minor quality issue(s) detected but no critical failures — "
    "data is safe to publish with warnings."
)
SUMMARY_CRITICAL = (
    "%d critical failure(s) detected — "
    "Gold layer write is blocked until issues are resolved."
)
