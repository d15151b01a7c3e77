"""The seven clinical contracts on messy tables that Spark derives from the test tables.

Patients come from customers, providers from suppliers, encounters from orders, diagnoses,
lab results and medications from order lines, vitals from events. The SQL answers from
the original columns, so it shares no parsing with the contracts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate import fixed_values as fixed
from rowgate.operators.checks import run_checks
from rowgate.operators.positions import with_positions
from rowgate.operators.enrich import enrich
from rowgate.operators.histogram import histograms
from rowgate.operators.split import clean_rows, rejections_by_reason
from rowgate.operators.verdict import verdicts
from rowgate.plans.healthcare import CHARTS, FACT, FACT_DIMENSIONS, healthcare
from rowgate.plans.lifecycle import tag_tables
from rowgate.session import spread
from rowgate.sources import StagingArea

from .book import pick, query
from .clinical_dirty import DECLARED
from .quality import VERDICT_SELECT, VERDICT_SQL, histogram_sql, verdict_text
from .scalars import BOOL_WORDS, DATE_LAYOUTS, written

AS_OF = date(2026, 6, 27)
RUN = "2026-06-27T12:00:00"
FIRST_BY = {
    "patients": ("source_row",),
    "providers": ("source_row",),
    "encounters": ("source_row",),
    "diagnoses": ("part", "supp", "cents"),
    "lab_results": ("part", "supp", "cents"),
    "medications": ("part", "supp", "cents"),
    "vitals": ("source_row",),
}


# ---- messy tables ------------------------------------------------------------------------


def _id(letter: str, key: str, mixed_by: str) -> str:
    """An id, written in lower case and with spaces in some rows."""
    return (
        f"concat(if({mixed_by} % 5 = 0, ' ', ''), if({mixed_by} % 3 = 0, '{letter.lower()}', "
        f"'{letter}'), lpad(cast({key} as string), 12, '0'), if({mixed_by} % 7 = 0, '  ', ''))"
    )


def _or(missing: str, when: str, value: str) -> Column:
    return F.expr(f"if({when}, '{missing}', {value})")


def _dated(column: str, key: str, bad_when: str, bad: str = "soon") -> Column:
    return F.when(F.expr(bad_when), bad).otherwise(written(column, key, DATE_LAYOUTS))


def _amount(column: str, key: str) -> Column:
    number = f"format_number({column}, 2)"
    return F.expr(
        f"case {key} % 4 when 0 then concat('$', {number}, ' USD') when 1 then {number} "
        f"when 2 then cast({column} as string) else concat('USD ', {number}) end"
    )


def _rounded(value: str) -> str:
    """A number rounded to a whole one as ``round`` does, half away from zero, but not by way of its text."""
    whole, half = f"floor(abs({value}))", f"abs({value}) - floor(abs({value})) >= 0.5D"
    number = f"if({value} < 0, -1L, 1L) * ({whole} + if({half}, 1L, 0L))"
    return f"if(abs({value}) < 1e15D, {number}, cast(round({value}) as bigint))"


def messy_patients(t) -> DataFrame:
    born = F.expr("date_add(date'1930-01-01', cast(c_custkey * 7919 % 25000 as int))")
    registered = F.expr("date_add(date'2015-01-01', cast(c_custkey % 3000 as int))")
    return t.customer.withColumns({"born": born, "registered": registered}).select(
        F.expr("lpad(cast(c_custkey as string), 12, '0')").alias("source_row"),
        _or(
            "N/A",
            "c_custkey % 50 = 7",
            _id("P", "if(c_custkey % 40 = 1, c_custkey - 1, c_custkey)", "c_custkey"),
        ).alias("patient_id"),
        _dated("born", "c_custkey", "c_custkey % 23 = 5", "unknown").alias("date_of_birth"),
        F.lit("999").alias("age"),
        _dated("registered", "c_custkey", "c_custkey % 6 = 0", "Not Provided").alias(
            "registration_date"
        ),
        pick("c_custkey", "MALE", "m", "Female", "F", "woman", "Non-Binary", "nonbinary",
             "non binary", "agender", "-").alias("gender"),
        pick("c_custkey", *BOOL_WORDS).alias("active"),
        F.concat(F.lit(" "), "c_mktsegment").alias("insurance"),
    )


def messy_providers(t) -> DataFrame:
    return t.supplier.select(
        F.expr("lpad(cast(s_suppkey as string), 12, '0')").alias("source_row"),
        _or(
            "null", "s_suppkey % 21 = 8", _id("Q", "if(s_suppkey % 25 = 1, s_suppkey - 1, s_suppkey)", "s_suppkey")
        ).alias("provider_id"),
        _or("-", "s_suppkey % 20 = 3", "cast(s_suppkey as string)").alias("npi"),
        F.expr("concat('st', s_nationkey)").alias("state"),
        F.expr("concat('Specialty ', s_nationkey, ' ')").alias("specialty"),
        pick("s_suppkey", "Y", "yes", "True", "1", "pending", "N", "").alias("board_certified"),
        pick("s_suppkey", *BOOL_WORDS).alias("accepting_patients"),
    )


def messy_encounters(t) -> DataFrame:
    patient = "if(o_orderkey % 37 = 5, o_custkey + 900000000, o_custkey)"
    provider = (
        "concat(if(o_orderkey % 29 = 3, 'q', 'Q'), "
        "lpad(cast(o_custkey div 15 as string), 12, '0'))"
    )
    return t.orders.select(
        F.expr("lpad(cast(o_orderkey as string), 15, '0')").alias("source_row"),
        _or(
            "null",
            "o_orderkey % 60 = 11",
            _id("E", "if(o_orderkey % 30 = 1, o_orderkey - 1, o_orderkey)", "o_orderkey"),
        ).alias("encounter_id"),
        _or("", "o_orderkey % 70 = 9", _id("P", patient, "o_custkey")).alias("patient_id"),
        _or("n/a", "o_orderkey % 31 = 4", provider).alias("provider_id"),
        _dated("o_orderdate", "o_orderkey", "o_orderkey % 41 = 6").alias("encounter_date"),
        _amount("o_totalprice", "o_orderkey").alias("total_charge_usd"),
        F.when(F.expr("o_orderkey % 6 = 0"), "free")
        .otherwise(_amount("o_totalprice", "o_custkey"))
        .alias("insurance_paid_usd"),
        F.lit("$0.00").alias("patient_paid_usd"),
        pick("o_orderkey", *BOOL_WORDS).alias("follow_up_required"),
    )


def _line_columns(letter: str):
    """Id, order columns and encounter of a table made of order lines."""
    return [
        _or("N/A", "l_partkey % 70 = 12", f"concat('{letter.lower()}', l_orderkey, '-', l_linenumber)"),
        F.col("l_partkey").cast("string").alias("part"),
        F.col("l_suppkey").cast("string").alias("supp"),
        F.expr(f"cast({_rounded('(l_extendedprice * 100)')} as string)").alias("cents"),
        _or("-", "l_partkey % 90 = 8", _id("E", "l_orderkey", "l_partkey")).alias("encounter_id"),
    ]


_LINE_PATIENT = _id("P", "l_partkey * 3 div 4", "l_suppkey")


def messy_diagnoses(t) -> DataFrame:
    key, *rest = _line_columns("D")
    return t.lineitem.select(
        key.alias("diagnosis_id"),
        *rest,
        F.expr(
            "case when l_partkey % 11 = 0 then 'bad' when l_partkey % 12 = 5 then 'n/a' "
            "else concat('a', lpad(cast(l_partkey % 100 as string), 2, '0'), '.1x') end"
        ).alias("icd10_code"),
        _dated("l_shipdate", "l_partkey", "l_partkey % 16 = 2", "unknown").alias("onset_date"),
        pick("l_partkey", *BOOL_WORDS).alias("resolved"),
        pick("l_suppkey", *BOOL_WORDS).alias("chronic"),
        pick("l_orderkey", *BOOL_WORDS).alias("confirmed"),
    )


def messy_lab_results(t) -> DataFrame:
    key, *rest = _line_columns("L")
    # Not a column of its own: between the scan and the positions it would keep all that is known of the file in each row.
    taken = "(l_shipdate + (l_linenumber * interval '1' hour + interval '30:15' minute to second))"
    return t.lineitem.select(
        key.alias("lab_id"),
        *rest,
        _or("null", "l_partkey % 80 = 6", _LINE_PATIENT).alias("patient_id"),
        F.expr(
            "case l_partkey % 5 when 0 then concat('> ', l_suppkey) when 1 then "
            "concat('<=', l_suppkey) when 2 then 'n/a' else cast(l_suppkey as string) end"
        ).alias("result_value"),
        written(taken, "l_partkey", fixed.TIMESTAMP_FORMATS).alias("collection_datetime"),
        _or("pending", "l_partkey % 9 = 0", f"date_format({taken}, 'MM/dd/yyyy HH:mm:ss')").alias(
            "result_datetime"
        ),
        pick("l_partkey", *BOOL_WORDS).alias("abnormal_flag"),
        pick("l_suppkey", *BOOL_WORDS).alias("critical_flag"),
        pick("l_orderkey", *BOOL_WORDS).alias("fasting"),
    )


def messy_medications(t) -> DataFrame:
    key, *rest = _line_columns("M")
    return t.lineitem.select(
        key.alias("medication_id"),
        *rest,
        _or("null", "l_partkey % 80 = 6", _LINE_PATIENT).alias("patient_id"),
        F.expr("concat(l_suppkey, 'mg', if(l_partkey % 3 = 0, ' . ', '..'))").alias("dosage"),
        pick("l_partkey", "p.o.", "PO", "Oral", "iv", "Im", "sq", "Topical", "inhaled", "rectal",
             "-").alias("route"),
        F.expr(
            "case when l_partkey % 13 = 1 then 'unknown' when l_partkey % 97 = 0 "
            "then cast(l_quantity - 10 as string) else cast(90 + l_quantity / 4 as string) end"
        ).alias("adherence_rate_pct"),
        pick("l_suppkey", "active", "on hold", "ON-hold", "DISCONTINUED", "").alias("status"),
        pick("l_partkey", *BOOL_WORDS).alias("adverse_reaction"),
        _dated("l_shipdate", "l_partkey", "l_partkey % 16 = 2", "unknown").alias("start_date"),
        F.lit("-").alias("end_date"),
    )


def messy_vitals(t) -> DataFrame:
    def reading(value: str):
        return F.expr(f"if(event_id % 33 = 2, 'n/a', cast({value} as string))")

    cents = _rounded("(value * 100)")
    return t.events.select(
        F.expr("lpad(cast(event_id as string), 15, '0')").alias("source_row"),
        _or(
            "NULL",
            "event_id % 45 = 4",
            _id("V", "if(event_id % 30 = 1, event_id - 1, event_id)", "event_id"),
        ).alias("vitals_id"),
        _or("-", "event_id % 50 = 14", _id("E", "event_id", "user_id")).alias("encounter_id"),
        written("ts", "event_id", fixed.TIMESTAMP_FORMATS).alias("recorded_datetime"),
        reading(f"if(event_id % 4 = 0, 98 + ({cents} % 60) / 10, 36.5D + value / 100)").alias(
            "temperature_celsius"
        ),
        reading(f"if(value > 300, 120, if(event_id % 500 = 17, 20, 90 + {cents} % 10))").alias("spo2_pct"),
        reading("40 + value").alias("heart_rate_bpm"),
        reading("80 + value / 4").alias("systolic_bp_mmhg"),
        reading("60 + value / 8").alias("diastolic_bp_mmhg"),
        pick("event_id", "15", "Null", "3").alias("glasgow_coma_scale"),
        F.expr("concat('nurse ', user_id)").alias("recorded_by"),
    )


MESSY = {
    "patients": messy_patients,
    "encounters": messy_encounters,
    "diagnoses": messy_diagnoses,
    "lab_results": messy_lab_results,
    "medications": messy_medications,
    "providers": messy_providers,
    "vitals": messy_vitals,
}


def tagged(t, *names: str) -> dict[str, DataFrame]:
    """The named tables tagged, and the tables they refer to."""
    contracts = healthcare(AS_OF, FIRST_BY)
    needed: set[str] = set()
    pending = list(names)
    while pending:
        name = pending.pop()
        needed.add(name)
        pending += contracts[name].parents
    chosen = {name: contracts[name] for name in contracts if name in needed}
    raw = {name: spread(with_positions(MESSY[name](t))) for name in chosen}
    return tag_tables(raw, chosen, StagingArea(t.spark))


def cleaned(t) -> dict[str, DataFrame]:
    return {name: clean_rows(df) for name, df in tagged(t, *MESSY).items()}


# ---- the same in SQL, from the original columns ------------------------------------------


def _sql_flag(key: str) -> str:
    return f"CASE WHEN {key} % 12 < 5 THEN 'True' WHEN {key} % 12 < 10 THEN 'False' END"


def _sql_date(column: str, key: str) -> str:
    """The date as read back: a two-digit year always lies in this century."""
    return (
        f"strftime(CASE WHEN {key} % 13 IN (3, 4) AND year({column}) < 2000 "
        f"THEN {column} + INTERVAL 100 YEAR ELSE {column} END, '%Y-%m-%d')"
    )


def _sql_time(column: str, key: str) -> str:
    """The time as read back from each layout, as text."""
    read = f"""CASE WHEN {key} % 17 = 0 THEN {column}
      WHEN {key} % 17 IN (4, 6, 8, 9, 10, 11) THEN date_trunc('minute', {column})
      WHEN {key} % 17 >= 12 THEN date_trunc('day', {column})
      ELSE date_trunc('second', {column}) END"""
    return (
        f"strftime(CASE WHEN {key} % 17 IN (9, 10, 11, 14, 15) AND year({column}) < 2000 "
        f"THEN {read} + INTERVAL 100 YEAR ELSE {read} END, '%Y-%m-%d %H:%M:%S')"
    )


def _sql_id(letter: str, key: str) -> str:
    return f"'{letter}' || lpad(({key})::VARCHAR, 12, '0')"


_LINES_SQL = f"""l_partkey::VARCHAR AS part, l_suppkey::VARCHAR AS supp,
    round(l_extendedprice * 100)::BIGINT::VARCHAR AS cents,
    CASE WHEN l_partkey % 90 <> 8 THEN {_sql_id("E", "l_orderkey")} END AS encounter_id"""


def _line_id_sql(letter: str) -> str:
    return f"CASE WHEN l_partkey % 70 <> 12 THEN '{letter}' || l_orderkey || '-' || l_linenumber END"


_LINE_PATIENT_SQL = f"CASE WHEN l_partkey % 80 <> 6 THEN {_sql_id('P', 'l_partkey * 3 // 4')} END"


def _dup(table: str, key: str) -> str:
    """Row rules done: mark the copies among the rows that are still accepted."""
    order = ", ".join(FIRST_BY[table])
    return (
        f"(SELECT *, CASE WHEN why0 IS NOT NULL THEN why0 WHEN row_number() OVER "
        f"(PARTITION BY {key}, why0 IS NULL ORDER BY {order}) > 1 "
        f"THEN 'duplicate primary key' END AS why1 FROM {table}_0)"
    )


def _child(table: str, source: str, why: str) -> str:
    return f"""{table} AS (SELECT x.*, CASE WHEN {why} IS NOT NULL THEN {why}
      WHEN e.k IS NULL THEN 'fk_encounter_id not in encounters' END AS rejection_reason
      FROM {source} x LEFT JOIN (SELECT encounter_id AS k FROM encounters
      WHERE rejection_reason IS NULL) e ON e.k = x.encounter_id)"""


SQL = {
    "patients": f"""
  patients_0 AS (SELECT *, CASE WHEN patient_id IS NULL THEN 'null patient_id'
      WHEN date_of_birth IS NULL THEN 'unparseable date in date_of_birth'
      WHEN date_of_birth > '{AS_OF}' THEN 'future date_of_birth' END AS why0,
      floor(date_diff('day', date_of_birth::DATE, DATE '{AS_OF}') / 365.25)::INTEGER AS age
    FROM (SELECT lpad(c_custkey::VARCHAR, 12, '0') AS source_row,
      CASE WHEN c_custkey % 50 <> 7 THEN {_sql_id("P", "CASE WHEN c_custkey % 40 = 1 THEN c_custkey - 1 ELSE c_custkey END")} END AS patient_id,
      CASE WHEN c_custkey % 23 <> 5 THEN {_sql_date("born", "c_custkey")} END AS date_of_birth,
      CASE WHEN c_custkey % 6 <> 0 THEN {_sql_date("registered", "c_custkey")} END
        AS registration_date,
      CASE c_custkey % 10 WHEN 0 THEN 'Male' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female'
        WHEN 3 THEN 'Female' WHEN 4 THEN 'Female' WHEN 8 THEN 'Other' WHEN 9 THEN NULL
        ELSE 'Non-binary' END AS gender,
      {_sql_flag("c_custkey")} AS active, c_mktsegment AS insurance
      FROM (SELECT *, DATE '1930-01-01' + (c_custkey * 7919 % 25000)::INTEGER AS born,
                   DATE '2015-01-01' + (c_custkey % 3000)::INTEGER AS registered FROM customer))),
  patients AS (SELECT *, why1 AS rejection_reason FROM {_dup("patients", "patient_id")})""",
    "providers": f"""
  providers_0 AS (SELECT *, CASE WHEN provider_id IS NULL THEN 'null provider_id'
      WHEN npi IS NULL THEN 'null npi' END AS why0 FROM
    (SELECT lpad(s_suppkey::VARCHAR, 12, '0') AS source_row,
      CASE WHEN s_suppkey % 21 <> 8 THEN
        {_sql_id("Q", "CASE WHEN s_suppkey % 25 = 1 THEN s_suppkey - 1 ELSE s_suppkey END")} END AS provider_id,
      CASE WHEN s_suppkey % 20 <> 3 THEN s_suppkey::VARCHAR END AS npi,
      'ST' || s_nationkey AS state, 'Specialty ' || s_nationkey AS specialty,
      CASE WHEN s_suppkey % 7 < 4 THEN 'True' WHEN s_suppkey % 7 < 6 THEN 'False' END
        AS board_certified,
      {_sql_flag("s_suppkey")} AS accepting_patients FROM supplier)),
  providers AS (SELECT *, why1 AS rejection_reason FROM {_dup("providers", "provider_id")})""",
    "encounters": f"""
  encounters_0 AS (SELECT *, CASE WHEN encounter_id IS NULL THEN 'null encounter_id'
      WHEN patient_id IS NULL THEN 'null patient_id'
      WHEN encounter_date IS NULL THEN 'unparseable date in encounter_date' END AS why0
    FROM (SELECT lpad(o_orderkey::VARCHAR, 15, '0') AS source_row,
      CASE WHEN o_orderkey % 60 <> 11 THEN {_sql_id("E", "CASE WHEN o_orderkey % 30 = 1 THEN o_orderkey - 1 ELSE o_orderkey END")} END AS encounter_id,
      CASE WHEN o_orderkey % 70 <> 9 THEN {_sql_id("P", "CASE WHEN o_orderkey % 37 = 5 THEN o_custkey + 900000000 ELSE o_custkey END")} END AS patient_id,
      CASE WHEN o_orderkey % 31 = 4 THEN NULL
           WHEN o_orderkey % 29 = 3 THEN {_sql_id("q", "o_custkey // 15")}
           ELSE {_sql_id("Q", "o_custkey // 15")} END AS provider_id,
      CASE WHEN o_orderkey % 41 <> 6 THEN {_sql_date("o_orderdate", "o_orderkey")} END
        AS encounter_date,
      o_totalprice AS total_charge_usd,
      CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice END AS insurance_paid_usd,
      0.0::DOUBLE AS patient_paid_usd, {_sql_flag("o_orderkey")} AS follow_up_required
      FROM orders)),
  encounters AS (SELECT x.*, CASE WHEN why1 IS NOT NULL THEN why1
      WHEN p.k IS NULL THEN 'fk_patient_id not in patients'
      WHEN q.k IS NULL THEN 'fk_provider_id not in providers' END AS rejection_reason
    FROM {_dup("encounters", "encounter_id")} x
    LEFT JOIN (SELECT patient_id AS k FROM patients WHERE rejection_reason IS NULL) p
      ON p.k = x.patient_id
    LEFT JOIN (SELECT provider_id AS k FROM providers WHERE rejection_reason IS NULL) q
      ON q.k = x.provider_id)""",
    "diagnoses": f"""
  diagnoses_0 AS (SELECT *, CASE WHEN diagnosis_id IS NULL THEN 'null diagnosis_id'
      WHEN encounter_id IS NULL THEN 'null encounter_id'
      WHEN icd10_code IS NULL THEN 'null icd10_code'
      WHEN icd10_code = 'BAD' THEN 'malformed icd10_code' END AS why0
    FROM (SELECT {_line_id_sql("D")} AS diagnosis_id, {_LINES_SQL},
      CASE WHEN l_partkey % 11 = 0 THEN 'BAD' WHEN l_partkey % 12 = 5 THEN NULL
        ELSE 'A' || lpad((l_partkey % 100)::VARCHAR, 2, '0') || '.1X' END AS icd10_code,
      CASE WHEN l_partkey % 16 <> 2 THEN {_sql_date("l_shipdate", "l_partkey")} END AS onset_date,
      {_sql_flag("l_partkey")} AS resolved, {_sql_flag("l_suppkey")} AS chronic,
      {_sql_flag("l_orderkey")} AS confirmed FROM lineitem)),
  {_child("diagnoses", _dup("diagnoses", "diagnosis_id"), "why1")}""",
    "lab_results": f"""
  lab_results_0 AS (SELECT *, CASE WHEN lab_id IS NULL THEN 'null lab_id'
      WHEN encounter_id IS NULL THEN 'null encounter_id'
      WHEN patient_id IS NULL THEN 'null patient_id' END AS why0
    FROM (SELECT {_line_id_sql("L")} AS lab_id, {_LINES_SQL},
      {_LINE_PATIENT_SQL} AS patient_id, l_partkey % 5 < 2 AS result_operator_flag,
      CASE WHEN l_partkey % 5 <> 2 THEN l_suppkey::VARCHAR END AS result_value,
      {_sql_time("taken", "l_partkey")} AS collection_datetime,
      CASE WHEN l_partkey % 9 <> 0 THEN strftime(taken, '%Y-%m-%d %H:%M:%S') END AS result_datetime,
      {_sql_flag("l_partkey")} AS abnormal_flag, {_sql_flag("l_suppkey")} AS critical_flag,
      {_sql_flag("l_orderkey")} AS fasting
      FROM (SELECT *, l_shipdate + to_hours(l_linenumber) + INTERVAL '30 minutes 15 seconds'
            AS taken FROM lineitem))),
  {_child("lab_results", _dup("lab_results", "lab_id"), "why1")}""",
    "medications": f"""
  medications_0 AS (SELECT *, CASE WHEN medication_id IS NULL THEN 'null medication_id'
      WHEN encounter_id IS NULL THEN 'null encounter_id'
      WHEN patient_id IS NULL THEN 'null patient_id' END AS why0
    FROM (SELECT {_line_id_sql("M")} AS medication_id, {_LINES_SQL},
      {_LINE_PATIENT_SQL} AS patient_id, l_suppkey || 'mg' AS dosage,
      CASE l_partkey % 10 WHEN 0 THEN 'PO' WHEN 1 THEN 'PO' WHEN 2 THEN 'PO' WHEN 3 THEN 'IV'
        WHEN 4 THEN 'IM' WHEN 5 THEN 'SQ' WHEN 6 THEN 'TOPICAL' WHEN 7 THEN 'INHALED'
        WHEN 8 THEN 'RECTAL' END AS route,
      CASE WHEN rate > 100 THEN 100 WHEN rate < 0 THEN 0 ELSE rate END AS adherence_rate_pct,
      coalesce(rate > 100, false) AS adherence_overcap_flag,
      CASE l_suppkey % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'On Hold' WHEN 2 THEN 'On-hold'
        WHEN 3 THEN 'Discontinued' END AS status,
      {_sql_flag("l_partkey")} AS adverse_reaction,
      CASE WHEN l_partkey % 16 <> 2 THEN {_sql_date("l_shipdate", "l_partkey")} END AS start_date,
      NULL::VARCHAR AS end_date
      FROM (SELECT *, CASE WHEN l_partkey % 13 = 1 THEN NULL WHEN l_partkey % 97 = 0
        THEN l_quantity - 10 ELSE 90 + l_quantity / 4 END AS rate FROM lineitem))),
  medications_1 AS (SELECT * FROM {_dup("medications", "medication_id")}),
  medications_2 AS (SELECT d.*, CASE WHEN why1 IS NOT NULL THEN why1
      WHEN abs((adherence_rate_pct - m) / s) > 3 THEN 'zscore_outlier_adherence_rate_pct' END AS why2
    FROM medications_1 d, (SELECT avg(adherence_rate_pct) AS m, stddev_samp(adherence_rate_pct) AS s
                           FROM medications_1 WHERE why1 IS NULL)),
  {_child("medications", "medications_2", "why2")}""",
    "vitals": f"""
  vitals_0 AS (SELECT *, CASE WHEN vitals_id IS NULL THEN 'null vitals_id'
      WHEN encounter_id IS NULL THEN 'null encounter_id' END AS why0
    FROM (SELECT lpad(event_id::VARCHAR, 15, '0') AS source_row,
      CASE WHEN event_id % 45 <> 4 THEN {_sql_id("V", "CASE WHEN event_id % 30 = 1 THEN event_id - 1 ELSE event_id END")} END AS vitals_id,
      CASE WHEN event_id % 50 <> 14 THEN {_sql_id("E", "event_id")} END AS encounter_id,
      {_sql_time("ts", "event_id")} AS recorded_datetime,
      CASE WHEN event_id % 33 = 2 THEN NULL WHEN event_id % 4 = 0
        THEN round((98 + (cents % 60) / 10 - 32) * 5.0::DOUBLE / 9.0::DOUBLE, 2)
        ELSE 36.5::DOUBLE + value / 100 END AS temperature_celsius,
      CASE WHEN event_id % 33 <> 2 THEN CASE WHEN value > 300 THEN 120.0
        WHEN event_id % 500 = 17 THEN 20 ELSE 90 + cents % 10 END END::DOUBLE AS spo2_pct,
      CASE WHEN event_id % 33 <> 2 THEN 40 + value END AS heart_rate_bpm,
      CASE WHEN event_id % 33 <> 2 THEN 80 + value / 4 END AS systolic_bp_mmhg,
      CASE WHEN event_id % 33 <> 2 THEN 60 + value / 8 END AS diastolic_bp_mmhg,
      CASE event_id % 3 WHEN 0 THEN '15' WHEN 2 THEN '3' END AS glasgow_coma_scale,
      'NURSE ' || user_id AS recorded_by
      FROM (SELECT *, round(value * 100)::BIGINT AS cents FROM events))),
  vitals_1 AS (SELECT *, CASE WHEN why1 IS NOT NULL THEN why1
      WHEN spo2_pct > 100 OR spo2_pct < 0 OR heart_rate_bpm > 300 OR heart_rate_bpm < 20
        OR systolic_bp_mmhg > 250 OR systolic_bp_mmhg < 50 OR diastolic_bp_mmhg > 150
        OR diastolic_bp_mmhg < 30 THEN 'out-of-range vital sign' END AS z0
    FROM {_dup("vitals", "vitals_id")}),
  """
    + ",\n  ".join(
        f"""vitals_{i + 2} AS (SELECT v.*, CASE WHEN z{i} IS NOT NULL THEN z{i}
      WHEN abs(({c} - m) / nullif(s, 0)) > 3 THEN 'zscore_outlier_{c}' END AS z{i + 1}
    FROM vitals_{i + 1} v, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM vitals_{i + 1}
                            WHERE z{i} IS NULL))"""
        for i, c in enumerate(fixed.VITAL_OUTLIER_ORDER)
    )
    + f""",
  {_child("vitals", "vitals_6", "z5")}""",
}
_PARENTS = {"encounters": ("patients", "providers")}


def with_tables(*names: str) -> str:
    """The WITH clause that defines the named tables and what they refer to."""
    order = ["patients", "providers", "encounters"]
    if names == ("patients",) or names == ("providers",):
        order = list(names)
    order += [n for n in names if n not in order]
    return "WITH " + ",".join(SQL[n] for n in order)


COLUMNS = {
    "patients": "source_row patient_id date_of_birth age registration_date gender active insurance",
    "providers": "source_row provider_id npi state specialty board_certified accepting_patients",
    "encounters": "source_row encounter_id patient_id provider_id encounter_date total_charge_usd "
    "insurance_paid_usd patient_paid_usd follow_up_required",
    "diagnoses": "diagnosis_id part supp cents encounter_id icd10_code onset_date resolved chronic "
    "confirmed",
    "lab_results": "lab_id part supp cents encounter_id patient_id result_value "
    "result_operator_flag collection_datetime result_datetime abnormal_flag critical_flag fasting",
    "medications": "medication_id part supp cents encounter_id patient_id dosage route "
    "adherence_rate_pct adherence_overcap_flag status adverse_reaction start_date end_date",
    "vitals": "source_row vitals_id encounter_id recorded_datetime temperature_celsius spo2_pct "
    "heart_rate_bpm systolic_bp_mmhg diastolic_bp_mmhg glasgow_coma_scale recorded_by",
}


def _times_as_text(df: DataFrame) -> DataFrame:
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times})


def _register_table(name: str) -> None:
    columns = [*COLUMNS[name].split(), "rejection_reason"]

    def build(t):
        return _times_as_text(tagged(t, name)[name].select(*columns))

    build.__name__ = f"clinical_{name}"
    build.__doc__ = f"{name}: every row normalised, with the reason it is rejected for."
    listed = ", ".join(columns)
    query(f"{with_tables(name)} SELECT {listed} FROM {name}")(build)


for _name in MESSY:
    _register_table(_name)


@query(
    with_tables(*MESSY)
    + " UNION ALL ".join(
        f""" SELECT '{name}' AS "table", rejection_reason, count(*) AS row_count
             FROM {name} GROUP BY ALL""" for name in MESSY
    )
)
def clinical_rejections(t):
    """Rows of every table per reason, the accepted ones under no reason."""
    parts = [rejections_by_reason(df, name) for name, df in tagged(t, *MESSY).items()]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def _checks(t, tables: dict[str, DataFrame], sample_size: int = 0) -> DataFrame:
    suites = [c.suite for c in healthcare(AS_OF, FIRST_BY).values()]
    area = StagingArea(t.spark)
    return area.stage(run_checks(tables, suites, RUN, sample_size, area), "check-results")


_ZSCORES = [
    ("vitals", "spo2", "spo2_pct"),
    ("vitals", "heart_rate", "heart_rate_bpm"),
    ("vitals", "temperature", "temperature_celsius"),
    ("vitals", "systolic_bp", "systolic_bp_mmhg"),
    ("vitals", "diastolic_bp", "diastolic_bp_mmhg"),
]


def _outliers_sql(table: str, check: str, column: str) -> str:
    return f"""SELECT '{table}', '{check}', count(*) FROM {table}_c,
      (SELECT avg({column}) AS m, stddev_samp({column}) AS s FROM {table}_c)
      WHERE abs(({column} - m) / s) > 3"""


_CLEAN_SQL = ", ".join(
    f"{name}_c AS (SELECT * FROM {name} WHERE rejection_reason IS NULL)" for name in MESSY
)
_FAILS_SQL = (
    f"""fails(t, c, n) AS (
  SELECT 'encounters', 'future_encounter_date', count(*) FROM encounters_c
    WHERE encounter_date > '{AS_OF}'
  UNION ALL SELECT 'lab_results', 'fk_patient_id', count(*) FROM lab_results_c
    WHERE patient_id NOT IN (SELECT patient_id FROM patients_c)
  UNION ALL SELECT 'medications', 'fk_patient_id', count(*) FROM medications_c
    WHERE patient_id NOT IN (SELECT patient_id FROM patients_c)
  UNION ALL SELECT 'vitals', 'temperature_range', count(*) FROM vitals_c
    WHERE temperature_celsius < 34 OR temperature_celsius > 42
  UNION ALL """
    + _outliers_sql("medications", "adherence_rate_zscore", "adherence_rate_pct")
    + "".join(
        " UNION ALL " + _outliers_sql(table, f"{label}_zscore_outliers", column)
        for table, label, column in _ZSCORES
    )
    + ")"
)


def _declared_sql() -> str:
    rows = [f"('{table}', '{check}', {i})" for i, (table, check) in enumerate(DECLARED)]
    return f"declared(t, c, ord) AS (VALUES {', '.join(rows)})"


_TOTALS_SQL = "totals(t, n) AS (" + " UNION ALL ".join(
    f"SELECT '{name}', count(*) FROM {name}_c" for name in MESSY
) + ")"
_RES_SQL = f"""{with_tables(*MESSY)}, {_CLEAN_SQL}, {_FAILS_SQL}, {_declared_sql()}, {_TOTALS_SQL},
  res AS (SELECT d.t, d.c, d.ord, totals.n AS rows, coalesce(fails.n, 0) AS fails
          FROM declared d JOIN totals ON totals.t = d.t
          LEFT JOIN fails ON fails.t = d.t AND fails.c = d.c)"""


@query(
    f"""{_RES_SQL} SELECT t AS "table", c AS "check", ord, rows AS row_count,
        fails AS fail_count, fails = 0 AS pass FROM res"""
)
def clinical_report(t):
    """The forty checks on the cleaned tables."""
    return _checks(t, cleaned(t)).select("table", "check", "ord", "row_count", "fail_count", "pass")


@query(f"{_RES_SQL}, {VERDICT_SQL} {VERDICT_SELECT.format(run=RUN, where='')}")
def clinical_verdict(t):
    return verdict_text(verdicts(_checks(t, cleaned(t))))


@query(
    f"""{with_tables("encounters")}
        SELECT e.* EXCLUDE (why0, why1, rejection_reason), date_of_birth, gender, insurance,
               specialty AS provider_specialty, board_certified AS provider_board_certified
        FROM encounters e
        LEFT JOIN (SELECT patient_id, date_of_birth, gender, insurance FROM patients
                   WHERE rejection_reason IS NULL) p ON p.patient_id = e.patient_id
        LEFT JOIN (SELECT provider_id, specialty, board_certified FROM providers
                   WHERE rejection_reason IS NULL) q ON q.provider_id = e.provider_id
        WHERE e.rejection_reason IS NULL"""
)
def clinical_gold(t):
    """Accepted encounters with attributes of their accepted patients and providers."""
    tables = {name: clean_rows(df) for name, df in tagged(t, FACT).items()}
    return enrich(tables[FACT], tables, FACT_DIMENSIONS)


@query(
    f"{with_tables(*MESSY)}, {_CLEAN_SQL}"
    + " UNION ALL ".join(histogram_sql(axis, f"{axis.table}_c") for axis in CHARTS)
)
def clinical_histograms(t):
    """The six charted columns of the cleaned tables, fifty bins each."""
    tables = {n: clean_rows(df) for n, df in tagged(t, "vitals", "medications").items()}
    counted = histograms(tables, CHARTS)
    return counted.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})
