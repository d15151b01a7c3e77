"""Column functions on derived messy text; the SQL answers from the original column."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowgate import fixed_values as fixed
from rowgate import functions as fn
from rowgate.operators.normalize import normalize
from rowgate.plans.healthcare import healthcare

from .book import query, pick

DATE_LAYOUTS = [*fixed.DATE_FORMATS, "yyyy-M-d", "yyyy/M/d", "MMM d, yyyy"]
AS_OF = date(2026, 6, 27)


def written(column: str, key: str, layouts) -> Column:
    """The date written in a layout chosen by the key."""
    arms = " ".join(
        f"when {i} then date_format({column}, '{layout}')"
        for i, layout in enumerate(f.replace("'", "\\'") for f in layouts)
    )
    return F.expr(f"case {key} % {len(layouts)} {arms} end")


BOOL_WORDS = ("Yes", "y", "TRUE", "1", "t", "No", "n", "false", "0", "F", "maybe", None)


@query("SELECT c_custkey, upper(c_name) AS customer_id FROM customer")
def upper_ids(t):
    ids = F.concat(F.lit("  "), F.lower("c_name")).alias("patient_id")
    rule = healthcare(AS_OF)["patients"].columns["patient_id"]
    cleaned = normalize(t.customer.select("c_custkey", ids), columns={"patient_id": rule})
    return cleaned.withColumnRenamed("patient_id", "customer_id")


@query(
    """SELECT c_custkey, CASE c_custkey % 10
         WHEN 0 THEN 'Male' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 3 THEN 'Female'
         WHEN 4 THEN 'Female' WHEN 5 THEN 'Non-binary' WHEN 6 THEN 'Non-binary'
         WHEN 7 THEN 'Non-binary' WHEN 8 THEN 'Other' END AS gender FROM customer"""
)
def map_category_default(t):
    words = pick("c_custkey", "MALE", "m", "Female", "F", "woman", "Non-Binary", "nonbinary",
                 "non binary", "agender", None)
    return t.customer.select(
        "c_custkey", fn.category_or_default(words, fixed.GENDERS, fixed.GENDER_OTHER).alias("gender")
    )


@query(
    """SELECT o_orderkey, CASE o_orderkey % 10
         WHEN 0 THEN 'PO' WHEN 1 THEN 'PO' WHEN 2 THEN 'PO' WHEN 3 THEN 'IV' WHEN 4 THEN 'IM'
         WHEN 5 THEN 'SQ' WHEN 6 THEN 'TOPICAL' WHEN 7 THEN 'INHALED' WHEN 8 THEN 'RECTAL'
         END AS route FROM orders"""
)
def map_category_passthrough(t):
    words = pick("o_orderkey", "p.o.", "PO", "Oral", "iv", "Im", "sq", "Topical", "inhaled",
                 "rectal", None)
    return t.orders.select("o_orderkey", fn.category_or_upper(words, fixed.ROUTES).alias("route"))


_BOOL_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 12 < 5 THEN true
                 WHEN o_orderkey % 12 < 10 THEN false END AS flag{} FROM orders"""


@query(_BOOL_SQL.format(""))
def bool_standard(t):
    return t.orders.select("o_orderkey", fn.flag(pick("o_orderkey", *BOOL_WORDS)).alias("flag"))


@query(
    _BOOL_SQL.format(
        """, CASE WHEN o_orderkey % 12 < 5 THEN 'True'
             WHEN o_orderkey % 12 < 10 THEN 'False' END AS flag_text"""
    )
)
def bool_flag(t):
    flag = fn.flag(pick("o_orderkey", *BOOL_WORDS))
    return t.orders.select("o_orderkey", flag.alias("flag"), fn.flag_text(flag).alias("flag_text"))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 7 < 4 THEN true WHEN s_suppkey % 7 < 6 THEN false
       END AS certified FROM supplier"""
)
def bool_affirmative(t):
    words = pick("s_suppkey", "Y", "yes", "True", "1", "pending", "N", None)
    return t.supplier.select("s_suppkey", fn.affirmative(words).alias("certified"))


@query(
    """SELECT o_orderkey,
              CASE WHEN o_orderkey % 9 < 7 THEN round(o_totalprice, 2) END AS amount,
              CASE WHEN o_orderkey % 9 IN (4, 5) THEN -round(o_totalprice, 2)
                   WHEN o_orderkey % 9 < 7 THEN round(o_totalprice, 2) END AS signed_amount
       FROM orders"""
)
def money_parse(t):
    number = "format_number(o_totalprice, 2)"
    text = F.expr(
        f"""case o_orderkey % 9 when 0 then concat('$', {number}, ' USD') when 1 then {number}
            when 2 then concat({number}, ' USD') when 3 then concat('USD ', {number})
            when 4 then concat('-$', {number}) when 5 then concat('($', {number}, ')')
            when 6 then replace({number}, ',', '') when 7 then 'free' end"""
    )
    return t.orders.select(
        "o_orderkey",
        fn.money(text).alias("amount"),
        fn.money(text, signed=True).alias("signed_amount"),
    )


@query(
    """SELECT event_id, event_id % 6 IN (0, 1, 2, 3) AS has_operator,
              CASE WHEN event_id % 6 = 5 THEN NULL ELSE user_id::VARCHAR END AS reading
       FROM events"""
)
def operator_strip(t):
    text = F.expr(
        """case event_id % 6 when 0 then concat('> ', user_id) when 1 then concat('<=', user_id)
           when 2 then concat('>=  ', user_id) when 3 then concat('!', user_id)
           when 4 then cast(user_id as string) end"""
    )
    return t.events.select(
        "event_id",
        fn.has_operator_prefix(text).alias("has_operator"),
        fn.strip_operator_prefix(text).alias("reading"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              CASE WHEN l_partkey % 5 = 4 THEN '' ELSE l_suppkey::VARCHAR || 'mg' END AS dosage
       FROM lineitem"""
)
def trailing_strip(t):
    text = F.expr(
        """case l_partkey % 5 when 0 then concat(l_suppkey, 'mg.')
           when 1 then concat(l_suppkey, 'mg . ') when 2 then concat(l_suppkey, 'mg..')
           when 3 then concat(l_suppkey, 'mg') else '..' end"""
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.strip_trailing_punctuation(text).alias("dosage"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'On Hold'
         WHEN 2 THEN 'On-hold' WHEN 3 THEN 'Discontinued' END AS status FROM orders"""
)
def title_case(t):
    words = pick("o_orderkey", "active", "on hold", "ON-hold", "DISCONTINUED", None)
    return t.orders.select("o_orderkey", fn.title_case(words).alias("status"))


@query(
    """SELECT o_orderkey, substr(o_orderkey::VARCHAR, 1, 4) || '***' AS masked,
              CASE WHEN o_orderkey % 10 = 0 THEN 'None***'
                   ELSE substr(o_orderstatus, 1, 4) || '***' END AS masked_or_none FROM orders"""
)
def mask_ids(t):
    status = F.expr("case when o_orderkey % 10 <> 0 then o_orderstatus end")
    return t.orders.select(
        "o_orderkey",
        fn.mask_id(F.col("o_orderkey")).alias("masked"),
        fn.mask_id(status).alias("masked_or_none"),
    )


@query(
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS lines,
              count(*) FILTER (WHERE l_discount > 0.08) AS discounted,
              printf('%.1f%%', count(*) FILTER (WHERE l_discount > 0.08) / count(*)::DOUBLE * 100)
                AS share
       FROM lineitem GROUP BY ALL"""
)
def percent_rendering(t):
    lines = t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_discount") > 0.08).alias("discounted")
    )
    return lines.withColumn("share", fn.percent_text(F.col("discounted"), F.col("lines")))


@query(
    """SELECT o_orderkey, strftime(
         CASE WHEN o_orderkey % 13 IN (3, 4) AND year(o_orderdate) < 2000
              THEN o_orderdate + INTERVAL 100 YEAR ELSE o_orderdate END, '%Y-%m-%d') AS order_date
       FROM orders"""
)
def parse_date_multi(t):
    text = written("o_orderdate", "o_orderkey", DATE_LAYOUTS)
    return t.orders.select("o_orderkey", fn.date_text(text).alias("order_date"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 THEN strftime(o_orderdate, '%Y-%m-%d') END
         AS order_date FROM orders"""
)
def parse_date_loose(t):
    """Stray white space is accepted where a lenient parser would; bad dates are NULL."""
    text = F.expr(
        r"""case o_orderkey % 7
            when 0 then concat('\t', date_format(o_orderdate, 'yyyy-MM-dd'), '\n')
            when 1 then date_format(o_orderdate, 'MMMM  d, yyyy')
            when 2 then concat(date_format(o_orderdate, 'M/'), lpad(day(o_orderdate), 2, ' '),
                               date_format(o_orderdate, '/yyyy'))
            when 3 then concat(date_format(o_orderdate, 'M/'), lpad(day(o_orderdate), 2, ' '),
                               date_format(o_orderdate, '/yyyy'), '  ')
            when 4 then concat(date_format(o_orderdate, 'MMM'), '\t', day(o_orderdate), ',  ',
                               year(o_orderdate))
            when 5 then concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00:00')
            else concat(date_format(o_orderdate, 'yyyy'), '-02-30') end"""
    )
    return t.orders.select("o_orderkey", fn.date_text(text).alias("order_date"))


@query(
    """SELECT event_id, strftime(CASE event_id % 17
         WHEN 0 THEN ts
         WHEN 4 THEN date_trunc('minute', ts) WHEN 6 THEN date_trunc('minute', ts)
         WHEN 8 THEN date_trunc('minute', ts) WHEN 9 THEN date_trunc('minute', ts)
         WHEN 10 THEN date_trunc('minute', ts) WHEN 11 THEN date_trunc('minute', ts)
         WHEN 12 THEN date_trunc('day', ts) WHEN 13 THEN date_trunc('day', ts)
         WHEN 14 THEN date_trunc('day', ts) WHEN 15 THEN date_trunc('day', ts)
         WHEN 16 THEN date_trunc('day', ts)
         ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S.%f') AS recorded FROM events"""
)
def parse_ts_multi(t):
    text = written("ts", "event_id", fixed.TIMESTAMP_FORMATS)
    parsed = F.date_format(fn.parse_timestamp(text), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.events.select("event_id", parsed.alias("recorded"))


@query(
    f"""SELECT o_orderkey,
          floor(date_diff('day', o_orderdate::DATE, DATE '{AS_OF}') / 365.25)::INTEGER AS age
        FROM orders"""
)
def age_as_of(t):
    born = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", fn.age_in_years(born, AS_OF).alias("age"))


@query(
    """SELECT event_id, CASE WHEN event_id % 5 < 3 THEN value END AS reading FROM events"""
)
def numeric_cast(t):
    text = F.expr(
        """case event_id % 5 when 0 then cast(value as string)
           when 1 then concat(' ', cast(value as string)) when 2 then concat(cast(value as string), ' ')
           when 3 then 'high' else concat(cast(value as string), '%') end"""
    )
    return t.events.select("event_id", fn.to_double(text).alias("reading"))


@query(
    """SELECT event_id, CASE WHEN event_id % 8 = 0 THEN NULL WHEN v > 100 THEN 100.0
              WHEN v < 0 THEN 0.0 ELSE v END AS rate,
              coalesce(event_id % 8 <> 0 AND v > 100, false) AS over_cap
       FROM (SELECT event_id, value - 20 AS v FROM events)"""
)
def clamp_flag(t):
    rate = F.expr("case when event_id % 8 <> 0 then value - 20 end")
    return t.events.select(
        "event_id",
        fn.clamp(rate, 0.0, 100.0).alias("rate"),
        fn.over_limit(rate, 100.0).alias("over_cap"),
    )


@query(
    """SELECT event_id, CASE WHEN value > 50 THEN round((value - 32) * 5.0::DOUBLE / 9.0::DOUBLE, 2)
         ELSE value END AS celsius FROM events"""
)
def fahrenheit_fix(t):
    return t.events.select("event_id", fn.fahrenheit_to_celsius(F.col("value")).alias("celsius"))
