"""Column functions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import (
    age_years, band, business_hours_flag, code_prefix, date_parts, elapsed, iso_week_parts, line_total,
    membership_flag, normalize_text, pct, rule_matrix_flag, sha256_hex, share_of_sum, standardize, tenure_years,
    threshold_status, total,
)
from tidemark.operators.joins import lookup
from tidemark.plans.hospital import AGE_BANDS
from tidemark.plans.marts import EXPERIENCE_BANDS, WAIT_BANDS
from tidemark.plans.testbed.base import AS_OF, money, query, table

# Which part types each brand may have, and limits per type.
BRAND_TYPES = {"Brand#1": ["ECO", "SMA"], "Brand#2": ["PRO"], "Brand#3": ["STA", "MED", "LAR"]}
CRITICAL = {"A": 0.85, "N": 0.90}


@query("q_age_band", """
SELECT o_orderkey, CAST(floor(d / 365.25) AS BIGINT) AS age,
       CASE WHEN floor(d / 365.25) < 0 THEN 'Desconocido' WHEN floor(d / 365.25) <= 12 THEN '0-12'
            WHEN floor(d / 365.25) <= 17 THEN '13-17' WHEN floor(d / 365.25) <= 40 THEN '18-40'
            WHEN floor(d / 365.25) <= 65 THEN '41-65' ELSE '+65' END AS age_band
FROM (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE) - CAST(o_totalprice / 20 AS INTEGER),
                                   DATE '2002-01-01') AS d FROM orders)
""")
def _age_band(spark, d):
    born = F.date_sub(F.col("o_orderdate").cast("date"), F.rint(F.col("o_totalprice") / 20).cast("int"))
    age = age_years(born, AS_OF)
    return table(spark, d, "orders").select(
        "o_orderkey", age.alias("age"), band(age, AGE_BANDS, "+65", floor=0, unknown="Desconocido").alias("age_band")
    )


@query("q_tenure", """
SELECT o_orderkey, t AS tenure, coalesce(CASE WHEN o_orderstatus <> 'P' THEN t END, 0.0) AS tenure_or_zero,
       CASE WHEN t < 2 THEN 'Junior' WHEN t < 5 THEN 'Semior' WHEN t < 10 THEN 'Senior' ELSE 'Experto' END AS level
FROM (SELECT *, CAST(round(date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') / 365.25, 1) AS DOUBLE) AS t
      FROM orders)
""")
def _tenure(spark, d):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    years = tenure_years("o_orderdate", AS_OF)
    return table(spark, d, "orders").select(
        "o_orderkey",
        years.alias("tenure"),
        tenure_years(known, AS_OF, if_null=0.0).alias("tenure_or_zero"),
        band(years, EXPERIENCE_BANDS, "Experto", side="<").alias("level"),
    )


@query("q_elapsed", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', o_orderdate, s) * 1440.0 AS DOUBLE) AS wait_minutes,
       CAST(date_diff('day', o_orderdate, s) * 24.0 AS DOUBLE) AS wait_hours,
       CAST(date_diff('day', o_orderdate, s) AS DOUBLE) AS wait_days,
       CASE WHEN d <= 20 THEN 'Optimo' WHEN d <= 45 THEN 'Aceptable' WHEN d <= 120 THEN 'Alto' ELSE 'Critico' END
         AS wait_class
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS s,
             CASE WHEN l_returnflag <> 'R' THEN date_diff('day', o_orderdate, l_shipdate) END AS d
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
""")
def _elapsed(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = lookup(table(spark, d, "lineitem"), orders, "l_orderkey", "o_orderkey")
    shipped = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    days = elapsed("o_orderdate", shipped, "day", 1)
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        elapsed("o_orderdate", shipped, "minute", 1).alias("wait_minutes"),
        elapsed("o_orderdate", shipped, "hour", 2).alias("wait_hours"),
        days.alias("wait_days"),
        band(days, WAIT_BANDS, "Critico").alias("wait_class"),
    )


@query("q_business_hours", """
SELECT event_id, CAST(dayofweek(ts) BETWEEN 1 AND 5 AND hour(ts) BETWEEN 7 AND 17 AS INTEGER) AS in_hours FROM events
""")
def _business_hours(spark, d):
    return table(spark, d, "events").select("event_id", business_hours_flag("ts").alias("in_hours"))


@query("q_calendar", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS anio, CAST(month(ts) AS INTEGER) AS mes, CAST(day(ts) AS INTEGER) AS dia,
       CAST(hour(ts) AS INTEGER) AS hora FROM events
""")
def _calendar(spark, d):
    parts = date_parts("ts", ("anio", "mes", "dia", "hora"))
    return table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("q_iso_week", """
SELECT o_orderkey, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(week(o_orderdate) AS INTEGER) AS iso_week,
       CAST(year(o_orderdate) AS INTEGER) AS calendar_year
FROM orders
""")
def _iso_week(spark, d):
    year, week = iso_week_parts("o_orderdate")
    calendar, _ = iso_week_parts("o_orderdate", calendar_year=True)
    return table(spark, d, "orders").select(
        "o_orderkey", year.alias("iso_year"), week.alias("iso_week"), calendar.alias("calendar_year")
    )


@query("q_prefix_matrix", """
SELECT p_partkey, left(p_type, 3) AS code,
       CAST((p_brand = 'Brand#1' AND left(p_type, 3) NOT IN ('ECO', 'SMA'))
         OR (p_brand = 'Brand#2' AND left(p_type, 3) NOT IN ('PRO'))
         OR (p_brand = 'Brand#3' AND left(p_type, 3) NOT IN ('STA', 'MED', 'LAR')) AS INTEGER) AS off_matrix
FROM part
""")
def _prefix_matrix(spark, d):
    code = code_prefix("p_type")
    return table(spark, d, "part").select(
        "p_partkey", code.alias("code"), rule_matrix_flag("p_brand", code, BRAND_TYPES).alias("off_matrix")
    )


@query("q_occupancy_status", """
SELECT *, CASE WHEN (l_returnflag = 'A' AND rate >= 0.85) OR (l_returnflag = 'N' AND rate >= 0.90) THEN 'Critico'
               WHEN rate >= 0.70 THEN 'Precaucion' ELSE 'Normal' END AS status
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
             CASE WHEN q + s > 0 THEN round(q / (q + s), 4) ELSE 0.0 END AS rate
      FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(p_size AS BIGINT) - 10 AS s
            FROM lineitem JOIN part ON l_partkey = p_partkey))
""")
def _occupancy_status(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_size")
    joined = lookup(table(spark, d, "lineitem"), part, "l_partkey", "p_partkey")
    rate = share_of_sum(F.col("l_quantity").cast("bigint"), F.col("p_size").cast("bigint") - 10)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", rate.alias("rate")).withColumn(
        "status", threshold_status("rate", "l_returnflag", CRITICAL, 0.70)
    )


@query("q_line_total", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_quantity AS INTEGER) AS DECIMAL(24, 2)) AS line_value
FROM lineitem
""")
def _line_total(spark, d):
    value = line_total(F.col("l_quantity").cast("int"), money("l_extendedprice"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", value.cast("decimal(24,2)").alias("line_value")
    )


@query("q_capacity_pct", """
SELECT l_orderkey, CAST(a + n + r AS BIGINT) AS lines_total,
       CASE WHEN a + n + r > 0 THEN round(r / (a + n + r) * 100, 2) ELSE 0.0 END AS pct_returned,
       CASE WHEN a + n + r >= 6 THEN 'Alta' WHEN a + n + r >= 3 THEN 'Media' ELSE 'Baja' END AS size_class
FROM (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n,
             count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY l_orderkey)
""")
def _capacity_pct(spark, d):
    flags = {f"n_{f.lower()}": F.count_if(F.col("l_returnflag") == f) for f in "ANR"}
    counts = table(spark, d, "lineitem").groupBy("l_orderkey").agg(*[c.alias(n) for n, c in flags.items()])
    lines = total(*flags)
    return counts.select(
        "l_orderkey",
        lines.alias("lines_total"),
        pct("n_r", lines).alias("pct_returned"),
        band(-lines, [(-6, "Alta"), (-3, "Media")], "Baja").alias("size_class"),
    )


@query("q_membership_flag", """
SELECT event_id, CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS converted FROM events
""")
def _membership(spark, d):
    return table(spark, d, "events").select(
        "event_id", membership_flag("event_type", ["purchase", "signup"]).alias("converted")
    )


@query("q_standardize", """
SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN p_type ELSE 'OTHER' END AS kind,
       CASE p_type WHEN 'ECONOMY' THEN 'ECO' WHEN 'SMALL' THEN 'SML' ELSE 'OTH' END AS kind_code,
       CASE WHEN p_size <= 5 THEN 'NONE' WHEN p_type IN ('ECONOMY', 'SMALL') THEN p_type ELSE 'OTHER' END AS sized_kind
FROM part
""")
def _standardize(spark, d):
    sized = F.when(F.col("p_size") > 5, F.col("p_type"))
    return table(spark, d, "part").select(
        "p_partkey",
        standardize("p_type", ["ECONOMY", "SMALL", "PROMO"], "OTHER").alias("kind"),
        standardize("p_type", mapping={"ECONOMY": "ECO", "SMALL": "SML"}, default="OTH").alias("kind_code"),
        standardize(sized, ["ECONOMY", "SMALL"], "OTHER", "NONE").alias("sized_kind"),
    )


@query("q_normalize_text", """
SELECT p_partkey, array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) FOR w IN string_split(p_name, ' ')], ' ')
       AS name FROM part
""")
def _normalize_text(spark, d):
    messy = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    return table(spark, d, "part").select("p_partkey", normalize_text(messy).alias("name"))


@query("q_hash_sha256", """
SELECT doc_id, sha256(text) AS text_hash, CASE WHEN lang <> 'en' THEN sha256(source) END AS source_hash FROM documents
""")
def _hash(spark, d):
    foreign = F.when(F.col("lang") != "en", F.col("source")).otherwise(F.lit(""))
    return table(spark, d, "documents").select(
        "doc_id", sha256_hex("text").alias("text_hash"), sha256_hex(foreign).alias("source_hash")
    )
