"""Dimensions, facts, KPI tables and baselines on the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.anomaly import anomaly_record, fill_missing_weeks, rolling_baseline, volume_anomalies
from tidemark.operators.changes import change_feed
from tidemark.operators.distinct import distinct_bitmaps, distinct_counts, merged_bitmaps
from tidemark.operators.joins import lookup, matching
from tidemark.operators.rollup import AGAIN
from tidemark.plans import marts
from tidemark.plans.testbed.base import (
    AS_OF, BATCH, FACT_CAPACITY_SQL, FACT_VISITS_SQL, FACT_WAIT_SQL, PATIENTS_SQL, SITES_SQL, STAMP, VISITS_SQL,
    appointments, beds, dispensing, doctors, patients, query, sites, table, visits,
)
from tidemark.session import work_dir


# ---- dimensions -------------------------------------------------------------------------------------------------

@query("q_dim_customer", f"""
WITH {PATIENTS_SQL}
SELECT pac_id, tip_doc, num_doc_hash, fec_nac, genero, grupo_edad, edad_actual, nom_ciudad_res, tip_aseguradora, id_eps,
       estrato_socioec, activo,
       CASE WHEN fec_primer_atencion IS NULL THEN 0.0
            ELSE CAST(round(date_diff('day', fec_primer_atencion, DATE '2002-01-01') / 365.25, 1) AS DOUBLE) END
         AS anos_desde_primer_atencion,
       CASE WHEN estrato_socioec = 0 THEN 'Desconocido' WHEN estrato_socioec <= 2 THEN 'Vulnerable'
            WHEN estrato_socioec <= 4 THEN 'Medio' ELSE 'Alto' END AS segmento_socioeconomico
FROM patients
""")
def _dim_customer(spark, d):
    return marts.dim_patients(patients(spark, d), AS_OF)


@query("q_dim_supplier", f"""
WITH {SITES_SQL},
docs AS (
  SELECT s_suppkey AS med_id, 'E' || s_nationkey AS esp_principal, s_name AS esp_secundaria,
         CAST(s_nationkey AS BIGINT) AS id_sede,
         CAST(DATE '1982-01-01' + CAST(floor(s_acctbal * 0.7) AS INTEGER) AS DATE) AS fec_ingreso,
         CASE WHEN s_acctbal > 5000 THEN 'Planta' ELSE 'Otro' END AS tip_contrato,
         CASE WHEN s_acctbal > 1000 THEN 'Turno' ELSE 'No Informado' END AS jornada, s_acctbal > 0 AS estado_activo
  FROM supplier
), aged AS (
  SELECT *, CAST(round(date_diff('day', fec_ingreso, DATE '2002-01-01') / 365.25, 1) AS DOUBLE) AS anos_experiencia
  FROM docs
)
SELECT med_id, esp_principal, esp_secundaria, id_sede, nom_sede, tip_sede AS tip_sede_principal,
       nom_ciudad AS ciudad_sede, nom_pais AS pais_sede, tip_contrato, jornada, estado_activo, fec_ingreso,
       anos_experiencia,
       CASE WHEN anos_experiencia < 2 THEN 'Junior' WHEN anos_experiencia < 5 THEN 'Semior'
            WHEN anos_experiencia < 10 THEN 'Senior' ELSE 'Experto' END AS nivel_experiencia
FROM aged LEFT JOIN sites USING (id_sede)
""")
def _dim_supplier(spark, d):
    return marts.dim_doctors(doctors(spark, d), sites(spark, d))


@query("q_dim_nation", f"""
WITH {SITES_SQL}
SELECT id_sede, nom_sede, tip_sede, nivel_complejidad, id_ciudad, nom_ciudad, id_pais, nom_pais,
       gen AS cap_camas_gen, uci AS cap_camas_uci, cir AS cap_camas_cirugia, urg AS cap_camas_urg,
       beds AS cap_camas_total, CASE WHEN beds > 0 THEN round(uci / beds * 100, 2) ELSE 0.0 END AS pct_uci, activa,
       'OTR' AS cod_pais,
       CASE WHEN beds >= 100 THEN 'Alta' WHEN beds >= 30 THEN 'Media' ELSE 'Baja' END AS categoria_capacidad
FROM sites
""")
def _dim_nation(spark, d):
    return marts.dim_sites(sites(spark, d))


# ---- facts ------------------------------------------------------------------------------------------------------

@query("q_fact_orders", f"WITH {FACT_VISITS_SQL} SELECT * FROM fact_visits")
def _fact_orders(spark, d):
    return marts.fact_visits(visits(spark, d), sites(spark, d), patients(spark, d))


@query("q_fact_order_cost", f"""
WITH {PATIENTS_SQL}, {VISITS_SQL},
totals AS (
  SELECT l_orderkey AS id_encuentro,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(10, 2)) * CAST(l_quantity AS BIGINT)) AS DECIMAL(38, 2)) AS v,
         CAST(count(*) AS BIGINT) AS n
  FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey
)
SELECT id_encuentro, pac_id, id_sede, fec_registro, tip_consulta, esp_atendida, diag_cie10_3char, tip_aseguradora,
       estado_factura, _nulo_vr_facturado, coalesce(v, 0) AS vr_medicamentos, coalesce(n, 0) AS num_medicamentos,
       coalesce(v, 0) AS costo_medicamentos, CAST(year(fec_registro) AS INTEGER) AS anio,
       CAST(month(fec_registro) AS INTEGER) AS mes
FROM visits LEFT JOIN totals USING (id_encuentro) LEFT JOIN patients USING (pac_id)
""")
def _fact_order_cost(spark, d):
    fact = marts.fact_visit_cost(visits(spark, d), dispensing(spark, d), patients(spark, d))
    wide = {c: F.col(c).cast("decimal(38,2)") for c in ("vr_medicamentos", "costo_medicamentos")}
    return fact.withColumns(wide)


@query("q_fact_capacity", f"WITH {FACT_CAPACITY_SQL} SELECT * FROM fact_capacity")
def _fact_capacity(spark, d):
    return marts.fact_capacity(beds(spark, d), sites(spark, d))


@query("q_fact_lag", f"WITH {FACT_WAIT_SQL} SELECT * FROM fact_wait")
def _fact_lag(spark, d):
    return marts.fact_wait(appointments(spark, d), sites(spark, d))


WEEKLY_SQL = f"""
{SITES_SQL}, {VISITS_SQL},
weekly AS (
  SELECT CAST(isoyear(fec_registro) AS INTEGER) AS anio, CAST(week(fec_registro) AS INTEGER) AS semana,
         nom_ciudad AS ciudad, diag_cie10_3char AS codigo_cie10, CAST(count(*) AS BIGINT) AS volumen_actual
  FROM visits LEFT JOIN sites USING (id_sede) GROUP BY ALL
),
compared AS (
  SELECT *, avg(volumen_actual) OVER (PARTITION BY ciudad, codigo_cie10 ORDER BY anio, semana
                                      ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS m
  FROM weekly
),
alerts AS (
  SELECT anio, semana, ciudad, codigo_cie10, volumen_actual, round(m, 2) AS promedio_historico,
         round((volumen_actual - m) / m * 100, 2) AS pct_desviacion
  FROM compared WHERE m > 0 AND round((volumen_actual - m) / m * 100, 2) > 40
)"""


@query("q_fact_alerts", f"""
WITH {WEEKLY_SQL}
SELECT *, 'BROTE_EPIDEMIOLOGICO' AS tipo_alerta, '{BATCH}' AS lote_id FROM alerts
""")
def _fact_alerts(spark, d):
    return marts.outbreak_alerts(visits(spark, d), sites(spark, d), batch_id=BATCH).drop("fec_alerta")


# ---- KPI tables -------------------------------------------------------------------------------------------------

@query("q_kpi_capacity", f"""
WITH {FACT_CAPACITY_SQL}
SELECT id_sede, nom_sede, nom_ciudad, nom_pais, tip_unidad, anio, mes,
       round(sum(CAST(round(tasa_ocupacion * 10000) AS BIGINT)) / count(*)) / 10000 AS tasa_ocupacion_promedio, max(tasa_ocupacion) AS tasa_ocupacion_maxima,
       CAST(sum(ind_critico) AS BIGINT) AS n_registros_criticos, CAST(count(*) AS BIGINT) AS n_snapshots,
       'OCUPACION_CAMAS' AS kpi_tipo
FROM fact_capacity GROUP BY ALL
""")
def _kpi_capacity(spark, d):
    return marts.kpi_capacity(_fact_capacity(spark, d))


def _loads(spark, d) -> list:
    """Bed snapshots after three loads: the first two weeks; all of them, the highest occupancies corrected; and without every
    seventh, those of one unit gone altogether."""
    fact = _staged(spark, _fact_capacity(spark, d), "fact")
    lowered = F.when((F.col("id_registro_cama") % 5 == 0) & (F.col("tasa_ocupacion") > 0.5), F.lit(0.0)).otherwise(F.col("tasa_ocupacion"))
    second = fact.withColumn("tasa_ocupacion", lowered)
    return [fact.filter("dia < 15"), second, second.filter("id_registro_cama % 7 <> 0 AND tip_unidad <> 'Urgencias'")]


def _staged(spark, df, label: str):
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@query("q_kpi_delta", f"""
WITH {FACT_CAPACITY_SQL},
last AS (
  SELECT * REPLACE (CASE WHEN id_registro_cama % 5 = 0 AND tasa_ocupacion > 0.5 THEN 0.0 ELSE tasa_ocupacion END AS tasa_ocupacion)
  FROM fact_capacity WHERE id_registro_cama % 7 <> 0 AND tip_unidad <> 'Urgencias')
SELECT id_sede, nom_sede, nom_ciudad, nom_pais, tip_unidad, anio, mes,
       round(sum(CAST(round(tasa_ocupacion * 10000) AS BIGINT)) / count(*)) / 10000 AS tasa_ocupacion_promedio, max(tasa_ocupacion) AS tasa_ocupacion_maxima,
       CAST(sum(ind_critico) AS BIGINT) AS n_registros_criticos, CAST(count(*) AS BIGINT) AS n_snapshots,
       'OCUPACION_CAMAS' AS kpi_tipo
FROM last GROUP BY ALL
""")
def _kpi_delta(spark, d):
    """The first load is rolled up whole, the others by their changes: only groups that lost their maximum are read again."""
    loads, rollup = _loads(spark, d), marts.CAPACITY
    parts = _staged(spark, rollup.aggregate(loads[0]), "parts")
    for version, (old, new) in enumerate(zip(loads, loads[1:]), 1):
        feed = _staged(spark, change_feed(old, new, ["id_registro_cama"], version), "feed")
        deltas = rollup.deltas(feed)
        merged = _staged(spark, rollup.merged(parts, deltas), "merged")
        again = merged.filter(AGAIN).select(*rollup.keys)
        same = merged.filter(~F.col(AGAIN)).drop(AGAIN)
        untouched = parts.join(deltas.select(*rollup.keys), list(rollup.keys), "left_anti")
        parts = _staged(spark, untouched.unionByName(same).unionByName(rollup.aggregate(matching(new, again, rollup.keys))), "parts")
    return rollup.published(parts)


@query("q_kpi_lag", f"""
WITH {FACT_WAIT_SQL}
SELECT id_sede, nom_ciudad, nom_pais, esp_solicitada, anio, mes,
       round(sum(CAST(round(tiempo_espera_min * 10) AS BIGINT)) / count(*)) / 10 AS tiempo_espera_promedio_min,
       max(tiempo_espera_min) AS tiempo_espera_maximo_min,
       round(sum(ind_supera_umbral) / count(*) * 100, 2) AS pct_supera_umbral_45min,
       CAST(count(*) AS BIGINT) AS n_citas_atendidas, 'TIEMPOS_ESPERA' AS kpi_tipo
FROM fact_wait GROUP BY ALL
""")
def _kpi_lag(spark, d):
    return marts.kpi_wait(_fact_lag(spark, d))


@query("q_kpi_volume", f"""
WITH {FACT_VISITS_SQL}
SELECT nom_ciudad, nom_pais, esp_atendida, tip_consulta, anio, mes, CAST(count(*) AS BIGINT) AS n_consultas,
       CAST(sum(ind_hospitalizacion) AS BIGINT) AS n_hospitalizaciones,
       CAST(sum(ind_dx_cronico) AS BIGINT) AS n_dx_cronicos,
       CAST(sum(ind_dx_oncologico) AS BIGINT) AS n_dx_oncologicos,
       CAST(sum(glosa_riesgo) AS BIGINT) AS n_glosas_riesgo,
       round(sum(glosa_riesgo) / count(*) * 100, 2) AS pct_glosa_riesgo, 'VOLUMEN_CONSULTAS' AS kpi_tipo
FROM fact_visits GROUP BY ALL
""")
def _kpi_volume(spark, d):
    return marts.kpi_volume(_fact_orders(spark, d))


@query("q_kpi_alerts", f"""
WITH {WEEKLY_SQL}
SELECT ciudad, codigo_cie10, anio, CAST(count(semana) AS BIGINT) AS n_semanas_alerta,
       max(pct_desviacion) AS max_desviacion_pct, max(volumen_actual) AS volumen_maximo,
       round(sum(CAST(round(promedio_historico * 100) AS BIGINT)) / count(*)) / 100 AS promedio_historico, 'ALERTAS_EPIDEMIOLOGICAS' AS kpi_tipo
FROM alerts GROUP BY ALL
""")
def _kpi_alerts(spark, d):
    return marts.kpi_alerts(_fact_alerts(spark, d))


@query("q_kpi_executive", f"""
WITH {FACT_VISITS_SQL}, {FACT_CAPACITY_SQL.replace(SITES_SQL + ",", "")}, {FACT_WAIT_SQL.replace(SITES_SQL + ",", "")},
base AS (
  SELECT anio, mes, CAST(count(*) AS BIGINT) AS total_consultas, CAST(count(DISTINCT pac_id) AS BIGINT) AS pacientes_unicos,
         CAST(count(DISTINCT id_sede) AS BIGINT) AS sedes_activas,
         CAST(sum(ind_hospitalizacion) AS BIGINT) AS total_hospitalizaciones,
         round(sum(ind_hospitalizacion) / count(*) * 100, 2) AS tasa_hospitalizacion_pct,
         CAST(sum(glosa_riesgo) AS BIGINT) AS total_glosas_riesgo
  FROM fact_visits GROUP BY anio, mes
)
SELECT base.*, tiempo_espera_promedio_min, tasa_ocupacion_promedio_red, 'RESUMEN_EJECUTIVO' AS kpi_tipo
FROM base
LEFT JOIN (SELECT anio, mes, round(sum(CAST(round(tiempo_espera_min * 10) AS BIGINT)) / count(*)) / 10 AS tiempo_espera_promedio_min FROM fact_wait
           GROUP BY anio, mes) USING (anio, mes)
LEFT JOIN (SELECT anio, mes, round(sum(CAST(round(tasa_ocupacion * 10000) AS BIGINT)) / count(*)) / 10000 AS tasa_ocupacion_promedio_red FROM fact_capacity
           GROUP BY anio, mes) USING (anio, mes)
""")
def _kpi_executive(spark, d):
    return marts.kpi_executive(*marts.executive_inputs(visits(spark, d), appointments(spark, d), beds(spark, d)))


_GRAINS = {"month": "anio, mes", "quarter": "anio, trimestre", "year": "anio"}


@query("q_distinct_rollup", f"""
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
                  CAST(month(o_orderdate) AS INTEGER) AS mes FROM orders)
{" UNION ALL ".join(
    f"SELECT '{grain}' AS grain, anio, {'mes' if grain == 'month' else 'trimestre' if grain == 'quarter' else 'NULL'} AS part, "
    f"CAST(count(DISTINCT o_custkey) AS BIGINT) AS pacientes_unicos FROM o GROUP BY {by}" for grain, by in _GRAINS.items()
)}
""")
def _distinct_rollup(spark, d):
    """Months, quarters and years from one table of bitmaps, which was filled by three loads."""
    when = F.col("o_orderdate")
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.year(when).alias("anio"), F.quarter(when).alias("trimestre"), F.month(when).alias("mes")
    )
    month, held = ["anio", "trimestre", "mes"], None
    for load in range(3):
        bitmaps = distinct_bitmaps(orders.filter(F.col("o_orderkey") % 3 == load), month, "o_custkey")
        held = _staged(spark, bitmaps if held is None else merged_bitmaps(held.unionByName(bitmaps), month), "bitmaps")
    out = None
    for grain, by in _GRAINS.items():
        by = by.split(", ")
        part = F.col(by[1]) if len(by) > 1 else F.lit(None).cast("int")
        counted = distinct_counts(held, by, "pacientes_unicos").select(F.lit(grain).alias("grain"), "anio", part.alias("part"), "pacientes_unicos")
        out = counted if out is None else out.unionByName(counted)
    return out


# ---- baselines --------------------------------------------------------------------------------------------------

@query("q_rolling_baseline", """
WITH daily AS (
  SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL
), compared AS (
  SELECT *, avg(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS m FROM daily
)
SELECT event_type, day, n, round(m, 6) AS baseline,
       CASE WHEN m > 0 THEN round((n - m) / m * 100, 2) END AS deviation
FROM compared
""")
def _rolling_baseline(spark, d):
    daily = table(spark, d, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    out = rolling_baseline(daily, "n", ["event_type"], ["day"], mean="baseline", deviation="deviation")
    return out.withColumn("baseline", F.round("baseline", 6))


@query("q_fill_missing_weeks", """
WITH w AS (
  SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, CAST(count(*) AS BIGINT) AS n
  FROM lineitem GROUP BY ALL
), grid AS (
  SELECT l_suppkey, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAYS)) AS DATE) AS week
  FROM w GROUP BY l_suppkey
), filled AS (SELECT l_suppkey, week, coalesce(n, 0) AS n FROM grid LEFT JOIN w USING (l_suppkey, week))
SELECT l_suppkey, week, n, CASE WHEN k = 8 AND m > 0 THEN round((n - m) / m * 100, 2) END AS deviation FROM (
  SELECT l_suppkey, week, n,
         avg(n) OVER p AS m, count(*) OVER p AS k FROM filled
  WINDOW p AS (PARTITION BY l_suppkey ORDER BY week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))
""")
def _fill_missing_weeks(spark, d):
    """Weeks without a delivery count as zero, and a baseline needs eight weeks."""
    week = F.trunc(F.col("l_shipdate").cast("date"), "week").alias("week")
    weekly = table(spark, d, "lineitem").groupBy("l_suppkey", week).agg(F.count(F.lit(1)).alias("n"))
    filled = fill_missing_weeks(weekly, ["l_suppkey"], "week", "n")
    return rolling_baseline(filled, "n", ["l_suppkey"], ["week"], min_rows=8, mean="m", deviation="deviation").drop("m")


def event_runs(spark, d):
    """Each day's events of a user and type as one load of that 'table'; some days failed, some brought nothing."""
    return table(spark, d, "events").groupBy(
        F.lit("bronze").alias("capa"),
        F.concat_ws("-", "event_type", "user_id").alias("tabla"),
        F.col("ts").cast("date").cast("timestamp_ntz").alias("ts_ejecucion"),
    ).agg(F.count(F.lit(1)).alias("registros_procesados")).withColumn(
        "estado",
        F.when(F.dayofmonth("ts_ejecucion") % 7 == 0, "ERROR").when(F.dayofmonth("ts_ejecucion") % 5 == 0, "SIN_CAMBIOS").otherwise("EXITOSO"),
    ).withColumn("registros_procesados", F.when(F.col("estado") == "EXITOSO", F.col("registros_procesados")).otherwise(F.lit(0)))


RUNS_SQL = """
runs AS (
  SELECT tabla, day, ok, CASE WHEN ok THEN c ELSE 0 END AS n FROM (
    SELECT event_type || '-' || user_id AS tabla, CAST(ts AS DATE) AS day, day(ts) % 5 <> 0 AS ok, count(*) AS c
    FROM events WHERE day(ts) % 7 <> 0 GROUP BY ALL)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tabla ORDER BY day DESC) AS r FROM runs
), past AS (
  SELECT *, row_number() OVER (PARTITION BY tabla ORDER BY day DESC) AS h FROM ranked WHERE ok AND r > 1
), judged AS (
  SELECT tabla, (SELECT max(n) FROM ranked x WHERE x.tabla = past.tabla AND x.r = 1) AS last, avg(n) FILTER (h <= 7) AS m,
         count(*) FILTER (h <= 7) AS k
  FROM past GROUP BY tabla
), found AS (
  SELECT 'bronze' AS capa, tabla, CAST(last AS BIGINT) AS n_actual, round(m, 0) AS n_promedio,
         round(abs(last - m) / m * 100, 2) AS pct_desviacion
  FROM judged WHERE k >= 3 AND m <> 0 AND abs(last - m) / m > 0.30
)"""


@query("q_volume_anomaly", f"WITH {RUNS_SQL} SELECT * FROM found")
def _volume_anomaly(spark, d):
    return volume_anomalies(event_runs(spark, d)).drop("ts_deteccion")


@query("q_anomaly_record", f"""
WITH {RUNS_SQL}
SELECT *, '{STAMP}' AS ts_deteccion, 'ANOMALIA' AS estado FROM found
UNION ALL
SELECT 'ALL', 'ALL', 0, 0.0, 0.0, '{STAMP}', 'OK' WHERE NOT EXISTS (SELECT 1 FROM found)
""")
def _anomaly_record(spark, d):
    return anomaly_record(volume_anomalies(event_runs(spark, d), detected_at=STAMP), STAMP)


# ---- joins ------------------------------------------------------------------------------------------------------

@query("q_lookup_null_keys", """
SELECT l_orderkey, l_linenumber, l_partkey, k, p_brand, p_size
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS k FROM lineitem) LEFT JOIN part ON k = p_partkey
""")
def _lookup_null_keys(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("k")
    )
    return lookup(lines, table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), "k", "p_partkey")


@query("q_line_revenue", """
SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_quantity AS INTEGER)) AS DECIMAL(38, 2))
         AS total_value,
       CAST(count(*) AS BIGINT) AS n_lines, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_parts,
       CAST(count(DISTINCT l_suppkey) AS BIGINT) AS n_suppliers, min(l_quantity) AS min_quantity,
       max(l_quantity) AS max_quantity, round(avg(CAST(l_quantity AS INTEGER)), 4) AS mean_quantity,
       round(count(*) FILTER (l_returnflag = 'R') / count(*) * 100, 2) AS pct_returned
FROM lineitem GROUP BY l_orderkey
""")
def _line_revenue(spark, d):
    """Lines are shuffled once, by order; the first line of each part and supplier of an order counts for it."""
    value = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_quantity").cast("int")
    firsts = {
        f"_{c}": (F.row_number().over(Window.partitionBy("l_orderkey", c).orderBy(c)) == 1) & F.col(c).isNotNull()
        for c in ("l_partkey", "l_suppkey")
    }
    used = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    return table(spark, d, "lineitem").select(*used).repartition("l_orderkey").withColumns(firsts).groupBy("l_orderkey").agg(
        F.sum(value).cast("decimal(38,2)").alias("total_value"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("_l_partkey").alias("n_parts"),
        F.count_if("_l_suppkey").alias("n_suppliers"),
        F.min("l_quantity").alias("min_quantity"),
        F.max("l_quantity").alias("max_quantity"),
        F.round(F.avg(F.col("l_quantity").cast("int")), 4).alias("mean_quantity"),
        F.round(F.count_if(F.col("l_returnflag") == "R") / F.count(F.lit(1)) * 100, 2).alias("pct_returned"),
    )
