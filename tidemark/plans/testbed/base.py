"""Registry of test queries, and the star-schema tables in the roles of the hospital's tables.

Stamps of the test tables have no zone; results keep them so, and they never pass through the session's zone.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import code_prefix, standardize
from tidemark.operators.cleaning import null_flags, split_by_rule
from tidemark.operators.joins import lookup
from tidemark.plans import hospital
from tidemark.sources.files import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = date(2002, 1, 1)
BATCH = "20240131_000000"
STAMP = "2024-01-31 00:00:00"


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it has no oracle."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = built(spark, root, f"schema of {name}", lambda s, r: read_table(s, r, name).schema)
    return read_table(spark, root, name, schema)


_BUILT: dict[tuple[str, str, str], object] = {}


def built(spark: SparkSession, root: str, name: str, make: Callable[[SparkSession, str], object]):
    """What several queries need (a set of written tables, a schema), made when the first of them asks."""
    key = (spark.sparkContext.applicationId, root, name)
    if key not in _BUILT:
        _BUILT[key] = make(spark, root)
    return _BUILT[key]


# ---- roles: Spark side ------------------------------------------------------------------------------------------

# How test columns stand for hospital values.
VISIT_TYPE = {
    "1-URGENT": "Urgencia", "2-HIGH": "Hospitalizacion", "3-MEDIUM": "Control", "4-NOT SPECIFIED": "Otra",
    "5-LOW": "Cirugia",
}
DIAGNOSIS = {"1-URGENT": "I10.9", "2-HIGH": "C50.1", "3-MEDIUM": "E11.0", "4-NOT SPECIFIED": "J06.9", "5-LOW": "F32.2"}
SPECIALTY = {
    "AUTOMOBILE": "Cardiologia", "BUILDING": "Oncologia", "FURNITURE": "Pediatria", "HOUSEHOLD": "Psiquiatria",
    "MACHINERY": "Endocrinologia",
}
UNIT = {"click": "General", "view": "UCI", "purchase": "Cirugia", "signup": "Urgencias", "error": "Pasillo"}
STATE = {"A": "Atendida", "N": "Atendida", "R": "Cancelada"}


def money(column: str, precision: int = 12):
    return F.col(column).cast(f"decimal({precision},2)")


def sites(spark: SparkSession, root: str) -> DataFrame:
    """Nations as sites; the customers of each market segment are its beds."""
    nation, region = table(spark, root, "nation"), table(spark, root, "region")
    placed = lookup(nation, region, "n_regionkey", "r_regionkey")
    beds = {"gen": "AUTOMOBILE", "uci": "BUILDING", "cirugia": "FURNITURE", "urg": "HOUSEHOLD"}
    counts = table(spark, root, "customer").groupBy("c_nationkey").agg(
        *[F.count_if(F.col("c_mktsegment") == segment).alias(f"cap_camas_{bed}") for bed, segment in beds.items()]
    )
    # Each nation has its counts, also one without customers.
    full = lookup(placed, counts, "n_nationkey", "c_nationkey").fillna(0, [f"cap_camas_{b}" for b in beds])
    raw = full.select(
        F.col("n_nationkey").cast("bigint").alias("id_sede"),
        F.col("n_name").alias("nom_sede"),
        F.when(F.col("r_name") == "ASIA", F.lit("Centro Diagnostico")).otherwise(F.col("r_name")).alias("tip_sede"),
        F.col("n_nationkey").cast("bigint").alias("id_ciudad"),
        F.col("n_name").alias("nom_ciudad"),
        F.col("n_regionkey").cast("bigint").alias("id_pais"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("nom_pais"),
        F.col("n_regionkey").cast("bigint").alias("nivel_complejidad"),
        *[f"cap_camas_{b}" for b in beds],
        (F.col("r_name") != "AFRICA").alias("activa"),
    )
    return hospital.SITES.derive(raw, AS_OF)


def patients(spark: SparkSession, root: str) -> DataFrame:
    """Customers as patients; their balance stands for a birth date, their first order for the first visit."""
    first = table(spark, root, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    full = lookup(table(spark, root, "customer"), first, "c_custkey", "o_custkey")
    born = F.date_add(F.lit("1970-01-01").cast("date"), F.floor("c_acctbal").cast("int"))
    raw = full.select(
        F.col("c_custkey").alias("pac_id"),
        F.col("c_mktsegment").alias("tip_doc"),
        F.sha2("c_name", 256).alias("num_doc_hash"),
        born.alias("fec_nac"),
        F.col("c_mktsegment").substr(1, 1).alias("genero"),
        F.col("c_nationkey").cast("string").alias("nom_ciudad_res"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Compensar"))
        .when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("tip_aseguradora"),
        F.col("c_mktsegment").alias("id_eps"),
        F.floor(F.col("c_acctbal") / 2000).alias("estrato_socioec"),
        F.col("first").cast("date").alias("fec_primer_atencion"),
        (F.col("c_acctbal") > 0).alias("activo"),
    )
    return hospital.PATIENTS.derive(raw, AS_OF)


def doctors(spark: SparkSession, root: str) -> DataFrame:
    """Suppliers as doctors; their balance stands for the date they were hired."""
    hired = F.date_add(F.lit("1982-01-01").cast("date"), F.floor(F.col("s_acctbal") * 0.7).cast("int"))
    raw = table(spark, root, "supplier").select(
        F.col("s_suppkey").alias("med_id"),
        F.concat(F.lit("E"), F.col("s_nationkey")).alias("esp_principal"),
        F.col("s_name").alias("esp_secundaria"),
        F.col("s_nationkey").cast("bigint").alias("id_sede"),
        hired.alias("fec_ingreso"),
        F.when(F.col("s_acctbal") > 5000, F.lit("Planta")).otherwise(F.lit("Externo")).alias("tip_contrato"),
        F.when(F.col("s_acctbal") > 1000, F.lit("Turno")).otherwise(F.lit("No Informado")).alias("jornada"),
        (F.col("s_acctbal") > 0).alias("estado_activo"),
    )
    return hospital.DOCTORS.derive(raw, AS_OF)


def visits(spark: SparkSession, root: str) -> DataFrame:
    """Orders as visits, at the site of the customer's nation."""
    who = table(spark, root, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    full = lookup(table(spark, root, "orders"), who, "o_custkey", "c_custkey")
    raw = full.select(
        F.col("o_orderkey").alias("id_encuentro"),
        F.col("o_custkey").alias("pac_id"),
        F.col("o_custkey").alias("med_id"),
        F.col("c_nationkey").cast("bigint").alias("id_sede"),
        F.col("o_orderdate").alias("fec_registro"),
        F.timestamp_add("HOUR", F.floor(F.col("o_totalprice") / 10000).cast("int"), F.col("o_orderdate"))
        .alias("fec_egreso"),
        standardize("o_orderpriority", mapping=VISIT_TYPE).alias("tip_consulta"),
        standardize("c_mktsegment", mapping=SPECIALTY).alias("esp_atendida"),
        standardize("o_orderpriority", mapping=DIAGNOSIS).alias("diag_principal_cie10"),
        F.when(F.col("o_totalprice") > 50000, money("o_totalprice", 14)).alias("vr_facturado"),
        F.col("o_orderstatus").alias("estado_factura"),
    )
    return hospital.VISITS.derive(null_flags(raw, ["vr_facturado"]), AS_OF)


def dispensing(spark: SparkSession, root: str) -> DataFrame:
    """Order lines as dispensed medicines; returned ones belong to no visit."""
    raw = table(spark, root, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_dispensacion"),
        F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")).alias("id_encuentro"),
        F.col("l_quantity").cast("bigint").alias("cantidad"),
        money("l_extendedprice", 10).alias("vr_unitario"),
        F.col("l_linestatus").alias("tip_prescripcion"),
    )
    return hospital.DISPENSING.derive(raw, AS_OF)


def beds(spark: SparkSession, root: str) -> DataFrame:
    """Events as bed snapshots at the site of the user's nation; those with negative free beds are rejected."""
    who = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    full = lookup(table(spark, root, "events"), who, "user_id", "c_custkey")
    raw = full.select(
        F.col("event_id").alias("id_registro_cama"),
        F.col("c_nationkey").cast("bigint").alias("id_sede"),
        standardize("event_type", mapping=UNIT).alias("tip_unidad"),
        F.col("ts").alias("fec_hora_registro"),
        F.get_json_object("props", "$.k").cast("bigint").alias("num_camas_ocupadas"),
        (F.floor("value") - 1).alias("num_camas_disp"),
        F.lit(0).cast("bigint").alias("num_camas_mant"),
    )
    good, _ = split_by_rule(hospital.BEDS.derive(raw, AS_OF), F.col("num_camas_disp") < 0)
    return good


def appointments(spark: SparkSession, root: str) -> DataFrame:
    """Order lines as appointments: a minute of waiting for each day from order to shipping."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = table(spark, root, "supplier").select("s_suppkey", "s_nationkey")
    full = lookup(lookup(table(spark, root, "lineitem"), orders, "l_orderkey", "o_orderkey"), supplier, "l_suppkey", "s_suppkey")
    raw = full.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_cita"),
        F.col("o_custkey").alias("pac_id"),
        F.col("l_suppkey").alias("med_id"),
        F.col("s_nationkey").cast("bigint").alias("id_sede"),
        F.col("o_orderdate").alias("fec_cita_programada"),
        F.col("o_orderdate").alias("hra_cita_programada"),
        F.col("o_orderdate").alias("hra_llegada_paciente"),
        F.timestamp_add("MINUTE", F.datediff("l_shipdate", "o_orderdate"), F.col("o_orderdate"))
        .alias("hra_inicio_atencion"),
        code_prefix("l_linestatus", 1).alias("esp_solicitada"),
        F.col("l_linestatus").alias("tip_cita"),
        standardize("l_returnflag", mapping=STATE).alias("estado_cita"),
    )
    return hospital.APPOINTMENTS.derive(raw, AS_OF)


# ---- the same roles in SQL ----------------------------------------------------------------------------------------

SITES_SQL = """
sites AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id_sede, n_name AS nom_sede, n_name AS nom_ciudad,
         CASE WHEN r_name = 'ASIA' THEN 'Centro Diagnostico' ELSE 'Otro' END AS tip_sede,
         CAST(n_nationkey AS BIGINT) AS id_ciudad, CAST(n_regionkey AS BIGINT) AS id_pais,
         CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
              ELSE upper(left(r_name, 1)) || lower(substr(r_name, 2)) END AS nom_pais,
         CAST(n_regionkey AS BIGINT) AS nivel_complejidad,
         gen, uci, cir, urg, gen + uci + cir + urg AS beds, r_name <> 'AFRICA' AS activa
  FROM nation JOIN region ON n_regionkey = r_regionkey
  JOIN (SELECT n_nationkey AS k,
               CAST(count(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS BIGINT) AS gen,
               CAST(count(*) FILTER (c_mktsegment = 'BUILDING') AS BIGINT) AS uci,
               CAST(count(*) FILTER (c_mktsegment = 'FURNITURE') AS BIGINT) AS cir,
               CAST(count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS BIGINT) AS urg
        FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey) ON k = n_nationkey
)"""

PATIENTS_SQL = """
patients AS (
  SELECT *, CASE WHEN edad_actual < 0 OR edad_actual IS NULL THEN 'Desconocido' WHEN edad_actual <= 12 THEN '0-12'
                 WHEN edad_actual <= 17 THEN '13-17' WHEN edad_actual <= 40 THEN '18-40'
                 WHEN edad_actual <= 65 THEN '41-65' ELSE '+65' END AS grupo_edad
  FROM (SELECT c_custkey AS pac_id, c_mktsegment AS tip_doc, sha256(c_name) AS num_doc_hash,
               CAST(DATE '1970-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS DATE) AS fec_nac,
               CAST(floor(date_diff('day', DATE '1970-01-01' + CAST(floor(c_acctbal) AS INTEGER), DATE '2002-01-01')
                    / 365.25) AS BIGINT) AS edad_actual,
               CASE left(c_mktsegment, 1) WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'O' END AS genero,
               CAST(c_nationkey AS VARCHAR) AS nom_ciudad_res,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Compensar' WHEN 'MACHINERY' THEN 'No Informado'
                    ELSE 'Otra Aseguradora' END AS tip_aseguradora,
               c_mktsegment AS id_eps, CAST(floor(c_acctbal / 2000) AS BIGINT) AS estrato_socioec,
               CAST(first AS DATE) AS fec_primer_atencion, c_acctbal > 0 AS activo
        FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY o_custkey)
             ON o_custkey = c_custkey)
)"""

VISITS_SQL = """
visits AS (
  SELECT *, left(diag_principal_cie10, 3) AS diag_cie10_3char,
         CAST((esp_atendida = 'Cardiologia' AND left(diag_principal_cie10, 3) NOT IN ('I10', 'I25', 'I50', 'I21'))
           OR (esp_atendida = 'Oncologia' AND left(diag_principal_cie10, 3) NOT IN ('C50', 'C34', 'C18'))
           OR (esp_atendida = 'Psiquiatria' AND left(diag_principal_cie10, 3) NOT IN ('F32', 'F33', 'F20'))
           OR (esp_atendida = 'Endocrinologia' AND left(diag_principal_cie10, 3) NOT IN ('E11', 'E14', 'E10'))
           AS INTEGER) AS glosa_riesgo
  FROM (SELECT o_orderkey AS id_encuentro, o_custkey AS pac_id, o_custkey AS med_id,
               CAST(c_nationkey AS BIGINT) AS id_sede, o_orderdate AS fec_registro,
               CAST(floor(o_totalprice / 10000) AS DOUBLE) AS tiempo_estadia_horas,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgencia' WHEN '2-HIGH' THEN 'Hospitalizacion'
                    WHEN '3-MEDIUM' THEN 'Control' WHEN '5-LOW' THEN 'Cirugia' ELSE 'Otro' END AS tip_consulta,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Cardiologia' WHEN 'BUILDING' THEN 'Oncologia'
                    WHEN 'FURNITURE' THEN 'Pediatria' WHEN 'HOUSEHOLD' THEN 'Psiquiatria'
                    ELSE 'Endocrinologia' END AS esp_atendida,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'I10.9' WHEN '2-HIGH' THEN 'C50.1' WHEN '3-MEDIUM' THEN 'E11.0'
                    WHEN '4-NOT SPECIFIED' THEN 'J06.9' ELSE 'F32.2' END AS diag_principal_cie10,
               o_orderstatus AS estado_factura, CAST(o_totalprice <= 50000 AS INTEGER) AS _nulo_vr_facturado
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
)"""

FACT_VISITS_SQL = f"""
{SITES_SQL}, {PATIENTS_SQL}, {VISITS_SQL},
fact_visits AS (
  SELECT id_encuentro, pac_id, med_id, id_sede, nom_ciudad, nom_pais, tip_sede, fec_registro, tip_consulta,
         esp_atendida, diag_principal_cie10, diag_cie10_3char, tiempo_estadia_horas, glosa_riesgo, estado_factura,
         grupo_edad, tip_aseguradora, _nulo_vr_facturado,
         CAST(year(fec_registro) AS INTEGER) AS anio, CAST(month(fec_registro) AS INTEGER) AS mes,
         CAST(tip_consulta IN ('Hospitalizacion', 'Cirugia') AS INTEGER) AS ind_hospitalizacion,
         CAST(diag_cie10_3char IN ('I10', 'E11', 'J45', 'F32', 'I25', 'E14') AS INTEGER) AS ind_dx_cronico,
         CAST(diag_cie10_3char IN ('C50', 'C34', 'C18') AS INTEGER) AS ind_dx_oncologico
  FROM visits LEFT JOIN sites USING (id_sede) LEFT JOIN patients USING (pac_id)
)"""

BEDS_SQL = """
snaps AS (
  SELECT *, CASE WHEN (raw_unit = 'UCI' AND tasa_ocupacion >= 0.85) OR (raw_unit = 'Urgencias' AND tasa_ocupacion >= 0.90)
                   OR (raw_unit IN ('General', 'Cirugia') AND tasa_ocupacion >= 0.88) THEN 'Critico'
                 WHEN tasa_ocupacion >= 0.70 THEN 'Precaucion' ELSE 'Normal' END AS estado_ocupacion,
         CASE WHEN raw_unit = 'Pasillo' THEN 'Otro' ELSE raw_unit END AS tip_unidad
  FROM (SELECT *, CASE WHEN used + free > 0 THEN round(used / (used + free), 4) ELSE 0.0 END AS tasa_ocupacion
        FROM (SELECT event_id AS id_registro_cama, CAST(c_nationkey AS BIGINT) AS id_sede, ts AS fec_hora_registro,
                     CASE event_type WHEN 'click' THEN 'General' WHEN 'view' THEN 'UCI' WHEN 'purchase' THEN 'Cirugia'
                          WHEN 'signup' THEN 'Urgencias' ELSE 'Pasillo' END AS raw_unit,
                     CAST(props::JSON ->> '$.k' AS BIGINT) AS used, CAST(floor(value) AS BIGINT) - 1 AS free
              FROM events LEFT JOIN customer ON user_id = c_custkey)
        WHERE free >= 0)
)"""

FACT_CAPACITY_SQL = f"""
{SITES_SQL}, {BEDS_SQL},
fact_capacity AS (
  SELECT id_registro_cama, id_sede, nom_sede, nom_ciudad, nom_pais, tip_sede, nivel_complejidad, tip_unidad,
         fec_hora_registro, used AS num_camas_ocupadas, free AS num_camas_disp, CAST(0 AS BIGINT) AS num_camas_mant,
         tasa_ocupacion, estado_ocupacion, CAST(year(fec_hora_registro) AS INTEGER) AS anio,
         CAST(month(fec_hora_registro) AS INTEGER) AS mes, CAST(day(fec_hora_registro) AS INTEGER) AS dia,
         CAST(hour(fec_hora_registro) AS INTEGER) AS hora,
         CAST(estado_ocupacion = 'Critico' AS INTEGER) AS ind_critico, used + free AS cap_total_operativa
  FROM snaps LEFT JOIN sites USING (id_sede)
)"""

FACT_WAIT_SQL = f"""
{SITES_SQL},
waits AS (
  SELECT l_orderkey * 10 + l_linenumber AS id_cita, o_custkey AS pac_id, l_suppkey AS med_id,
         CAST(s_nationkey AS BIGINT) AS id_sede, o_orderdate AS fec_cita_programada, l_linestatus AS esp_solicitada,
         l_linestatus AS tip_cita, CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS tiempo_espera_min,
         CAST(dayofweek(o_orderdate) BETWEEN 1 AND 5 AND hour(o_orderdate) BETWEEN 7 AND 17 AS INTEGER)
           AS ind_horario_habil
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_returnflag IN ('A', 'N')
),
fact_wait AS (
  SELECT id_cita, pac_id, med_id, id_sede, nom_ciudad, nom_pais, esp_solicitada, tip_cita, fec_cita_programada,
         tiempo_espera_min, ind_horario_habil, CAST(year(fec_cita_programada) AS INTEGER) AS anio,
         CAST(month(fec_cita_programada) AS INTEGER) AS mes,
         CASE WHEN tiempo_espera_min <= 20 THEN 'Optimo' WHEN tiempo_espera_min <= 45 THEN 'Aceptable'
              WHEN tiempo_espera_min <= 120 THEN 'Alto' ELSE 'Critico' END AS categoria_espera,
         CAST(tiempo_espera_min > 45 AS INTEGER) AS ind_supera_umbral
  FROM waits LEFT JOIN sites USING (id_sede) WHERE tiempo_espera_min >= 0
)"""
