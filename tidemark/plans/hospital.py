"""Source tables of the hospital network: schemas, keys, null handling, derivations, rejects, parents, rules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    age_years, band, business_hours_flag, code_prefix, elapsed, line_total, normalize_text, pct, rule_matrix_flag,
    share_of_sum, standardize, tenure_years, threshold_status, total,
)
from tidemark.spec import ForeignKey, Reject, Rule, TableSpec, columns

# Column names and types of the source tables.
SCHEMAS = {
    "RED_SEDES": (
        "id_sede long!, nom_sede string!, tip_sede string!, id_ciudad long!, "
        "nom_ciudad string!, id_pais long!, nom_pais string!, "
        "nivel_complejidad long!, cap_camas_gen long!, cap_camas_uci long!, "
        "cap_camas_cirugia long!, cap_camas_urg long!, activa boolean!, "
        "fec_apertura string"
    ),
    "MED_PLANTA": (
        "med_id long!, esp_principal string!, esp_secundaria string, id_sede long!, "
        "fec_ingreso string!, tip_contrato string!, jornada string!, "
        "estado_activo boolean!"
    ),
    "PAC_REGISTRO": (
        "pac_id long!, tip_doc string!, num_doc_hash string!, fec_nac string!, "
        "genero string!, id_ciudad_res long, nom_ciudad_res string, tip_aseguradora string, id_eps string, "
        "estrato_socioec long, fec_primer_atencion string, activo boolean!"
    ),
    "AGE_CITAS": (
        "id_cita long!, pac_id long!, med_id long!, id_sede long!, "
        "fec_agendamiento string!, fec_cita_programada string!, hra_cita_programada string!, "
        "hra_llegada_paciente string, hra_inicio_atencion string, esp_solicitada string!, "
        "tip_cita string!, estado_cita string!"
    ),
    "HCE_ENCUENTROS": (
        "id_encuentro long!, pac_id long!, med_id long!, id_sede long!, "
        "fec_registro string!, fec_inicio_atencion string, fec_egreso string, tip_consulta string!, "
        "esp_atendida string!, diag_principal_cie10 string!, diag_sec1_cie10 string, "
        "cod_procedimientos string, vr_facturado double, estado_factura string"
    ),
    "GCM_CAMAS": (
        "id_registro_cama long!, id_sede long!, tip_unidad string!, "
        "fec_hora_registro string!, num_camas_ocupadas long!, num_camas_disp long!, "
        "num_camas_mant long, motivo_indisponibilidad string"
    ),
    "FAR_DISPENSACION": (
        "id_dispensacion long!, id_encuentro long, pac_id long!, id_sede long!, "
        "fec_dispensacion string!, cod_medicamento string!, nom_medicamento string!, "
        "cantidad long!, vr_unitario double, tip_prescripcion string"
    ),
}

# Catalogs and limits the results depend on.
SITE_TYPES = [
    "Hospital Alta Complejidad", "Clinica Mediana Complejidad", "Centro Medico Ambulatorio", "Centro Diagnostico",
]
CONTRACTS = ["Planta", "Prestacion Servicios", "Honorarios"]
SHIFTS = ["Completa", "Medio Tiempo", "Turno"]
INSURERS = [
    "EPS Sanitas", "EPS Sura", "Nueva EPS", "Compensar", "Famisanar", "Salud Total", "Coosalud", "Medimas",
    "Particular", "Rimac Seguros", "Pacifico Seguros", "La Positiva Seguros", "IESS Ecuador", "Seguros Sucre",
]
APPOINTMENT_STATES = ["Atendida", "Cancelada", "No Asistio", "Programada"]
VISIT_TYPES = ["Primera Vez", "Control", "Urgencia", "Hospitalizacion", "Cirugia"]
UNITS = ["General", "UCI", "Cirugia", "Urgencias"]
PRESCRIPTIONS = ["Formulado", "Venta Libre", "Muestra Medica"]
EXPECTED_DIAGNOSES = {
    "Cardiologia": ["I10", "I25", "I50", "I21"],
    "Endocrinologia": ["E11", "E14", "E10"],
    "Oncologia": ["C50", "C34", "C18"],
    "Neurologia": ["G40", "G35", "G43"],
    "Neumologia": ["J45", "J18", "J44"],
    "Psiquiatria": ["F32", "F33", "F20"],
}
CRITICAL_OCCUPANCY = {"UCI": 0.85, "Urgencias": 0.90, "General": 0.88, "Cirugia": 0.88}
CAUTION_OCCUPANCY = 0.70
AGE_BANDS = [(12, "0-12"), (17, "13-17"), (40, "18-40"), (65, "41-65")]
FIRST_VALID_DATE = "2023-01-01"
UNINFORMED = "No Informado"


def _sites(df: DataFrame, as_of: date) -> DataFrame:
    beds = total("cap_camas_gen", "cap_camas_uci", "cap_camas_cirugia", "cap_camas_urg")
    return df.withColumns(
        {
            "tip_sede": standardize("tip_sede", SITE_TYPES, "Otro"),
            "cap_camas_total": beds,
            "pct_uci": pct("cap_camas_uci", beds),
            "nom_pais": normalize_text("nom_pais"),
        }
    )


def _doctors(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumns(
        {
            "anos_experiencia": tenure_years("fec_ingreso", as_of),
            "tip_contrato": standardize("tip_contrato", CONTRACTS, "Otro"),
            # The placeholder put in for a missing shift is a value of its own.
            "jornada": standardize("jornada", [*SHIFTS, UNINFORMED], "Otro"),
        }
    )


def _patients(df: DataFrame, as_of: date) -> DataFrame:
    age = age_years("fec_nac", as_of)
    return df.withColumns(
        {
            "edad_actual": age,
            "grupo_edad": band(age, AGE_BANDS, "+65", floor=0, unknown="Desconocido"),
            "tip_aseguradora": standardize(
                "tip_aseguradora", [*INSURERS, UNINFORMED], "Otra Aseguradora", UNINFORMED
            ),
            "genero": standardize("genero", ["M", "F"], "O"),
        }
    )


def _appointments(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumns(
        {
            "tiempo_espera_min": elapsed("hra_llegada_paciente", "hra_inicio_atencion", "minute", 1),
            "estado_cita": standardize("estado_cita", APPOINTMENT_STATES, "Otro"),
            "ind_horario_habil": business_hours_flag("fec_cita_programada", "hra_cita_programada"),
        }
    )


def _visits(df: DataFrame, as_of: date) -> DataFrame:
    code = code_prefix("diag_principal_cie10")
    return df.withColumns(
        {
            "tiempo_estadia_horas": elapsed("fec_registro", "fec_egreso", "hour", 2),
            "diag_cie10_3char": code,
            "glosa_riesgo": rule_matrix_flag("esp_atendida", code, EXPECTED_DIAGNOSES),
            "tip_consulta": standardize("tip_consulta", VISIT_TYPES, "Otro"),
        }
    )


def _beds(df: DataFrame, as_of: date) -> DataFrame:
    rate = share_of_sum("num_camas_ocupadas", "num_camas_disp")
    return df.withColumns(
        {
            "tasa_ocupacion": rate,
            "estado_ocupacion": threshold_status(rate, "tip_unidad", CRITICAL_OCCUPANCY, CAUTION_OCCUPANCY),
            "tip_unidad": standardize("tip_unidad", UNITS, "Otro"),
        }
    )


def _dispensing(df: DataFrame, as_of: date) -> DataFrame:
    return df.withColumns(
        {
            "vr_total_dispensacion": line_total("cantidad", "vr_unitario"),
            "tip_prescripcion": standardize("tip_prescripcion", PRESCRIPTIONS, UNINFORMED),
        }
    )


def _not_null(column: str, critical: bool = True, label: str = "no nulo") -> Rule:
    return Rule(f"{column} {label}", lambda: F.col(column).isNotNull(), critical)


def _in_catalog(column: str, values: list[str], label: str = "en catálogo") -> Rule:
    return Rule(f"{column} {label}", lambda: F.col(column).isin(values))


def _null_or_not_negative(column: str, critical: bool) -> Rule:
    return Rule(f"{column} >= 0 o nulo", lambda: F.col(column).isNull() | (F.col(column) >= 0), critical)


def _before_valid():
    return F.col("fec_registro").try_cast("timestamp") < F.lit(FIRST_VALID_DATE).cast("timestamp")


_TO_PATIENTS = ForeignKey("pac_id", "PAC_REGISTRO", "pac_id")
_TO_SITES = ForeignKey("id_sede", "RED_SEDES", "id_sede")


def _schema(name: str) -> T.StructType:
    return columns(SCHEMAS[name])


SITES = TableSpec(
    name="RED_SEDES",
    schema=_schema("RED_SEDES"),
    keys=["id_sede"],
    date_column="fec_apertura",
    fmt="csv",
    nulls={"fec_apertura": ("indicador", None), "nom_ciudad": ("imputar", "Sin Ciudad")},
    derive=_sites,
    rules=[
        _not_null("id_sede"),
        _in_catalog("tip_sede", [*SITE_TYPES, "Otro"], "en catálogo controlado"),
        Rule("cap_camas_total >= 0", lambda: F.col("cap_camas_total") >= 0, True),
        Rule("nivel_complejidad entre 1 y 3", lambda: F.col("nivel_complejidad").between(1, 3)),
        _not_null("nom_pais"),
    ],
)

DOCTORS = TableSpec(
    name="MED_PLANTA",
    schema=_schema("MED_PLANTA"),
    keys=["med_id"],
    date_column="fec_ingreso",
    fmt="csv",
    nulls={"esp_secundaria": ("imputar", "Sin Subespecialidad"), "jornada": ("imputar", UNINFORMED)},
    derive=_doctors,
    parents=[_TO_SITES],
    rules=[
        _not_null("med_id"),
        _not_null("esp_principal"),
        Rule("anos_experiencia >= 0", lambda: F.col("anos_experiencia") >= 0),
        _in_catalog("tip_contrato", [*CONTRACTS, "Otro"]),
        _not_null("id_sede"),
    ],
)

PATIENTS = TableSpec(
    name="PAC_REGISTRO",
    schema=_schema("PAC_REGISTRO"),
    keys=["pac_id"],
    date_column="fec_primer_atencion",
    nulls={
        "tip_aseguradora": ("imputar", UNINFORMED),
        "estrato_socioec": ("imputar", 0),
        "nom_ciudad_res": ("imputar", UNINFORMED),
        "fec_primer_atencion": ("indicador", None),
        "id_eps": ("imputar", "SIN_EPS"),
    },
    derive=_patients,
    rules=[
        _not_null("pac_id"),
        Rule("num_doc_hash longitud 64 (SHA-256)", lambda: F.length("num_doc_hash") == 64, True),
        _in_catalog("genero", ["M", "F", "O"], "en M/F/O"),
        Rule("edad_actual entre 0 y 120", lambda: F.col("edad_actual").between(0, 120)),
        _not_null("grupo_edad", False, "asignado"),
    ],
)

APPOINTMENTS = TableSpec(
    name="AGE_CITAS",
    schema=_schema("AGE_CITAS"),
    keys=["id_cita"],
    date_column="fec_agendamiento",
    nulls={
        "esp_solicitada": ("imputar", UNINFORMED),
        "hra_llegada_paciente": ("indicador", None),
        "hra_inicio_atencion": ("indicador", None),
    },
    derive=_appointments,
    rejects=[
        Reject("TIEMPO_ESPERA_NEGATIVO", lambda: F.col("tiempo_espera_min") < 0, null_out="tiempo_espera_min"),
    ],
    parents=[_TO_PATIENTS],
    rules=[
        _not_null("id_cita"),
        _not_null("pac_id"),
        _in_catalog("estado_cita", [*APPOINTMENT_STATES, "Otro"]),
        _not_null("fec_cita_programada", label="no nula"),
        _null_or_not_negative("tiempo_espera_min", True),
    ],
)

VISITS = TableSpec(
    name="HCE_ENCUENTROS",
    schema=_schema("HCE_ENCUENTROS"),
    keys=["id_encuentro"],
    date_column="fec_registro",
    decimals={"vr_facturado": (14, 2)},
    nulls={
        "vr_facturado": ("indicador", None),
        "estado_factura": ("imputar", "Sin Estado"),
        "diag_sec1_cie10": ("imputar", "Z00"),
        "cod_procedimientos": ("imputar", "Sin Procedimiento"),
        "fec_egreso": ("indicador", None),
    },
    masked=["vr_facturado"],
    derive=_visits,
    rejects=[Reject(f"FECHA_FUERA_RANGO: fec_registro < {FIRST_VALID_DATE}", _before_valid)],
    parents=[_TO_PATIENTS],
    rules=[
        _not_null("id_encuentro"),
        _not_null("diag_principal_cie10"),
        Rule(f"fec_registro >= {FIRST_VALID_DATE}", lambda: ~_before_valid(), True),
        _null_or_not_negative("tiempo_estadia_horas", False),
        _in_catalog("tip_consulta", [*VISIT_TYPES, "Otro"]),
    ],
)

BEDS = TableSpec(
    name="GCM_CAMAS",
    schema=_schema("GCM_CAMAS"),
    keys=["id_registro_cama"],
    date_column="fec_hora_registro",
    fmt="json",
    nulls={"num_camas_mant": ("imputar", 0), "motivo_indisponibilidad": ("imputar", "Sin Motivo")},
    derive=_beds,
    rejects=[Reject("CAMAS_DISP_NEGATIVA: num_camas_disp < 0", lambda: F.col("num_camas_disp") < 0)],
    parents=[_TO_SITES],
    rules=[
        _not_null("id_registro_cama"),
        Rule("num_camas_disp >= 0", lambda: F.col("num_camas_disp") >= 0, True),
        Rule("tasa_ocupacion entre 0 y 1", lambda: F.col("tasa_ocupacion").between(0, 1), True),
        _in_catalog("tip_unidad", [*UNITS, "Otro"]),
        _in_catalog("estado_ocupacion", ["Critico", "Precaucion", "Normal"], "asignado"),
    ],
)

DISPENSING = TableSpec(
    name="FAR_DISPENSACION",
    schema=_schema("FAR_DISPENSACION"),
    keys=["id_dispensacion"],
    date_column="fec_dispensacion",
    fmt="json",
    decimals={"vr_unitario": (10, 2)},
    nulls={
        "vr_unitario": ("indicador", None),
        "tip_prescripcion": ("imputar", UNINFORMED),
        "id_encuentro": ("indicador", None),
    },
    masked=["vr_unitario"],
    derive=_dispensing,
    rejects=[Reject("CANTIDAD_INVALIDA: cantidad <= 0", lambda: F.col("cantidad") <= 0)],
    parents=[_TO_PATIENTS],
    rules=[
        _not_null("id_dispensacion"),
        Rule("cantidad > 0", lambda: F.col("cantidad") > 0, True),
        _not_null("cod_medicamento"),
        _in_catalog("tip_prescripcion", [*PRESCRIPTIONS, UNINFORMED]),
        _not_null("pac_id"),
    ],
)

TABLES = [SITES, DOCTORS, PATIENTS, APPOINTMENTS, VISITS, BEDS, DISPENSING]
"""In loading order: parents before the tables that refer to them."""
