"""The layered run on a small hospital network: two loads, late corrections, rejects, replays."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.anomaly import VolumeAnomalyError
from tidemark.plans import hospital, marts
from tidemark.plans.flow import HOSPITAL_KPIS, HOSPITAL_MARTS, REPORT_SCHEMA, RULE_SCHEMA, Lakehouse, Mart, Run, RunError, label
from tidemark.sources.files import conform_schema, nullable, stamp_modified, stream_files, write_landing
from tidemark.sources.tables import LakeTable
from tidemark.spec import ForeignKey, Reject, Rule, TableSpec, columns
from tidemark.streaming.ingest import foreach_batch_sink, load_all, load_to_table

DAY1, DAY2, DAY3 = datetime(2024, 6, 1, 2), datetime(2024, 6, 2, 2), datetime(2024, 6, 3, 2)

SITES = [
    (1, "S1", "Hospital Alta Complejidad", 1, "Bogota", 1, " COLOMBIA", 3, 60, 20, 10, 30, True, "2010-01-01"),
    (2, "S2", "Puesto", 2, None, 2, "peru", 1, 5, 0, 0, 5, True, None),
]
DOCTORS = [
    (1, "Cardiologia", None, 1, "2023-01-01", "Planta", "Completa", True),
    (2, "Pediatria", "X", 9, "2010-01-01", "Otro", "Turno", True),
]
HASH = "a" * 64
PATIENTS = [
    (1, "CC", HASH, "1980-05-01", "M", 1, "Bogota", None, None, None, "2020-01-01", True),
    (2, "CC", HASH, "2015-05-01", "X", 1, "Lima", "Compensar", "E1", 3, None, True),
]
APPOINTMENTS = [
    (1, 1, 1, 1, "2024-01-01", "2024-01-08", "09:00:00", "2024-01-08 08:50:00", "2024-01-08 09:20:00", "Cardiologia", "C", "Atendida"),
    (2, 2, 1, 1, "2024-01-01", "2024-01-07", "09:00:00", "2024-01-07 09:00:00", "2024-01-07 08:00:00", "Cardiologia", "C", "Atendida"),
    (3, 8, 1, 1, "2024-01-01", "2024-01-08", "19:00:00", None, None, "Cardiologia", "C", "Perdida"),
]
VISITS = [
    (1, 1, 1, 1, "2024-01-08 09:00:00", None, "2024-01-08 11:30:00", "Control", "Cardiologia", "I10.1", None, None, 10.5, None),
    (2, 2, 1, 2, "2024-02-08 09:00:00", None, None, "Cirugia", "Cardiologia", "C50.1", "Z00", "P1", None, "Pagada"),
    (3, 1, 1, 1, "2022-12-31 23:59:59", None, None, "Control", "Cardiologia", "I10", None, None, 1.0, None),
    (4, 9, 1, 1, "2024-01-08 09:00:00", None, None, "Rara", "Pediatria", "I10", None, None, 1.0, None),
]
BEDS = [
    (1, 1, "UCI", "2024-01-08 10:00:00", 85, 15, None, None),
    (2, 1, "UCI", "2024-01-08 11:00:00", 5, -1, 0, None),
    (3, 9, "UCI", "2024-01-08 11:00:00", 5, 5, 0, None),
]
LINES = [
    (1, 1, 1, 1, "2024-01-08", "M1", "Med", 2, 10.25, "Formulado"),
    (2, 1, 1, 1, "2024-01-08", "M2", "Med", 1, 0.5, None),
    (3, None, 1, 1, "2024-01-08", "M2", "Med", 1, 0.5, None),
    (4, 2, 1, 1, "2024-01-08", "M2", "Med", 0, 0.5, None),
]
DATA = {
    "RED_SEDES": SITES, "MED_PLANTA": DOCTORS, "PAC_REGISTRO": PATIENTS, "AGE_CITAS": APPOINTMENTS,
    "HCE_ENCUENTROS": VISITS, "GCM_CAMAS": BEDS, "FAR_DISPENSACION": LINES,
}
SPECS = {s.name: s for s in hospital.TABLES}


def frame(spark, name, rows, modified):
    spec = SPECS[name]
    df = spark.createDataFrame(rows, nullable(spec.schema))
    return stamp_modified(conform_schema(df, spec.schema, spec.decimals), modified)


def sources(spark, changed=None, modified=DAY2):
    """The first load, followed by ``changed`` rows with a later stamp."""
    out = {n: frame(spark, n, rows, DAY1) for n, rows in DATA.items()}
    for name, rows in (changed or {}).items():
        out[name] = out[name].unionByName(frame(spark, name, rows, modified))
    return out


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    lake = Lakehouse(spark, root, hospital.TABLES, HOSPITAL_MARTS, HOSPITAL_KPIS)
    lake.run(sources(spark), DAY1)
    return lake


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_cleaned_tables(lake):
    sites = by_key(lake.silver("RED_SEDES").read(), "id_sede")
    assert (sites[1].cap_camas_total, sites[1].pct_uci, sites[1].nom_pais) == (120, 16.67, "Colombia")
    assert (sites[2].tip_sede, sites[2].nom_ciudad, sites[2]["_nulo_fec_apertura"]) == ("Otro", "Sin Ciudad", 1)
    assert list(by_key(lake.silver("MED_PLANTA").read(), "med_id")) == [1]
    patients = by_key(lake.silver("PAC_REGISTRO").read(), "pac_id")
    assert (patients[1].edad_actual, patients[1].grupo_edad, patients[1].tip_aseguradora) == (44, "41-65", "No Informado")
    assert (patients[2].genero, patients[2].grupo_edad, patients[2].id_eps) == ("O", "0-12", "E1")
    appointments = by_key(lake.silver("AGE_CITAS").read(), "id_cita")
    assert set(appointments) == {1, 2}
    assert (appointments[1].tiempo_espera_min, appointments[1].ind_horario_habil) == (30.0, 1)
    assert (appointments[2].tiempo_espera_min, appointments[2].ind_horario_habil) == (None, 0)
    visits = by_key(lake.silver("HCE_ENCUENTROS").read(), "id_encuentro")
    assert set(visits) == {1, 2}
    assert (visits[1].tiempo_estadia_horas, visits[1].glosa_riesgo, visits[1].vr_facturado) == (2.5, 0, None)
    assert (visits[2].glosa_riesgo, visits[2]["_nulo_vr_facturado"], visits[2]["_nulo_fec_egreso"]) == (1, 1, 1)
    beds = by_key(lake.silver("GCM_CAMAS").read(), "id_registro_cama")
    assert (beds[1].tasa_ocupacion, beds[1].estado_ocupacion, beds[1].motivo_indisponibilidad) == (0.85, "Critico", "Sin Motivo")
    lines = by_key(lake.silver("FAR_DISPENSACION").read(), "id_dispensacion")
    assert set(lines) == {1, 2, 3} and lines[1].vr_unitario is None and float(lines[1].vr_total_dispensacion) == 20.5
    assert (lines[2].tip_prescripcion, lines[3]["_nulo_id_encuentro"]) == ("No Informado", 1)


def test_every_lost_row_is_in_quarantine(lake):
    errors = sorted((r.tabla_origen, r.motivo_error) for r in lake.errors().collect())
    assert errors == [
        ("AGE_CITAS", "FK_INVALIDA: pac_id no existe en PAC_REGISTRO"),
        ("AGE_CITAS", "TIEMPO_ESPERA_NEGATIVO"),
        ("FAR_DISPENSACION", "CANTIDAD_INVALIDA: cantidad <= 0"),
        ("GCM_CAMAS", "CAMAS_DISP_NEGATIVA: num_camas_disp < 0"),
        ("GCM_CAMAS", "FK_INVALIDA: id_sede no existe en RED_SEDES"),
        ("HCE_ENCUENTROS", "FECHA_FUERA_RANGO: fec_registro < 2023-01-01"),
        ("HCE_ENCUENTROS", "FK_INVALIDA: pac_id no existe en PAC_REGISTRO"),
        ("MED_PLANTA", "FK_INVALIDA: id_sede no existe en RED_SEDES"),
    ]
    negative = lake.errors().filter("motivo_error = 'TIEMPO_ESPERA_NEGATIVO'").first()
    assert '"tiempo_espera_min":-60.0' in negative.payload


def test_rules_and_report(lake):
    rules = lake.reports("pruebas_calidad", RULE_SCHEMA)
    assert rules.count() == 35
    assert {r.prueba for r in rules.filter(~F.col("aprobada")).collect()} == set()
    report = by_key(lake.reports("reporte_calidad", REPORT_SCHEMA), "tabla")["HCE_ENCUENTROS"]
    assert (report.n_registros_bronze, report.n_registros_silver, report.n_rechazados, report.pct_conformes) == (4, 2, 2, 50.0)


def test_marts(lake):
    patients = by_key(lake.gold("dim_pacientes").read(), "pac_id")
    assert (patients[1].segmento_socioeconomico, patients[2].segmento_socioeconomico) == ("Desconocido", "Medio")
    assert patients[2].anos_desde_primer_atencion == 0.0
    assert by_key(lake.gold("dim_medicos").read(), "med_id")[1].nivel_experiencia == "Junior"
    sites = by_key(lake.gold("dim_sedes").read(), "id_sede")
    assert [(s.cod_pais, s.categoria_capacidad) for s in (sites[1], sites[2])] == [("COL", "Alta"), ("PER", "Baja")]
    visits = by_key(lake.gold("fact_consultas").read(), "id_encuentro")
    assert [(v.ind_hospitalizacion, v.ind_dx_cronico, v.ind_dx_oncologico) for v in (visits[1], visits[2])] == [(0, 1, 0), (1, 0, 1)]
    assert visits[1].nom_ciudad == "Bogota" and visits[2].grupo_edad == "0-12"
    cost = by_key(lake.gold("fact_costos_atencion").read(), "id_encuentro")
    assert (float(cost[1].vr_medicamentos), cost[1].num_medicamentos) == (21.0, 2)
    assert (float(cost[2].costo_medicamentos), cost[2].num_medicamentos) == (0.0, 0)
    wait = by_key(lake.gold("fact_tiempos_espera").read(), "id_cita")
    assert set(wait) == {1} and wait[1].categoria_espera == "Aceptable"
    beds = by_key(lake.gold("fact_ocupacion_camas").read(), "id_registro_cama")
    assert (beds[1].ind_critico, beds[1].cap_total_operativa, beds[1].hora) == (1, 100, 10)
    assert lake.gold("fact_alertas_epidemiologicas").read().isEmpty()


def test_kpis(lake):
    executive = by_key(lake.gold("kpis_resumen_ejecutivo").read(), "mes")
    assert (executive[1].total_consultas, executive[1].tiempo_espera_promedio_min, executive[1].tasa_ocupacion_promedio_red) == (1, 30.0, 0.85)
    assert (executive[2].tasa_hospitalizacion_pct, executive[2].tiempo_espera_promedio_min) == (100.0, None)
    volume = lake.gold("kpis_volumen_consultas").read()
    assert volume.count() == 2 and {r.kpi_tipo for r in volume.collect()} == {"VOLUMEN_CONSULTAS"}


def test_second_run_without_changes_does_nothing(lake, spark):
    versions = {n: lake.gold(n).version() for n in [*lake.marts, *lake.kpis]}
    lake.run(sources(spark), DAY2)
    log = lake.run_log().filter(F.col("ts_ejecucion") == F.lit(DAY2))
    assert {r.estado for r in log.collect()} == {"SIN_CAMBIOS"}
    assert versions == {n: lake.gold(n).version() for n in [*lake.marts, *lake.kpis]}


def test_third_run_reaches_only_what_changes_touch(lake, spark):
    """A site moves to another city, a line moves to another visit, a visit changes its month."""
    moved_site = (2, *SITES[1][1:4], "Cali", *SITES[1][5:])
    moved_line = (2, 2, *LINES[1][2:])
    moved_visit = (1, *VISITS[0][1:4], "2024-02-09 09:00:00", *VISITS[0][5:])
    cancelled = (*APPOINTMENTS[0][:-1], "Cancelada")
    changed = {
        "RED_SEDES": [moved_site], "FAR_DISPENSACION": [moved_line], "HCE_ENCUENTROS": [moved_visit],
        "AGE_CITAS": [cancelled],
    }
    lake.run(sources(spark, changed), DAY3)

    incremental = {n: by_key(lake.gold(n).read(), lake.gold(n).keys[0]) for n in ("fact_consultas", "fact_costos_atencion")}
    visits, cost = incremental["fact_consultas"], incremental["fact_costos_atencion"]
    assert visits[2].nom_ciudad == "Cali" and (visits[1].mes, visits[1].anio) == (2, 2024)
    assert (float(cost[1].vr_medicamentos), float(cost[2].vr_medicamentos)) == (20.5, 0.5)
    cities = {(r.nom_ciudad, r.mes): r.n_consultas for r in lake.gold("kpis_volumen_consultas").read().collect()}
    assert cities == {("Cali", 2): 1, ("Bogota", 2): 1}  # nothing is left of January
    assert lake.gold("fact_tiempos_espera").read().isEmpty() and lake.gold("kpis_tiempos_espera").read().isEmpty()

    # The same as building everything anew from the cleaned tables.
    silver = {n: lake.silver(n).read() for n in SPECS}
    full = marts.fact_visit_cost(silver["HCE_ENCUENTROS"], silver["FAR_DISPENSACION"], silver["PAC_REGISTRO"])
    stored = lake.gold("fact_costos_atencion").read().select(*full.columns)
    assert full.exceptAll(stored).isEmpty() and stored.exceptAll(full).isEmpty()


def test_business_key_finds_copies_with_new_ids(spark):
    copies = [APPOINTMENTS[0], (9, *APPOINTMENTS[0][1:])]
    df = frame(spark, "AGE_CITAS", copies, DAY1)
    spec = SPECS["AGE_CITAS"]
    patients = spark.createDataFrame([(1,)], "pac_id bigint")
    assert label(df, spec, date(2024, 1, 1), {"PAC_REGISTRO": patients}).count() == 2
    from dataclasses import replace

    strict = replace(spec, dedup_keys=["pac_id", "id_sede", "fec_cita_programada"])
    assert label(df, strict, date(2024, 1, 1), {"PAC_REGISTRO": patients}).count() == 1


def test_late_rows_and_errors(spark, tmp_path):
    from dataclasses import replace

    spec = replace(SPECS["RED_SEDES"], lateness="2 days")
    lake = Lakehouse(spark, str(tmp_path / "late"), [spec])
    run1, run2 = Run.start(DAY2), Run.start(DAY3)
    lake.ingest("RED_SEDES", frame(spark, "RED_SEDES", SITES[:1], DAY2), run1)
    both = frame(spark, "RED_SEDES", SITES[:1], DAY2).unionByName(frame(spark, "RED_SEDES", SITES[1:], DAY1))
    assert lake.ingest("RED_SEDES", both, run2) == "EXITOSO"
    assert [r.id_sede for r in lake.bronze("RED_SEDES").feed(0).collect()] == [2]
    assert lake.ingest("RED_SEDES", both, run2) == "SIN_CAMBIOS"
    with pytest.raises(Exception, match="fec_modificacion"):
        lake.ingest("RED_SEDES", both.withColumnRenamed("fec_modificacion", "no_such"), run2)
    assert lake.run_log().filter("estado = 'ERROR'").count() == 1


def test_full_load_replaces_bronze(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "full"), [SPECS["RED_SEDES"]])
    lake.ingest("RED_SEDES", frame(spark, "RED_SEDES", SITES, DAY1), Run.start(DAY1))
    lake.ingest("RED_SEDES", lambda since: frame(spark, "RED_SEDES", SITES[:1], DAY1), Run.start(DAY2), full=True)
    assert lake.bronze("RED_SEDES").read().count() == 1


def test_volume_check(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "volumes"), [SPECS["RED_SEDES"]])
    for day, n in enumerate([10, 10, 10, 10], start=1):
        lake._log("bronze", "RED_SEDES", Run.start(datetime(2024, 6, day)), n, "EXITOSO", "", 0)
    assert lake.check_volumes(Run.start(datetime(2024, 6, 9))).isEmpty()
    lake._log("bronze", "RED_SEDES", Run.start(datetime(2024, 6, 10)), 100, "EXITOSO", "", 0)
    with pytest.raises(VolumeAnomalyError):
        lake.check_volumes(Run.start(datetime(2024, 6, 11)))


# ---- landing streams ------------------------------------------------------------------------------------------------

def test_two_drops_a_restart_and_a_broken_line(spark, tmp_path):
    spec = SPECS["GCM_CAMAS"]
    folder, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    table = LakeTable(spark, str(tmp_path / "source"))
    write_landing(spark.createDataFrame(BEDS[:1], nullable(spec.schema)), str(folder), "json", files=1)
    load = lambda: load_to_table(spark, spec, str(folder), table, checkpoint, now=lambda: DAY1)
    load()
    load()  # nothing new
    assert table.read().count() == 1 and table.version() == 0
    (folder / "more.json").write_text('{"id_registro_cama": 7, "id_sede": 1}\n{"id_registro_cama": "broken\n')
    load()
    got = {r.id_registro_cama: r for r in table.read().collect()}
    assert set(got) == {1, 7, None} and got[7].fec_modificacion == DAY1


def test_periodic_trigger_keeps_running(spark, tmp_path):
    spec = SPECS["GCM_CAMAS"]
    folder = tmp_path / "landing"
    write_landing(spark.createDataFrame(BEDS[:2], nullable(spec.schema)), str(folder), "json")
    table = LakeTable(spark, str(tmp_path / "source"))
    stream = stream_files(spark, str(folder), "json", nullable(spec.schema))
    write = lambda batch, n: table.append(batch, DAY1, tag=f"batch-{n}", once=True)
    query = foreach_batch_sink(stream, write, str(tmp_path / "checkpoint"), once=False, interval="1 second")
    try:
        assert query.isActive
        query.processAllAvailable()
        assert table.read().count() == 2
    finally:
        query.stop()


def test_tables_load_in_order_and_one_failure_stops_nobody(spark):
    seen = []

    def load(spec):
        seen.append(spec.name)
        if spec.name == "MED_PLANTA":
            raise RuntimeError("no folder")

    summary = {r.tabla: r.estado for r in load_all(spark, hospital.TABLES, load).collect()}
    assert seen == [s.name for s in hospital.TABLES]
    assert [n for n, state in summary.items() if state == "ERROR"] == ["MED_PLANTA"]


# ---- what the layered run must not lose, leak or keep ---------------------------------------------------------------

def small_spec(**more):
    return TableSpec(
        "T", columns("k long, v string, m double, ts timestamp"), keys=["k"], date_column="ts", watermark="ts", **more,
    )


def small_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, m double, ts timestamp")


def test_rows_with_the_stamp_of_the_watermark_arrive_later(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), [small_spec()])
    lake.run({"T": small_rows(spark, (1, "a", 1.0, DAY1))}, DAY1)
    later = small_rows(spark, (1, "a", 1.0, DAY1), (2, "b", 1.0, DAY1), (3, "c", 1.0, None))
    lake.run({"T": later}, DAY2)
    lake.run({"T": later}, DAY3)
    assert sorted(r.k for r in lake.silver("T").read().collect()) == [1, 2]
    assert lake.bronze("T").read().count() == 2
    assert [r.motivo_error for r in lake.errors().collect()] == ["SIN_FECHA: ts"]


def test_a_late_old_version_stays_out_of_silver(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path), [small_spec(lateness="10 days")])
    lake.run({"T": small_rows(spark, (1, "new", 1.0, DAY2))}, DAY2)
    lake.run({"T": small_rows(spark, (1, "old", 1.0, DAY1), (2, "other", 1.0, DAY1))}, DAY3)
    assert {r.k: r.v for r in lake.silver("T").read().collect()} == {1: "new", 2: "other"}
    (error,) = lake.errors().collect()
    assert error.motivo_error == "VERSION_ANTERIOR" and '"v":"old"' in error.payload


def test_no_report_shows_masked_values(spark, tmp_path):
    rejects = [Reject("BAD", lambda: F.col("v") == "bad"), Reject("FIX", lambda: F.col("v") == "fix", null_out="v")]
    lake = Lakehouse(spark, str(tmp_path), [small_spec(masked=["m"], rejects=rejects)])
    rows = [(1, "bad", 99.5, DAY1), (2, "fix", 99.5, DAY1), (3, "ok", 99.5, DAY1), (3, "ok", 99.5, DAY1), (4, "x", 99.5, None), (None, "n", 99.5, DAY1), (None, "o", 99.5, DAY1)]
    lake.run({"T": small_rows(spark, *rows)}, DAY1)
    errors = lake.errors().collect()
    assert sorted(e.motivo_error for e in errors) == ["BAD", "CLAVE_NULA: k", "CLAVE_NULA: k", "DUPLICADO_EXACTO", "FIX", "SIN_FECHA: ts"]
    assert not any("99.5" in e.payload for e in errors)
    assert lake._scratch == []


def test_a_rebuilt_mart_drops_rows_and_keeps_null_keys(spark, tmp_path):
    mart = Mart("M", ["v"], [], lambda t, run: t["T"].filter("m > 0").groupBy("v").count(), "T", nullable_keys=True)
    lake = Lakehouse(spark, str(tmp_path), [small_spec()], [mart])
    lake.run({"T": small_rows(spark, (1, "a", 1.0, DAY1), (2, None, 1.0, DAY1))}, DAY1)
    assert {r.v for r in lake.gold("M").read().collect()} == {"a", None}
    lake.run({"T": small_rows(spark, (1, "a", -1.0, DAY2))}, DAY2)
    assert {r.v for r in lake.gold("M").read().collect()} == {None}


def test_a_parent_without_rows_and_a_step_that_fails(spark, tmp_path):
    child = TableSpec(
        "C", columns("c long, k long, ts timestamp"), keys=["c"], date_column="ts", watermark="ts", parents=[ForeignKey("k", "T", "k")],
    )
    broken = Mart("broken", ["c"], [], lambda t, run: t["C"].select("no_such"), "C")
    fine = Mart("fine", ["c"], [], lambda t, run: t["C"].select("c"), "C", dims={"T": ("k", "k")})
    lake = Lakehouse(spark, str(tmp_path), [small_spec(), child], [broken, fine])
    rows = spark.createDataFrame([(1, 1, DAY1), (2, None, DAY1)], "c long, k long, ts timestamp")
    with pytest.raises(RunError, match="gold.broken"):
        lake.run({"C": rows}, DAY1)
    assert lake.silver("T").read().isEmpty() and lake.gold("fine").read().isEmpty()
    assert {e.motivo_error for e in lake.errors().collect()} == {"FK_INVALIDA: k no existe en T"}
    states = {(r.capa, r.tabla): r.estado for r in lake.run_log().collect()}
    assert states["gold", "broken"] == "ERROR" and states["gold", "fine"] == "EXITOSO"


def test_a_rule_that_fails_on_a_row_stops_no_load(spark, tmp_path):
    """The rows are written without the rules, which are then tried apart; the report is the same."""
    rules = [Rule("fails", lambda: F.col("s").cast("int") > 0, True), Rule("fine", lambda: F.col("k") > 1)]
    spec = TableSpec("t", columns("k long, s string"), ["k"], "seen", watermark="seen", rules=rules)
    lake = Lakehouse(spark, str(tmp_path), [spec])
    rows = spark.createDataFrame([(1, "x"), (2, "2"), (2, "2")], "k long, s string")
    lake.run({"t": stamp_modified(rows, DAY1, "seen")}, DAY1)
    found = {r.prueba: (r.n_fallos, r.estado) for r in lake.reports("pruebas_calidad", RULE_SCHEMA).collect()}
    assert found == {"fails": (0, "ERROR"), "fine": (1, "ADVERTENCIA")}
    row = lake.reports("reporte_calidad", REPORT_SCHEMA).first()
    assert (row.n_registros_bronze, row.n_registros_silver, row.n_duplicados, row.n_rechazados) == (3, 2, 1, 0)
    assert lake.errors().first().motivo_error == "DUPLICADO_EXACTO" and lake.silver("t").read().count() == 2


def test_a_corrected_value_under_an_old_stamp_is_loaded(spark, tmp_path):
    spec = TableSpec("t", columns("k long, s string"), ["k"], "seen", watermark="seen")
    lake = Lakehouse(spark, str(tmp_path), [spec])
    for day, value in ((DAY1, "old"), (DAY2, "new"), (DAY3, "new")):
        rows = spark.createDataFrame([(1, value), (2, "same"), (3, None)], "k long, s string")
        lake.run({"t": stamp_modified(rows, DAY1, "seen")}, day)
    assert {r.k: r.s for r in lake.silver("t").read().collect()} == {1: "new", 2: "same", 3: None}
    assert lake.bronze("t").read().count() == 4 and lake.errors().isEmpty()
