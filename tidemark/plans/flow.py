"""The layered run: ingest (bronze), clean (silver), marts and KPI tables (gold), volume check.

Each step reads what changed since it last finished, writes through :class:`LakeTable`, and only then notes how far it
got. A step that dies is repeated as a whole and ends in the same state.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import incremental as inc
from tidemark.operators.anomaly import anomaly_record, fail_on_anomalies, rolling_baseline, rolling_update, volume_anomalies
from tidemark.operators.cleaning import (
    counted_dedup, duplicate_rejects, fill_nulls, first_reason, mask_null, null_flags, null_rejects, quarantine,
)
from tidemark.operators.joins import mark_known, matching, merged_if_many
from tidemark.operators.rollup import AGAIN, Rollup
from tidemark.operators.quality import Watched, evaluation_error, quality_rules
from tidemark.plans import marts
from tidemark.session import one_row, work_dir
from tidemark.sources.files import conform_schema, nullable, read_or_empty
from tidemark.sources.tables import LakeTable
from tidemark.spec import TableSpec

SILVER_STAMPS = ("_silver_ts", "_silver_lote")
GOLD_STAMPS = ("_gold_ts", "_gold_lote")
COPY = ("_copia_motivo", "_copia")
COPIES = "_copias"
OLDER = "VERSION_ANTERIOR"
#: Begins the tag of a version that holds the changes of other tables up to the versions that follow.
APPLIED = "applied "
ERROR_SCHEMA = "tabla_origen string, motivo_error string, ts_error timestamp, payload string"
RULE_SCHEMA = (
    "tabla string, prueba string, aprobada boolean, n_fallos bigint, pct_fallo double, critica boolean, estado string, "
    "ts_ejecucion timestamp"
)
REPORT_SCHEMA = (
    "tabla string, lote_id string, ts_reporte timestamp, n_registros_bronze bigint, n_registros_silver bigint, "
    "n_duplicados bigint, n_rechazados bigint, pct_conformes double, detalle_nulos string"
)


@dataclass(frozen=True)
class Mart:
    """A published table: a function of cleaned tables, rebuilt for the base rows a change can reach."""

    name: str
    keys: Sequence[str]
    partition_by: Sequence[str]
    build: Callable[..., DataFrame]
    """Takes a dict of tables and the run."""
    base: str
    base_key: str | None = None
    """Without it the mart is rebuilt as a whole: dimensions, and what needs all history."""
    dims: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    """table -> (column of the base, key of the table)."""
    children: Mapping[str, str] = field(default_factory=dict)
    """table -> its column that holds the base key."""
    nullable_keys: bool = False
    """Keys may be null, and rows of an upsert may not: the table is then keyed by a digest of its keys."""

    @property
    def inputs(self) -> list[str]:
        return [self.base, *self.dims, *self.children]


@dataclass(frozen=True)
class Kpi:
    """A rollup of marts, recomputed for every group that had or has a changed row; with ``rollup``, of one mart, brought up to
    date from the changes alone."""

    name: str
    sources: Sequence[str]
    build: Callable[..., DataFrame] | None = None
    partition_by: Sequence[str] = ("anio", "mes")
    group: Sequence[str] | None = None
    """Columns of the grain; by default those of the rollup, or those that are known for the name."""
    rollup: Rollup | None = None
    """Its parts are kept in the table, in columns that begin with ``_``."""
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
    """With ``rollup``: adds columns of the grain to rows of the mart or of its feed."""

    @property
    def keys(self) -> list[str]:
        return list(self.group or (self.rollup.keys if self.rollup else marts.KPI_KEYS[self.name]))

    def rows(self, *facts: DataFrame) -> DataFrame:
        """The table from whole groups of facts."""
        return self.rollup.with_parts(self.rollup.aggregate(*map(self.prepare, facts))) if self.rollup else self.build(*facts)


@dataclass(frozen=True)
class Watch:
    """Alerts on the series of a rollup that is kept as a table: each period against the mean of those before it.

    Only periods a change can reach are compared again, and only rows of their series in the rollup are read.
    """

    name: str
    source: str
    """The KPI that rolls up; its rows are groups and periods."""
    groups: Sequence[str]
    order: Sequence[str]
    value: str
    build: Callable[[DataFrame, Run], DataFrame]
    """From periods with their baselines to the alerts among them."""
    weeks: int = 8
    min_weeks: int = 1
    partition_by: Sequence[str] = ()

    @property
    def keys(self) -> list[str]:
        return [*self.order, *self.groups]


HOSPITAL_MARTS = [
    Mart(
        "dim_pacientes", ["pac_id"], ["tip_aseguradora"],
        lambda t, run: marts.dim_patients(t["PAC_REGISTRO"], run.as_of), "PAC_REGISTRO",
    ),
    Mart(
        "dim_medicos", ["med_id"], ["esp_principal"],
        lambda t, run: marts.dim_doctors(t["MED_PLANTA"], t["RED_SEDES"]), "MED_PLANTA",
        dims={"RED_SEDES": ("id_sede", "id_sede")},
    ),
    Mart("dim_sedes", ["id_sede"], ["nom_pais"], lambda t, run: marts.dim_sites(t["RED_SEDES"]), "RED_SEDES"),
    Mart(
        "fact_consultas", ["id_encuentro"], ["anio", "mes"],
        lambda t, run: marts.fact_visits(t["HCE_ENCUENTROS"], t["RED_SEDES"], t["PAC_REGISTRO"]),
        "HCE_ENCUENTROS", "id_encuentro",
        dims={"RED_SEDES": ("id_sede", "id_sede"), "PAC_REGISTRO": ("pac_id", "pac_id")},
    ),
    Mart(
        "fact_costos_atencion", ["id_encuentro"], ["anio", "mes"],
        lambda t, run: marts.fact_visit_cost(t["HCE_ENCUENTROS"], t["FAR_DISPENSACION"], t["PAC_REGISTRO"]),
        "HCE_ENCUENTROS", "id_encuentro",
        dims={"PAC_REGISTRO": ("pac_id", "pac_id")}, children={"FAR_DISPENSACION": "id_encuentro"},
    ),
    Mart(
        "fact_ocupacion_camas", ["id_registro_cama"], ["anio", "mes", "tip_unidad"],
        lambda t, run: marts.fact_capacity(t["GCM_CAMAS"], t["RED_SEDES"]),
        "GCM_CAMAS", "id_registro_cama", dims={"RED_SEDES": ("id_sede", "id_sede")},
    ),
    Mart(
        "fact_tiempos_espera", ["id_cita"], ["anio", "mes"],
        lambda t, run: marts.fact_wait(t["AGE_CITAS"], t["RED_SEDES"]),
        "AGE_CITAS", "id_cita", dims={"RED_SEDES": ("id_sede", "id_sede")},
    ),
]

HOSPITAL_KPIS = [
    Kpi("kpis_ocupacion_camas", ["fact_ocupacion_camas"], rollup=marts.CAPACITY),
    Kpi("kpis_tiempos_espera", ["fact_tiempos_espera"], rollup=marts.WAIT),
    Kpi("kpis_volumen_consultas", ["fact_consultas"], rollup=marts.VOLUME),
    Kpi("volumenes_semanales", ["fact_consultas"], partition_by=("anio",), rollup=marts.WEEKLY, prepare=marts.by_week),
    Watch(
        "fact_alertas_epidemiologicas", "volumenes_semanales", marts.SERIES, marts.WEEK, "volumen_actual",
        lambda compared, run: marts.alerts_of(compared, run.at, run.batch_id), weeks=marts.OUTBREAK_WEEKS, partition_by=("anio",),
    ),
    Kpi("kpis_alertas_epidemiologicas", ["fact_alertas_epidemiologicas"], partition_by=("anio",), rollup=marts.ALERTS),
    Kpi(
        "kpis_resumen_ejecutivo", ["fact_consultas", "fact_tiempos_espera", "fact_ocupacion_camas"],
        marts.kpi_executive, ("anio",),
    ),
]


@dataclass(frozen=True)
class Run:
    """The clock of one run, fixed at its start so that repeated steps give equal rows."""

    at: datetime
    as_of: date
    batch_id: str

    @classmethod
    def start(cls, at: datetime | None = None) -> Run:
        at = at or datetime.now()
        return cls(at, at.date(), at.strftime("%Y%m%d_%H%M%S"))


# ---- cleaning as one plan ---------------------------------------------------------------------------------------

def no_key(spec: TableSpec) -> Column:
    """Whether a row lacks part of its key."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])


def shown(df: DataFrame, spec: TableSpec) -> list[Column]:
    """The columns as a report may show them: masked ones are null."""
    return [F.lit(None).cast(df.schema[c].dataType).alias(c) if c in spec.masked else F.col(c) for c in df.columns]


def label(
    df: DataFrame, spec: TableSpec, as_of: date, parents: Mapping[str, DataFrame], held: DataFrame | None = None
) -> DataFrame:
    """Deduplicated, filled and derived rows with ``_motivo``: why the row is rejected, null if it is good; and ``_copias``:
    the rows that its key had.

    All reject rules and parent checks add to one plan, so good rows, rejects and counts come from a single pass. A good row that is
    older than what ``held`` (keys and stamps) has for its key is rejected as well.
    Rows a rule only corrects carry a JSON copy of how they were, without the values of masked columns. Rows with a null
    key are no copies of one another: each is rejected by itself.
    """
    stamp = [spec.watermark] if spec.watermark in df.columns else []
    lacking = no_key(spec)
    alone = df.filter(lacking).withColumn(COPIES, F.lit(1).cast("bigint"))
    df = counted_dedup(df.filter(~lacking), spec.dedup_keys or spec.keys, stamp, COPIES)
    newest = F.lit(None).cast("timestamp")
    if held is not None:
        newest = F.col("_held")
        held = held.select(*[F.col(k).alias(f"_h_{k}") for k in spec.keys], F.col(spec.watermark).alias("_held"))
        df = df.join(held, [F.col(k) == F.col(f"_h_{k}") for k in spec.keys], "left").drop(*[f"_h_{k}" for k in spec.keys])
    df = df.unionByName(alone, allowMissingColumns=True)
    older = newest.isNotNull() & F.coalesce(F.col(spec.watermark) < newest, F.lit(True)) if held is not None else F.lit(False)
    df = df.withColumn("_older", older).drop("_held")
    for column, (kind, value) in spec.nulls.items():
        df = fill_nulls(df, {column: value}) if kind == "imputar" else df
        df = null_flags(df, [column]) if kind == "indicador" else df
    df = spec.derive(df, as_of)

    reasons = [(f"CLAVE_NULA: {k}", F.col(k).isNull()) for k in spec.keys]
    reasons += [(why, F.col(c).isNull()) for c, why in null_rejects(spec.nulls).items()]
    copy_reason, copy = F.lit(None).cast("string"), F.lit(None).cast("string")
    corrections = {}
    for rule in spec.rejects:
        if rule.null_out is None:
            reasons.append((rule.reason, rule.bad()))
            continue
        copy_reason = F.coalesce(copy_reason, F.when(rule.bad(), F.lit(rule.reason)))
        copy = F.coalesce(copy, F.when(rule.bad(), F.to_json(F.struct(*shown(df.drop(COPIES, "_older"), spec)))))
        corrections[rule.null_out] = F.when(rule.bad(), F.lit(None)).otherwise(F.col(rule.null_out))
    flags = ["_older"]
    for i, fk in enumerate(spec.parents):
        df = mark_known(df, parents[fk.parent], fk.column, fk.parent_key, f"_fk{i}", unique=True)
        reasons.append((fk.reason, ~F.col(f"_fk{i}")))
        flags.append(f"_fk{i}")
    reasons.append((OLDER, F.col("_older")))
    labelled = df.withColumns({COPY[0]: copy_reason, COPY[1]: copy, "_motivo": first_reason(reasons), **corrections})
    return labelled.drop(*flags)


def digest(keys: Sequence[str]) -> Column:
    """One key that is never null for columns that may be."""
    return F.sha2(F.to_json(F.struct(*keys)), 256)


class RunError(RuntimeError):
    """Raised at the end of a run in which steps failed; the others were done."""


# ---- the lakehouse ----------------------------------------------------------------------------------------------

class Lakehouse:
    """Tables of all layers below one root folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: Sequence[TableSpec],
        mart_specs: Sequence[Mart] = (),
        kpis: Sequence[Kpi | Watch] = (),
        source_name: str = "source",
        watermark_mode: str = "exact",
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.specs = {s.name: s for s in specs}
        self.marts = {m.name: m for m in mart_specs}
        self.kpis = {k.name: k for k in kpis}
        self.source_name, self.watermark_mode = source_name, watermark_mode
        self._open: dict[tuple[str, str], LakeTable] | None = None
        self._scratch: list[str] = []
        self._shapes: dict[str, T.StructType] = {}

    # tables

    def _table(self, layer: str, name: str) -> LakeTable:
        """A table for a step; during a whole run each is opened once."""
        opener = getattr(self, layer)
        if self._open is None:
            return opener(name)
        if (layer, name) not in self._open:
            self._open[layer, name] = opener(name)
        return self._open[layer, name]

    def bronze(self, name: str) -> LakeTable:
        return LakeTable(self.spark, f"{self.root}/bronze/{name}", partition_by=self.specs[name].date_parts)

    def silver(self, name: str) -> LakeTable:
        spec = self.specs[name]
        return LakeTable(
            self.spark, f"{self.root}/silver/{name}", keys=spec.keys, partition_by=spec.date_parts,
            ignore=SILVER_STAMPS, shape=self._shape(name),
        )

    def _shape(self, name: str) -> T.StructType | None:
        """The schema of a cleaned table before its first row, so that what reads it works from the first day."""
        if name not in self._shapes:
            spec = self.specs[name]
            stamp = [T.StructField(spec.watermark, T.TimestampType())] if spec.watermark not in spec.schema.names else []
            raw = self.spark.createDataFrame([], nullable(T.StructType([*spec.schema.fields, *stamp])))
            raw = conform_schema(raw, nullable(spec.schema), spec.decimals) if not stamp else raw
            if spec.date_column not in raw.columns:
                return None
            parents = {fk.parent: self.spark.createDataFrame([], self.specs[fk.parent].schema) for fk in spec.parents}
            good = label(raw, spec, date(2000, 1, 1), parents).drop("_motivo", COPIES, *COPY)
            self._shapes[name] = self._finished(good, spec, Run.start(datetime(2000, 1, 1))).schema
        return self._shapes[name]

    def _finished(self, good: DataFrame, spec: TableSpec, run: Run) -> DataFrame:
        dated = inc.with_date_parts(mask_null(good, spec.masked), spec.date_column, spec.date_parts)
        return dated.withColumns({"_silver_ts": F.lit(run.at).cast("timestamp"), "_silver_lote": F.lit(run.batch_id)})

    def gold(self, name: str) -> LakeTable:
        spec = self.marts.get(name) or self.kpis[name]
        # Alert time and batch say when an alert was found, not what it is.
        ignore = [*GOLD_STAMPS, "fec_alerta", "lote_id"]
        keys, parts = list(spec.keys), list(spec.partition_by)
        if name in self.kpis or spec.nullable_keys:
            # Groups may be null (a site without a city), and keys of an upsert may not: the key is a digest.
            keys = ["_grupo"]
        return LakeTable(self.spark, f"{self.root}/gold/{name}", keys=keys, partition_by=parts, ignore=ignore)

    def control(self, name: str, schema: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/control/{name}", schema)

    def _note(self, name: str, row: DataFrame) -> None:
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/control/{name}")

    def run_log(self) -> DataFrame:
        return self.control("run_log", inc.RUN_LOG_SCHEMA)

    def errors(self) -> DataFrame:
        """Quarantined rows of all tables."""
        return self.reports("errores", ERROR_SCHEMA)

    def reports(self, name: str, schema: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/control/{name}", f"{schema}, carga string").drop("carga")

    def _report(self, name: str, load: str, rows: DataFrame) -> None:
        """Rows about one load, in a folder of their own: a load that is repeated replaces what it said before."""
        rows.write.mode("overwrite").parquet(f"{self.root}/control/{name}/carga={load}")

    def _done(self, consumer: str) -> dict[str, int]:
        """table -> last version the consumer finished; one entry per table it reads."""
        ledger = self.control("ledger", inc.LEDGER_SCHEMA).filter(F.col("consumidor") == consumer)
        return {r[0]: r[1] for r in ledger.groupBy("tabla").agg(F.max("ultima_version")).collect()}

    def _finish(self, consumer: str, versions: Mapping[str, int], run: Run) -> None:
        rows = [inc.ledger_row(self.spark, consumer, t, v, run.at) for t, v in versions.items()]
        self._note("ledger", reduce(DataFrame.unionByName, rows))

    def _logged(self, layer: str, table: str, run: Run, step: Callable[[], int | None]) -> str:
        """Run a step, write its line of the run log, pass on its error."""
        began = time.monotonic()
        try:
            rows = step()
        except Exception as e:
            self._log(layer, table, run, 0, "ERROR", str(e), began)
            raise
        finally:
            self._clear()
        status = "SIN_CAMBIOS" if rows is None else "EXITOSO"
        self._log(layer, table, run, rows or 0, status, "No new rows" if rows is None else "", began)
        return status

    def _clear(self) -> None:
        """Remove the copies that a step staged: they hold unmasked values."""
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self._scratch:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(hadoop).delete(at, True)
        self._scratch.clear()

    def _log(self, layer, table, run, rows, status, message, began) -> None:
        seconds = int(time.monotonic() - began)
        self._note(
            "run_log",
            inc.run_log_row(self.spark, layer, table, run.batch_id, run.at, rows, status, message, seconds),
        )

    # bronze

    def watermark(self, name: str) -> datetime:
        """How far the table was read: the stored mark, or the newest stamp of the last commit if that is later
        (a run that died between its commit and its mark)."""
        marks = self.control("watermarks", inc.WATERMARK_SCHEMA)
        stored = inc.get_watermark(marks, name).first()["ultimo_proceso"]
        table = self._table("bronze", name)
        version = table.version()
        if version < 0:
            return stored
        last = inc.high_watermark(table.feed(version - 1), self.specs[name].watermark).first()["max_wm"]
        return max(stored, last) if last is not None else stored

    def ingest(self, name: str, source: DataFrame | Callable[[datetime], DataFrame], run: Run, full: bool = False):
        """Append the source's new rows to bronze. ``source`` is a frame, or a function that reads rows after a
        stamp (a JDBC query). With ``full`` the table is replaced by all rows."""
        return self._logged("bronze", name, run, lambda: self._ingest(name, source, run, full))

    def _ingest(self, name, source, run, full) -> int | None:
        spec, table = self.specs[name], self._table("bronze", name)
        since = datetime.fromisoformat(inc.EPOCH) if full else self.watermark(name)
        rows = source(since) if callable(source) else source
        if not full:
            lost = inc.undated(rows, spec.watermark)
            if not lost.isEmpty():
                # One folder for all runs: the source shows these rows again and again.
                shown_rows = lost.select(*shown(lost, spec))
                self._report("errores", f"{name}-sin_fecha", quarantine(shown_rows, name, run.at, f"SIN_FECHA: {spec.watermark}"))
            rows = inc.incremental_scan(rows, spec.watermark, since, spec.lateness, inclusive=True)
            if table.exists():
                held = self._held(table, spec, since)
                rows = inc.unseen(rows, held, spec.keys, spec.watermark, rows.columns)
        audited = inc.with_audit(rows, self.source_name, run.batch_id, run.at)
        dated = inc.with_date_parts(audited, spec.date_column, spec.date_parts)
        counts = {"n": F.count(F.lit(1)), "wm": F.max(F.col(spec.watermark).try_cast("timestamp"))}
        _, written = table.append_counted(dated, run.at, "overwrite" if full else "append", counts=counts)
        n = written["n"]
        if not n:
            return None
        stamp = lambda v: F.lit(v).cast("timestamp")
        mark = F.greatest(inc.next_watermark(stamp(written["wm"]), self.watermark_mode), stamp(since))
        row = one_row(self.spark, inc.WATERMARK_SCHEMA, (name, "full_load" if full else "incremental", None, run.at))
        self._note("watermarks", row.withColumn("ultimo_proceso", mark))
        return n

    def _held(self, table: LakeTable, spec: TableSpec, since: datetime) -> DataFrame:
        """Rows of bronze from the watermark on. If its partitions are dates of the stamp, only these are read."""
        if spec.date_column == spec.watermark:
            return inc.pruned_scan(table.read(), spec.watermark, since, spec.date_parts, spec.lateness, inclusive=True)
        return inc.incremental_scan(table.read(), spec.watermark, since, spec.lateness, inclusive=True)

    # silver

    def clean(self, name: str, run: Run):
        """Bring new bronze rows into the cleaned table; quarantine, rules and report on the way."""
        return self._logged("silver", name, run, lambda: self._clean(name, run))

    def _clean(self, name: str, run: Run) -> int | None:
        spec, consumer = self.specs[name], f"silver.{name}"
        bronze, table = self._table("bronze", name), self._table("silver", name)
        since, upto = self._done(consumer).get(name, -1), bronze.version()
        if upto <= since:
            return None
        changes = inc.read_changes(bronze.feed(since), since)
        parents = {fk.parent: merged_if_many(self._table("silver", fk.parent).read()) for fk in spec.parents}
        held = None
        if table.exists() and spec.watermark in changes.columns:
            held = merged_if_many(table.read().select(*spec.keys, spec.watermark))
        watched, labelled = self._watched(label(changes, spec, run.as_of, parents, held), spec)
        good = labelled.filter(F.col("_motivo").isNull()).drop("_motivo", COPIES, *COPY)
        n, n_before, bad, late, corrected = (watched.count(c) for c in ("n", "n_before", "bad", "late", "corrected"))

        load = f"{name}-{upto}"
        duplicated = changes if n_before > n else None
        self._quarantine(spec, duplicated, labelled, bad + late + corrected, run, load)
        by_itself = spec.rules and not watched.rules
        verdicts = quality_rules(good, name, spec.rules, run.at) if by_itself else watched.verdicts(run.at)
        self._report("pruebas_calidad", load, verdicts)
        self._report("reporte_calidad", load, watched.report(run.batch_id, run.at, n_before, n_before - n, bad))

        table.upsert(self._finished(good, spec, run), run.at, unique=set(spec.dedup_keys or spec.keys) <= set(spec.keys))
        self._finish(consumer, {name: upto}, run)
        return n - bad

    def _watched(self, labelled: DataFrame, spec: TableSpec) -> tuple[Watched, DataFrame]:
        """The labelled rows, written, and what was counted on the way: rows, rejects, rules and nulls of the good ones.

        If a rule can't be evaluated on some row, the rows are written without rules, which are then tried apart.
        """
        why = F.col("_motivo")
        counts = {
            "n": F.count(F.lit(1)), "n_before": F.sum(COPIES), "bad": F.count_if(why != OLDER), "late": F.count_if(why == OLDER),
            "corrected": F.count(COPY[1]),
        }
        visible = [c for c in labelled.columns if c not in ("_motivo", COPIES, *COPY)]
        for rules in (spec.rules, ()):
            watched = Watched(labelled, spec.name, rules, why.isNull(), visible, **counts)
            try:
                return watched, self._staged(watched.frame, spec.name)
            except PySparkException as e:
                if not rules or not evaluation_error(e):
                    raise
        raise AssertionError

    def _quarantine(self, spec, duplicated, labelled, n_rejects, run, load) -> None:
        """Rejected rows, copies of corrected rows, removed duplicates and late old versions, in one append."""
        parts = []
        report = lambda rows: quarantine(rows.select(*shown(rows, spec)), spec.name, run.at)
        if n_rejects:
            bad = labelled.filter(F.col("_motivo").isNotNull()).withColumnRenamed("_motivo", "motivo_error")
            parts.append(report(bad.drop(COPIES, *COPY)))
            copies = labelled.filter(F.col(COPY[1]).isNotNull())
            parts.append(
                copies.select(
                    F.lit(spec.name).alias("tabla_origen"), F.col(COPY[0]).alias("motivo_error"),
                    F.lit(run.at).cast("timestamp").alias("ts_error"), F.col(COPY[1]).alias("payload"),
                )
            )
        if duplicated is not None:
            stamp = [spec.watermark] if spec.watermark in duplicated.columns else []
            reasons = ("DUPLICADO_EXACTO", OLDER)
            parts.append(report(duplicate_rejects(duplicated.filter(~no_key(spec)), spec.dedup_keys or spec.keys, stamp, reasons)))
        if parts:
            self._report("errores", load, reduce(DataFrame.unionByName, parts))

    # gold

    def build_mart(self, name: str, run: Run):
        """Rebuild the mart's rows that changed inputs can reach, and merge them in."""
        return self._logged("gold", name, run, lambda: self._build_mart(self.marts[name], run))

    def _pending(self, consumer: str, tables: Mapping[str, LakeTable]) -> tuple[dict[str, int], dict[str, int]]:
        now = {n: t.version() for n, t in tables.items()}
        finished = self._done(consumer)
        return now, {n: finished.get(n, -1) for n in tables}

    def _build_mart(self, mart: Mart, run: Run) -> int | None:
        consumer = f"gold.{mart.name}"
        tables = {n: self._table("silver", n) for n in mart.inputs}
        now, done = self._pending(consumer, tables)
        published = self._table("gold", mart.name)
        if all(now[n] <= done[n] for n in tables) and published.exists():
            return None
        if mart.base_key is None or min(done.values()) < 0 or list(mart.keys) != [mart.base_key]:
            # What the rebuild no longer yields goes: the scope is all that is there.
            inputs = {n: t.read() for n, t in tables.items()}
            scope = published.read().select(*published.keys) if published.exists() else None
        else:
            inputs, scope = self._affected(mart, tables, done)
        rows = mart.build(inputs, run)
        if mart.nullable_keys:
            rows = rows.withColumn("_grupo", digest(mart.keys))
        n = self._publish(published, rows, run, scope)
        self._finish(consumer, now, run)
        return n

    def _affected(self, mart: Mart, tables: Mapping[str, LakeTable], done: Mapping[str, int]):
        """(the inputs, cut to the rows of the base a change can reach, with dimensions whole; the keys of these
        rows)."""
        base, key = tables[mart.base], mart.base_key
        reached = [base.feed(done[mart.base]).select(key)]
        for dim, (fk, pk) in mart.dims.items():
            moved = tables[dim].feed(done[dim]).select(F.col(pk).alias(fk))
            reached.append(matching(base.read().select(key, fk), moved, [fk]).select(key))
        for child, fk in mart.children.items():
            # Old images count too: a line that moved to another visit changes both.
            reached.append(tables[child].feed(done[child]).select(F.col(fk).alias(key)))
        keys = self._staged(reduce(DataFrame.unionByName, reached).distinct(), "keys")
        cut = {dim: tables[dim].read() for dim in mart.dims}
        cut[mart.base] = base.matching(keys, [key])
        for child, fk in mart.children.items():
            cut[child] = tables[child].matching(keys.select(F.col(key).alias(fk)), [fk])
        return cut, keys

    def _staged(self, df: DataFrame, label: str) -> DataFrame:
        """Write once what is read several times; the copy outlives lost executors and its size is known."""
        path = work_dir(self.spark, f"stage-{label}")
        self._scratch.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _publish(
        self, table: LakeTable, rows: DataFrame, run: Run, scope: DataFrame | None = None, tag: str | None = None
    ) -> int:
        """Merge rows into a published table; keys of ``scope`` that have no row any more are removed from it."""
        staged = self._staged(rows, table.path.rsplit("/", 1)[-1])
        stamps = {"_gold_ts": F.lit(run.at).cast("timestamp"), "_gold_lote": F.lit(run.batch_id)}
        table.upsert(staged.withColumns(stamps), run.at, tag=tag, scope=scope)
        return staged.count()

    def build_kpi(self, name: str, run: Run):
        """Recompute the groups that had or have a changed row."""
        kpi = self.kpis[name]
        step = self._build_watch if isinstance(kpi, Watch) else self._build_kpi
        return self._logged("gold", name, run, lambda: step(kpi, run))

    def _build_kpi(self, kpi: Kpi, run: Run) -> int | None:
        consumer = f"gold.{kpi.name}"
        tables = {n: self._table("gold", n) for n in kpi.sources}
        now, done = self._pending(consumer, tables)
        if all(now[n] <= done[n] for n in tables):
            return None
        published = self._table("gold", kpi.name)
        # What a run that died had published already, though it didn't come to note it: deltas must not be added twice.
        done = {n: max(v, self._applied(published).get(n, -1)) for n, v in done.items()}
        if all(now[n] <= done[n] for n in tables):
            self._finish(consumer, now, run)
            return 0
        if min(done.values()) >= 0 and kpi.rollup is not None:
            rows, scope = self._rolled_on(kpi, published, tables[kpi.sources[0]], done[kpi.sources[0]])
        else:
            scope = None
            facts = [t.read() for t in tables.values()]
            if min(done.values()) >= 0:
                touched = [t.feed(done[n]).select(*kpi.keys) for n, t in tables.items()]
                groups = self._staged(reduce(DataFrame.unionByName, touched).distinct(), "groups")
                facts = [t.matching(groups, kpi.keys) for t in tables.values()]
                scope = groups.select(digest(kpi.keys).alias("_grupo"))
            rows = kpi.rows(*facts).withColumn("_grupo", digest(kpi.keys))
        n = self._publish(published, rows, run, scope, APPLIED + json.dumps(now))
        self._finish(consumer, now, run)
        return n

    @staticmethod
    def _applied(table: LakeTable) -> dict[str, int]:
        """table -> version up to which its changes are in the newest version of ``table``."""
        tag = table.tag() or ""
        return json.loads(tag.removeprefix(APPLIED)) if tag.startswith(APPLIED) else {}

    def _build_watch(self, watch: Watch, run: Run) -> int | None:
        consumer = f"gold.{watch.name}"
        source = self._table("gold", watch.source)
        now, done = self._pending(consumer, {watch.source: source})
        published = self._table("gold", watch.name)
        since = done[watch.source]
        if now[watch.source] <= since and published.exists():
            return None
        how = (watch.value, watch.groups, watch.order, watch.weeks, watch.min_weeks)
        if since < 0:
            compared = rolling_baseline(source.read(), *how)
            scope = published.read().select("_grupo") if published.exists() else None
        else:
            touched = self._staged(source.feed(since).select(*watch.keys).distinct(), "touched")
            series = source.matching(touched.select(*watch.groups).distinct(), watch.groups)
            compared = self._staged(rolling_update(series, touched, *how), "compared")
            scope = compared.select(digest(watch.keys).alias("_grupo"))
        rows = watch.build(compared, run).withColumn("_grupo", digest(watch.keys))
        n = self._publish(published, rows, run, scope)
        self._finish(consumer, now, run)
        return n

    def _rolled_on(self, kpi: Kpi, published: LakeTable, fact: LakeTable, since: int) -> tuple[DataFrame, DataFrame]:
        """(the groups that changes after ``since`` have touched, as they are now; all touched groups).

        Reads the changes and these groups' rows of the KPI table. Facts are only read for groups whose maximum has left.
        """
        rollup = kpi.rollup
        deltas = self._staged(rollup.deltas(kpi.prepare(fact.feed(since))).withColumn("_grupo", digest(kpi.keys)), "deltas")
        touched = deltas.select("_grupo")
        held = published.matching(touched, ["_grupo"])
        merged = self._staged(rollup.merged(held, deltas, ["_grupo"]), "merged")
        rows = rollup.with_parts(merged.filter(~F.col(AGAIN))).withColumn("_grupo", digest(kpi.keys))
        again = merged.filter(AGAIN).select(*kpi.keys)
        if rollup.maxima and not again.isEmpty():
            whole = rollup.aggregate(matching(kpi.prepare(fact.read()), again, kpi.keys))
            rows = rows.unionByName(rollup.with_parts(whole).withColumn("_grupo", digest(kpi.keys)))
        return rows, touched

    # whole run

    def run(
        self, sources: Mapping[str, DataFrame | Callable[[datetime], DataFrame]], at: datetime | None = None, fail: bool = True
    ) -> Run:
        """All layers in order. ``sources`` maps table names to frames or readers. A step that fails stops no other: it
        is logged, takes up where it was in the next run, and is named in the error that ends this one (unless ``fail``
        is false)."""
        run = Run.start(at)
        steps = [("bronze", n, lambda n=n: self.ingest(n, sources[n], run)) for n in self.specs if n in sources]
        steps += [("silver", n, lambda n=n: self.clean(n, run)) for n in self.specs]
        steps += [("gold", n, lambda n=n: self.build_mart(n, run)) for n in self.marts]
        steps += [("gold", n, lambda n=n: self.build_kpi(n, run)) for n in self.kpis]
        failed = []
        self._open = {}
        try:
            for layer, name, step in steps:
                try:
                    step()
                except Exception as e:  # noqa: BLE001 - named below
                    failed.append((f"{layer}.{name}", e))
        finally:
            self._open = None
        if failed and fail:
            raise RunError("; ".join(f"{where}: {e}" for where, e in failed)) from failed[0][1]
        return run

    def check_volumes(self, run: Run, fail: bool = True, **limits) -> DataFrame:
        """Compare the newest load of every table with those before; store the finding and raise if there is one."""
        now = run.at.strftime("%Y-%m-%d %H:%M:%S")
        found = volume_anomalies(self.run_log(), detected_at=now, **limits)
        record = anomaly_record(found, now)
        self._report("alertas_volumen", run.batch_id, record)
        path = f"{self.root}/control/alertas_volumen/carga={run.batch_id}"
        anomalies = self.spark.read.schema(record.schema).parquet(path).filter(F.col("estado") == "ANOMALIA")
        if fail:
            fail_on_anomalies(anomalies)
        return anomalies
