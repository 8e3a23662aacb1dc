"""Baselines over time: rolling means of weekly volumes and load-volume checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class VolumeAnomalyError(RuntimeError):
    """Raised at the end of a run whose volumes are off."""


def rolling_baseline(
    df: DataFrame,
    value: str,
    groups: Sequence[str],
    order: Sequence[str],
    rows: int = 8,
    min_rows: int = 1,
    mean: str = "promedio_8_semanas",
    deviation: str = "pct_desviacion",
) -> DataFrame:
    """Mean of the ``rows`` preceding rows of the group, the current one excluded, and the deviation from it in %.

    ``df`` holds one row per group and period, so a group is as long as the calendar, however large the data was.
    The deviation is null without a baseline, with a baseline of zero, or with fewer than ``min_rows`` periods.
    """
    past = Window.partitionBy(*groups).orderBy(*order).rowsBetween(-rows, -1)
    out = df.withColumn(mean, F.avg(value).over(past))
    usable = F.col(mean) > 0
    if min_rows > 1:
        out = out.withColumn("_periods", F.count(value).over(past))
        usable = usable & (F.col("_periods") >= min_rows)
    off = F.round((F.col(value) - F.col(mean)) / F.col(mean) * 100, 2)
    return out.withColumn(deviation, F.when(usable, off)).drop("_periods")


def rolling_update(
    series: DataFrame,
    touched: DataFrame,
    value: str,
    groups: Sequence[str],
    order: Sequence[str],
    rows: int = 8,
    min_rows: int = 1,
    mean: str = "promedio_8_semanas",
    deviation: str = "pct_desviacion",
) -> DataFrame:
    """:func:`rolling_baseline` for the periods that a change can reach: those ``touched``, and the ``rows`` after each.

    ``series`` is the rollup as it is now, one row per group and period, at least of the groups in ``touched``; its value is never
    null. ``touched`` holds the groups and periods that came, went or changed. A period that went is returned with a null value;
    it shifts the baselines of those after it as well. Both sides meet in one shuffle by group, null matching null.
    """
    keys = [*groups, *order]
    marks = touched.select(*keys).withColumns({value: F.lit(None).cast(series.schema[value].dataType), "_mark": F.lit(1)})
    both = series.select(*keys, value).withColumn("_mark", F.lit(0)).unionByName(marks).repartition(*groups)
    both = both.groupBy(*keys).agg(F.max(value).alias(value), F.max("_mark").alias("_mark"))
    # A period's place among those there are; one that went has the place of the last before it.
    so_far = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_at", F.count(value).over(so_far))
    placed = placed.withColumn("_last", F.max(F.when(F.col("_mark") == 1, F.col("_at"))).over(so_far))
    reached = (F.col("_mark") == 1) | (F.col("_at") - F.col("_last") <= rows)
    there = placed.withColumn("_reached", F.coalesce(reached, F.lit(False)))
    now = there.filter(F.col(value).isNotNull())
    compared = rolling_baseline(now, value, groups, order, rows, min_rows, mean, deviation).filter("_reached")
    gone = there.filter(F.col(value).isNull())
    return compared.select(*keys, value, mean, deviation).unionByName(gone.select(*keys, value), allowMissingColumns=True)


def fill_missing_weeks(df: DataFrame, groups: Sequence[str], week: str, value: str) -> DataFrame:
    """Add a zero row for each week between a group's first and last that has none; ``week`` is a date (Monday)."""
    span = df.groupBy(*groups).agg(F.min(week).alias("_first"), F.max(week).alias("_last"))
    weeks = F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 7 DAYS")))
    grid = span.select(*groups, weeks.alias(week))
    return grid.join(df, [*groups, week], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def volume_anomalies(
    run_log: DataFrame,
    keep: int = 7,
    min_runs: int = 3,
    threshold: float = 0.30,
    detected_at=None,
    status: str | None = "EXITOSO",
    failed: str = "ERROR",
) -> DataFrame:
    """Tables whose newest run deviates from the mean of up to ``keep`` runs before it by more than ``threshold``.

    ``run_log`` has capa, tabla, ts_ejecucion and registros_procesados. With ``status`` only such runs are history; the
    newest run is judged whatever its status, unless it is ``failed``: a load that brought nothing is the largest
    deviation there is. Fewer than ``min_runs`` earlier runs, or a mean of zero, give no verdict. The cut on the rank
    keeps ``keep + 1`` rows per table and kind in each map task, before the shuffle.
    """
    ok = F.lit(True) if status is None else F.coalesce(F.col("estado") == status, F.lit(False))
    log = run_log if status is None else run_log.filter(~F.coalesce(F.col("estado") == failed, F.lit(False)))
    order = [F.col("ts_ejecucion").desc(), F.col("registros_procesados").desc(), F.col("_ok").desc()]
    recent = (
        log.select("capa", "tabla", "ts_ejecucion", "registros_procesados", ok.alias("_ok"))
        .withColumn("_kind_rank", F.row_number().over(Window.partitionBy("capa", "tabla", "_ok").orderBy(*order)))
        .filter(F.col("_kind_rank") <= keep + 1)
    )
    newest = Window.partitionBy("capa", "tabla").orderBy(*order)
    ranked = recent.withColumns({"_rank": F.row_number().over(newest), "_judged": F.first("_ok").over(newest)})
    # Successful runs before the newest one: the newest is no history of its own.
    ago = F.col("_kind_rank") - F.col("_judged").cast("int")
    recent = ranked.filter((F.col("_rank") == 1) | (F.col("_ok") & (ago <= keep)))
    earlier = F.when(F.col("_rank") > 1, F.col("registros_procesados"))
    per_table = recent.groupBy("capa", "tabla").agg(
        F.max(F.when(F.col("_rank") == 1, F.col("registros_procesados"))).alias("n_actual"),
        F.count(earlier).alias("_runs"),
        F.avg(earlier).alias("_mean"),
    )
    off = F.abs(F.col("n_actual") - F.col("_mean")) / F.col("_mean")
    judged = per_table.filter((F.col("_runs") >= min_runs) & (F.col("_mean") != 0))
    return judged.filter(off > threshold).select(
        "capa",
        "tabla",
        "n_actual",
        F.round("_mean", 0).alias("n_promedio"),
        F.round(off * 100, 2).alias("pct_desviacion"),
        F.lit(detected_at).cast("string").alias("ts_deteccion"),
    )


def anomaly_record(anomalies: DataFrame, detected_at) -> DataFrame:
    """The rows to store: the anomalies, or a single ``OK`` row if there are none."""
    found = anomalies.withColumn("estado", F.lit("ANOMALIA"))
    total = anomalies.agg(F.count(F.lit(1)).alias("_n"))
    ok = total.filter(F.col("_n") == 0).select(
        F.lit("ALL").alias("capa"), F.lit("ALL").alias("tabla"),
        F.lit(0).cast("bigint").alias("n_actual"), F.lit(0.0).alias("n_promedio"),
        F.lit(0.0).alias("pct_desviacion"), F.lit(detected_at).cast("string").alias("ts_deteccion"),
        F.lit("OK").alias("estado"),
    )
    return found.unionByName(ok)


def fail_on_anomalies(anomalies: DataFrame, threshold: float = 0.30) -> None:
    """Raise, naming the tables, if there is any anomaly. There is at most one row per table of the lakehouse."""
    names = [f"{r.capa}.{r.tabla}" for r in anomalies.select("capa", "tabla").collect()]
    if names:
        raise VolumeAnomalyError(f"ANOMALIA_VOLUMEN: more than {threshold:.0%} off: {names}")
