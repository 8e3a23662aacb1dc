"""Reading only what is new: watermarks, version ledgers, audit and date columns, run logs.

Control state (watermarks, ledger) is an append-only log of tiny rows; the current state is the latest row per key.
That makes every update a plain append, which a retry can repeat without harm.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import date_parts
from tidemark.session import one_row

EPOCH = "1900-01-01 00:00:00"
WATERMARK_SCHEMA = "tabla_nombre string, estrategia string, ultimo_proceso timestamp, ultima_ejecucion timestamp"
LEDGER_SCHEMA = "consumidor string, tabla string, ultima_version bigint, ts_actualizacion timestamp"
RUN_LOG_SCHEMA = (
    "capa string, tabla string, lote_id string, ts_ejecucion timestamp, registros_procesados bigint, "
    "tamano_mb double, duracion_seg bigint, estado string, mensaje string"
)
FEED_COLUMNS = ("_change_type", "_commit_version", "_commit_timestamp")
CURRENT_KINDS = ("insert", "update_postimage")


# ---- scans and watermarks -------------------------------------------------------------------------------------

def _typed(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the column's own type, so that the comparison can be pushed into the file scan."""
    return F.lit(value).cast(df.schema[column].dataType)


def incremental_scan(
    df: DataFrame, column: str, since, lateness: str | None = None, inclusive: bool = False
) -> DataFrame:
    """Rows whose stamp is strictly after ``since``.

    With ``lateness`` (an interval such as ``2 hours``) the scan starts that much earlier, and with ``inclusive`` it
    takes the bound itself, so that rows which share the watermark's stamp but arrive later are not lost; the caller
    removes what it already holds, see :func:`unseen`. Null stamps are never read, see :func:`undated`.
    """
    bound = _typed(df, column, since)
    if lateness:
        bound = (bound - F.expr(f"INTERVAL {lateness}")).cast(df.schema[column].dataType)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def pruned_scan(
    df: DataFrame, column: str, since, parts: Sequence[str] = ("_anio", "_mes", "_dia"), lateness: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """:func:`incremental_scan` of a table partitioned by the year, month and day of ``column`` (or the first of these): the same
    rows, but partitions that lie before the bound aren't read.

    The bound is worked out here, so that the scan sees plain values. Partitions without a date are read.
    """
    names, bound = list(parts), _typed(df, column, since)
    if lateness:
        bound = bound - F.expr(f"INTERVAL {lateness}")
    moment = [F.year(bound), F.month(bound), F.dayofmonth(bound)][: len(names)]
    first = df.sparkSession.range(0, 1, 1, 1).select(*[c.alias(n) for c, n in zip(moment, names, strict=True)]).first()
    reached = F.lit(True)
    # From the finest part up: a later year, or the same year and what holds for the month.
    for name in reversed(names):
        part, least = F.col(name), F.lit(first[name])
        reached = (part > least) | ((part == least) & reached)
    undated_part = F.lit(False)
    for name in names:
        undated_part = undated_part | F.col(name).isNull()
    return incremental_scan(df.filter(undated_part | reached), column, since, lateness, inclusive)


def undated(df: DataFrame, column: str) -> DataFrame:
    """Rows without a stamp, which no watermark ever reaches: they belong in quarantine."""
    return df.filter(F.col(column).isNull())


def unseen(
    df: DataFrame, seen: DataFrame, keys: Sequence[str], column: str, compared: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a scan that were not taken before: no row with the same keys (null like null) and stamp in ``seen``.

    With ``compared`` (columns of ``df``) a row was only taken before if those are the same, too: a value that was corrected
    without a new stamp is a new row. A column that ``seen`` lacks was null there.
    """
    rest = [c for c in compared or () if c not in (*keys, column)]

    def plain(frame: DataFrame, c: str) -> Column:
        # Maps can't be compared, their text can.
        kind = df.schema[c].dataType
        cell = frame[c] if c in frame.columns else F.lit(None).cast(kind)
        return F.to_json(F.struct(cell)) if "map<" in kind.simpleString() else cell

    taken = seen.select(*[plain(seen, c).alias(f"_s_{c}") for c in (*keys, column, *rest)])
    same = [plain(df, c).eqNullSafe(taken[f"_s_{c}"]) for c in (*keys, column, *rest)]
    return df.join(taken, same, "left_anti")


def not_older(df: DataFrame, held: DataFrame, keys: Sequence[str], column: str) -> tuple[DataFrame, DataFrame]:
    """(rows to merge, rows that are older than what ``held`` has for their key): a late row never replaces a newer one.

    ``held`` has each key once. A row without a stamp is older than one with.
    """
    newest = held.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.col(column).alias("_held"))
    joined = df.join(newest, [df[k] == newest[f"_h_{k}"] for k in keys], "left").drop(*[f"_h_{k}" for k in keys])
    older = F.col("_held").isNotNull() & F.coalesce(F.col(column) < F.col("_held"), F.lit(True))
    return joined.filter(~older).drop("_held"), joined.filter(older).drop("_held")


def high_watermark(df: DataFrame, column: str) -> DataFrame:
    """One row, ``max_wm``: the latest stamp."""
    return df.agg(F.max(F.col(column).try_cast("timestamp")).alias("max_wm"))


def next_watermark(stamp: Column, mode: str = "exact") -> Column:
    """What to store after a run that has seen ``stamp``.

    ``exact`` keeps it as it is. ``second_plus_one`` cuts it to the second and adds one, for sources that keep whole
    seconds only; rows written later within that second are then skipped.
    """
    if mode == "exact":
        return stamp
    if mode != "second_plus_one":
        raise ValueError(f"unknown watermark mode {mode!r}")
    return F.date_trunc("second", stamp) + F.expr("INTERVAL 1 SECOND")


def init_watermarks(spark: SparkSession, tables: Iterable[str], strategy: str = "incremental") -> DataFrame:
    """Control rows for a first run: everything after 1900 is new."""
    epoch = datetime.fromisoformat(EPOCH)
    return spark.createDataFrame([(t, strategy, epoch, epoch) for t in tables], WATERMARK_SCHEMA)


def get_watermark(watermarks: DataFrame, table: str) -> DataFrame:
    """One row, ``ultimo_proceso``: the table's current watermark, or the start of 1900 if it has none."""
    latest = F.max_by("ultimo_proceso", F.struct("ultima_ejecucion", "ultimo_proceso"))
    return watermarks.filter(F.col("tabla_nombre") == table).agg(
        F.coalesce(latest, F.lit(EPOCH).cast("timestamp")).alias("ultimo_proceso")
    )


def advance_watermark(watermarks: DataFrame, table: str, stamp, run_at, mode: str = "exact") -> DataFrame:
    """The control table with the row of ``table`` moved forward; other rows are left alone."""
    stamp, run_at = F.lit(stamp).cast("timestamp"), F.lit(run_at).cast("timestamp")
    return update_where(
        watermarks,
        F.col("tabla_nombre") == table,
        {"ultimo_proceso": next_watermark(stamp, mode), "ultima_ejecucion": run_at},
    )


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """SQL ``UPDATE``: set columns where the condition is true; null counts as false."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


# ---- audit columns --------------------------------------------------------------------------------------------

def with_audit(df: DataFrame, source: str, batch_id: str, ingested_at) -> DataFrame:
    """Stamp rows with ingest time, source name and batch id."""
    return df.withColumns(
        {
            "_ingesta_ts": F.lit(ingested_at).cast("timestamp"),
            "_fuente": F.lit(source),
            "_lote_id": F.lit(batch_id),
        }
    )


def with_date_parts(df: DataFrame, column: str, names: Sequence[str] = ("_anio", "_mes", "_dia")) -> DataFrame:
    """Add year, month and day columns to partition by; null where ``column`` is no date."""
    return df.withColumns(date_parts(column, names))


def drop_audit(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Remove bookkeeping columns, those that exist. By default audit, date-part and layer stamps."""
    return df.drop(*(columns or AUDIT_COLUMNS))


AUDIT_COLUMNS = (
    "_ingesta_ts", "_fuente", "_lote_id", "_anio", "_mes", "_dia",
    "_silver_ts", "_silver_lote", "_gold_ts", "_gold_lote",
)


# ---- change feeds and the ledger of what each consumer has read -----------------------------------------------

def ledger_get(ledger: DataFrame, consumer: str, table: str) -> DataFrame:
    """One row, ``ultima_version``: the last version of ``table`` that ``consumer`` finished, -1 if none."""
    mine = (F.col("consumidor") == consumer) & (F.col("tabla") == table)
    return ledger.filter(mine).agg(
        F.coalesce(F.max("ultima_version"), F.lit(-1).cast("bigint")).alias("ultima_version")
    )


def ledger_row(spark: SparkSession, consumer: str, table: str, version: int, at: datetime) -> DataFrame:
    """The row that records progress. Each consumer keeps its own mark on each table it reads."""
    return one_row(spark, LEDGER_SCHEMA, (consumer, table, version, at))


def latest_version(feed: DataFrame) -> DataFrame:
    """One row, ``version``: the newest committed version, null for an empty feed."""
    return feed.agg(F.max("_commit_version").alias("version"))


def read_changes(feed: DataFrame, since: int, keys: Sequence[str] | None = None) -> DataFrame:
    """New and changed rows after version ``since``, without feed and audit columns.

    Old images and deletes are left out. With ``keys`` a row that changed several times comes once, in its newest
    version, so that it is not counted twice downstream.
    """
    fresh = feed.filter((F.col("_commit_version") > since) & F.col("_change_type").isin(*CURRENT_KINDS))
    if keys:
        from tidemark.operators.cleaning import dedup

        fresh = dedup(fresh, keys, ["_commit_version"])
    return drop_audit(fresh.drop(*FEED_COLUMNS))


# ---- run log ----------------------------------------------------------------------------------------------------

def run_log_row(
    spark: SparkSession, layer: str, table: str, batch_id: str, at: datetime, rows: int, status: str,
    message: str = "", seconds: int = 0,
) -> DataFrame:
    """One line of the run log. ``status`` is EXITOSO, SIN_CAMBIOS or ERROR; messages are kept whole."""
    row = (layer, table, batch_id, at, int(rows), None, int(seconds), status, message or "")
    return one_row(spark, RUN_LOG_SCHEMA, row)
