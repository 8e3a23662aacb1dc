"""Cleaning: deduplication, nulls, masking, referential checks, rejects and their quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import mark_known, matching

ERROR_COLUMNS = ("tabla_origen", "motivo_error", "ts_error", "payload")
#: Rows of one key that a task can rank by itself.
CROWD = 1_000_000


# ---- duplicates -------------------------------------------------------------------------------------------------

def _newest_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """Latest stamp first, then every other column, so that the survivor does not depend on row order."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    plain = [F.col(c).desc_nulls_last() for c in [*order_by, *rest] if c not in maps]
    return plain + [F.to_json(F.col(c)).desc_nulls_last() for c in rest if c in maps]


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``order_by``. Null keys are a key like any other.

    The ``= 1`` on the rank lets Spark keep only the best row per key of every map task before it shuffles, so a key
    that holds a large part of the rows costs no more than any other.
    """
    order = _newest_first(df, keys, order_by) or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def _ranked(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> Column:
    """What the best row of a key has most of: as in :func:`_newest_first`, with nulls smallest."""
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    return F.struct(F.lit(0), *[F.col(c) for c in rest if c not in maps], *[F.to_json(F.col(c)) for c in rest if c in maps])


def counted_dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), count: str = "_copias") -> DataFrame:
    """The rows :func:`dedup` keeps, each with the number of rows its key had.

    Each task first counts and compares its own rows of a key, so a key that holds a large part of them is one row per task
    in the shuffle. The counts add up to the rows of ``df``, so nobody has to count these apart.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    best = _ranked(df, keys, order_by)
    grouped = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
    if any("map<" in kind for kind in kinds.values()) or any("double" in kinds[k] or "float" in kinds[k] for k in keys):
        grouped = grouped.agg(F.max_by(F.struct(*df.columns), best).alias("_row"), F.count(F.lit(1)).alias(count))
        return grouped.select("_row.*", count)
    # What a row is compared by is all of it but for the key: it goes through the shuffle once.
    grouped = grouped.agg(F.max(best).alias("_row"), F.count(F.lit(1)).alias(count))
    return grouped.select(*[F.col(f"_k_{c}").alias(c) if c in keys else F.col(f"_row.{c}") for c in df.columns], count)


def expand_copies(df: DataFrame, count: str, chunk: int = 100_000) -> DataFrame:
    """Repeat each row ``count`` times. Rows with very many copies are first cut into chunks that are spread out."""
    columns = [c for c in df.columns if c != count]
    starts = F.sequence(F.lit(0).cast("bigint"), (F.col(count) - 1).cast("bigint"), F.lit(chunk).cast("bigint"))
    chunks = df.filter(F.col(count) > 0).withColumn("_from", F.explode(starts))
    plain = [c for c in columns if "map<" not in df.schema[c].dataType.simpleString()]
    spread = chunks.repartition(F.xxhash64(*plain, "_from"))
    copies = F.sequence(F.lit(1).cast("bigint"), F.least(F.col(count) - F.col("_from"), F.lit(chunk)))
    return spread.select(*columns, F.explode(copies).alias("_copy")).drop("_copy")


def duplicate_rejects(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), reasons: tuple[str, str] | None = None, crowd: int = CROWD
) -> DataFrame:
    """All rows :func:`dedup` leaves out, as a multiset: ``df`` minus its survivors.

    Rows are shuffled once, by key, and ranked there. Keys of more than ``crowd`` rows would be too much for one task: a first
    look counts the rows of each key (by a hash, in each task and then together), and if there are such keys their rows
    are counted and compared before they are shuffled. With ``reasons`` the column ``motivo_error`` says whether a row is a copy of
    its key's best row (the first) or another version of its key (the second).
    """
    place = F.xxhash64(*keys).alias("_place")
    crowded = df.groupBy(place).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > crowd).select("_place")
    # No more than one for each ``crowd`` rows.
    many = [r[0] for r in crowded.collect()]
    if not many:
        return _ranked_rejects(df, keys, order_by, reasons)
    known = df.sparkSession.createDataFrame([(m,) for m in many], "_place bigint")
    placed = df.withColumn("_place", place)
    few = placed.join(known, "_place", "left_anti").select(*df.columns)
    rest = placed.join(known, "_place", "left_semi").select(*df.columns)
    return _ranked_rejects(few, keys, order_by, reasons).unionByName(_counted_rejects(rest, keys, order_by, reasons))


def _ranked_rejects(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], reasons: tuple[str, str] | None) -> DataFrame:
    """All rows but the first of each key, in the order of :func:`dedup`."""
    by_key = Window.partitionBy(*keys).orderBy(*(_newest_first(df, keys, order_by) or [F.lit(1)]))
    ranked = df.withColumns({"_at": F.row_number().over(by_key)} | ({"_rank": F.rank().over(by_key)} if reasons else {}))
    gone = ranked.filter(F.col("_at") > 1)
    if reasons:
        gone = gone.withColumn("motivo_error", F.when(F.col("_rank") == 1, F.lit(reasons[0])).otherwise(F.lit(reasons[1])))
    return gone.drop("_at", "_rank")


def _counted_rejects(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], reasons: tuple[str, str] | None) -> DataFrame:
    """The same for keys of very many rows.

    Equal rows are first counted, in each task and then together, and each key's best row is a maximum that is taken the
    same way; only keys that repeat go through the join. One copy of the best row stays out, what is left is repeated at
    the end.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    # Maps can't be grouped by, their text can; and zeros lose their sign when they are, unless it is told beside them.
    maps = [c for c, kind in kinds.items() if "map<" in kind]
    floats = [c for c, kind in kinds.items() if c not in maps and ("double" in kind or "float" in kind)]
    by = [F.col(c).alias(f"_g_{c}") for c in df.columns if c not in maps]
    by += [F.to_json(F.struct(c)).alias(f"_t_{c}") for c in maps]
    for c in floats:
        plain = kinds[c] in ("double", "float")
        by.append((F.when(F.col(c) == 0, F.col(c).cast("string")) if plain else F.to_json(F.struct(c))).alias(f"_t_{c}"))
    odd = {*maps, *floats}
    grouped = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in df.columns if c in odd])
    counted = grouped.select(*[F.col(c) if c in odd else F.col(f"_g_{c}").alias(c) for c in df.columns], "_n")
    counted = counted.select(*df.columns, "_n", _ranked(df, keys, order_by).alias("_rank"))
    best = counted.groupBy(*keys).agg(F.sum("_n").alias("_all"), F.max("_rank").alias("_best")).filter(F.col("_all") > 1)
    best = best.select(*[F.col(k).alias(f"_b_{k}") for k in keys], "_best")
    marked = counted.join(best, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys])
    is_best = F.col("_rank").eqNullSafe(F.col("_best"))
    extra = marked.withColumn("_copies", F.col("_n") - F.when(is_best, 1).otherwise(0)).filter(F.col("_copies") > 0)
    why = {"motivo_error": F.when(is_best, F.lit(reasons[0])).otherwise(F.lit(reasons[1]))} if reasons else {}
    return expand_copies(extra.withColumns(why).select(*df.columns, *why, "_copies"), "_copies")


# ---- nulls ------------------------------------------------------------------------------------------------------

def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls; columns that do not exist are skipped, a value of the wrong type fills nothing."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v).try_cast(df.schema[c].dataType))
        for c, v in values.items()
        if c in df.columns
    }
    return df.withColumns(filled) if filled else df


def null_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``_nulo_<column>``: 1 where the column is null, else 0."""
    flags = {
        f"_nulo_{c}": F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)) for c in columns if c in df.columns
    }
    return df.withColumns(flags) if flags else df


def exclude_nulls(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows where all columns are filled, rows where one is null)."""
    bad = F.lit(False)
    for c in columns:
        if c in df.columns:
            bad = bad | F.col(c).isNull()
    return split_by_rule(df, bad)


def null_rejects(strategies: Mapping[str, tuple[str, object]]) -> dict[str, str]:
    """column -> reason, for the columns whose strategy is to exclude."""
    return {c: f"NULO_EXCLUIDO: {c}" for c, (kind, _) in strategies.items() if kind == "excluir"}


def apply_null_strategies(
    df: DataFrame, strategies: Mapping[str, tuple[str, object]]
) -> tuple[DataFrame, DataFrame]:
    """Apply ``imputar`` / ``indicador`` / ``excluir`` in the declared order; returns (kept, excluded).

    The indicator of a column shows the state it has at that point: fill first and it is always 0.
    """
    for column, (kind, value) in strategies.items():
        if kind == "imputar":
            df = fill_nulls(df, {column: value})
        elif kind == "indicador":
            df = null_flags(df, [column])
        elif kind != "excluir":
            raise ValueError(f"unknown null strategy {kind!r}")
    return exclude_nulls(df, list(null_rejects(strategies)))


def mask_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace values by nulls of the same type and say so in ``_<column>_enmascarado``."""
    present = [c for c in columns if c in df.columns]
    masked = {c: F.lit(None).cast(df.schema[c].dataType) for c in present}
    return df.withColumns({**masked, **{f"_{c}_enmascarado": F.lit(1) for c in present}}) if present else df


# ---- referential checks -----------------------------------------------------------------------------------------

def fk_orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str, dim_name: str = "dim") -> DataFrame:
    """Rows without a parent, a null key included, with ``motivo_error``."""
    parents = dim.select(F.col(pk).alias("_parent"))
    orphans = fact.join(parents, fact[fk] == parents["_parent"], "left_anti")
    return orphans.withColumn("motivo_error", F.lit(f"FK_INVALIDA: {fk} no existe en {dim_name}"))


def fk_valid(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows with a parent. Repeated parents do not multiply rows."""
    parents = dim.select(F.col(pk).alias("_parent"))
    return fact.join(parents, fact[fk] == parents["_parent"], "left_semi")


def fk_split(
    fact: DataFrame, dim: DataFrame, fk: str, pk: str, unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid, orphans) from one join. Say ``unique`` if the parents are known to have each key once."""
    marked = mark_known(fact, dim, fk, pk, "_known_fk", unique)
    return (
        marked.filter(F.col("_known_fk")).drop("_known_fk"),
        marked.filter(~F.col("_known_fk")).drop("_known_fk"),
    )


# ---- rejects and quarantine -------------------------------------------------------------------------------------

def split_by_rule(
    df: DataFrame, bad: Column, reason: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good, bad): every row is in exactly one of them. A null condition is good."""
    bad = F.coalesce(bad, F.lit(False))
    rejected = df.filter(bad)
    return df.filter(~bad), rejected.withColumn("motivo_error", F.lit(reason)) if reason else rejected


def null_out_invalid(
    df: DataFrame, column: str, bad: Column, reason: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(all rows, the column set to null where ``bad``; copies of those rows as they were)."""
    _, copies = split_by_rule(df, bad, reason)
    return df.withColumn(column, F.when(bad, F.lit(None)).otherwise(F.col(column))), copies


def first_reason(reasons: Sequence[tuple[str, Column]]) -> Column:
    """The reason of the first condition that is true, null if none is: rejects in order, in one pass."""
    return F.coalesce(*[F.when(bad, F.lit(reason)) for reason, bad in reasons], F.lit(None).cast("string"))


def quarantine(
    df: DataFrame, table: str, at, reason: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rejected rows as (table, reason, time, JSON of all other columns).

    The reason is ``motivo_error`` of the row where there is one, else ``reason``.
    """
    base = ("tabla_origen", "motivo_error", "ts_error")
    columns = columns or [c for c in df.columns if c not in base]
    fallback = F.lit(reason).cast("string")
    why = F.coalesce(F.col("motivo_error"), fallback) if "motivo_error" in df.columns else fallback
    return df.select(
        F.lit(table).alias("tabla_origen"),
        why.alias("motivo_error"),
        F.lit(at).cast("timestamp").alias("ts_error"),
        F.to_json(F.struct(*columns)).alias("payload"),
    )
