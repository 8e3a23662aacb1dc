"""Quality rules, null profiles and load reports.

Each is one aggregation pass over the data; :class:`Watched` takes all of them in the pass that writes the data anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException, PythonException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.spec import Rule

RULE_COLUMNS = ("tabla", "prueba", "aprobada", "n_fallos", "pct_fallo", "critica", "estado", "ts_ejecucion")
VERDICT_SCHEMA = "prueba string, aprobada boolean, n_fallos bigint, pct_fallo double, critica boolean, estado string"


def evaluation_error(e: Exception) -> bool:
    """Whether an expression failed on a value (a cast, a division, an error it raises itself), not the engine or its input."""
    if isinstance(e, PythonException):
        return True
    state = e.getSqlState() if isinstance(e, PySparkException) else None
    return bool(state) and (state.startswith("22") or state == "P0001")


def _resolves(df: DataFrame, condition: Column) -> bool:
    try:
        df.select(condition).schema
        return True
    except AnalysisException:
        return False


def _counted(df: DataFrame, counters: Sequence[tuple[str, Column]]) -> dict[str, int]:
    """The values of counters. If one can't be evaluated, halves are tried until it is alone; it then has no value. Errors
    that are no counter's fault are raised."""
    try:
        return df.agg(*[c.alias(name) for name, c in counters]).first().asDict()
    except PySparkException as e:
        if not evaluation_error(e):
            raise
    if len(counters) == 1:
        return {}
    half = len(counters) // 2
    return _counted(df, counters[:half]) | _counted(df, counters[half:])


def _pct(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def _rule_counters(df: DataFrame, rules: Sequence[Rule], null_fails: bool, among: Column | None = None) -> list[tuple[str, Column]]:
    """A counter of failures for each rule that ``df`` has the columns for, named by the rule's place."""
    out = []
    for i, rule in enumerate(rules):
        condition = rule.condition()
        if _resolves(df, condition):
            failed = ~F.coalesce(condition, F.lit(not null_fails))
            # Rows that aren't meant are not evaluated: a condition may fail on them.
            out.append((f"_f{i}", F.count_if(failed if among is None else F.when(among, failed))))
    return out


def _verdict_rows(spark: SparkSession, rules: Sequence[Rule], found: Mapping[str, int], n: int) -> DataFrame:
    """The verdicts as literals: no job, no Python worker."""
    if not rules:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _verdicts().fields])
    results = []
    for i, rule in enumerate(rules):
        known = found.get(f"_f{i}")
        fails = F.lit(known or 0).cast("bigint")
        passed = known == 0
        bad_label = "FALLIDA" if rule.critical else "ADVERTENCIA"
        results.append(
            F.struct(
                F.lit(rule.name).alias("prueba"),
                F.lit(passed).alias("aprobada"),
                fails.alias("n_fallos"),
                _pct(fails, F.lit(n)).alias("pct_fallo"),
                F.lit(rule.critical).alias("critica"),
                F.lit("APROBADA" if passed else bad_label if known is not None else "ERROR").alias("estado"),
            )
        )
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*results)).alias("r")).select("r.*")


def quality_rules(
    df: DataFrame, table: str, rules: Sequence[Rule], at=None, null_fails: bool = False
) -> DataFrame:
    """One row per rule: failures, their share, verdict.

    A row whose condition is null passes unless ``null_fails``. A rule that cannot be evaluated, for instance on a
    missing column or because a cast fails on some row, is recorded as not passed, with a count of 0 and the label
    ERROR. All rules are counted in one pass, which runs here; if a rule fails in it, halves of the list are tried until it is
    found. What is no rule's fault (a lost executor, an unreadable file, an error in ``df`` itself) is raised.
    """
    counters = _rule_counters(df, rules, null_fails)
    found = _counted(df, [("_n", F.count(F.lit(1))), *counters]) if rules else {}
    if rules and "_n" not in found:
        # Not even rows can be counted: the fault is the frame's.
        df.agg(F.count(F.lit(1))).first()
    return _stamped(_verdict_rows(df.sparkSession, rules, found, found.get("_n", 0)), table, at)


def _verdicts() -> T.StructType:
    return T.StructType.fromDDL(VERDICT_SCHEMA)


def _stamped(verdicts: DataFrame, table: str, at) -> DataFrame:
    stamps = {"tabla": F.lit(table), "ts_ejecucion": F.lit(at).cast("timestamp")}
    return verdicts.withColumns(stamps).select(*RULE_COLUMNS)


def _profiled(df: DataFrame, include_hidden: bool = False) -> list[str]:
    return [c for c in df.columns if include_hidden or not c.startswith("_")]


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column that does not start with ``_``: number and percentage of nulls."""
    columns = _profiled(df)
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("columna"), F.col(c).alias("n_nulos"), _pct(F.col(c), F.col("_n")).alias("pct_nulos")
        )
        for c in columns
    ]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def quality_report(
    before: DataFrame, after: DataFrame, table: str, batch_id: str, at, duplicates: int, rejected: int
) -> DataFrame:
    """One row: rows before and after cleaning, what was dropped, share that conforms, null share per column (JSON)."""
    columns = _profiled(after)
    n = F.col("_n")
    nulls = F.create_map(*[x for c in columns for x in (F.lit(c), _pct(F.col(c), n))])
    profile = after.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    ).select(n.alias("n_registros_silver"), F.to_json(nulls).alias("detalle_nulos"))
    source = before.agg(F.count(F.lit(1)).alias("n_registros_bronze"))
    both = source.unionByName(profile, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        F.lit(table).alias("tabla"),
        F.lit(batch_id).alias("lote_id"),
        F.lit(at).cast("timestamp").alias("ts_reporte"),
        "n_registros_bronze",
        "n_registros_silver",
        F.lit(duplicates).cast("bigint").alias("n_duplicados"),
        F.lit(rejected).cast("bigint").alias("n_rechazados"),
        _pct(F.col("n_registros_silver"), F.col("n_registros_bronze")).alias("pct_conformes"),
        "detalle_nulos",
    )


def report_row(
    spark: SparkSession, table: str, batch_id: str, at, before: int, after: int, duplicates: int, rejected: int,
    nulls: Mapping[str, int],
) -> DataFrame:
    """The row of :func:`quality_report` from counts that are known; ``nulls`` has them by column."""
    n = F.lit(after)
    shares = F.create_map(*[x for c, k in nulls.items() for x in (F.lit(c), _pct(F.lit(k), n))])
    counts = {"n_registros_bronze": before, "n_registros_silver": after, "n_duplicados": duplicates, "n_rechazados": rejected}
    return spark.range(0, 1, 1, 1).select(
        F.lit(table).alias("tabla"),
        F.lit(batch_id).alias("lote_id"),
        F.lit(at).cast("timestamp").alias("ts_reporte"),
        *[F.lit(v).cast("bigint").alias(c) for c, v in counts.items()],
        _pct(n, F.lit(before)).alias("pct_conformes"),
        F.to_json(shares).alias("detalle_nulos"),
    )


class Watched:
    """A frame that counts its rows, rule failures, nulls and whatever else is asked while it is written or read, once.

    ``frame`` is to be written in place of the one given. The counts are taken in the last stage of that job, whose tasks
    count once however often they are tried, and are there when it has ended. ``good`` says which rows rules and nulls are
    counted among; rules and profile see the columns of ``shown``.
    """

    def __init__(
        self, df: DataFrame, table: str, rules: Sequence[Rule] = (), good: Column | None = None, shown: Sequence[str] | None = None,
        null_fails: bool = False, **counts: Column,
    ):
        good = F.lit(True) if good is None else F.coalesce(good, F.lit(False))
        self.table, self.rules, self.spark = table, list(rules), df.sparkSession
        self.columns = _profiled(df.select(*(shown or df.columns)))
        nulls = [F.count_if(good & F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(self.columns)]
        counters = _rule_counters(df, self.rules, null_fails, good)
        failures, self._evaluated = [c.alias(name) for name, c in counters], [name for name, _ in counters]
        asked = [c.alias(name) for name, c in counts.items()]
        self._seen = Observation()
        self.frame = df.observe(self._seen, F.count_if(good).alias("_n"), *nulls, *failures, *asked)

    def count(self, name: str) -> int:
        # Of no rows at all there may be nothing to observe.
        return self._seen.get.get(name) or 0

    def verdicts(self, at=None) -> DataFrame:
        """As :func:`quality_rules` of the good rows."""
        found = {name: self.count(name) for name in self._evaluated}
        return _stamped(_verdict_rows(self.spark, self.rules, found, self.count("_n")), self.table, at)

    def report(self, batch_id: str, at, before: int, duplicates: int, rejected: int) -> DataFrame:
        """As :func:`quality_report` of ``before`` rows and the good ones."""
        nulls = {c: self.count(f"_z{i}") for i, c in enumerate(self.columns)}
        return report_row(self.spark, self.table, batch_id, at, before, self.count("_n"), duplicates, rejected, nulls)
