"""Landing values that can't be read, as rows: which record, which column, and the text that was there.

``read_landing`` reads CSV and JSON lines as text, so nothing is lost before it is looked at; records that aren't even that are
kept whole. ``conform_rescued`` casts to the declared types as :func:`conform_schema` does, and collects in the same pass every
text that became null by it. ``rejected_values`` lists these, and the unreadable records, one a row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import FORMAT_OPTIONS, conform_schema

#: The text of a record that can't be read at all.
RECORD = "_registro_ilegible"
#: What became null when a record was conformed.
REJECTED = "_valores_rechazados"
REJECTED_TYPE = "array<struct<columna:string,texto:string,tipo:string>>"
UNREADABLE = "REGISTRO_ILEGIBLE"
BAD_VALUE = "VALOR_ILEGIBLE"

# Without pruning CSV columns a record is judged as a whole, whichever columns a query asks for.
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
_CSV = {"columnPruning": "false", "enforceSchema": "true"}


def text_schema(schema: T.StructType) -> T.StructType:
    """The declared columns as text, and the column for unreadable records."""
    return T.StructType([T.StructField(c, T.StringType()) for c in [*schema.names, RECORD]])


def _options(fmt: str, options: Mapping[str, str] | None) -> dict[str, str]:
    if fmt not in ("csv", "json"):
        raise ValueError(f"{fmt} files carry types of their own; read them with read_files")
    return {**FORMAT_OPTIONS[fmt], **(options or {}), **_OPTIONS, **(_CSV if fmt == "csv" else {})}


def _kept_apart(df: DataFrame) -> DataFrame:
    """The unreadable record, always true of it but not for the optimizer: so it never stands in a query alone, which Spark
    refuses, and no filter on it is pushed into the parser, which would ask before it knows."""
    always = F.length(F.concat_ws("", F.col(df.columns[0]), F.col(RECORD))) >= 0
    return df.withColumn(RECORD, F.when(always, F.col(RECORD)))


def read_landing(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, options: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV or JSON lines with every declared column as text, and unreadable records as they were in ``RECORD``.

    A CSV record with too few or too many fields is unreadable; so is a line of JSON that isn't an object. What a JSON
    value of a declared column was, a number or a string or an object, does not matter here. ``options`` say how files
    differ from the usual layout (``{"header": "false"}``).
    """
    return _kept_apart(spark.read.format(fmt).options(**_options(fmt, options)).schema(text_schema(schema)).load(path))


def stream_landing(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, files_per_batch: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same as a stream that picks up new files; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).options(**_options(fmt, options)).schema(text_schema(schema))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _kept_apart(reader.load(path))


def conform_rescued(
    df: DataFrame, schema: T.StructType, decimals: Mapping[str, tuple[int, int]] | None = None
) -> DataFrame:
    """:func:`conform_schema`, and in ``REJECTED`` each value that was there before and is null after it.

    An array in the order of the declared columns, empty if all could be read. Values of a decimal column that have too many
    digits for it are among them. Rows of unreadable records have nulls and no entries: ``RECORD`` has all of them.
    """
    plain = df.drop("_rescued_data")
    after = conform_schema(plain, schema, decimals)
    touched = [c for c in plain.columns if plain.schema[c].dataType != after.schema[c].dataType or c in (decimals or {})]
    # The values before go along until all are compared.
    before = {f"_antes_{c}": F.col(c) for c in touched}
    both = conform_schema(plain.withColumns(before) if before else plain, schema, decimals)
    readable = F.col(RECORD).isNull() if RECORD in plain.columns else F.lit(True)
    none = F.array().cast(REJECTED_TYPE)
    # Joined, not filtered: a lambda would take the whole projection out of generated code.
    found = [
        F.when(
            readable & F.col(old).isNotNull() & F.col(c).isNull(),
            F.array(F.struct(F.lit(c).alias("columna"), F.col(old).cast("string").alias("texto"), F.lit(after.schema[c].dataType.simpleString()).alias("tipo"))),
        ).otherwise(none)
        for c, old in zip(touched, before, strict=True)
    ]
    entries = F.concat(*found) if found else none
    return both.withColumn(REJECTED, entries.cast(REJECTED_TYPE)).drop(*before)


def rescued(df: DataFrame) -> Column:
    """Whether anything of a conformed row could not be read."""
    unreadable = F.col(RECORD).isNotNull() if RECORD in df.columns else F.lit(False)
    return unreadable | (F.size(REJECTED) > 0)


def rejected_values(df: DataFrame, keys: Sequence[str] = (), hidden: Sequence[str] = ()) -> DataFrame:
    """One row for each value of a conformed frame that could not be read: the keys, ``columna``, ``texto``, ``tipo``, ``motivo_error``.

    An unreadable record is one row with its whole text and without keys or column. Texts of ``hidden`` columns are null, and so
    are unreadable records if any column is hidden, since its value may stand in them.
    """
    whole = F.struct(F.lit(None).cast("string").alias("columna"), F.col(RECORD).alias("texto"), F.lit(None).cast("string").alias("tipo"))
    entries = F.col(REJECTED)
    unreadable = F.lit(False)
    if RECORD in df.columns:
        unreadable = F.col(RECORD).isNotNull()
        entries = F.when(unreadable, F.array(whole)).otherwise(entries)
    rows = df.select(
        *[F.when(~unreadable, F.col(k)).alias(k) for k in keys],
        F.explode(entries).alias("_valor"),
        F.when(unreadable, F.lit(UNREADABLE)).otherwise(F.lit(BAD_VALUE)).alias("_por_que"),
    )
    column, text = F.col("_valor.columna"), F.col("_valor.texto")
    if hidden:
        text = F.when(column.isNotNull() & ~column.isin(*hidden), text)
    why = F.concat_ws(": ", "_por_que", column)
    return rows.select(*keys, column.alias("columna"), text.alias("texto"), F.col("_valor.tipo").alias("tipo"), why.alias("motivo_error"))


def readable_rows(df: DataFrame) -> DataFrame:
    """The rows of a conformed frame that were records, without what was collected beside them."""
    kept = df.filter(F.col(RECORD).isNull()) if RECORD in df.columns else df
    return kept.drop(RECORD, REJECTED)
