"""Per-table configuration.

A :class:`TableSpec` says everything that differs from one source table to the next: its declared schema, keys,
null handling, masked columns, derivations, rejection rules, parents and quality rules. The operators stay generic.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def columns(text: str) -> T.StructType:
    """A schema from ``name type`` pairs, ``type!`` for columns that are never null. Needs no session."""
    schema = T.StructType()
    for name, kind in (item.split() for item in text.split(",")):
        schema.add(name, kind.rstrip("!"), nullable=not kind.endswith("!"))
    return schema


@dataclass(frozen=True)
class Rule:
    """A quality check. A row passes when ``condition`` is true, or unknown (see ``quality_rules``)."""

    name: str
    condition: Callable[[], Column]
    critical: bool = False


@dataclass(frozen=True)
class Reject:
    """Rows for which ``bad`` is true leave the table with ``reason``.

    With ``null_out`` the row stays, the named column is set to null, and a copy of the original is quarantined.
    ``bad`` that is null never rejects.
    """

    reason: str
    bad: Callable[[], Column]
    null_out: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must exist as ``parent_key`` in the cleaned table ``parent``."""

    column: str
    parent: str
    parent_key: str

    @property
    def reason(self) -> str:
        return f"FK_INVALIDA: {self.column} no existe en {self.parent}"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: Sequence[str]
    date_column: str
    """Column the year/month/day partition parts are taken from."""
    date_parts: Sequence[str] = ("_anio", "_mes", "_dia")
    """Partition columns: year, month and day, or fewer where a day holds too little for a file."""
    fmt: str = "parquet"
    """Landing file format: csv, json or parquet."""
    watermark: str = "fec_modificacion"
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    """Money columns, cast to ``decimal(precision, scale)`` when conforming."""
    nulls: Mapping[str, tuple[str, object]] = field(default_factory=dict)
    """column -> (``imputar`` | ``excluir`` | ``indicador``, fill value), applied in order."""
    masked: Sequence[str] = ()
    """Columns published as typed nulls; derivations still see the real values."""
    derive: Callable[[DataFrame, object], DataFrame] = lambda df, as_of: df
    rejects: Sequence[Reject] = ()
    parents: Sequence[ForeignKey] = ()
    rules: Sequence[Rule] = ()
    dedup_keys: Sequence[str] | None = None
    """Defaults to ``keys``; a business key also catches copies stored under new ids."""
    lateness: str | None = None
    """Interval text such as ``2 hours``: how far behind the watermark rows may still arrive."""
