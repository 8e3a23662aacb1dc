"""Text columns: catalog values, normalised names, hashes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize(
    c: Column | str,
    allowed: Iterable[str] = (),
    default: str | None = None,
    null_default: str | None = None,
    mapping: Mapping[str, str] | None = None,
) -> Column:
    """Keep values of the catalog (translated through ``mapping`` if given), replace all others by ``default``.

    Matching is exact: another case or a trailing space is another value. Null becomes ``null_default``, or
    ``default`` where none is set.
    """
    c = as_col(c)
    out = F.when(c.isNull(), F.lit(null_default if null_default is not None else default))
    for value, target in (mapping or {}).items():
        out = out.when(c == value, F.lit(target))
    allowed = list(allowed)
    if allowed:
        out = out.when(c.isin(allowed), c)
    return out.otherwise(F.lit(default))


def normalize_text(c: Column | str) -> Column:
    """Trim, then capitalise every word."""
    return F.initcap(F.trim(as_col(c)))


def sha256_hex(c: Column | str) -> Column:
    """Lower-case hex SHA-256; null and the empty string give null."""
    c = as_col(c)
    return F.when(F.length(c) > 0, F.sha2(c, 256))
