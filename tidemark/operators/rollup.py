"""Rollups that are kept up to date from a change feed instead of from all rows.

A :class:`Rollup` is a group-by whose results follow from parts that can be added and taken away: numbers of rows, sums of
whole numbers or decimals, counts, maxima. ``deltas`` turns a feed into what it adds to each group's parts and takes from them;
``merged`` applies that to the parts there were. Only a maximum can't be taken away: where the greatest value that left was the
group's greatest, the group is marked, and has to be rolled up again from its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.incremental import CURRENT_KINDS

#: Whether a group must be rolled up from its rows.
AGAIN = "_de_nuevo"


@dataclass(frozen=True)
class Rollup:
    """``keys``, the parts by name, and ``publish``: the columns made of parts.

    Parts are called ``_s_<name>`` (a sum; null if it has no summand), ``_c_<name>`` (a count, also of a sum's summands) and
    ``_m_<name>`` (a maximum). Sums must be of a type that adds exactly.
    """

    keys: Sequence[str]
    sums: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    counts: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)
    publish: Callable[[], Sequence[Column]] = tuple

    @property
    def parts(self) -> list[str]:
        summed = [p for name in self.sums for p in (f"_s_{name}", f"_c_{name}")]
        return ["_n", *summed, *[f"_c_{name}" for name in self.counts], *[f"_m_{name}" for name in self.maxima]]

    def aggregate(self, rows: DataFrame) -> DataFrame:
        """Keys and parts of all groups of ``rows``."""
        out = [F.count(F.lit(1)).alias("_n")]
        for name, value in self.sums.items():
            out += [F.sum(value()).alias(f"_s_{name}"), F.count(value()).alias(f"_c_{name}")]
        out += [F.count(c).alias(f"_c_{name}") for name, c in self.counts.items()]
        out += [F.max(c).alias(f"_m_{name}") for name, c in self.maxima.items()]
        return rows.groupBy(*self.keys).agg(*out)

    def published(self, parts: DataFrame) -> DataFrame:
        return parts.select(*self.keys, *self.publish())

    def build(self, rows: DataFrame) -> DataFrame:
        """The published columns from all rows."""
        return self.published(self.aggregate(rows))

    def with_parts(self, parts: DataFrame) -> DataFrame:
        """The published columns and the parts they were made of, to be kept."""
        return parts.select(*self.keys, *self.publish(), *self.parts)

    def deltas(self, feed: DataFrame) -> DataFrame:
        """What the images of a feed add to each group's parts; for maxima the greatest value that came and that went."""
        came = F.col("_change_type").isin(*CURRENT_KINDS)
        sign = F.when(came, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
        out = [F.sum(sign).alias("_n")]

        def counted(value: Column) -> Column:
            return F.sum(F.when(value.isNotNull(), sign).otherwise(F.lit(0).cast("bigint")))

        for name, value in self.sums.items():
            out += [F.sum(F.when(came, value()).otherwise(-value())).alias(f"_s_{name}"), counted(value()).alias(f"_c_{name}")]
        out += [counted(F.col(c)).alias(f"_c_{name}") for name, c in self.counts.items()]
        for name, c in self.maxima.items():
            out += [F.max(F.when(came, F.col(c))).alias(f"_in_{name}"), F.max(F.when(~came, F.col(c))).alias(f"_out_{name}")]
        return feed.groupBy(*self.keys).agg(*out)

    def merged(self, held: DataFrame, deltas: DataFrame, on: Sequence[str] | None = None) -> DataFrame:
        """Keys and parts of the groups in ``deltas`` after these, and ``AGAIN``. Groups that have no row left aren't there.

        ``held`` has the parts that were kept, at least of these groups. ``on`` are columns both have that tell groups apart
        and are never null; without, the keys do.
        """
        on = list(on or self.keys)
        old = held.select(*[F.col(c).alias(f"_h_{c}") for c in on], *[F.col(p).alias(f"_h{p}") for p in self.parts])
        both = deltas.join(old, [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in on], "left")

        def plus(part: str) -> Column:
            return F.coalesce(F.col(f"_h{part}"), F.lit(0)) + F.coalesce(F.col(part), F.lit(0))

        columns, again = {}, F.lit(False)
        for part in self.parts:
            kind = held.schema[part].dataType
            if part.startswith("_m_"):
                name = part.removeprefix("_m_")
                best, went = F.greatest(F.col(f"_h{part}"), F.col(f"_in_{name}")), F.col(f"_out_{name}")
                columns[part] = best.cast(kind)
                # What is greater than all that went is still there; if it isn't, nobody knows what is next.
                again = again | (went.isNotNull() & F.coalesce(went >= best, F.lit(True)))
            elif part.startswith("_s_"):
                columns[part] = F.when(plus(part.replace("_s_", "_c_", 1)) > 0, plus(part)).cast(kind)
            else:
                columns[part] = plus(part).cast(kind)
        extra = [c for c in on if c not in self.keys]
        out = both.select(*self.keys, *extra, *[c.alias(p) for p, c in columns.items()], again.alias(AGAIN))
        return out.filter(F.col("_n") > 0)


def mean(name: str, digits: int) -> Column:
    """The mean, to ``digits``, of a part that sums whole units of that many digits."""
    return F.round(F.col(f"_s_{name}") / F.col(f"_c_{name}")) / 10**digits


def units(column: str, digits: int) -> Callable[[], Column]:
    """A column that has no more than ``digits`` digits as whole numbers, whose sum does not depend on their order."""
    return lambda: F.round(F.col(column) * 10**digits).cast("bigint")


def rate(flag: str, of: str) -> Column:
    """A summed flag in percent of a count."""
    return F.round(F.col(f"_s_{flag}") / F.col(f"_c_{of}") * 100, 2)
