"""tidemark: incremental lakehouse operators written as plain Spark plans.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column -> Column`` one); the few sinks and the
per-table run functions sit on top of them and are driven by :class:`tidemark.spec.TableSpec`.
"""

from tidemark.spec import ForeignKey, Reject, Rule, TableSpec

__all__ = ["ForeignKey", "Reject", "Rule", "TableSpec"]
