"""Column functions: everything here takes columns or names and returns a column; no Python runs per row."""

from tidemark.functions.derive import (
    age_years,
    band,
    business_hours_flag,
    code_prefix,
    date_parts,
    elapsed,
    iso_week_parts,
    line_total,
    membership_flag,
    pct,
    rule_matrix_flag,
    share_of_sum,
    tenure_years,
    threshold_status,
    total,
)
from tidemark.functions.text import normalize_text, sha256_hex, standardize

__all__ = [
    "age_years", "band", "business_hours_flag", "code_prefix", "date_parts", "elapsed", "iso_week_parts",
    "line_total", "membership_flag", "normalize_text", "pct", "rule_matrix_flag", "sha256_hex", "share_of_sum",
    "standardize", "tenure_years", "threshold_status", "total",
]
