"""Column expressions shared by the operators."""

from playlab.functions.hashing import uniform_hash, unit_hash, HASH_RANGE
from playlab.functions.columns import (
    REFERENCE_COLUMNS,
    SAMPLE_FRACTIONS,
    EXCLUDED_LABEL,
    LABEL,
    KEY,
)

__all__ = [
    "uniform_hash",
    "unit_hash",
    "HASH_RANGE",
    "REFERENCE_COLUMNS",
    "SAMPLE_FRACTIONS",
    "EXCLUDED_LABEL",
    "LABEL",
    "KEY",
]
