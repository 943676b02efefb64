"""Column-expression helpers (all JVM-side, codegen friendly)."""

from cairn.functions.columns import (
    clean_double, finite_or_null, hash_order, hash_uniform, is_nan_or_inf,
    kind_of, numeric_columns, r6, safe_div, string_columns,
)

__all__ = [
    "clean_double", "finite_or_null", "hash_order", "hash_uniform", "is_nan_or_inf",
    "kind_of", "numeric_columns", "r6", "safe_div", "string_columns",
]
