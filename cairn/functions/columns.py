"""Small column-expression builders shared by the operators.

Nothing here runs Python per row: each helper returns a ``Column`` built
from ``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r6(c) -> Column:
    """Round to 6 places: the precision at which Spark and the SQL oracle agree."""
    return F.round(_c(c).cast("double"), 6)


def is_nan_or_inf(c) -> Column:
    c = _c(c).cast("double")
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def finite_or_null(c) -> Column:
    """NaN and +/-inf become NULL; other values are kept (as double)."""
    c = _c(c).cast("double")
    return F.when(is_nan_or_inf(c), F.lit(None).cast("double")).otherwise(c)


def clean_double(c) -> Column:
    """NaN -> NULL (Spark aggregates skip NULL but not NaN); inf is kept."""
    c = _c(c).cast("double")
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def safe_div(num, den, default=0.0) -> Column:
    """num / den when den > 0, else ``default`` (ANSI-safe, no division by zero); a NaN counts as missing."""
    num, den = clean_double(num), clean_double(den)
    return F.when(den > 0, F.try_divide(num, den)).otherwise(F.lit(default).cast("double"))


def hash_order(seed: int, key) -> Column:
    """Seeded, partition-independent order key: md5('<seed>:<key>') as hex.

    Identical in Spark and DuckDB, so splits and samples are oracle-checkable.
    """
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))


def hash_uniform(seed: int, key, salt: str = "") -> Column:
    """Deterministic uniform value in [0, 1) from the first 32 bits of the md5 hash."""
    h = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), _c(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dt, T.StringType):
        return "string"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "other"


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if kind_of(f.dataType) == "numeric" and f.name not in set(exclude)]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if kind_of(f.dataType) == "string" and f.name not in set(exclude)]
