"""P1-P6 (projections, filters, predicates) and O1-O4 (sorts, limits, set ops)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cairn.functions.columns import clean_double, kind_of

# Columns that are never model features.
NON_FEATURES = ("customer_id", "churned", "split_type", "split_timestamp")


def feature_columns(df: DataFrame, exclude=NON_FEATURES) -> list[str]:
    """Every column not in the exclude list, in schema order."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex]


def columns_of_kind(df: DataFrame, kinds=("numeric",), exclude=("customer_id",)) -> list[str]:
    """Columns whose kind (numeric/string/bool/date/timestamp) is in ``kinds``."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if kind_of(f.dataType) in set(kinds) and f.name not in ex]


def drop_non_numeric(df: DataFrame, kinds=("string", "date", "timestamp")) -> DataFrame:
    """Drop the columns of the given kinds (booleans stay: they are indicators)."""
    return df.drop(*[f.name for f in df.schema.fields if kind_of(f.dataType) in set(kinds)])


def count_outside(df: DataFrame, col: str, lo=None, hi=None, out: str = "n_outside") -> DataFrame:
    """Rows with ``col < lo or col > hi`` (NULL and NaN never count), one pass."""
    c = clean_double(col)
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias(out))


def set_where(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    """P5: ``df.loc[cond, col] = value``; rows where cond is NULL are unchanged."""
    return df.withColumn(col, F.when(F.coalesce(cond, F.lit(False)), F.lit(value)).otherwise(F.col(col)))


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Plan-time presence check; a missing column raises ``ValueError``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) {missing} not found in data")
    return df


def sort_desc(df: DataFrame, col: str, tie: str | None = None) -> DataFrame:
    """O1: descending sort with an ascending tie-breaker (range-partitioned sort)."""
    order = [F.col(col).desc_nulls_last()] + ([F.col(tie).asc()] if tie else [])
    return df.orderBy(*order)


def top_k(df: DataFrame, col: str, k: int = 10, tie: str | None = None) -> DataFrame:
    """O2: the k largest rows; planned as TakeOrdered (k rows per partition, then merged)."""
    return sort_desc(df, col, tie).limit(k)


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """O3: distinct keys present in both frames (set intersection)."""
    return a.select(key).intersect(b.select(key))


def concat_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Column-wise concatenation of two frames describing the same rows.

    A DataFrame has no row order, so rows are matched on their key (1:1)."""
    extra = [c for c in right.columns if c != key and c not in left.columns]
    return left.join(right.select(key, *extra), key, "left")
