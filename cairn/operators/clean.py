"""Imputation, IQR capping, clamps and non-finite replacement.

Statistics are computed in one distributed pass per operator and applied
as literals, so the rewritten columns stay plain projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from cairn.functions.columns import clean_double, is_nan_or_inf, numeric_columns, r6, string_columns
from cairn.operators.profile import is_missing, mode_values, quantile_values

KEY = "customer_id"


def _with_missing(df: DataFrame, cols: list[str]) -> list[str]:
    if not cols:
        return []
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"__m{i}"] > 0]


def columns_with_missing(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    """Columns (default: all) holding at least one NULL or NaN - one aggregate pass."""
    return _with_missing(df, df.columns if cols is None else list(cols))


def impute_median(df: DataFrame, cols: list[str] | None = None, exclude=(KEY,),
                  missing: list[str] | None = None) -> DataFrame:
    """NULLs and NaNs in numeric columns (default: all but the id; the target too)
    become the column median.  Only columns with NULLs change; they become
    double, as a median may fall between two integers."""
    cols = numeric_columns(df, exclude) if cols is None else list(cols)
    todo = _with_missing(df, cols) if missing is None else [c for c in cols if c in set(missing)]
    med = quantile_values(df, todo, [0.5])
    fill = {c: med[(c, 0.5)] for c in todo if med[(c, 0.5)] is not None}
    return df.select(*[F.coalesce(clean_double(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                       for c in df.columns])


def impute_mode(df: DataFrame, cols: list[str] | None = None, exclude=(KEY,),
                default: str = "Unknown", missing: list[str] | None = None) -> DataFrame:
    """NULLs in string columns become the mode (ties -> smallest value;
    a column with no values gets ``default``)."""
    cols = string_columns(df, exclude) if cols is None else list(cols)
    todo = _with_missing(df, cols) if missing is None else [c for c in cols if c in set(missing)]
    fill = mode_values(df, todo, default)
    return df.fillna(fill) if fill else df


def iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5) -> dict:
    """{column: (q1, q3, lower, upper)} from one exact quantile pass."""
    q = quantile_values(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        if q1 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    return out


def _clip(c: str, lo, hi):
    col = clean_double(c)
    # greatest/least skip NULL, so NULL (and NaN, which is missing too) is kept explicitly
    return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.least(col, F.lit(hi)), F.lit(lo)))


def cap_iqr(df: DataFrame, cols: list[str], k: float = 1.5, bounds: dict | None = None) -> DataFrame:
    """Clip each column to [Q1 - k IQR, Q3 + k IQR]; capped columns become double."""
    cols = [c for c in cols if c in df.columns]
    b = iqr_bounds(df, cols, k) if bounds is None else bounds
    return df.select(*[_clip(c, b[c][2], b[c][3]).alias(c) if c in b else F.col(c) for c in df.columns])


def iqr_report(df: DataFrame, cols: list[str], k: float = 1.5, bounds: dict | None = None) -> DataFrame:
    """C3 report: (column, q1, q3, iqr, lower, upper, n_outliers) - counts in one pass."""
    cols = [c for c in cols if c in df.columns]
    b = iqr_bounds(df, cols, k) if bounds is None else bounds
    cols = [c for c in cols if c in b]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, q1 double, q3 double, iqr double, "
                                         "lower double, upper double, n_outliers long")
    counts = df.agg(*[F.count_if((clean_double(c) < b[c][2]) | (clean_double(c) > b[c][3])).alias(f"__o{i}")
                      for i, c in enumerate(cols)])
    stats = spark.createDataFrame([(i, c, *b[c]) for i, c in enumerate(cols)],
                                  "i int, column string, q1 double, q3 double, lower double, upper double")
    n_out = counts.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"__o{i}").alias("n_outliers"))
                                              for i in range(len(cols))])).alias("s")).select("s.*")
    return stats.join(n_out, "i").select(
        "column", r6("q1").alias("q1"), r6("q3").alias("q3"), r6(F.col("q3") - F.col("q1")).alias("iqr"),
        r6("lower").alias("lower"), r6("upper").alias("upper"), "n_outliers")


def clamp(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """C4: values below lo become lo, above hi become hi (NULL and NaN stay as they are)."""
    c, v = F.col(col), clean_double(col)
    return df.withColumn(col, F.when(v < lo, F.lit(lo)).when(v > hi, F.lit(hi)).otherwise(c))


def floor_at(df: DataFrame, col: str, lo=0) -> DataFrame:
    """Values below lo (default 0, e.g. negative spend) become lo."""
    c = F.col(col)
    return df.withColumn(col, F.when(c < lo, F.lit(lo).cast(df.schema[col].dataType)).otherwise(c))


def finite_or(df: DataFrame, cols: list[str] | None = None, value=0.0, exclude=()) -> DataFrame:
    """NaN, +/-inf and NULL in numeric columns become ``value``."""
    cols = numeric_columns(df, exclude) if cols is None else list(cols)
    out = []
    for f in df.schema.fields:
        if f.name not in cols:
            out.append(F.col(f.name))
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(is_nan_or_inf(c), F.lit(None)).otherwise(c)
        out.append(F.coalesce(c, F.lit(value).cast(f.dataType)).alias(f.name))
    return df.select(*out)


def non_finite_report(df: DataFrame, cols: list[str] | None = None, exclude=()) -> DataFrame:
    """C6 report: (n_non_finite) cells that ``finite_or`` replaces, one pass."""
    cols = numeric_columns(df, exclude) if cols is None else list(cols)
    cells = [F.count_if(F.col(c).isNull() | is_nan_or_inf(c)) for c in cols]
    return df.agg(sum(cells).alias("n_non_finite") if cells else F.lit(0).alias("n_non_finite"))
