"""Flags, indicators, date features, ratios, scaled scores, encodings."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cairn.functions.columns import clean_double, safe_div
from cairn.operators.profile import quantile_values
from cairn.operators.ranking import dense_rank_values

# Account-age bins (years, right-closed) and their labels.
AGE_EDGES = (0.0, 1.0, 3.0, 5.0, math.inf)
AGE_LABELS = ("New", "Young", "Mature", "Veteran")
DAYS_PER_YEAR = 365.25


def _flag(cond) -> F.Column:
    # a comparison with NULL is false -> 0, as with NaN in pandas
    return F.coalesce(cond, F.lit(False)).cast("int")


def flag_ge_quantile(df: DataFrame, col: str, q: float = 0.75, out: str = "is_high_value",
                     threshold: float | None = None) -> DataFrame:
    """1 when ``col >= P_q(col)`` (exact, interpolated quantile)."""
    t = quantile_values(df, [col], [q])[(col, q)] if threshold is None else threshold
    return df.withColumn(out, _flag(clean_double(col) >= F.lit(t)) if t is not None else F.lit(0))


def flag_gt(df: DataFrame, col: str, x=2, out: str = "is_high_support") -> DataFrame:
    """1 when ``col > x``."""
    return df.withColumn(out, _flag(clean_double(col) > F.lit(x)))


def flag_le_quantile(df: DataFrame, col: str, q: float = 0.25, out: str = "is_low_engagement",
                     threshold: float | None = None) -> DataFrame:
    """1 when ``col <= P_q(col)``."""
    t = quantile_values(df, [col], [q])[(col, q)] if threshold is None else threshold
    return df.withColumn(out, _flag(clean_double(col) <= F.lit(t)) if t is not None else F.lit(0))


def categories_of(df: DataFrame, col: str, max_categories: int = 1000) -> list:
    """Sorted distinct non-NULL values; more than ``max_categories`` raises
    (the output width must be bounded)."""
    vals = df.select(col).where(F.col(col).isNotNull()).distinct().limit(max_categories + 1).collect()
    if len(vals) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories for one-hot encoding")
    return sorted(r[0] for r in vals)


def one_hot(df: DataFrame, col: str, prefix: str | None = None, categories: list | None = None,
            max_categories: int = 1000) -> DataFrame:
    """one boolean ``<prefix>_<value>`` column per category (sorted); the
    source column is kept; NULL gives all false."""
    prefix = col if prefix is None else prefix
    cats = categories_of(df, col, max_categories) if categories is None else list(categories)
    return df.select("*", *[F.coalesce(F.col(col) == F.lit(v), F.lit(False)).alias(f"{prefix}_{v}")
                            for v in cats])


def parse_date(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """string -> date; an unparsable value becomes NULL (per row)."""
    c = F.col(col)
    parsed = c if dict(df.dtypes)[col] == "date" else F.to_date(F.try_to_timestamp(c.cast("string")))
    return df.withColumn(out or col, parsed)


def date_parse_failures(df: DataFrame, col: str) -> DataFrame:
    """F13 report: non-NULL values that fail to parse as a date."""
    c = F.col(col)
    bad = c.isNotNull() & F.try_to_timestamp(c.cast("string")).isNull()
    return df.agg(F.count_if(bad).alias("n_unparsable"), F.count(c).alias("n_values"))


def age_days(df: DataFrame, col: str, as_of: str, out: str = "account_age_days") -> DataFrame:
    """whole days from the date in ``col`` to ``as_of``."""
    return df.withColumn(out, F.datediff(F.lit(as_of).cast("date"), F.col(col)))


def age_years(df: DataFrame, days_col: str = "account_age_days", out: str = "account_age_years") -> DataFrame:
    """days / 365.25."""
    return df.withColumn(out, F.col(days_col) / F.lit(DAYS_PER_YEAR))


def bucketize(df: DataFrame, col: str, edges=AGE_EDGES, labels=AGE_LABELS,
              out: str = "account_age_bucket") -> DataFrame:
    """F8: right-closed bins (e0, e1], (e1, e2], ...; outside or NULL -> NULL."""
    c = F.col(col)
    expr = F.when(c.isNull() | (c <= edges[0]), F.lit(None).cast("string"))
    for hi, lab in zip(edges[1:], labels):
        expr = expr.when(c <= hi, F.lit(lab))
    return df.withColumn(out, expr)


def account_age(df: DataFrame, col: str = "account_created_date", as_of: str = "2001-08-01") -> DataFrame:
    """F5-F8 chained: parsed date, age in days and years, and the age bucket."""
    return bucketize(age_years(age_days(parse_date(df, col), col, as_of)), "account_age_years")


def safe_ratio(df: DataFrame, num: str, den: str, out: str = "spend_per_session") -> DataFrame:
    """num / den when den > 0 else 0."""
    return df.withColumn(out, safe_div(num, den))


def extremes_of(df: DataFrame, cols: list[str]) -> dict:
    """{column: (min, max)} for several columns in one aggregate pass."""
    if not cols:
        return {}
    row = df.agg(*[F.min(clean_double(c)).alias(f"mn{i}") for i, c in enumerate(cols)],
                 *[F.max(clean_double(c)).alias(f"mx{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"mn{i}"], row[f"mx{i}"]) for i, c in enumerate(cols)}


def scale_by_max(df: DataFrame, col: str, out: str = "support_risk_score", maximum: float | None = None) -> DataFrame:
    """col / max(col); a max <= 0 gives 0 everywhere."""
    m = extremes_of(df, [col])[col][1] if maximum is None else maximum
    if m is None or m <= 0:
        return df.withColumn(out, F.lit(0.0))
    return df.withColumn(out, clean_double(col) / F.lit(m))


def minmax_mean(df: DataFrame, cols: list[str], out: str = "customer_value_tier",
                extremes: dict | None = None) -> DataFrame:
    """mean of the min-max scaled columns; a constant column contributes 0."""
    ext = extremes_of(df, cols) if extremes is None else extremes
    parts = []
    for c in cols:
        mn, mx = ext[c]
        parts.append((clean_double(c) - F.lit(mn)) / F.lit(mx - mn) if mn is not None and mx > mn else F.lit(0.0))
    return df.withColumn(out, sum(parts[1:], parts[0]) / F.lit(float(len(cols))))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """0-based rank of the distinct values in string order ('10' < '2').

    The dictionary is built with the distributed dense rank and joined back
    on the value (broadcast by AQE when it is small, shuffled otherwise)."""
    out = out or f"{col}_encoded"
    s = df.withColumn("__s", F.col(col).cast("string"))
    dic = dense_rank_values(s, "__s", out="__code")
    return s.join(dic, "__s", "left").withColumn(out, F.col("__code").cast("long")).drop("__s", "__code")
