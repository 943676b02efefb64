"""A1-A10: profiling aggregates.  Each report is one pass (one ``agg``) where
possible; exact quantiles use the distributed running sum."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cairn.functions.columns import clean_double, kind_of, r6
from cairn.operators.ranking import running_sum


def is_missing(df: DataFrame, c: str):
    """NULL, or NaN in a floating-point column."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_summary(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """A1: (column, null_count, null_share) in one pass; by default only columns with nulls."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(is_missing(df, c)).alias(f"__m{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("null_count"))
                                  for i, c in enumerate(cols)]))
    out = agg.select("__n", stacked.alias("s")).select("s.column", "s.null_count", "__n")
    if only_missing:
        out = out.where(F.col("null_count") > 0)
    return out.select("column", "null_count",
                      r6(F.try_divide(F.col("null_count"), F.col("__n"))).alias("null_share"))


def total_nulls(df: DataFrame) -> DataFrame:
    """Total missing cells as a one-row frame (``total_nulls``)."""
    return df.agg(sum(F.count_if(is_missing(df, c)) for c in df.columns).alias("total_nulls")) \
        if df.columns else df.sparkSession.range(1).select(F.lit(0).cast("long").alias("total_nulls"))


def type_report(df: DataFrame) -> DataFrame:
    """A2: (position, column, type, kind) from the schema."""
    rows = [(i, f.name, f.dataType.simpleString(), kind_of(f.dataType))
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, kind string")


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """A3: (value, count) per distinct value, NULL included as its own value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def mean_rate(df: DataFrame, col: str, out: str = "rate") -> DataFrame:
    """A4: mean of a 0/1 column over its values (NULL and NaN are none)."""
    return df.agg(F.count(F.lit(1)).alias("n"), r6(F.avg(clean_double(col))).alias(out))


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return (df.select(F.explode(F.array(*pairs)).alias("s")).select("s.column", "s.value")
              .where(F.col("value").isNotNull() & ~F.isnan("value")))


def order_stats(df: DataFrame, cols: list[str], probs: list[float]) -> dict:
    """{(column, p): (lower value, upper value, fraction) or None} for the linear
    interpolation at position p * (n - 1) among the non-NULL values.

    (column, value) counts are pre-aggregated, ranked with the distributed
    running sum, and only the rows holding the needed positions are fetched:
    no per-column value map is ever held by a single task.  Because the
    neighbours are returned, a caller can push any non-decreasing map
    (a clip, a floor) through the statistic without another pass.
    """
    if not cols:
        return {}
    hist = _long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    rs = running_sum(hist, ["value"], {"cum": "n"}, ["column"])
    need, plan = set(), {}
    for c in cols:
        total = rs.totals.get((c,), (0,))[0]
        for p in probs:
            if total == 0:
                plan[(c, p)] = None
                continue
            h = p * (total - 1)
            lo, hi = math.floor(h), math.ceil(h)
            plan[(c, p)] = (lo, hi, h - lo)
            need.update({(c, lo), (c, hi)})
    found = {}
    if need:
        targets = df.sparkSession.createDataFrame(sorted(need), "column string, pos long")
        r = rs.df.alias("r")
        t = F.broadcast(targets).alias("t")
        hits = (r.join(t, (F.col("r.column") == F.col("t.column"))
                       & (F.col("t.pos") >= F.col("r.cum") - F.col("r.n"))
                       & (F.col("t.pos") < F.col("r.cum")))
                 .select("t.column", "t.pos", "r.value").collect())
        found = {(h["column"], h["pos"]): h["value"] for h in hits}
    return {k: None if spec is None else (found[(k[0], spec[0])], found[(k[0], spec[1])], spec[2])
            for k, spec in plan.items()}


def interpolate(stat, fn=None):
    """Value of an ``order_stats`` entry, after an optional non-decreasing map."""
    if stat is None:
        return None
    vlo, vhi, frac = stat
    if fn is not None:
        vlo, vhi = fn(vlo), fn(vhi)
    return vlo if frac == 0 or vhi == vlo else vlo + (vhi - vlo) * frac


def quantile_values(df: DataFrame, cols: list[str], probs: list[float],
                    exact: bool = True, accuracy: int = 10000) -> dict:
    """A5: {(column, p): value}, linear interpolation (pandas/NumPy default).

    Exact by default (see ``order_stats``); ``exact=False`` uses
    ``percentile_approx`` (a bounded sketch per column)."""
    if not cols:
        return {}
    if not exact:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
                       for c in cols]).first()
        return {(c, p): (None if row[c] is None else row[c][i])
                for c in cols for i, p in enumerate(probs)}
    return {k: interpolate(v) for k, v in order_stats(df, cols, probs).items()}


def quantiles(df: DataFrame, cols: list[str], probs: list[float] = (0.25, 0.5, 0.75),
              exact: bool = True) -> DataFrame:
    """A5 as a table: (column, quantile, value)."""
    vals = quantile_values(df, list(cols), list(probs), exact)
    rows = [(c, float(p), None if v is None else float(v)) for (c, p), v in vals.items()]
    return df.sparkSession.createDataFrame(rows, "column string, quantile double, value double") \
        .select("column", "quantile", r6("value").alias("value"))


def mode_values(df: DataFrame, cols: list[str], default: str | None = "Unknown") -> dict:
    """{column: most frequent value}; ties -> smallest value; no values -> default.

    (column, value) counts are pre-aggregated before the shuffle; the winner
    per column is a ``min_by`` with a one-row buffer, so no value map is held.
    """
    if not cols:
        return {}
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    counts = (df.select(F.explode(F.array(*pairs)).alias("s")).select("s.*")
                .where(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("mode"))
    got = {r["column"]: r["mode"] for r in best.collect()}
    return {c: got.get(c, default) for c in cols}


def modes(df: DataFrame, cols: list[str], default: str = "Unknown") -> DataFrame:
    """A6 as a table: (column, mode)."""
    vals = mode_values(df, cols, default)
    return df.sparkSession.createDataFrame(list(vals.items()), "column string, mode string")


def extremes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, min_value, max_value) in one pass."""
    agg = df.agg(*[F.struct(F.lit(c).alias("column"), F.min(clean_double(c)).alias("min_value"),
                            F.max(clean_double(c)).alias("max_value")).alias(f"__e{i}")
                   for i, c in enumerate(cols)])
    return agg.select(F.explode(F.array(*[F.col(f"__e{i}") for i in range(len(cols))])).alias("s")) \
        .select("s.column", r6("s.min_value").alias("min_value"), r6("s.max_value").alias("max_value"))


def inf_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, n_inf, n_nan) over numeric columns, one pass."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if kind_of(f.dataType) == "numeric"]
    agg = df.agg(*[F.struct(F.lit(c).alias("column"),
                            F.count_if(F.abs(F.col(c).cast("double")) == float("inf")).alias("n_inf"),
                            F.count_if(F.isnan(F.col(c).cast("double"))).alias("n_nan")).alias(f"__i{i}")
                   for i, c in enumerate(cols)])
    return agg.select(F.explode(F.array(*[F.col(f"__i{i}") for i in range(len(cols))])).alias("s")) \
        .select("s.column", "s.n_inf", "s.n_nan")


def min_class_check(df: DataFrame, target: str, test_size: float = 0.2) -> DataFrame:
    """N, minority class size, required size int(n * test_size * 0.5), warn flag."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("c"))
    return counts.agg(F.sum("c").cast("long").alias("n"), F.min("c").alias("min_class_count"),
                      F.count(F.lit(1)).alias("n_classes")) \
        .withColumn("required_min_count", F.floor(F.col("n") * F.lit(test_size) * 0.5).cast("long")) \
        .withColumn("warn", F.col("min_class_count") < F.col("required_min_count"))


def summary(df: DataFrame, target: str | None = "churned") -> DataFrame:
    """A10: rows, columns, missing cells and target rate in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *summary_aggregates(df, target)).withColumn("n_columns", F.lit(len(df.columns)))


def summary_aggregates(df: DataFrame, target: str | None = "churned") -> list[Column]:
    """A10's aggregates besides the row count, which a write job can observe."""
    aggs = [(sum(F.count_if(is_missing(df, c)) for c in df.columns)).alias("n_missing")]
    if target and target in df.columns:
        aggs.append(r6(F.avg(clean_double(target))).alias("target_rate"))
    return aggs
