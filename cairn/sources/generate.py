"""Seeded synthetic customers.

Every value is a function of (seed, key, column) through md5, so output
does not depend on partitioning or task retries, and SQL can reproduce it.
Keys come from ``spark.range(n)`` or from an existing key frame.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.functions.columns import hash_uniform, r6

# The region labels of the generated customers.
REGIONS = ("North", "South", "East", "West", "Central")
DATE_BASE = "2020-01-01"
SEED = 42


def with_random_choice(df: DataFrame, key: str, col: str, values=REGIONS, seed: int = SEED) -> DataFrame:
    """Uniform choice among ``values``."""
    u = hash_uniform(seed, key, col)
    idx = F.least(F.floor(u * len(values)).cast("int"), F.lit(len(values) - 1)) + 1
    return df.withColumn(col, F.element_at(F.array(*[F.lit(v) for v in values]), idx))


def with_random_date(df: DataFrame, key: str, col: str, base: str = DATE_BASE, as_of: str = "2024-01-01",
                     seed: int = SEED) -> DataFrame:
    """Uniform date in [base, as_of) formatted yyyy-MM-dd."""
    span = F.datediff(F.lit(as_of).cast("date"), F.lit(base).cast("date"))
    days = F.floor(hash_uniform(seed, key, col) * span).cast("int")
    return df.withColumn(col, F.date_format(F.date_add(F.lit(base).cast("date"), days), "yyyy-MM-dd"))


def generate_customers(spark: SparkSession, n: int | None = None, positive_rate: float = 0.12,
                       seed: int = SEED, keys: DataFrame | None = None, key: str = "customer_id",
                       as_of: str = "2024-01-01") -> DataFrame:
    """G1: customers with spend, sessions, tickets, churn label (u < rate),
    age, region and account creation date."""
    base = keys.select(F.col(keys.columns[0]).alias(key)) if keys is not None else \
        spark.range(n).select(F.col("id").alias(key))
    u = lambda c: hash_uniform(seed, key, c)
    df = base.select(
        key,
        F.round(F.lit(10.0) + u("monthly_spend") * 490.0, 2).alias("monthly_spend"),
        (F.floor(u("sessions_per_month") * 60) + 1).cast("int").alias("sessions_per_month"),
        F.floor(u("support_tickets_last_month") * 6).cast("int").alias("support_tickets_last_month"),
        (u("churned") < positive_rate).cast("int").alias("churned"),
        (F.floor(u("age") * 63) + 18).cast("int").alias("age"))
    return with_random_date(with_random_choice(df, key, "region", REGIONS, seed),
                            key, "account_created_date", DATE_BASE, as_of, seed)


# Weights of the label's logit on the features, each scaled to about [0, 1].
LOGIT = {"monthly_spend": -2.0, "sessions_per_month": -4.0, "support_tickets_last_month": 5.0, "age": -1.0}


def generate_labelled(spark: SparkSession, n: int | None = None, positive_rate: float = 0.12, seed: int = SEED, keys: DataFrame | None = None,
                      key: str = "customer_id", as_of: str = "2024-01-01", noise: float = 1.0) -> DataFrame:
    """G1 with a label that can be learnt and an exact rate: ceil(n * positive_rate) rows are positive.

    Features come from inverse distribution functions of hashed uniforms: spend and sessions exponential, tickets geometric, age uniform.
    A row's score is a logit of its features plus ``noise`` times a logistic draw, rounded to 9 places; the label is 1 up to the k-th
    highest score (ties: the smaller key), found by distributed selection.  A NULL key raises."""
    from cairn.operators.ranking import kth_rows
    base = keys.select(F.col(keys.columns[0]).alias(key)) if keys is not None else spark.range(n).select(F.col("id").alias(key))
    if not base.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"NULL in key {key}")
    u = lambda c: hash_uniform(seed, key, c)
    late = lambda c: -F.ln(1 - u(c))
    df = base.select(key, F.round(F.least(10 + 90 * late("monthly_spend"), F.lit(500.0)), 2).alias("monthly_spend"),
                     F.least(F.floor(12 * late("sessions_per_month")) + 1, F.lit(60)).cast("int").alias("sessions_per_month"),
                     F.least(F.floor(1.5 * late("support_tickets_last_month")), F.lit(5)).cast("int").alias("support_tickets_last_month"),
                     (F.floor(u("age") * 63) + 18).cast("int").alias("age"))
    draw = (u("churned") * 4294967296.0 + 0.5) / 4294967296.0
    score = (LOGIT["monthly_spend"] * F.col("monthly_spend") / 500 + LOGIT["sessions_per_month"] * F.col("sessions_per_month") / 60
             + LOGIT["support_tickets_last_month"] * F.col("support_tickets_last_month") / 5 + LOGIT["age"] * F.col("age") / 81
             + noise * F.ln(draw / (1 - draw)))
    df = df.withColumn("__s", -F.round(score, 9))
    k = math.ceil(df.count() * positive_rate)
    cut = kth_rows(df.select(key, "__s"), [F.col("__s"), F.col(key)], {(): k}, []) if k else {}
    kind = dict(df.dtypes)[key]
    label = F.struct(F.col("__s").alias("s"), F.col(key).alias("k")) <= F.struct(F.lit(cut[()]["__s"]).alias("s"), F.lit(cut[()][key]).cast(kind).alias("k")) \
        if cut else F.lit(False)
    df = df.withColumn("churned", label.cast("int")).drop("__s")
    return with_random_date(with_random_choice(df, key, "region", REGIONS, seed), key, "account_created_date", DATE_BASE, as_of, seed)


# The two generated tables and their columns.
GROUPS = {
    "transactions": ["monthly_spend", "sessions_per_month", "support_tickets_last_month", "churned"],
    "demographics": ["age", "region", "account_created_date"],
}


def split_vertical(df: DataFrame, key: str = "customer_id", groups: dict | None = None) -> dict:
    """One keyed frame per column group (two ``select``s)."""
    return {name: df.select(key, *cols) for name, cols in (groups or GROUPS).items()}


def positive_rate(df: DataFrame, target: str = "churned") -> DataFrame:
    """Realised positive count and rate."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("long")).alias("n_positive"),
                  r6(F.avg(F.col(target).cast("double"))).alias("positive_rate"))
