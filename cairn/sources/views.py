"""Stand-in feature views derived from the driver tables.

The pipeline expects two customer-keyed inputs (transactions, demographics).
They are derived here from orders / customer / nation / region with plain
aggregations and joins, so their size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.sources.tables import load

# Fixed parameters of the stand-in views.
MONTHS_IN_RANGE = 80              # calendar months covered by o_orderdate
CHURN_CUTOFF = "2001-01-01"       # last order before this date -> churned
URGENT = "1-URGENT"
AGE_BASE, AGE_MOD = 10, 97
CREATED_BASE, CREATED_STEP, CREATED_SPAN = "1995-01-01", 37, 2400
AS_OF = "2001-08-01"              # reference date for account age


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer with orders: spend, activity, urgent orders, churn label."""
    o = load(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("customer_id"))
             .agg((F.round(F.sum("o_totalprice"), 2) / MONTHS_IN_RANGE).alias("monthly_spend"),
                  (F.count(F.lit(1)) / MONTHS_IN_RANGE).alias("sessions_per_month"),
                  F.count_if(F.col("o_orderpriority") == URGENT).alias("support_tickets_last_month"),
                  (F.max("o_orderdate") < F.lit(CHURN_CUTOFF).cast("timestamp_ntz"))
                  .cast("int").alias("churned")))


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer join nation join region: age, region name, creation date string."""
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed-size dimensions: no hint, the
    # planner broadcasts them from their file-size statistics under
    # spark.sql.autoBroadcastJoinThreshold (a checked bound) and falls back otherwise
    cnr = (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, F.col("n_regionkey") == r.r_regionkey))
    created = F.date_add(F.lit(CREATED_BASE).cast("date"),
                         ((F.col("c_custkey") * CREATED_STEP) % CREATED_SPAN).cast("int"))
    return cnr.select(F.col("c_custkey").alias("customer_id"),
                      (F.lit(AGE_BASE) + F.col("c_custkey") % AGE_MOD).alias("age"),
                      F.col("r_name").alias("region"),
                      F.date_format(created, "yyyy-MM-dd").alias("account_created_date"))


def sparse_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer left join per-user event aggregates: NULLs for most customers."""
    c = load(spark, sf_dir, "customer")
    e = load(spark, sf_dir, "events")
    per_user = (e.groupBy("user_id")
                 .agg(F.count(F.lit(1)).alias("n_events"),
                      F.round(F.sum("value"), 6).alias("total_value"),
                      F.mode("event_type", deterministic=True).alias("top_event_type")))
    return (c.join(per_user, c.c_custkey == per_user.user_id, "left")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("c_acctbal").alias("acctbal"),
                     F.col("c_mktsegment").alias("segment"),
                     "n_events", "total_value", "top_event_type"))


def labelled_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, label, score, prediction) from lineitem, with many tied scores.

    label = returned item; score mixes the discount (0..10 cents) with half of
    the label, so it carries signal and only 21 distinct values.
    """
    li = load(spark, sf_dir, "lineitem")
    label = (F.col("l_returnflag") == "R").cast("int")
    disc = F.round(F.col("l_discount") * 100).cast("int")
    score = (disc + 10 * label * (F.col("l_linenumber") % 2)) / F.lit(20.0)
    return (li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
                      label.alias("label"), score.alias("score"))
              .withColumn("prediction", (F.col("score") >= 0.5).cast("int")))
