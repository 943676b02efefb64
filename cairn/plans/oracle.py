"""Independent SQL (DuckDB dialect) for the registered queries.

The CTE blocks restate the stand-in views and pipeline steps in plain SQL
over the driver tables; each oracle text is ``WITH <blocks> <final select>``.
Values are rounded to 6 places wherever the Spark side rounds.
"""

from __future__ import annotations

from cairn.plans import boost_sql

# --- stand-in views --------------------------------------------------------
TRANS = """trans AS (
  SELECT o_custkey AS customer_id,
         round(sum(o_totalprice), 2) / 80 AS monthly_spend,
         count(*) / 80 AS sessions_per_month,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS support_tickets_last_month,
         CAST(max(o_orderdate) < TIMESTAMP '2001-01-01' AS INTEGER) AS churned
  FROM orders GROUP BY o_custkey)"""

DEMO = """demo AS (
  SELECT c_custkey AS customer_id, 10 + c_custkey % 97 AS age, r_name AS region,
         strftime(DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INTEGER), '%Y-%m-%d')
           AS account_created_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

JOINED = """joined AS (
  SELECT t.customer_id, t.monthly_spend, t.sessions_per_month, t.support_tickets_last_month, t.churned,
         d.age, d.region, d.account_created_date
  FROM trans t JOIN demo d ON t.customer_id = d.customer_id)"""

SPARSE = """per_user AS (
  SELECT user_id, count(*) AS n_events, round(sum(value), 6) AS total_value,
         min(event_type) FILTER (WHERE rk = 1) AS top_event_type
  FROM (SELECT user_id, value, event_type,
               rank() OVER (PARTITION BY user_id ORDER BY cnt DESC, event_type) AS rk
        FROM (SELECT user_id, value, event_type,
                     count(*) OVER (PARTITION BY user_id, event_type) AS cnt FROM events))
  GROUP BY user_id),
sparse AS (
  SELECT c_custkey AS customer_id, c_acctbal AS acctbal, c_mktsegment AS segment,
         n_events, total_value, top_event_type
  FROM customer LEFT JOIN per_user ON c_custkey = user_id)"""

SCORES = """scores AS (
  SELECT l_orderkey * 10 + l_linenumber AS item_id,
         CAST(l_returnflag = 'R' AS INTEGER) AS label,
         (CAST(round(l_discount * 100) AS INTEGER)
          + 10 * CAST(l_returnflag = 'R' AS INTEGER) * (l_linenumber % 2)) / 20.0 AS score
  FROM lineitem),
scored AS (SELECT item_id, label, score, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scores)"""

# --- preprocess step (C3 -> C4 -> C5 -> F1-F3 -> F4 -> F5-F8) ---------------
CAP = """q AS (
  SELECT quantile_cont(monthly_spend, 0.25) AS s1, quantile_cont(monthly_spend, 0.75) AS s3,
         quantile_cont(age, 0.25) AS a1, quantile_cont(age, 0.75) AS a3,
         quantile_cont(sessions_per_month, 0.25) AS e1, quantile_cont(sessions_per_month, 0.75) AS e3
  FROM joined),
b AS (
  SELECT s1 - 1.5 * (s3 - s1) AS slo, s3 + 1.5 * (s3 - s1) AS shi,
         a1 - 1.5 * (a3 - a1) AS alo, a3 + 1.5 * (a3 - a1) AS ahi,
         e1 - 1.5 * (e3 - e1) AS elo, e3 + 1.5 * (e3 - e1) AS ehi FROM q),
capped AS (
  SELECT j.customer_id,
         greatest(least(CAST(j.monthly_spend AS DOUBLE), shi), slo) AS monthly_spend_c,
         greatest(least(CAST(j.sessions_per_month AS DOUBLE), ehi), elo) AS sessions_per_month,
         j.support_tickets_last_month, j.churned,
         greatest(least(CAST(j.age AS DOUBLE), ahi), alo) AS age_c,
         j.region, j.account_created_date
  FROM joined j, b),
clamped AS (
  SELECT customer_id,
         CASE WHEN monthly_spend_c < 0 THEN 0.0 ELSE monthly_spend_c END AS monthly_spend,
         sessions_per_month, support_tickets_last_month, churned,
         CASE WHEN age_c < 18 THEN 18.0 WHEN age_c > 100 THEN 100.0 ELSE age_c END AS age,
         region, account_created_date
  FROM capped),
thr AS (
  SELECT quantile_cont(monthly_spend, 0.75) AS hv, quantile_cont(sessions_per_month, 0.25) AS le
  FROM clamped),
pre AS (
  SELECT c.customer_id, c.monthly_spend, c.sessions_per_month, c.support_tickets_last_month, c.churned,
         c.age, c.region, CAST(c.account_created_date AS DATE) AS account_created_date,
         CAST(c.monthly_spend >= hv AS INTEGER) AS is_high_value,
         CAST(c.support_tickets_last_month > 2 AS INTEGER) AS is_high_support,
         CAST(c.sessions_per_month <= le AS INTEGER) AS is_low_engagement,
         coalesce(c.region = 'AFRICA', false) AS "region_AFRICA",
         coalesce(c.region = 'AMERICA', false) AS "region_AMERICA",
         coalesce(c.region = 'ASIA', false) AS "region_ASIA",
         coalesce(c.region = 'EUROPE', false) AS "region_EUROPE",
         coalesce(c.region = 'MIDDLE EAST', false) AS "region_MIDDLE EAST",
         CAST(DATE '2001-08-01' - CAST(c.account_created_date AS DATE) AS INTEGER) AS account_age_days
  FROM clamped c, thr),
pre2 AS (
  SELECT *, account_age_days / 365.25 AS account_age_years FROM pre),
prep AS (
  SELECT *, CASE WHEN account_age_years IS NULL OR account_age_years <= 0 THEN NULL
                 WHEN account_age_years <= 1 THEN 'New' WHEN account_age_years <= 3 THEN 'Young'
                 WHEN account_age_years <= 5 THEN 'Mature' ELSE 'Veteran' END AS account_age_bucket
  FROM pre2)"""

PRE_BLOCKS = [TRANS, DEMO, JOINED, CAP]


def with_blocks(blocks, final: str) -> str:
    return "WITH " + ",\n".join(blocks) + "\n" + final


REGION_PROFILE = with_blocks(PRE_BLOCKS, """
SELECT region, count(*) AS n_customers, round(avg(churned), 6) AS churn_rate,
       round(avg(is_high_value), 6) AS high_value_rate, round(avg(is_high_support), 6) AS high_support_rate,
       round(avg(is_low_engagement), 6) AS low_engagement_rate,
       round(avg(monthly_spend), 6) AS avg_monthly_spend, round(avg(age), 6) AS avg_age
FROM prep GROUP BY region""")

# --- engineer step (F9-F11, then numeric columns only) ----------------------
ENG = """mm AS (
  SELECT min(monthly_spend) AS mn_s, max(monthly_spend) AS mx_s,
         min(sessions_per_month) AS mn_e, max(sessions_per_month) AS mx_e,
         CAST(max(support_tickets_last_month) AS DOUBLE) AS mx_t FROM prep),
eng AS (
  SELECT customer_id, monthly_spend, sessions_per_month, support_tickets_last_month, churned, age,
         is_high_value, is_high_support, is_low_engagement,
         "region_AFRICA", "region_AMERICA", "region_ASIA", "region_EUROPE", "region_MIDDLE EAST",
         account_age_days, account_age_years,
         CASE WHEN sessions_per_month > 0 THEN monthly_spend / sessions_per_month ELSE CAST(0 AS DOUBLE) END
           AS spend_per_session,
         CASE WHEN mx_t > 0 THEN support_tickets_last_month / mx_t ELSE CAST(0 AS DOUBLE) END AS support_risk_score,
         ((CASE WHEN mx_s > mn_s THEN (monthly_spend - mn_s) / (mx_s - mn_s) ELSE 0 END)
          + (CASE WHEN mx_e > mn_e THEN (sessions_per_month - mn_e) / (mx_e - mn_e) ELSE 0 END)) / 2
           AS customer_value_tier
  FROM prep, mm)"""

ENG_BLOCKS = PRE_BLOCKS + [ENG]

# --- splits: largest-remainder class quotas, seeded md5 order -----------------
SPLIT = """keys AS (SELECT customer_id, churned FROM eng),
cc AS (SELECT churned, count(*) AS n FROM keys GROUP BY churned),
tot AS (SELECT sum(n) AS n_all, CAST(ceil(CAST(sum(n) AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_test FROM cc),
sh AS (SELECT churned, n * n_test / n_all AS share, floor(n * n_test / n_all) AS fl, n_test FROM cc, tot),
rk AS (SELECT churned, fl, n_test, row_number() OVER (ORDER BY share - fl DESC, churned) AS rr FROM sh),
quota AS (SELECT churned, fl + CASE WHEN rr <= n_test - (SELECT sum(fl) FROM sh) THEN 1 ELSE 0 END AS q FROM rk),
ranked AS (
  SELECT customer_id, churned,
         row_number() OVER (PARTITION BY churned ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id) AS r
  FROM keys),
splitk AS (
  SELECT r.customer_id, r.churned, CASE WHEN r.r <= q.q THEN 'test' ELSE 'train' END AS split
  FROM ranked r JOIN quota q ON r.churned = q.churned),
esplit AS (SELECT e.*, s.split FROM eng e JOIN splitk s ON e.customer_id = s.customer_id)"""

SPLIT_BLOCKS = ENG_BLOCKS + [SPLIT]


def _round_cols(cols):
    return ", ".join(f'round({c}, 6) AS {c}' for c in cols)


A5_COLS = ["monthly_spend", "sessions_per_month", "support_tickets_last_month", "age"]


def _quantile_union(cols, probs, src):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS quantile, "
        f"round(CAST(quantile_cont({c}, {p}) AS DOUBLE), 6) AS value FROM {src}"
        for c in cols for p in probs)


def _extremes_union(cols, src):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(CAST(min({c}) AS DOUBLE), 6) AS min_value, "
        f"round(CAST(max({c}) AS DOUBLE), 6) AS max_value FROM {src}" for c in cols)


def _nulls_union(cols, src):
    return "SELECT * FROM (" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS null_share FROM {src}"
        for c in cols) + ") WHERE null_count > 0"


def _mode_union(cols, src):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", coalesce((SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1), 'Unknown') AS mode" for c in cols)


SPARSE_COLS = ["customer_id", "acctbal", "segment", "n_events", "total_value", "top_event_type"]
TYPE_MAP = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
  WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(data_type) END"""
KIND_MAP = """CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT') THEN 'numeric'
  WHEN data_type = 'VARCHAR' THEN 'string' WHEN data_type = 'BOOLEAN' THEN 'bool' WHEN data_type = 'DATE' THEN 'date'
  WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE 'other' END"""

IQR_REPORT_FINAL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round({q1}, 6) AS q1, round({q3}, 6) AS q3, round({q3} - {q1}, 6) AS iqr, "
    f"round({lo}, 6) AS lower, round({hi}, 6) AS upper, "
    f"(SELECT count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) FROM joined) AS n_outliers FROM q, b"
    for c, q1, q3, lo, hi in [("monthly_spend", "s1", "s3", "slo", "shi"), ("age", "a1", "a3", "alo", "ahi"),
                              ("sessions_per_month", "e1", "e3", "elo", "ehi")])

FEATURE_COLS = ["monthly_spend", "sessions_per_month", "support_tickets_last_month", "age",
                "is_high_value", "is_high_support", "is_low_engagement",
                '"region_AFRICA"', '"region_AMERICA"', '"region_ASIA"', '"region_EUROPE"', '"region_MIDDLE EAST"',
                "account_age_days", "account_age_years", "spend_per_session", "support_risk_score",
                "customer_value_tier"]
DOUBLE_FEATURES = {"monthly_spend", "sessions_per_month", "age", "account_age_years", "spend_per_session",
                   "support_risk_score", "customer_value_tier"}

CLASS_REPORT = """c AS (
  SELECT CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn,
         CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp FROM scored),
m AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
            CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
            CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
            tp + fn AS s1, tn + fp AS s0, tn + fp + fn + tp AS n FROM c),
f AS (
  SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
            CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0 FROM m)"""

ROC_BASE = """h AS (
  SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(count(*) - sum(label) AS BIGINT) AS neg
  FROM scored GROUP BY score),
cs AS (
  SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
         sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps FROM h),
tt AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM h)"""

HIST = """rg AS (
  SELECT label, CASE WHEN max(score) > min(score) THEN min(score) ELSE min(score) - 0.5 END AS lo,
         CASE WHEN max(score) > min(score) THEN max(score) ELSE max(score) + 0.5 END AS hi
  FROM scored GROUP BY label),
hb AS (
  SELECT s.label, CAST(least(floor((s.score - rg.lo) * (CAST(30 AS DOUBLE) / (rg.hi - rg.lo))), 29) AS INTEGER) AS bin
  FROM scored s JOIN rg ON s.label = rg.label),
hc AS (SELECT label, bin, count(*) AS n FROM hb GROUP BY label, bin),
grid AS (SELECT rg.label, rg.lo, rg.hi, CAST(g.range AS INTEGER) AS bin FROM rg, range(30) g)"""

SQL = {
    "flagship_region_churn": REGION_PROFILE,
    "j1_customer_join": with_blocks([TRANS, DEMO, JOINED], "SELECT * FROM joined"),
    "j2_join_coverage": with_blocks([TRANS, DEMO, JOINED], """
SELECT l.left_keys, j.joined_keys, round(j.joined_keys / l.left_keys, 6) AS coverage,
       j.joined_keys / l.left_keys < 0.95 AS warn
FROM (SELECT count(DISTINCT customer_id) AS left_keys FROM trans) l,
     (SELECT count(DISTINCT customer_id) AS joined_keys FROM joined) j"""),
    "j3_key_overlap": with_blocks([TRANS], """
SELECT customer_id FROM trans WHERE churned = 1 INTERSECT SELECT user_id AS customer_id FROM events"""),
    "a1_null_summary": with_blocks([SPARSE], _nulls_union(SPARSE_COLS, "sparse")),
    "a2_type_report": f"""
SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS "column", {TYPE_MAP} AS type,
       {KIND_MAP} AS kind
FROM information_schema.columns WHERE table_name = 'orders'""",
    "a3_value_counts": with_blocks([TRANS, DEMO, JOINED], "SELECT region, count(*) AS n FROM joined GROUP BY region"),
    "a4_mean_rate": with_blocks([TRANS], "SELECT count(*) AS n, round(avg(churned), 6) AS churn_rate FROM trans"),
    "a5_quantiles": with_blocks([TRANS, DEMO, JOINED], _quantile_union(A5_COLS, [0.25, 0.5, 0.75], "joined")),
    "a6_modes": with_blocks([SPARSE], _mode_union(["segment", "top_event_type"], "sparse")),
    "a7_extremes": with_blocks([TRANS, DEMO, JOINED], _extremes_union(A5_COLS, "joined")),
    "a8_inf_counts": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE isinf({c})) AS n_inf, "
        f"count(*) FILTER (WHERE isnan({c})) AS n_nan FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "a9_min_class_check": with_blocks([TRANS], """
SELECT CAST(sum(c) AS BIGINT) AS n, min(c) AS min_class_count, count(*) AS n_classes,
       CAST(floor(sum(c) * CAST(0.2 AS DOUBLE) * 0.5) AS BIGINT) AS required_min_count,
       min(c) < CAST(floor(sum(c) * CAST(0.2 AS DOUBLE) * 0.5) AS BIGINT) AS warn
FROM (SELECT churned, count(*) AS c FROM trans GROUP BY churned)"""),
    "a10_summary": with_blocks(PRE_BLOCKS, """
SELECT count(*) AS n_rows,
       CAST(sum((customer_id IS NULL)::INT + (monthly_spend IS NULL)::INT + (sessions_per_month IS NULL)::INT
           + (support_tickets_last_month IS NULL)::INT + (churned IS NULL)::INT + (age IS NULL)::INT
           + (region IS NULL)::INT + (account_created_date IS NULL)::INT + (is_high_value IS NULL)::INT
           + (is_high_support IS NULL)::INT + (is_low_engagement IS NULL)::INT + (account_age_days IS NULL)::INT
           + (account_age_years IS NULL)::INT + (account_age_bucket IS NULL)::INT) AS BIGINT) AS n_missing,
       round(avg(churned), 6) AS target_rate, 19 AS n_columns
FROM prep"""),
    "c1_impute_median": with_blocks([SPARSE], """
SELECT customer_id, acctbal, segment,
       coalesce(CAST(n_events AS DOUBLE), (SELECT quantile_cont(n_events, 0.5) FROM sparse)) AS n_events,
       coalesce(total_value, (SELECT quantile_cont(total_value, 0.5) FROM sparse)) AS total_value,
       top_event_type
FROM sparse"""),
    "c2_impute_mode": with_blocks([SPARSE], """
SELECT customer_id, acctbal, segment, n_events, total_value,
       coalesce(top_event_type, (SELECT top_event_type FROM sparse WHERE top_event_type IS NOT NULL
                                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS top_event_type
FROM sparse"""),
    "c3_iqr_cap": with_blocks(PRE_BLOCKS, """
SELECT customer_id, monthly_spend_c AS monthly_spend, sessions_per_month, support_tickets_last_month, churned,
       age_c AS age, region, account_created_date FROM capped"""),
    "c3_iqr_report": with_blocks(PRE_BLOCKS, IQR_REPORT_FINAL),
    "c4_clamp_age": with_blocks(PRE_BLOCKS, """
SELECT customer_id, CASE WHEN age_c < 18 THEN 18.0 WHEN age_c > 100 THEN 100.0 ELSE age_c END AS age FROM capped"""),
    "c5_floor_balance": with_blocks([SPARSE], """
SELECT customer_id, CASE WHEN acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE acctbal END AS acctbal FROM sparse"""),
    "c6_finite_or": with_blocks([SPARSE], """
SELECT customer_id, coalesce(acctbal, 0) AS acctbal, coalesce(n_events, 0) AS n_events,
       coalesce(total_value, CAST(0 AS DOUBLE)) AS total_value FROM sparse"""),
    "f1_high_value": with_blocks(PRE_BLOCKS, "SELECT customer_id, monthly_spend, is_high_value FROM prep"),
    "f2_high_support": with_blocks([TRANS], """
SELECT customer_id, support_tickets_last_month, CAST(support_tickets_last_month > 2 AS INTEGER) AS is_high_support
FROM trans"""),
    "f3_low_engagement": with_blocks(PRE_BLOCKS, "SELECT customer_id, sessions_per_month, is_low_engagement FROM prep"),
    "f4_one_hot_region": with_blocks([DEMO], """
SELECT customer_id, region,
       coalesce(region = 'AFRICA', false) AS "region_AFRICA", coalesce(region = 'AMERICA', false) AS "region_AMERICA",
       coalesce(region = 'ASIA', false) AS "region_ASIA", coalesce(region = 'EUROPE', false) AS "region_EUROPE",
       coalesce(region = 'MIDDLE EAST', false) AS "region_MIDDLE EAST" FROM demo"""),
    "f5_parse_date": with_blocks([DEMO], "SELECT customer_id, CAST(account_created_date AS DATE) AS account_created_date FROM demo"),
    "f6_account_age_days": with_blocks([DEMO], """
SELECT customer_id, CAST(DATE '2001-08-01' - CAST(account_created_date AS DATE) AS INTEGER) AS account_age_days FROM demo"""),
    "f7_account_age_years": with_blocks([DEMO], """
SELECT customer_id,
       round(CAST(DATE '2001-08-01' - CAST(account_created_date AS DATE) AS INTEGER) / CAST(365.25 AS DOUBLE), 6)
         AS account_age_years FROM demo"""),
    "f8_account_age_bucket": with_blocks([DEMO], """
SELECT customer_id, CASE WHEN y IS NULL OR y <= 0 THEN NULL WHEN y <= 1 THEN 'New' WHEN y <= 3 THEN 'Young'
                         WHEN y <= 5 THEN 'Mature' ELSE 'Veteran' END AS account_age_bucket
FROM (SELECT customer_id, CAST(DATE '2001-08-01' - CAST(account_created_date AS DATE) AS INTEGER)
             / CAST(365.25 AS DOUBLE) AS y FROM demo)"""),
    "f9_spend_per_session": with_blocks(ENG_BLOCKS, "SELECT customer_id, round(spend_per_session, 6) AS spend_per_session FROM eng"),
    "f10_support_risk_score": with_blocks(ENG_BLOCKS, "SELECT customer_id, round(support_risk_score, 6) AS support_risk_score FROM eng"),
    "f11_customer_value_tier": with_blocks(ENG_BLOCKS, "SELECT customer_id, round(customer_value_tier, 6) AS customer_value_tier FROM eng"),
    "f12_label_encode": with_blocks([TRANS], """
SELECT customer_id, CAST(dense_rank() OVER (ORDER BY CAST(customer_id AS VARCHAR)) - 1 AS BIGINT) AS customer_id_encoded
FROM trans"""),
    "f13_date_parse_failures": with_blocks([DEMO], """
SELECT count(*) FILTER (WHERE account_created_date IS NOT NULL AND try_cast(account_created_date AS DATE) IS NULL)
         AS n_unparsable, count(account_created_date) AS n_values FROM demo"""),
    "p1_feature_columns": with_blocks(ENG_BLOCKS, "SELECT customer_id, " + ", ".join(
        f"round({c}, 6) AS {c}" if c in DOUBLE_FEATURES else c for c in FEATURE_COLS) + " FROM eng"),
    "p2_columns_of_kind": with_blocks([TRANS, DEMO, JOINED], """
SELECT customer_id, monthly_spend, sessions_per_month, support_tickets_last_month, churned, age FROM joined"""),
    "p3_drop_non_numeric": with_blocks([TRANS, DEMO, JOINED], """
SELECT customer_id, monthly_spend, sessions_per_month, support_tickets_last_month, churned, age FROM joined"""),
    "p4_count_outside": with_blocks([TRANS, DEMO, JOINED],
                                    "SELECT count(*) FILTER (WHERE age < 18 OR age > 100) AS n_invalid_age FROM joined"),
    "p5_set_where": with_blocks([DEMO], "SELECT customer_id, CASE WHEN age < 18 THEN 18 ELSE age END AS age FROM demo"),
    "p6_require_columns": with_blocks([TRANS], "SELECT customer_id, churned FROM trans"),
    "o1_sort_desc": with_blocks([TRANS], "SELECT customer_id, monthly_spend FROM trans ORDER BY monthly_spend DESC, customer_id"),
    "o2_top_k": with_blocks([TRANS], """
SELECT customer_id, monthly_spend FROM trans ORDER BY monthly_spend DESC, customer_id LIMIT 10"""),
    "o3_common_keys": with_blocks([TRANS, SPARSE], """
SELECT customer_id FROM trans WHERE churned = 1
INTERSECT SELECT customer_id FROM sparse WHERE n_events IS NOT NULL"""),
    "o4_concat_columns": with_blocks([DEMO, SPARSE], """
SELECT d.customer_id, d.age, d.region, s.segment, s.n_events
FROM demo d LEFT JOIN sparse s ON d.customer_id = s.customer_id"""),
    "t1_stratified_split": with_blocks(SPLIT_BLOCKS, "SELECT customer_id, churned, split FROM splitk"),
    "t2_random_split": with_blocks(ENG_BLOCKS, """
SELECT customer_id,
       CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id)
                 <= (SELECT ceil(CAST(count(*) AS DOUBLE) * CAST(0.2 AS DOUBLE)) FROM eng)
            THEN 'test' ELSE 'train' END AS split FROM eng"""),
    "t4_balance_report": with_blocks(SPLIT_BLOCKS, """
SELECT round(tr, 6) AS train_rate, round(te, 6) AS test_rate, round(al, 6) AS overall_rate,
       round(abs(tr - te), 6) AS rate_diff, abs(tr - te) > 0.02 AS warn
FROM (SELECT avg(churned) FILTER (WHERE split = 'train') AS tr, avg(churned) FILTER (WHERE split = 'test') AS te,
             avg(churned) AS al FROM esplit)"""),
    "t5_drift_report": with_blocks(SPLIT_BLOCKS, "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS feature, round(tr, 6) AS train_mean, round(te, 6) AS test_mean,
       round(CASE WHEN tr <> 0 THEN abs(tr - te) / abs(tr) END, 6) AS relative_diff,
       coalesce(CASE WHEN tr <> 0 THEN abs(tr - te) / abs(tr) END > 0.1, false) AS warn
FROM (SELECT avg(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'train') AS tr,
             avg(CAST({c} AS DOUBLE)) FILTER (WHERE split = 'test') AS te FROM esplit)"""
        for c in ["monthly_spend", "sessions_per_month", "support_tickets_last_month", "age", "is_high_value"])),
    "t6_leakage_check": with_blocks(SPLIT_BLOCKS, """
SELECT count(*) AS n_overlap, count(*) > 0 AS leakage FROM (
  SELECT customer_id FROM esplit WHERE split = 'train' INTERSECT SELECT customer_id FROM esplit WHERE split = 'test')"""),
    "t7_split_summary": with_blocks(SPLIT_BLOCKS, """
SELECT split, count(*) AS n, round(count(*) / (SELECT count(*) FROM esplit), 6) AS share FROM esplit GROUP BY split"""),
    "m3_assign_folds": with_blocks(ENG_BLOCKS, """
SELECT customer_id, churned,
       CAST(ceil(row_number() OVER (PARTITION BY churned ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id)
                 * 5 / count(*) OVER (PARTITION BY churned)) - 1 AS INTEGER) AS fold FROM eng"""),
    "e1_confusion": with_blocks([SCORES], """
SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
FROM scored"""),
    "e2_e4_basic_metrics": with_blocks([SCORES, CLASS_REPORT], """
SELECT round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, 6) AS accuracy, round(p1, 6) AS precision,
       round(r1, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score,
       round(r0, 6) AS specificity, round(CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END, 6) AS false_positive_rate,
       round(CASE WHEN fn + tp > 0 THEN fn / (fn + tp) ELSE 0 END, 6) AS false_negative_rate FROM m"""),
    "e5_roc_auc": with_blocks([SCORES], """
h AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) - sum(label) AS DOUBLE) AS neg FROM scored GROUP BY score),
c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cneg FROM h)
SELECT round(sum(pos * (cneg - 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c""".replace("\nh AS", ", h AS", 1)),
    "e6_class_report": with_blocks([SCORES, CLASS_REPORT], """
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM f"""),
    "e7_roc_curve": with_blocks([SCORES, ROC_BASE, """cs2 AS (
  SELECT score, tps, fps, row_number() OVER (ORDER BY score DESC) AS i, count(*) OVER () AS m,
         lag(tps) OVER (ORDER BY score DESC) AS tps_p, lead(tps) OVER (ORDER BY score DESC) AS tps_n,
         lag(fps) OVER (ORDER BY score DESC) AS fps_p, lead(fps) OVER (ORDER BY score DESC) AS fps_n FROM cs)"""], """
SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL
SELECT CAST(score AS DOUBLE), round(fps / N, 6), round(tps / P, 6) FROM cs2, tt
WHERE i = 1 OR i = m OR fps_n - 2 * fps + fps_p <> 0 OR tps_n - 2 * tps + tps_p <> 0"""),
    "e8_pr_curve": with_blocks([SCORES, ROC_BASE], """
SELECT CAST(score AS DOUBLE) AS threshold, round(CASE WHEN tps + fps > 0 THEN tps / (tps + fps) ELSE 0 END, 6) AS precision,
       round(tps / P, 6) AS recall, round(P / (P + N), 6) AS baseline FROM cs, tt
UNION ALL
SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), round(P / (P + N), 6) FROM tt"""),
    "e9_score_histogram": with_blocks([SCORES, HIST], """
SELECT g.label, g.bin, round(g.lo + g.bin * ((g.hi - g.lo) / 30), 6) AS bin_start,
       round(g.lo + (g.bin + 1) * ((g.hi - g.lo) / 30), 6) AS bin_end, CAST(coalesce(hc.n, 0) AS BIGINT) AS n
FROM grid g LEFT JOIN hc ON g.label = hc.label AND g.bin = hc.bin"""),
    "e10_sample_rows": with_blocks([SCORES], """
SELECT * FROM scored ORDER BY md5('42:' || CAST(item_id AS VARCHAR)), item_id LIMIT 100"""),
    "e12_predictions": with_blocks([SCORES], """
SELECT item_id, label AS actual_churn, prediction AS predicted_churn, score AS churn_probability,
       label = prediction AS correct_prediction FROM scored"""),
    "e13_predicted_rate": with_blocks([SCORES], "SELECT count(*) AS n, round(avg(prediction), 6) AS predicted_rate FROM scored"),
}


def _u(col: str, key: str = "c_custkey") -> str:
    return (f"(CAST(('0x' || substr(md5('42:{col}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" / CAST(4294967296 AS DOUBLE))")


GEN = f"""gen AS (
  SELECT c_custkey AS customer_id,
         round(10.0 + {_u('monthly_spend')} * 490.0, 2) AS monthly_spend,
         CAST(floor({_u('sessions_per_month')} * 60) + 1 AS INTEGER) AS sessions_per_month,
         CAST(floor({_u('support_tickets_last_month')} * 6) AS INTEGER) AS support_tickets_last_month,
         CAST({_u('churned')} < 0.12 AS INTEGER) AS churned,
         CAST(floor({_u('age')} * 63) + 18 AS INTEGER) AS age,
         (['North', 'South', 'East', 'West', 'Central'])[CAST(least(floor({_u('region')} * 5), 4) AS INTEGER) + 1]
           AS region,
         strftime(DATE '2020-01-01' + CAST(floor({_u('account_created_date')}
                  * (DATE '2024-01-01' - DATE '2020-01-01')) AS INTEGER), '%Y-%m-%d') AS account_created_date
  FROM customer)"""

S13_FINAL = """SELECT c.c_mktsegment AS segment, count(*) AS n_orders, round(avg(o.o_totalprice), 6) AS avg_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice > 100000.0 GROUP BY c.c_mktsegment"""

SQL.update({
    "g1_generate_customers": with_blocks([GEN], "SELECT * FROM gen"),
    "g2_split_vertical": with_blocks([GEN], "SELECT customer_id, age, region, account_created_date FROM gen"),
    "g3_random_choice": with_blocks([GEN], "SELECT customer_id, region FROM gen"),
    "g4_random_date": with_blocks([GEN], "SELECT customer_id, account_created_date FROM gen"),
    "g5_positive_rate": with_blocks([GEN], """
SELECT count(*) AS n, CAST(sum(churned) AS BIGINT) AS n_positive, round(avg(churned), 6) AS positive_rate FROM gen"""),
    "s1_s2_csv_roundtrip": with_blocks([TRANS], "SELECT * FROM trans"),
    "s3_s4_view_roundtrip": with_blocks([DEMO], "SELECT * FROM demo"),
    "s12_predictions_sink": SQL["e12_predictions"],
    "s13_run_sql": S13_FINAL,
    "m1_assemble": with_blocks(ENG_BLOCKS, "SELECT customer_id, [" + ", ".join(
        f"round(CAST({c} AS DOUBLE), 6)" for c in FEATURE_COLS) + "] AS features FROM eng"),
})


_BASIC = SQL["e2_e4_basic_metrics"]
SQL.update({
    "e2_accuracy": f"SELECT accuracy FROM ({_BASIC})",
    "e3_precision_recall_f1": f"SELECT precision, recall, f1_score FROM ({_BASIC})",
    "e4_specificity_fpr_fnr": f"SELECT specificity, false_positive_rate, false_negative_rate FROM ({_BASIC})",
    "t3_split_fallback": """
SELECT c_custkey AS customer_id,
       CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey)
                 <= (SELECT ceil(CAST(count(*) AS DOUBLE) * CAST(0.2 AS DOUBLE)) FROM customer)
            THEN 'test' ELSE 'train' END AS split FROM customer""",
})

SQL.update({
    "t5_drift_summary": f"""
SELECT round(avg(relative_diff), 6) AS avg_relative_diff, count(relative_diff) AS n_checked,
       round(avg(relative_diff), 6) < 0.05 AS consistent
FROM ({SQL["t5_drift_report"]})""",
    "s11_log_metrics": f"""
SELECT 'score_model' AS model, 'v1' AS version, metric, value FROM (
  UNPIVOT ({_BASIC}) ON accuracy, precision, recall, f1_score, specificity, false_positive_rate, false_negative_rate
  INTO NAME metric VALUE value)""",
})


# --- facts that any right model, registry or record has -----------------------
_METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
_N_FEATURES = len(FEATURE_COLS) - sum(c in ("customer_id", "churned") for c in FEATURE_COLS)


def _rows(values: str, names: str) -> str:
    return f"(VALUES {values}) t({names})"


def _scored_rows(part: str) -> str:
    return with_blocks(SPLIT_BLOCKS, f"""
SELECT customer_id, churned, true AS probability_ok, true AS label_ok FROM esplit WHERE split = '{part}'""")


_METRIC_ROWS = _rows(", ".join(f"('{m}')" for m in _METRICS), "metric")
_FEATURE_ROWS = _rows(", ".join(f"('{c}')" for c in (x.strip('"') for x in FEATURE_COLS) if c not in ("customer_id", "churned")), "feature")
_N_TEST = "(SELECT count(*) FROM esplit WHERE split = 'test')"
_N_TRAIN = "(SELECT count(*) FROM esplit WHERE split = 'train')"
_ASKED = _rows("('customer_transactions', 'None', 'v9'), ('customer_transactions', 'current', 'v9'), "
               "('customer_transactions', 'latest', 'v10'), ('customer_demographics', 'latest', 'v2'), "
               "('customer_demographics', 'v1', 'v1')", "name, requested, resolved")
_COUNTS = """n AS (SELECT 'customer_transactions' AS name, count(*) AS n_rows FROM trans
  UNION ALL SELECT 'customer_demographics', count(*) FROM demo)"""
_A10 = SQL["a10_summary"]

SQL.update({
    "s3_versions_differ": with_blocks([DEMO], """
SELECT customer_id, age, CAST(age AS VARCHAR) AS age_text, upper(region) AS extra FROM demo"""),
    "s5_resolve_version": with_blocks([TRANS, DEMO, _COUNTS], f"""
SELECT name, requested, resolved, n_rows FROM {_ASKED} JOIN n USING (name)"""),
    "s6_latest_versions": with_blocks([TRANS, DEMO, _COUNTS], """
SELECT 'view' AS kind, name, CASE WHEN name = 'customer_transactions' THEN 'v10' ELSE 'v2' END AS latest_version,
       CAST(2 AS BIGINT) AS n_versions, n_rows FROM n"""),
    "s7_find_view": with_blocks([TRANS], "SELECT *, 'customer_transactions' AS found FROM trans"),
    "s8_list_views": with_blocks([TRANS, DEMO, _COUNTS], """
SELECT 'view' AS kind, name, CASE WHEN name = 'customer_transactions' THEN 'v10' ELSE 'v2' END AS latest_version,
       CAST(2 AS BIGINT) AS n_versions,
       CASE WHEN name = 'customer_transactions' THEN 'latest transactions' ELSE '' END AS description, n_rows FROM n"""),
    "s9_run_record": f"""
SELECT 'preprocess' AS step, stat, value FROM (
  UNPIVOT (SELECT CAST(n_rows AS DOUBLE) AS n_rows, CAST(n_missing AS DOUBLE) AS n_missing,
                  CAST(target_rate AS DOUBLE) AS target_rate, CAST(n_columns AS DOUBLE) AS n_columns FROM ({_A10}))
  ON COLUMNS(*) INTO NAME stat VALUE value)""",
    "s10_model_roundtrip": with_blocks(SPLIT_BLOCKS, f"SELECT {_N_TEST} AS n_rows, CAST(0 AS BIGINT) AS n_different"),
    "m2_gbt_fit": _scored_rows("train"),
    "m5_score": _scored_rows("test"),
    "m3_many_classes": """
SELECT o_orderkey, cls, CAST(ceil(row_number() OVER (PARTITION BY cls ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey)
                                  * 5 / count(*) OVER (PARTITION BY cls)) - 1 AS INTEGER) AS fold
FROM (SELECT o_orderkey, nullif(o_custkey % 101, 0) AS cls FROM orders)""",
    "m4_cross_validate": with_blocks(SPLIT_BLOCKS, """
SELECT fold, count(*) AS n_held_out, true AS metrics_ok FROM (
  SELECT CAST(ceil(row_number() OVER (PARTITION BY churned ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id)
                   * 3 / count(*) OVER (PARTITION BY churned)) - 1 AS INTEGER) AS fold FROM esplit WHERE split = 'train')
GROUP BY fold"""),
    "m4_cv_summary": f"SELECT metric, CAST(3 AS INTEGER) AS n_folds, true AS mean_ok, true AS std_ok FROM {_METRIC_ROWS}",
    "m6_training_metrics": f"SELECT metric, true AS same FROM {_METRIC_ROWS}",
    "m7_importance": f"""
SELECT CAST({_N_FEATURES} AS BIGINT) AS n_features, CAST(1 AS DOUBLE) AS total, CAST(0 AS BIGINT) AS n_negative, true AS sorted""",
    "m8_training_record": with_blocks(SPLIT_BLOCKS, f"""
SELECT 'gbt_churn_model' AS model_name, 'v1' AS model_version, {_N_TRAIN} AS training_samples,
       CAST({_N_FEATURES} AS INTEGER) AS feature_count, 'churned' AS target_column, CAST(3 AS INTEGER) AS cv_folds,
       CAST(5 AS INTEGER) AS n_cv_metrics, CAST(5 AS INTEGER) AS n_metrics, CAST({_N_FEATURES} AS INTEGER) AS n_feature_columns,
       true AS timed"""),
    "e11_permutation_attribution": f"SELECT feature, true AS in_range FROM {_FEATURE_ROWS}",
    "e11_tree_shap_attribution": f"SELECT feature, true AS same FROM {_FEATURE_ROWS}",
    "e11_tree_shap_values": with_blocks(SPLIT_BLOCKS, f"""
SELECT customer_id, CAST({_N_FEATURES} AS INTEGER) AS n_values, true AS additive FROM esplit WHERE split = 'test'"""),
    "e14_evaluation_record": with_blocks(SPLIT_BLOCKS, f"""
SELECT metric, true AS same, {_N_TEST} AS test_samples, CAST({_N_FEATURES} AS BIGINT) AS feature_count,
       least({_N_TEST}, 100) AS attribution_sample_size FROM {_METRIC_ROWS}"""),
    "pipeline_end_to_end": with_blocks([*SPLIT_BLOCKS, _COUNTS], f"""
SELECT name, 'v1' AS version, n_rows FROM n
UNION ALL SELECT 'preprocessed_customer_features', 'v1', count(*) FROM prep
UNION ALL SELECT 'engineered_customer_features', 'v1', count(*) FROM eng
UNION ALL SELECT 'train_customer_features', 'v1', {_N_TRAIN}
UNION ALL SELECT 'test_customer_features', 'v1', {_N_TEST}"""),
    "c_nan_preprocess": """
WITH e AS (SELECT user_id AS customer_id, CASE WHEN user_id % 7 <> 0 THEN round(sum(value), 6) END AS v FROM events GROUP BY user_id),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM e)
SELECT customer_id, round(coalesce(v, med), 6) AS spend,
       round(CASE WHEN v IS NOT NULL THEN least(greatest(greatest(least(v, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)), 0), 1000000) END, 6) AS raw,
       CAST(coalesce(v >= q3, false) AS INTEGER) AS is_high,
       round(CASE WHEN v > 0 THEN customer_id / v ELSE 0 END, 6) AS per_raw FROM e, q""",
})


# --- second-order boosting with trees of depth one ----------------------------
_STUMP_FEATURES = [c for c in FEATURE_COLS if c not in ("customer_id", "churned")]
_STUMP_ROUNDS, _STUMP_BINS, _STUMP_RATE = 4, 16, 0.5


def _stumps(models: list[tuple], *more: str) -> list[str]:
    return [*SPLIT_BLOCKS, *boost_sql.chain(_STUMP_FEATURES, models, _STUMP_ROUNDS, _STUMP_BINS), *more]


_ONE = [(0, -1, _STUMP_RATE, 1.0)]
_FOLDS = [(i, i, _STUMP_RATE, 1.0) for i in range(3)]
# The grid's combinations in order, three folds each: learning rate, then lambda.
_CELLS = [(lr, lam) for lr in (0.5, 0.1) for lam in (1.0, 20.0)]
_GRID = [(3 * c + i, i, lr, lam) for c, (lr, lam) in enumerate(_CELLS) for i in range(3)]
_CELL_PARAMS = "CASE m // 3 " + " ".join(
    f"""WHEN {c} THEN '{{"learning_rate": {lr}, "reg_lambda": {lam}}}'""" for c, (lr, lam) in enumerate(_CELLS)) + " END"
_FIVE = "accuracy, precision, recall, f1_score, roc_auc"

SQL.update({
    "m2_boosted_stumps": with_blocks(_stumps(_ONE), """
SELECT CAST(round AS INTEGER) AS round, feature, round(cut, 6) AS cut, round(gain, 6) AS gain, round(vl, 6) AS left_value, round(vr, 6) AS right_value,
       round(hl, 6) AS left_cover, round(hr, 6) AS right_cover FROM best"""),
    "m4_boosted_folds": with_blocks(_stumps(_FOLDS, *boost_sql.metrics("fold = left_out", "m")), f"""
SELECT CAST(m AS INTEGER) AS fold, {_FIVE} FROM found"""),
    "m4_grid_search": with_blocks(_stumps(_GRID, *boost_sql.metrics("fold = left_out", "m")), f"""
SELECT CAST(m // 3 AS INTEGER) AS cell, {_CELL_PARAMS} AS params, CAST(m % 3 AS INTEGER) AS fold, CAST({_STUMP_ROUNDS} AS INTEGER) AS rounds,
       CAST(NULL AS INTEGER) AS dropped_at, {_FIVE} FROM found"""),
    "m5_boosted_scores": with_blocks(_stumps(_ONE), """
SELECT customer_id, y AS churned, CAST(prob > 0.5 AS INTEGER) AS prediction, round(prob, 6) AS probability_1 FROM scores WHERE split = 'test'"""),
    "m6_boosted_metrics": with_blocks(_stumps(_ONE, *boost_sql.metrics("split = 'train'", "m")), f"SELECT {_FIVE} FROM found"),
    "m7_boosted_importance": with_blocks(_stumps(_ONE), """
SELECT feature, round(coalesce(share, 0), 6) AS importance FROM feature_names LEFT JOIN (
  SELECT feature, avg(gain) / sum(avg(gain)) OVER () AS share FROM best GROUP BY feature) USING (feature)"""),
    "e11_boosted_shap": with_blocks(_stumps(_ONE), """
SELECT e.customer_id, n.feature, round(coalesce(sum(CASE WHEN lb.b <= s.b THEN vl ELSE vr END - (hl * vl + hr * vr) / (hl + hr)), 0), 6) AS shap
FROM everyone e JOIN feature_names n ON split = 'test' LEFT JOIN best s ON s.f = n.f LEFT JOIN lb ON lb.customer_id = e.customer_id AND lb.f = n.f
GROUP BY e.customer_id, n.feature"""),
    "e14_boosted_metrics": with_blocks(_stumps(_ONE, *boost_sql.metrics("split = 'test'", "m")), """
SELECT metric, value FROM (UNPIVOT found ON accuracy, precision, recall, f1_score, roc_auc, specificity, false_positive_rate, false_negative_rate,
  tn, fp, fn, tp INTO NAME metric VALUE value)"""),
})

# --- joins, splits, CSV and generated labels -----------------------------------
_LINE = """CAST(customer_id AS VARCHAR) || ',' || CASE WHEN customer_id % 7 = 0 THEN 'n/a' ELSE CAST(CAST(round(monthly_spend * 100) AS BIGINT) AS VARCHAR) END
  || ',' || CAST(CAST(round(sessions_per_month * 80) AS BIGINT) AS VARCHAR) || ',' || CAST(support_tickets_last_month AS VARCHAR)
  || CASE WHEN customer_id % 11 = 0 THEN '' WHEN customer_id % 13 = 0 THEN ',' || CAST(churned AS VARCHAR) || ',x' ELSE ',' || CAST(churned AS VARCHAR) END"""
_DRAW = f"(({_u('churned')} * 4294967296.0 + 0.5) / 4294967296.0)"

SQL.update({
    "j1_hot_key_join": """
WITH li AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END AS k, l_quantity FROM lineitem),
o AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier UNION ALL SELECT 0, r_regionkey FROM region)
SELECT k, n, count(*) AS n_rows, round(sum(l_quantity), 6) AS quantity FROM li JOIN o USING (k) GROUP BY k, n""",
    "t1_split_two_columns": with_blocks(PRE_BLOCKS, """,
st AS (SELECT churned, region, count(*) AS n, row_number() OVER (ORDER BY churned, region) - 1 AS pos FROM prep GROUP BY churned, region),
tt AS (SELECT CAST(sum(n) AS BIGINT) AS n_all, CAST(ceil(CAST(sum(n) AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS n_test, count(*) AS m FROM st),
se AS (SELECT st.*, n_all, n_test, m, n * n_test // n_all AS fl, n * n_test % n_all AS r FROM st, tt),
ch AS (SELECT b, churned, region, pos, n, n_all, n_test, m, r, fl, fl + ((b >> pos) & 1) AS seats, (b >> pos) & 1 AS up
  FROM se, range(CAST(1 << (SELECT m FROM tt) AS BIGINT)) t(b)),
ok AS (SELECT b FROM ch GROUP BY b HAVING sum(seats) = any_value(n_test) AND count(*) FILTER (WHERE up = 1 AND r = 0) = 0
  EXCEPT SELECT b FROM (SELECT b, sum(seats) AS s, sum(n) * any_value(n_test) AS x, any_value(n_all) AS y FROM ch GROUP BY b, churned
    UNION ALL SELECT b, sum(seats), sum(n) * any_value(n_test), any_value(n_all) FROM ch GROUP BY b, region) WHERE s < x // y OR s > (x + y - 1) // y),
best AS (SELECT b FROM ch SEMI JOIN ok USING (b) GROUP BY b ORDER BY sum(up * ((CAST(r AS HUGEINT) << CAST(m AS INTEGER)) + (1 << (m - 1 - pos)))) DESC LIMIT 1),
q2 AS (SELECT churned, region, seats FROM ch SEMI JOIN best USING (b))
SELECT p.customer_id, p.churned, p.region, CASE WHEN row_number() OVER (PARTITION BY p.churned, p.region
  ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id) <= seats THEN 'test' ELSE 'train' END AS split
FROM prep p JOIN q2 ON p.churned = q2.churned AND p.region = q2.region""").replace("\n,\nst AS", ",\nst AS"),
    "s1_csv_good_rows": with_blocks([TRANS], """
SELECT customer_id, CAST(round(monthly_spend * 100) AS DOUBLE) AS monthly_spend, CAST(round(sessions_per_month * 80) AS DOUBLE) AS sessions_per_month,
       support_tickets_last_month, churned FROM trans WHERE customer_id % 7 > 0 AND customer_id % 11 > 0 AND customer_id % 13 > 0"""),
    "s1_csv_bad_rows": with_blocks([TRANS], f"""
SELECT {_LINE} AS line, CASE WHEN customer_id % 11 = 0 THEN '4 fields, not 5' WHEN customer_id % 13 = 0 THEN '6 fields, not 5'
  ELSE 'monthly_spend: n/a is no double' END AS reason FROM trans WHERE customer_id % 7 = 0 OR customer_id % 11 = 0 OR customer_id % 13 = 0"""),
    "s1_csv_inferred": with_blocks([DEMO], "SELECT customer_id, age, region, CAST(account_created_date AS DATE) AS account_created_date FROM demo"),
    "g1_labelled_customers": f"""
WITH v AS (SELECT c_custkey AS customer_id, round(least(10 - 90 * ln(1 - {_u('monthly_spend')}), 500.0), 2) AS monthly_spend,
  CAST(least(floor(-12 * ln(1 - {_u('sessions_per_month')})) + 1, 60) AS INTEGER) AS sessions_per_month,
  CAST(least(floor(-1.5 * ln(1 - {_u('support_tickets_last_month')})), 5) AS INTEGER) AS support_tickets_last_month,
  CAST(floor({_u('age')} * 63) + 18 AS INTEGER) AS age, ln({_DRAW} / (1 - {_DRAW})) AS noise,
  (['North', 'South', 'East', 'West', 'Central'])[CAST(least(floor({_u('region')} * 5), 4) AS INTEGER) + 1] AS region,
  strftime(DATE '2020-01-01' + CAST(floor({_u('account_created_date')} * (DATE '2024-01-01' - DATE '2020-01-01')) AS INTEGER), '%Y-%m-%d') AS account_created_date
  FROM customer),
s AS (SELECT *, round(-2.0 * monthly_spend / 500 - 4.0 * sessions_per_month / 60 + 5.0 * support_tickets_last_month / 5 - 1.0 * age / 81 + noise, 9) AS score FROM v)
SELECT customer_id, monthly_spend, sessions_per_month, support_tickets_last_month, age, CAST(row_number() OVER (ORDER BY score DESC, customer_id)
  <= ceil(count(*) OVER () * CAST(0.12 AS DOUBLE)) AS INTEGER) AS churned, region, account_created_date FROM s""",
})
