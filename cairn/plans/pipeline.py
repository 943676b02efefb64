"""Step composition: preprocess -> engineer -> split -> train -> evaluate.

Each step is a plain function of DataFrames; the lazy plan is the DAG.
Statistics a later expression needs are computed in as few passes as
possible and applied as literals.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from cairn.operators import clean, features as feat, joins, profile
from cairn.operators.select import drop_non_numeric
from cairn.session import shared_dir
from cairn.sources import views
from cairn.sources.tables import normalise_nan

log = logging.getLogger(__name__)

KEY, TARGET = "customer_id", "churned"
# Outlier-capped columns and validity ranges.
CAP_COLUMNS = ("monthly_spend", "age", "sessions_per_month")
AGE_RANGE = (18, 100)
HIGH_SUPPORT_TICKETS = 2


@dataclass
class PreprocessReport:
    coverage: DataFrame | None = None
    bounds: dict = field(default_factory=dict)
    thresholds: dict = field(default_factory=dict)


def cap_and_flag(df: DataFrame, report: PreprocessReport | None = None) -> DataFrame:
    """C3 -> C4 -> C5 -> F1-F3 with ONE exact quantile pass.

    Q1/Q3 of the capped columns and the flag thresholds (P75 spend, P25
    sessions, both measured after capping) sit at the same order-statistic
    positions; capping, clamping and flooring are non-decreasing maps, so
    the post-capping thresholds follow from the same neighbours."""
    cols = [c for c in CAP_COLUMNS if c in df.columns]
    stats = profile.order_stats(df, cols, [0.25, 0.75])
    bounds = {}
    for c in cols:
        q1, q3 = profile.interpolate(stats[(c, 0.25)]), profile.interpolate(stats[(c, 0.75)])
        if q1 is not None:
            bounds[c] = (q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    out = clean.cap_iqr(df, cols, bounds=bounds)
    if "age" in out.columns:
        out = clean.clamp(out, "age", *AGE_RANGE)
    if "monthly_spend" in out.columns:
        out = clean.floor_at(out, "monthly_spend", 0)

    def after(c):
        lo, hi = bounds[c][2], bounds[c][3]
        floor0 = c == "monthly_spend"
        return lambda v: max(min(max(v, lo), hi), 0.0) if floor0 else min(max(v, lo), hi)

    thr = {}
    if "monthly_spend" in bounds:
        thr["is_high_value"] = profile.interpolate(stats[("monthly_spend", 0.75)], after("monthly_spend"))
        out = feat.flag_ge_quantile(out, "monthly_spend", 0.75, "is_high_value", threshold=thr["is_high_value"])
    if "support_tickets_last_month" in out.columns:
        out = feat.flag_gt(out, "support_tickets_last_month", HIGH_SUPPORT_TICKETS, "is_high_support")
    if "sessions_per_month" in bounds:
        thr["is_low_engagement"] = profile.interpolate(stats[("sessions_per_month", 0.25)],
                                                       after("sessions_per_month"))
        out = feat.flag_le_quantile(out, "sessions_per_month", 0.25, "is_low_engagement",
                                    threshold=thr["is_low_engagement"])
    if report is not None:
        report.bounds, report.thresholds = bounds, thr
    return out


def preprocess(trans: DataFrame, demo: DataFrame, as_of: str = views.AS_OF,
               report: PreprocessReport | None = None, cache: bool = True, key: str = KEY,
               max_categories: int = 1000) -> DataFrame:
    """J1 -> C1/C2 -> C3-C5 -> F1-F3 -> F4 -> F5-F8 (the order matters:
    thresholds see capped data).  NaN counts as missing throughout."""
    trans, demo = normalise_nan(trans), normalise_nan(demo)
    df = joins.join_inner(trans, demo, key)
    if cache:   # read by several stat passes: compute once, cut lineage, hold no executor memory
        shared_dir(df.sparkSession)
        held = df.persist(StorageLevel.MEMORY_AND_DISK)
        df = held.checkpoint(eager=True)
        held.unpersist()
    if report is not None:
        report.coverage = joins.join_coverage(trans, df, key)
    missing = clean.columns_with_missing(df)     # one pass serves C1 and C2
    df = clean.impute_median(df, exclude=(key,), missing=missing)
    df = clean.impute_mode(df, exclude=(key,), missing=missing)
    df = cap_and_flag(df, report)
    if "region" in df.columns:
        df = feat.one_hot(df, "region", "region", max_categories=max_categories)
    if "account_created_date" in df.columns:
        df = feat.account_age(df, "account_created_date", as_of)
    return df


def engineer(df: DataFrame, key: str = KEY) -> DataFrame:
    """F9-F11, then C6 and P3: numeric features only, key and target kept."""
    if {"monthly_spend", "sessions_per_month"} <= set(df.columns):
        df = feat.safe_ratio(df, "monthly_spend", "sessions_per_month", "spend_per_session")
    mm_cols = [c for c in ("monthly_spend", "sessions_per_month") if c in df.columns]
    ext = feat.extremes_of(df, mm_cols + [c for c in ["support_tickets_last_month"] if c in df.columns])
    if "support_tickets_last_month" in df.columns:
        df = feat.scale_by_max(df, "support_tickets_last_month", "support_risk_score",
                               maximum=ext["support_tickets_last_month"][1])
    if len(mm_cols) == 2:
        df = feat.minmax_mean(df, mm_cols, "customer_value_tier", extremes=ext)
    numeric = set(drop_non_numeric(df).columns) | {key}
    df = df.select(*[c for c in df.columns if c in numeric])
    return clean.finite_or(df, exclude=(key,))


def preprocessed_view(spark, sf_dir: str, **kw) -> DataFrame:
    return preprocess(views.transactions(spark, sf_dir), views.demographics(spark, sf_dir), **kw)


def region_churn_profile(pre: DataFrame) -> DataFrame:
    """Flagship report: per-region customers, churn rate and flag rates."""
    return (pre.groupBy("region")
               .agg(F.count(F.lit(1)).alias("n_customers"),
                    F.round(F.avg("churned"), 6).alias("churn_rate"),
                    F.round(F.avg("is_high_value"), 6).alias("high_value_rate"),
                    F.round(F.avg("is_high_support"), 6).alias("high_support_rate"),
                    F.round(F.avg("is_low_engagement"), 6).alias("low_engagement_rate"),
                    F.round(F.avg("monthly_spend"), 6).alias("avg_monthly_spend"),
                    F.round(F.avg("age"), 6).alias("avg_age")))


def _warn_if(flag_df: DataFrame, col: str, msg: str) -> None:
    rows = flag_df.where(F.col(col)).collect()
    for r in rows:
        log.warning("%s: %s", msg, r.asDict())


def run(spark, sf_dir: str | None, root: str, params: dict | None = None, folds: int | None = None, version: str = "v1",
        as_of: str = views.AS_OF, test_size: float = 0.2, seed: int = 42, key: str = KEY, target: str = TARGET,
        stratify: str | None = None, inputs: tuple[DataFrame, DataFrame] | None = None, generate_shap: bool = True,
        max_classes: int = 10_000, max_categories: int = 1000, mode: str = "cluster") -> dict:
    """The whole pipeline over the registry at ``root``: register inputs ->
    preprocess -> engineer -> split (with its data checks) -> train -> evaluate.
    Each output is a versioned view, a saved model or logged metrics; each
    step leaves a run record.  Returns the records and reports.

    ``inputs`` are the (transactions, demographics) frames, such as those of
    ``sources.generate``; without them the stand-in views of ``sf_dir`` are
    read.  ``stratify`` is the split's column (default: the target).  The
    defaults train PIPELINE_PARAMS with PIPELINE_FOLDS folds."""
    from cairn.operators import model as mdl, split as sp
    from cairn.operators.evaluate import predictions
    from cairn.operators.select import require_columns
    from cairn.sources import models as mstore, registry as reg
    from cairn.sources.models import write_predictions

    params = mdl.PIPELINE_PARAMS if params is None else params
    folds = mdl.PIPELINE_FOLDS if folds is None else folds
    stratify = stratify or target

    def record(step, prm, stats):
        reg.write_run_record(reg.run_record(spark, step, prm, stats), root)

    def published(df, name):
        """The view as it was written; its figures (A10) come from the write job."""
        reg.register_view(df, root, name, [key], version, observe=profile.summary_aggregates(df, target))
        return reg.read_view(spark, root, name, version)

    def figures(name, df):
        return reg.view_stats(spark, root, name, version) | {"n_columns": len(df.columns)}

    trans, demo = inputs or (views.transactions(spark, sf_dir), views.demographics(spark, sf_dir))
    trans, demo = published(trans, "customer_transactions"), published(demo, "customer_demographics")
    record("generate", {"version": version, "given": inputs is not None}, figures("customer_transactions", trans))
    rep = PreprocessReport()
    pre = preprocess(trans, demo, as_of, rep, key=key, max_categories=max_categories)
    _warn_if(rep.coverage, "warn", "low join coverage")
    pre = published(pre, "preprocessed_customer_features")
    record("preprocess", {"version": version, "as_of": as_of, "bounds": rep.bounds, "thresholds": rep.thresholds},
           figures("preprocessed_customer_features", pre))

    eng = published(engineer(pre, key), "engineered_customer_features")
    record("engineer", {"version": version}, figures("engineered_customer_features", eng))

    require_columns(eng, [target, stratify])
    _warn_if(profile.min_class_check(eng, stratify, test_size), "warn", "minority class small relative to test size")
    split = sp.stratified_split(eng, key, stratify, test_size, seed, max_classes=max_classes)
    tr, te = sp.train_test(split)
    train_df, test_df = published(tr, "train_customer_features"), published(te, "test_customer_features")
    both = train_df.withColumn("split", F.lit(sp.TRAIN)).unionByName(test_df.withColumn("split", F.lit(sp.TEST)))
    balance = sp.balance_report(both, target)
    drift = sp.drift_report(both, target=target)
    _warn_if(balance, "warn", "target rate differs between splits")
    _warn_if(drift, "warn", "feature distribution differs between splits")
    leakage = sp.leakage_check(both, key)          # raises on any shared key
    summary = sp.split_summary(both)
    bal = balance.first().asDict()
    record("split", {"version": version, "test_size": test_size, "seed": seed, "stratify": stratify},
           {"rate_diff": bal["rate_diff"], "train_rate": bal["train_rate"], "test_rate": bal["test_rate"],
            **{f"n_{r['split']}": r["n"] for r in summary.collect()}})

    model, feats, train_rec, cv = mdl.train(train_df, target, params, folds, key, version=version, seed=seed,
                                            source=f"train_customer_features:{version}", mode=mode)
    mstore.save_model(model, root, "gbt_churn_model", version)
    tm = train_rec.first()
    record("train", {"version": version, "params": params, "folds": folds},
           {**tm["training_metrics"], "training_time_seconds": tm["training_time_seconds"]})
    reg.write_record(train_rec, root, "training")

    scored, eval_rec = mdl.evaluate(mstore.load_model(spark, root, "gbt_churn_model", version), test_df, feats,
                                    target, key, version=version, seed=seed, generate_shap=generate_shap,
                                    source=f"test_customer_features:{version}", mode=mode)
    em = eval_rec.first()
    record("evaluate", {"version": version, "generate_shap": generate_shap},
           {**{k: v for k, v in em["performance_metrics"].items() if v is not None}, **em["confusion_matrix"],
            "test_samples": em["test_samples"], "prediction_time_seconds": em["prediction_time_seconds"]})
    reg.write_record(eval_rec, root, "evaluation")
    metrics = reg.log_metrics(eval_rec.select(F.explode("performance_metrics").alias("metric", "value")),
                              root, "gbt_churn_model", version)
    write_predictions(predictions(scored, key, target, "prediction", "probability_1"),
                      f"{root.rstrip('/')}/predictions/gbt_churn_model/{version}")
    return {"training": train_rec, "evaluation": eval_rec, "metrics": metrics, "coverage": rep.coverage,
            "cv": cv, "balance": balance, "drift": drift, "leakage": leakage, "split_summary": summary}
