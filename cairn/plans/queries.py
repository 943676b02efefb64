"""Registered queries: one per operator id of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame computed from the driver
tables (or data Spark derives from them), over whole tables.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairn.functions.columns import r6
from cairn.operators import boost, clean, evaluate as ev, features as feat, joins, model as mdl, profile, select as sel
from cairn.operators import split as sp, treeshap as tsh
from cairn.plans import pipeline
from cairn.session import shared_dir
from cairn.sources import generate as gen, models as mstore, registry as reg, sql as sqlsrc, views
from cairn.sources.tables import load, read_csv_checked, read_table, write_table

KEY, TARGET = "customer_id", "churned"


def _trans(spark, sf):
    return views.transactions(spark, sf)


def _demo(spark, sf):
    return views.demographics(spark, sf)


def _joined(spark, sf):
    return joins.join_inner(_trans(spark, sf), _demo(spark, sf), KEY)


def _pre(spark, sf):
    return pipeline.preprocessed_view(spark, sf)


def _eng(spark, sf):
    return pipeline.engineer(_pre(spark, sf))


def _sparse(spark, sf):
    return views.sparse_activity(spark, sf)


def _scored(spark, sf):
    return views.labelled_scores(spark, sf)


def _split(spark, sf):
    return sp.stratified_split(_eng(spark, sf), KEY, TARGET, 0.2, 42)


# --- joins -------------------------------------------------------------------
def j1_customer_join(spark, sf):
    return _joined(spark, sf)


def j1_hot_key_join(spark, sf):
    """J1 between line items and suppliers where a third of the line items has one key, which several rows of the other side have."""
    li = load(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).alias("k"), "l_quantity")
    other = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n")).unionByName(
        load(spark, sf, "region").select(F.lit(0).cast("long").alias("k"), F.col("r_regionkey").alias("n")))
    return joins.join_skewed(li, other, "k").groupBy("k", "n").agg(F.count(F.lit(1)).alias("n_rows"), r6(F.sum("l_quantity")).alias("quantity"))


def j2_join_coverage(spark, sf):
    t = _trans(spark, sf)
    return joins.join_coverage(t, joins.join_inner(t, _demo(spark, sf), KEY), KEY)


def j3_key_overlap(spark, sf):
    churned = _trans(spark, sf).where(F.col(TARGET) == 1)
    active = load(spark, sf, "events").select(F.col("user_id").alias(KEY))
    return joins.key_overlap(churned, active, KEY, fail=False)


# --- aggregations and profiling ---------------------------------------------
def a1_null_summary(spark, sf):
    return profile.null_summary(_sparse(spark, sf))


def a2_type_report(spark, sf):
    return profile.type_report(load(spark, sf, "orders"))


def a3_value_counts(spark, sf):
    return profile.value_counts(_joined(spark, sf), "region")


def a4_mean_rate(spark, sf):
    return profile.mean_rate(_trans(spark, sf), TARGET, "churn_rate")


A5_COLS = ["monthly_spend", "sessions_per_month", "support_tickets_last_month", "age"]


def a5_quantiles(spark, sf):
    return profile.quantiles(_joined(spark, sf), A5_COLS, [0.25, 0.5, 0.75])


def a6_modes(spark, sf):
    return profile.modes(_sparse(spark, sf), ["segment", "top_event_type"])


def a7_extremes(spark, sf):
    return profile.extremes(_joined(spark, sf), A5_COLS)


def a8_inf_counts(spark, sf):
    li = load(spark, sf, "lineitem")
    return profile.inf_counts(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def a9_min_class_check(spark, sf):
    return profile.min_class_check(_trans(spark, sf), TARGET, 0.2)


def a10_summary(spark, sf):
    return profile.summary(_pre(spark, sf), TARGET)


# --- cleaning ----------------------------------------------------------------
def c1_impute_median(spark, sf):
    return clean.impute_median(_sparse(spark, sf))


def c2_impute_mode(spark, sf):
    return clean.impute_mode(_sparse(spark, sf))


CAP = list(pipeline.CAP_COLUMNS)


def c3_iqr_cap(spark, sf):
    return clean.cap_iqr(_joined(spark, sf), CAP)


def c3_iqr_report(spark, sf):
    return clean.iqr_report(_joined(spark, sf), CAP)


def c4_clamp_age(spark, sf):
    capped = clean.cap_iqr(_joined(spark, sf), CAP)
    return clean.clamp(capped, "age", 18, 100).select(KEY, "age")


def c5_floor_balance(spark, sf):
    return clean.floor_at(_sparse(spark, sf), "acctbal", 0).select(KEY, "acctbal")


def c6_finite_or(spark, sf):
    s = _sparse(spark, sf).select(KEY, "acctbal", "n_events", "total_value")
    return clean.finite_or(s, exclude=(KEY,))


# --- feature construction ----------------------------------------------------
def f1_high_value(spark, sf):
    return _pre(spark, sf).select(KEY, "monthly_spend", "is_high_value")


def f2_high_support(spark, sf):
    return feat.flag_gt(_trans(spark, sf), "support_tickets_last_month", 2, "is_high_support") \
        .select(KEY, "support_tickets_last_month", "is_high_support")


def f3_low_engagement(spark, sf):
    return _pre(spark, sf).select(KEY, "sessions_per_month", "is_low_engagement")


def f4_one_hot_region(spark, sf):
    d = feat.one_hot(_demo(spark, sf), "region", "region")
    return d.drop("age", "account_created_date")


def f5_parse_date(spark, sf):
    return feat.parse_date(_demo(spark, sf), "account_created_date").select(KEY, "account_created_date")


def _aged(spark, sf):
    return feat.account_age(_demo(spark, sf), "account_created_date", views.AS_OF)


def f6_account_age_days(spark, sf):
    return _aged(spark, sf).select(KEY, "account_age_days")


def f7_account_age_years(spark, sf):
    return _aged(spark, sf).select(KEY, r6("account_age_years").alias("account_age_years"))


def f8_account_age_bucket(spark, sf):
    return _aged(spark, sf).select(KEY, "account_age_bucket")


def f9_spend_per_session(spark, sf):
    return _eng(spark, sf).select(KEY, r6("spend_per_session").alias("spend_per_session"))


def f10_support_risk_score(spark, sf):
    return _eng(spark, sf).select(KEY, r6("support_risk_score").alias("support_risk_score"))


def f11_customer_value_tier(spark, sf):
    return _eng(spark, sf).select(KEY, r6("customer_value_tier").alias("customer_value_tier"))


def f12_label_encode(spark, sf):
    return feat.label_encode(_trans(spark, sf).select(KEY), KEY, "customer_id_encoded")


def f13_date_parse_failures(spark, sf):
    return feat.date_parse_failures(_demo(spark, sf), "account_created_date")


# --- projections, filters, predicates ------------------------------------------
def p1_feature_columns(spark, sf):
    e = _eng(spark, sf)
    return e.select(KEY, *[r6(c).alias(c) if t == "double" else F.col(c)
                           for c, t in e.select(sel.feature_columns(e)).dtypes])


def p2_columns_of_kind(spark, sf):
    j = _joined(spark, sf)
    return j.select(KEY, *sel.columns_of_kind(j, ("numeric",), (KEY,)))


def p3_drop_non_numeric(spark, sf):
    return sel.drop_non_numeric(_joined(spark, sf))


def p4_count_outside(spark, sf):
    return sel.count_outside(_joined(spark, sf), "age", 18, 100, "n_invalid_age")


def p5_set_where(spark, sf):
    d = _demo(spark, sf)
    return sel.set_where(d, "age", F.col("age") < 18, 18).select(KEY, "age")


def p6_require_columns(spark, sf):
    return sel.require_columns(_trans(spark, sf), [KEY, TARGET]).select(KEY, TARGET)


# --- sorts, limits, set operations ----------------------------------------------
def o1_sort_desc(spark, sf):
    return sel.sort_desc(_trans(spark, sf).select(KEY, "monthly_spend"), "monthly_spend", KEY)


def o2_top_k(spark, sf):
    return sel.top_k(_trans(spark, sf).select(KEY, "monthly_spend"), "monthly_spend", 10, KEY)


def o3_common_keys(spark, sf):
    active = _sparse(spark, sf).where(F.col("n_events").isNotNull())
    return sel.common_keys(_trans(spark, sf).where(F.col(TARGET) == 1), active, KEY)


def o4_concat_columns(spark, sf):
    d = _demo(spark, sf).select(KEY, "age", "region")
    s = _sparse(spark, sf).select(KEY, "segment", "n_events")
    return sel.concat_columns(d, s, KEY)


# --- split and split quality ------------------------------------------------------
def t1_stratified_split(spark, sf):
    return _split(spark, sf).select(KEY, TARGET, "split")


def t1_split_two_columns(spark, sf):
    """T1 on (churned, region)."""
    return sp.stratified_split_by(_pre(spark, sf).select(KEY, TARGET, "region"), KEY, [TARGET, "region"], 0.2, 42)


def t2_random_split(spark, sf):
    return sp.random_split(_eng(spark, sf), KEY, 0.2, 42).select(KEY, "split")


def t3_split_fallback(spark, sf):
    """Stratifying on a class with a single member (the top account balance)
    is impossible, so the split falls back to the seeded random split."""
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias(KEY), "c_acctbal")
    top = c.agg(F.max("c_acctbal")).first()[0]
    c = c.select(KEY, (F.col("c_acctbal") == F.lit(top)).cast("int").alias("is_top_balance"))
    return sp.stratified_split(c, KEY, "is_top_balance", 0.2, 42).select(KEY, "split")


def t4_balance_report(spark, sf):
    return sp.balance_report(_split(spark, sf), TARGET)


def t5_drift_report(spark, sf):
    return sp.drift_report(_split(spark, sf), target=TARGET)


def t5_drift_summary(spark, sf):
    return sp.drift_summary(sp.drift_report(_split(spark, sf), target=TARGET))


def t6_leakage_check(spark, sf):
    return sp.leakage_check(_split(spark, sf), KEY)


def t7_split_summary(spark, sf):
    return sp.split_summary(_split(spark, sf))


def m3_assign_folds(spark, sf):
    return sp.assign_folds(_eng(spark, sf).select(KEY, TARGET), KEY, TARGET, 5, 42)


# --- evaluation on labelled scores -------------------------------------------------
def e1_confusion(spark, sf):
    return ev.confusion(_scored(spark, sf))


def e2_e4_basic_metrics(spark, sf):
    return ev.basic_metrics(_scored(spark, sf))


def e2_accuracy(spark, sf):
    return ev.basic_metrics(_scored(spark, sf)).select("accuracy")


def e3_precision_recall_f1(spark, sf):
    return ev.basic_metrics(_scored(spark, sf)).select("precision", "recall", "f1_score")


def e4_specificity_fpr_fnr(spark, sf):
    return ev.basic_metrics(_scored(spark, sf)).select("specificity", "false_positive_rate", "false_negative_rate")


def e5_roc_auc(spark, sf):
    return ev.roc_auc(_scored(spark, sf))


def e6_class_report(spark, sf):
    return ev.class_report(_scored(spark, sf))


def e7_roc_curve(spark, sf):
    return ev.roc_curve(_scored(spark, sf))


def e8_pr_curve(spark, sf):
    return ev.pr_curve(_scored(spark, sf))


def e9_score_histogram(spark, sf):
    return ev.score_histogram(_scored(spark, sf))


def e10_sample_rows(spark, sf):
    return ev.sample_rows(_scored(spark, sf), "item_id", 100, 42)


def e12_predictions(spark, sf):
    return ev.predictions(_scored(spark, sf), "item_id", "label", "prediction", "score")


def e13_predicted_rate(spark, sf):
    return ev.predicted_rate(_scored(spark, sf))


def flagship(spark, sf):
    return pipeline.region_churn_profile(_pre(spark, sf))




# --- model training and model-based evaluation (no SQL oracle) -----------------

# What the model queries share, held as long as its session; the frames are checkpoints, nothing is persisted.
_TRAINED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


_SPLITS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _trained_split(spark, sf):
    """The split's train and test rows as checkpoints, once per (session, sf)."""
    held = _SPLITS.setdefault(spark, {})
    if sf not in held:
        shared_dir(spark)
        held[sf] = tuple(x.checkpoint() for x in sp.train_test(_split(spark, sf)))
    return held[sf]


def _trained(spark, sf):
    """Train once per (session, sf) with TEST_PARAMS (50 trees, depth 4, 3 folds); every model query reuses it."""
    held = _TRAINED.setdefault(spark, {})
    if sf not in held:
        tr, te = _trained_split(spark, sf)
        model, feats, rec, cv = mdl.train(tr, TARGET, mdl.TEST_PARAMS, mdl.TEST_FOLDS, KEY)
        held[sf] = dict(model=model, features=feats, record=rec, cv=cv, train=tr, test=te)
    return held[sf]


def _checked(scored):
    """Scores as facts that any right model has: a probability in [0, 1], and the label that the 0.5 threshold gives."""
    p = F.col("probability_1")
    return scored.select(KEY, TARGET, F.coalesce(p.between(0, 1), F.lit(False)).alias("probability_ok"),
                         F.coalesce(F.col("prediction") == (p > 0.5).cast("int"), F.lit(False)).alias("label_ok"))


def _differences(a: dict, b: dict, spark):
    """(metric, same): whether two computations of each metric agree to 6 places."""
    rows = [(k, a[k] is not None and b[k] is not None and abs(a[k] - b[k]) < 2e-6) for k in mdl.METRICS]
    return spark.createDataFrame(rows, "metric string, same boolean")


def _recomputed(spark, scored) -> dict:
    s = scored.select(F.col(TARGET).alias("label"), "prediction", F.col("probability_1").alias("score"))
    return {**ev.basic_metrics(s).first().asDict(), "roc_auc": ev.roc_auc(s).first()["roc_auc"]}


def m1_assemble(spark, sf):
    e = _eng(spark, sf)
    feats = mdl.model_features(e)
    v = mdl.assemble(e, feats)
    return v.select(KEY, F.transform(mdl.vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


def m2_gbt_fit(spark, sf):
    """The fit's own rows, scored: every row has a probability and its label."""
    t = _trained(spark, sf)
    return _checked(mdl.score(t["model"], t["train"], [KEY, TARGET]))


def m4_cross_validate(spark, sf):
    """Rows held out per fold, and whether the fold has all five metrics within [0, 1]."""
    t = _trained(spark, sf)
    held_out = sp.assign_folds(t["train"].select(KEY, TARGET), KEY, TARGET, mdl.TEST_FOLDS, 42).groupBy("fold").count()
    ok = F.lit(True)
    for m in mdl.METRICS:
        ok = ok & F.coalesce(F.col(m).between(0, 1), F.lit(False))
    return t["cv"].join(held_out, "fold", "full").select("fold", F.col("count").alias("n_held_out"), ok.alias("metrics_ok"))


def m4_cv_summary(spark, sf):
    """Per metric: folds counted, and whether mean and deviation are those of its scores."""
    s = mdl.cv_summary(_trained(spark, sf)["cv"])
    n = F.size("scores")
    mean = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / n
    std = F.sqrt(F.aggregate("scores", F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n)
    return s.select("metric", n.alias("n_folds"), (F.abs(mean - F.col("mean")) < 2e-6).alias("mean_ok"),
                    (F.abs(std - F.col("std")) < 2e-6).alias("std_ok"))


def m5_score(spark, sf):
    """Every test row with a probability and its label."""
    t = _trained(spark, sf)
    return _checked(mdl.score(t["model"], t["test"], [KEY, TARGET]))


def m6_training_metrics(spark, sf):
    """Each training metric against a second computation from the scores."""
    t = _trained(spark, sf)
    scored = mdl.score(t["model"], t["train"], [KEY, TARGET])
    return _differences(mdl.training_metrics(scored, TARGET).first().asDict(), _recomputed(spark, scored), spark)


def m7_importance(spark, sf):
    """Importances of all features: their number, sum, and whether any is negative or out of order."""
    t = _trained(spark, sf)
    rows = mdl.importance(t["model"], t["features"], None)
    top = [r.importance for r in rows.limit(len(t["features"])).collect()]
    return rows.agg(F.count(F.lit(1)).alias("n_features"), r6(F.sum("importance")).alias("total"),
                    F.count_if(F.col("importance") < 0).alias("n_negative")) \
        .withColumn("sorted", F.lit(top == sorted(top, reverse=True)))


def m8_training_record(spark, sf):
    """The record's facts that the data decide, and whether it has a time, all metrics and all folds."""
    rec = _trained(spark, sf)["record"]
    return rec.select("model_name", "model_version", "training_samples", "feature_count", "target_column", "cv_folds",
                      F.size("cv_scores").alias("n_cv_metrics"), F.size("training_metrics").alias("n_metrics"),
                      F.size("feature_columns").alias("n_feature_columns"),
                      (F.col("recorded_at").isNotNull() & (F.col("training_time_seconds") > 0)).alias("timed"))


def e11_permutation_attribution(spark, sf):
    """Permutation attribution over all test rows: features, and whether each is a mean of probability gaps."""
    t = _trained(spark, sf)
    att = mdl.permutation_attribution(t["model"], t["test"], t["features"], KEY, None, 42)
    return att.select("feature", F.col("attribution").between(0, 1).alias("in_range"))


def e11_tree_shap_attribution(spark, sf):
    """E11 as the reference computes it: mean |tree SHAP| (log-odds) on 100 sampled test rows,
    against the mean over the same rows of the per-row values."""
    t = _trained(spark, sf)
    att = tsh.tree_shap_attribution(t["model"], t["test"], t["features"], KEY, 100, 42)
    rows = ev.sample_rows(t["test"].select(KEY, *t["features"]), KEY, 100, 42)
    each = tsh.shap_values(t["model"], rows, t["features"], KEY)
    names = F.array(*[F.lit(f) for f in t["features"]])
    again = (each.select(F.explode(F.arrays_zip(names.alias("feature"), F.col("shap").alias("v"))).alias("x"))
             .groupBy(F.col("x.feature").alias("feature")).agg(F.avg(F.abs("x.v")).alias("mean_abs")))
    return att.join(again, "feature", "full").select(
        "feature", F.coalesce(F.abs(F.col("attribution") - F.col("mean_abs")) < 2e-6, F.lit(False)).alias("same"))


def e11_tree_shap_values(spark, sf):
    """Every test row's exact tree SHAP values: one per feature, adding up to the logit of its probability."""
    t = _trained(spark, sf)
    vals = tsh.shap_values(t["model"], t["test"], t["features"], KEY)
    scored = mdl.score(t["model"], t["test"], [KEY])
    p = F.least(F.greatest(F.col("probability_1"), F.lit(1e-12)), F.lit(1 - 1e-12))
    gap = F.abs(F.col("base_value") + F.aggregate("shap", F.lit(0.0), lambda a, v: a + v) - F.log(p / (1 - p)))
    return vals.join(scored, KEY, "full").select(KEY, F.size("shap").alias("n_values"),
                                                 F.coalesce(gap < 1e-6, F.lit(False)).alias("additive"))


def e14_evaluation_record(spark, sf):
    """The record's metrics against a second computation, with the facts that the data decide."""
    t = _trained(spark, sf)
    scored, rec = mdl.evaluate(t["model"], t["test"], t["features"], TARGET, KEY)
    row = rec.first()
    facts = [int(row[c]) for c in ("test_samples", "feature_count", "attribution_sample_size")]
    return _differences(row["performance_metrics"], _recomputed(spark, scored), spark).select(
        "metric", "same", *[F.lit(v).cast("long").alias(c) for c, v in
                            zip(("test_samples", "feature_count", "attribution_sample_size"), facts, strict=True)])


# --- second-order boosting with trees of depth one, which SQL can state -----------
# Fixed values, as in the SQL.
STUMPS = {"n_estimators": 4, "max_depth": 1, "learning_rate": 0.5, "max_bins": 16, "random_state": 42}
STUMP_GRID = {"learning_rate": [0.5, 0.1], "reg_lambda": [1.0, 20.0]}
_STUMP_MODELS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _stumps(spark, sf):
    """(model, features, train, test) of the stumps on the train rows, once per (session, sf)."""
    held = _STUMP_MODELS.setdefault(spark, {})
    if sf not in held:
        tr, te = _trained_split(spark, sf)
        feats = mdl.model_features(tr, TARGET, exclude=(*sel.NON_FEATURES, KEY))
        model, = mdl.fit_boosted(tr, feats, TARGET, KEY, [boost.Fit(boost.BoostParams.of(STUMPS))])
        held[sf] = model, feats, tr, te
    return held[sf]


def m2_boosted_stumps(spark, sf):
    """M2: every tree's split, gain, leaf values and covers."""
    model, feats, _, _ = _stumps(spark, sf)
    nodes = spark.createDataFrame(model.stages[-1].nodes, boost.NODE_SCHEMA)
    root, left, right = (nodes.where(F.col("node") == n).alias(a) for n, a in ((0, "p"), (1, "l"), (2, "r")))
    names = F.array(*[F.lit(f) for f in feats])
    return (root.join(left, "tree").join(right, "tree")
            .select((F.col("tree") + 1).alias("round"), F.element_at(names, F.col("p.feature") + 1).alias("feature"), r6("p.cut").alias("cut"),
                    r6("p.gain").alias("gain"), r6("l.value").alias("left_value"), r6("r.value").alias("right_value"),
                    r6("l.cover").alias("left_cover"), r6("r.cover").alias("right_cover")))


def m4_boosted_folds(spark, sf):
    """M4: the five metrics on every fold's held-out rows."""
    _, feats, tr, _ = _stumps(spark, sf)
    return mdl.cross_validate(tr, feats, TARGET, STUMPS, mdl.TEST_FOLDS, KEY)


def m4_grid_search(spark, sf):
    """M4: every combination of the grid on every fold."""
    _, feats, tr, _ = _stumps(spark, sf)
    return mdl.grid_search(tr, feats, STUMP_GRID, STUMPS, TARGET, mdl.TEST_FOLDS, KEY)


def m5_boosted_scores(spark, sf):
    """M5: probability and label of every test row."""
    model, _, _, te = _stumps(spark, sf)
    return mdl.score(model, te, [KEY, TARGET]).select(KEY, TARGET, "prediction", r6("probability_1").alias("probability_1"))


def m6_boosted_metrics(spark, sf):
    """M6: the training metrics."""
    model, _, tr, _ = _stumps(spark, sf)
    return mdl.training_metrics(mdl.score(model, tr, [KEY, TARGET]), TARGET)


def m7_boosted_importance(spark, sf):
    """M7: every feature's share of the mean gains."""
    model, feats, _, _ = _stumps(spark, sf)
    return mdl.importance(model, feats, None).select("feature", r6("importance").alias("importance"))


def e11_boosted_shap(spark, sf):
    """Tree SHAP value of every feature of every test row."""
    model, feats, _, te = _stumps(spark, sf)
    names = F.array(*[F.lit(f) for f in feats])
    return (tsh.shap_values(model, te, feats, KEY).select(KEY, F.posexplode("shap").alias("i", "v"))
            .select(KEY, F.element_at(names, F.col("i") + 1).alias("feature"), (r6("v") + 0.0).alias("shap")))


def e14_boosted_metrics(spark, sf):
    """Metrics and confusion counts of the evaluation record on the test rows."""
    model, feats, _, te = _stumps(spark, sf)
    _, rec = mdl.evaluate(model, te, feats, TARGET, KEY, generate_shap=False)
    both = F.map_concat("performance_metrics", F.transform_values("confusion_matrix", lambda _, v: v.cast("double")))
    return rec.select(F.explode(both).alias("metric", "value"))


# --- sources and sinks ----------------------------------------------------------
TRANS_SCHEMA = ("customer_id bigint, monthly_spend double, sessions_per_month double, "
                "support_tickets_last_month bigint, churned int")


def s1_s2_csv_roundtrip(spark, sf):
    path = shared_dir(spark, "cairn-csv")
    write_table(_trans(spark, sf), path, "csv")
    return read_table(spark, path, "csv", schema=TRANS_SCHEMA)


TRANS_FIELDS = [f.split(" ")[0] for f in TRANS_SCHEMA.split(", ")]


def _csv_with_faults(spark, sf):
    """(good, bad) of the transactions as lines without a header, some with a word for a number, a field too few or one too many."""
    path = shared_dir(spark, "cairn-lines")
    text = {c: F.col(c).cast("string") for c in TRANS_FIELDS}
    text["monthly_spend"] = F.when(F.col(KEY) % 7 == 0, F.lit("n/a")).otherwise(F.round(F.col("monthly_spend") * 100).cast("long").cast("string"))
    text["sessions_per_month"] = F.round(F.col("sessions_per_month") * 80).cast("long").cast("string")
    text[TARGET] = F.when(F.col(KEY) % 11 == 0, F.lit(None)).when(F.col(KEY) % 13 == 0, F.concat(text[TARGET], F.lit(",x"))).otherwise(text[TARGET])
    _trans(spark, sf).select(F.concat_ws(",", *text.values()).alias("value")).write.text(path)
    return read_csv_checked(spark, path, TRANS_SCHEMA, header=False)


def s1_csv_good_rows(spark, sf):
    """Rows whose lines have the right fields and types."""
    return _csv_with_faults(spark, sf)[0]


def s1_csv_bad_rows(spark, sf):
    """The other lines, each with its first fault."""
    return _csv_with_faults(spark, sf)[1].select("line", "reason")


def s1_csv_inferred(spark, sf):
    """Types from the values of all files, each with its own header."""
    path = shared_dir(spark, "cairn-csv")
    write_table(_demo(spark, sf).repartition(3), path, "csv")
    return read_csv_checked(spark, path)[0]


def _registered(spark, sf):
    root = shared_dir(spark, "cairn-registry")
    d = _demo(spark, sf)
    reg.register_view(d, root, "customer_demographics", [KEY], "v1", desc="demographics stand-in")
    reg.register_view(d.withColumn("age", F.col("age") + 1), root, "customer_demographics", [KEY], "v2")
    reg.register_view(_trans(spark, sf), root, "customer_transactions", [KEY], "v9")
    reg.register_view(_trans(spark, sf), root, "customer_transactions", [KEY], "v10", desc="latest transactions")
    return root


def s3_s4_view_roundtrip(spark, sf):
    root = _registered(spark, sf)
    return reg.read_view(spark, root, "customer_demographics", "v1")


def s5_resolve_version(spark, sf):
    """What was asked for, what it means, and the rows that a read of it finds."""
    root = _registered(spark, sf)
    reg.set_default_version(spark, root, "customer_transactions", "v9")
    r = reg.registry(spark, root)
    asks = [("customer_transactions", None), ("customer_transactions", "current"),
            ("customer_transactions", "latest"), ("customer_demographics", "latest"), ("customer_demographics", "v1")]
    rows = [(n, str(v), reg.resolve_version(r, n, v), reg.read_view(spark, root, n, v).count()) for n, v in asks]
    return spark.createDataFrame(rows, "name string, requested string, resolved string, n_rows long")


def s6_latest_versions(spark, sf):
    """The latest version of every view, and the rows that a read of it finds."""
    root = _registered(spark, sf)
    found = reg.latest_versions(reg.registry(spark, root), "view").collect()
    rows = [(*x, reg.read_view(spark, root, x.name, "latest").count()) for x in found]
    return spark.createDataFrame(rows, "kind string, name string, latest_version string, n_versions long, n_rows long")


def s7_find_view(spark, sf):
    """The rows of the first candidate that is registered."""
    root = _registered(spark, sf)
    name = reg.find_view(reg.registry(spark, root), ["customer_features", "customer_transactions", "customer_demographics"])
    return reg.read_view(spark, root, name, "latest").withColumn("found", F.lit(name))


def s8_list_views(spark, sf):
    """Views with latest version, description and row count, as the registry has them."""
    return reg.list_views(reg.registry(spark, _registered(spark, sf)), "view")


def s3_versions_differ(spark, sf):
    """Two versions of one view with other columns and another type, both read back whole."""
    root = shared_dir(spark, "cairn-registry")
    d = _demo(spark, sf)
    reg.register_view(d.select(KEY, "age"), root, "customer_demographics", [KEY], "v1")
    reg.register_view(d.select(KEY, F.col("age").cast("string").alias("age"), F.upper("region").alias("extra")),
                      root, "customer_demographics", [KEY], "v2")
    v1, v2 = (reg.read_view(spark, root, "customer_demographics", v) for v in ("v1", "v2"))
    return v1.join(v2.withColumnRenamed("age", "age_text"), KEY, "full")


def m3_many_classes(spark, sf):
    """Folds over 101 classes of orders, one of them NULL."""
    o = load(spark, sf, "orders").select("o_orderkey", F.nullif(F.col("o_custkey") % 101, F.lit(0)).alias("cls"))
    return sp.assign_folds(o, "o_orderkey", "cls", 5, 42)


def c_nan_preprocess(spark, sf):
    """NaN from a computed column, through the registry and the cleaning and flag operators."""
    e = load(spark, sf, "events").groupBy(F.col("user_id").alias(KEY)).agg(r6(F.sum("value")).alias("spend"))
    made = e.withColumn("spend", F.when(F.col(KEY) % 7 == 0, F.lit(float("nan"))).otherwise(F.col("spend")))
    root = shared_dir(spark, "cairn-registry")
    reg.register_view(made, root, "events_spend", [KEY], "v1")
    df = reg.read_view(spark, root, "events_spend", "v1").withColumn("raw", F.when(F.col(KEY) % 7 == 0, F.lit(float("nan")))
                                                                     .otherwise(F.col("spend")))
    df = feat.flag_ge_quantile(df, "raw", 0.75, "is_high")
    df = feat.safe_ratio(df, KEY, "raw", "per_raw")
    df = clean.clamp(clean.cap_iqr(clean.impute_median(df, ["spend"]), ["raw"]), "raw", 0, 1_000_000)
    return df.select(KEY, r6("spend").alias("spend"), r6(F.nanvl("raw", F.lit(None))).alias("raw"), "is_high",
                     r6("per_raw").alias("per_raw"))


def s9_run_record(spark, sf):
    stats = profile.summary(_pre(spark, sf), TARGET)
    rec = reg.run_record(spark, "preprocess", {"as_of": views.AS_OF, "cap_columns": list(pipeline.CAP_COLUMNS)}, stats)
    path = reg.write_run_record(rec, shared_dir(spark, "cairn-runs"))
    back = spark.read.schema(reg.RUN_SCHEMA).json(path).where("recorded_at is not null")
    return back.select("step", F.explode("stats").alias("stat", "value"))


def s10_model_roundtrip(spark, sf):
    t = _trained(spark, sf)
    root = shared_dir(spark, "cairn-models")
    mstore.save_model(t["model"], root, "gbt_churn_model", "v1")
    loaded = mstore.load_model(spark, root, "gbt_churn_model", "latest")
    before = mdl.score(t["model"], t["test"], [KEY]).withColumnRenamed("probability_1", "p")
    after = mdl.score(loaded, t["test"], [KEY])
    return before.join(after, KEY, "full").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.coalesce(F.abs(F.col("p") - F.col("probability_1")) < 1e-12, F.lit(False))).alias("n_different"))


def s11_log_metrics(spark, sf):
    root = shared_dir(spark, "cairn-metrics")
    mdl_metrics = ev.basic_metrics(_scored(spark, sf))
    reg.log_metrics(mdl_metrics, root, "score_model", "v1")
    return reg.read_metrics(spark, root, "score_model").select("model", "version", "metric", "value")


def s12_predictions_sink(spark, sf):
    path = shared_dir(spark, "cairn-predictions")
    mstore.write_predictions(e12_predictions(spark, sf), path)
    return read_table(spark, path)


def s13_run_sql(spark, sf):
    return sqlsrc.run_sql(spark, S13_SQL, {"min_price": 100000.0},
                          {"orders": load(spark, sf, "orders"), "customer": load(spark, sf, "customer")})


S13_SQL = """SELECT c.c_mktsegment AS segment, count(*) AS n_orders, round(avg(o.o_totalprice), 6) AS avg_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice > :min_price GROUP BY c.c_mktsegment"""


# --- data generation --------------------------------------------------------------
def g1_labelled_customers(spark, sf):
    """G1 with a label that follows from the features, at an exact rate."""
    return gen.generate_labelled(spark, keys=load(spark, sf, "customer").select("c_custkey"))


def _generated(spark, sf):
    return gen.generate_customers(spark, positive_rate=0.12, seed=42,
                                  keys=load(spark, sf, "customer").select("c_custkey"))


def pipeline_end_to_end(spark, sf):
    """All six steps through the versioned registry, from the given input views: rows of each view that it leaves."""
    root = shared_dir(spark, "cairn-pipeline")
    pipeline.run(spark, sf, root, mdl.TEST_PARAMS, mdl.TEST_FOLDS)
    return reg.registry(spark, root).where("kind = 'view'").select("name", "version", "n_rows")


def g1_generate_customers(spark, sf):
    return _generated(spark, sf)


def g2_split_vertical(spark, sf):
    return gen.split_vertical(_generated(spark, sf))["demographics"]


def g3_random_choice(spark, sf):
    return _generated(spark, sf).select(KEY, "region")


def g4_random_date(spark, sf):
    return _generated(spark, sf).select(KEY, "account_created_date")


def g5_positive_rate(spark, sf):
    return gen.positive_rate(_generated(spark, sf))


QUERIES = {
    "flagship_region_churn": flagship,
    **{n: globals()[n] for n in [
        "j1_customer_join", "j2_join_coverage", "j3_key_overlap",
        "a1_null_summary", "a2_type_report", "a3_value_counts", "a4_mean_rate", "a5_quantiles", "a6_modes",
        "a7_extremes", "a8_inf_counts", "a9_min_class_check", "a10_summary",
        "c1_impute_median", "c2_impute_mode", "c3_iqr_cap", "c3_iqr_report", "c4_clamp_age", "c5_floor_balance",
        "c6_finite_or",
        "f1_high_value", "f2_high_support", "f3_low_engagement", "f4_one_hot_region", "f5_parse_date",
        "f6_account_age_days", "f7_account_age_years", "f8_account_age_bucket", "f9_spend_per_session",
        "f10_support_risk_score", "f11_customer_value_tier", "f12_label_encode", "f13_date_parse_failures",
        "p1_feature_columns", "p2_columns_of_kind", "p3_drop_non_numeric", "p4_count_outside", "p5_set_where",
        "p6_require_columns",
        "o1_sort_desc", "o2_top_k", "o3_common_keys", "o4_concat_columns",
        "t1_stratified_split", "t2_random_split", "t3_split_fallback", "t4_balance_report", "t5_drift_report", "t5_drift_summary",
        "t6_leakage_check", "t7_split_summary", "m3_assign_folds",
        "e1_confusion", "e2_e4_basic_metrics", "e2_accuracy", "e3_precision_recall_f1", "e4_specificity_fpr_fnr", "e5_roc_auc", "e6_class_report", "e7_roc_curve", "e8_pr_curve",
        "e9_score_histogram", "e10_sample_rows", "e12_predictions", "e13_predicted_rate",
        "g1_generate_customers", "g2_split_vertical", "g3_random_choice", "g4_random_date", "g5_positive_rate",
        "s1_s2_csv_roundtrip", "s3_s4_view_roundtrip", "s3_versions_differ", "m3_many_classes", "c_nan_preprocess", "s5_resolve_version", "s6_latest_versions",
        "s7_find_view", "s8_list_views", "s9_run_record", "s11_log_metrics", "s12_predictions_sink", "s13_run_sql",
        "m1_assemble", "m2_gbt_fit", "m4_cross_validate", "m4_cv_summary", "m5_score", "m6_training_metrics",
        "m7_importance", "m8_training_record", "s10_model_roundtrip", "e11_permutation_attribution",
        "e11_tree_shap_attribution", "e11_tree_shap_values",
        "e14_evaluation_record", "pipeline_end_to_end",
        "j1_hot_key_join", "t1_split_two_columns", "s1_csv_good_rows", "s1_csv_bad_rows", "s1_csv_inferred", "g1_labelled_customers",
        "m2_boosted_stumps", "m4_boosted_folds", "m4_grid_search", "m5_boosted_scores", "m6_boosted_metrics", "m7_boosted_importance",
        "e11_boosted_shap", "e14_boosted_metrics",
    ]},
}
