import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import evaluate as ev, split as sp


def _frame(spark, n=1000, pos=0.3, seed=3):
    rnd = random.Random(seed)
    return spark.createDataFrame([(i, int(rnd.random() < pos), rnd.random()) for i in range(n)],
                                 "customer_id long, churned int, x double")


def test_stratified_split_sizes_and_partition_independence(spark):
    df = _frame(spark)
    splits = []
    for parts in (1, 4, 16):
        out = sp.stratified_split(df.repartition(parts), test_size=0.2, seed=7)
        splits.append({r["customer_id"]: r["split"] for r in out.collect()})
    assert splits[0] == splits[1] == splits[2]
    test = [k for k, v in splits[0].items() if v == "test"]
    assert len(test) == 200
    counts = {r["churned"]: r["count"] for r in df.groupBy("churned").count().collect()}
    quotas = sp.class_quotas(counts, 200)
    got = df.where(F.col("customer_id").isin(test)).groupBy("churned").count().collect()
    assert {r["churned"]: r["count"] for r in got} == quotas


def test_split_fallback_single_member_class(spark):
    rows = [(i, 0) for i in range(50)] + [(50, 1)]
    df = spark.createDataFrame(rows, "customer_id long, churned int")
    out = sp.stratified_split(df, test_size=0.2)
    assert out.where("split = 'test'").count() == 11


def test_folds_balanced_per_class(spark):
    df = _frame(spark, 503)
    f = sp.assign_folds(df, k=5)
    per = f.groupBy("churned", "fold").count().collect()
    for c in (0, 1):
        sizes = [r["count"] for r in per if r["churned"] == c]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_leakage_and_reports(spark):
    out = sp.stratified_split(_frame(spark), test_size=0.25)
    assert sp.leakage_check(out).first()["n_overlap"] == 0
    b = sp.balance_report(out).first()
    assert b["rate_diff"] < 0.02
    s = {r["split"]: r["n"] for r in sp.split_summary(out).collect()}
    assert s == {"train": 750, "test": 250}


def _sk_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def _scored(spark, n=400, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.4)
        s = round(min(1.0, max(0.0, rnd.random() * 0.7 + 0.3 * y)), 1)   # heavy ties
        rows.append((i, y, s, int(s >= 0.5)))
    return spark.createDataFrame(rows, "item_id long, label int, score double, prediction int"), rows


def test_auc_with_ties_matches_pairwise(spark):
    df, rows = _scored(spark)
    y = np.array([r[1] for r in rows]); s = np.array([r[2] for r in rows])
    assert ev.roc_auc(df).first()["roc_auc"] == pytest.approx(_sk_auc(y, s), abs=1e-6)


def test_roc_pr_points(spark):
    df, rows = _scored(spark)
    y = np.array([r[1] for r in rows]); s = np.array([r[2] for r in rows])
    roc = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in ev.roc_curve(df, drop_intermediate=False).collect())
    P, N = y.sum(), (1 - y).sum()
    for t, fpr, tpr in roc[:-1]:
        assert tpr == pytest.approx(((s >= t) & (y == 1)).sum() / P, abs=1e-6)
        assert fpr == pytest.approx(((s >= t) & (y == 0)).sum() / N, abs=1e-6)
    assert roc[-1] == (float("inf"), 0.0, 0.0)
    # default drops collinear intermediate points (reference library default)
    fps = np.array([((s >= t) & (y == 0)).sum() for t in sorted(set(s), reverse=True)])
    tps = np.array([((s >= t) & (y == 1)).sum() for t in sorted(set(s), reverse=True)])
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    assert ev.roc_curve(df).count() == len(keep) + 1
    pr = ev.pr_curve(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)
    assert len(pr) == len(set(s)) + 1


def test_histogram_matches_numpy(spark):
    df, rows = _scored(spark)
    h = ev.score_histogram(df).collect()
    for c in (0, 1):
        s = np.array([r[2] for r in rows if r[1] == c])
        expect, _ = np.histogram(s, bins=30)
        got = [r["n"] for r in sorted((r for r in h if r["label"] == c), key=lambda r: r["bin"])]
        assert got == expect.tolist()


def test_single_class_confusion_zeros(spark):
    df = spark.createDataFrame([(1, 0, 0.2, 0), (2, 0, 0.7, 1)], "item_id long, label int, score double, prediction int")
    c = ev.confusion(df).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (1, 1, 0, 0)
    m = ev.basic_metrics(df).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0
    assert ev.roc_auc(df).first()["roc_auc"] is None


def test_sample_rows_bounded_and_deterministic(spark):
    df, _ = _scored(spark)
    a = [r["item_id"] for r in ev.sample_rows(df.repartition(7), "item_id", 50, 1).collect()]
    b = [r["item_id"] for r in ev.sample_rows(df.repartition(2), "item_id", 50, 1).collect()]
    assert len(a) == 50 and sorted(a) == sorted(b)


def test_many_class_split_uses_join_path(spark, monkeypatch):
    rows = [(i, i % 9) for i in range(900)]
    df = spark.createDataFrame(rows, "customer_id long, churned int")
    lit_path = {r["customer_id"]: r["split"] for r in sp.stratified_split(df, test_size=0.3).collect()}
    monkeypatch.setattr(sp, "LITERAL_CUTS", 2)
    join_path = {r["customer_id"]: r["split"] for r in sp.stratified_split(df, test_size=0.3).collect()}
    assert lit_path == join_path and sum(v == "test" for v in join_path.values()) == 270


def test_empty_table_edges(spark):
    from cairn.operators import clean, profile
    df = spark.createDataFrame([], "customer_id long, churned int, x double, s string")
    assert profile.quantile_values(df, ["x"], [0.5]) == {("x", 0.5): None}
    assert profile.mode_values(df, ["s"]) == {"s": "Unknown"}
    assert clean.cap_iqr(df, ["x"]).count() == 0
    assert sp.stratified_split(df).count() == 0
    assert sp.assign_folds(df).count() == 0
    sc = spark.createDataFrame([], "item_id long, label int, score double, prediction int")
    assert ev.roc_auc(sc).first()["roc_auc"] is None
    assert ev.roc_curve(sc).count() == 1 and ev.pr_curve(sc).count() == 1
    assert ev.confusion(sc).first()["tp"] == 0


def test_fold_paths_agree(spark, monkeypatch):
    df = _frame(spark, 301)
    a = {r["customer_id"]: r["fold"] for r in sp.assign_folds(df, k=4).collect()}
    monkeypatch.setattr(sp, "LITERAL_CUTS", 0)
    b = {r["customer_id"]: r["fold"] for r in sp.assign_folds(df, k=4).collect()}
    assert a == b and set(a.values()) == {0, 1, 2, 3}
