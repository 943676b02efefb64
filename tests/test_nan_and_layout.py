"""NaN past the first read, NULL classes and keys, layouts, parameters, and what stays behind."""

import gc
import math
import os
import time

import pytest
from pyspark.sql import functions as F

from cairn.operators import clean, evaluate as ev, features as feat, model as mdl, profile, select as sel, split as sp
from cairn.session import shared_dir

NAN = float("nan")


@pytest.fixture(scope="module")
def nans(spark):
    return spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, NAN), (5, None), (6, 100.0)], "customer_id long, x double")


def _col(df, c):
    return [r[c] for r in df.orderBy("customer_id").collect()]


def test_nan_is_missing_when_cleaning(nans):
    assert clean.columns_with_missing(nans) == ["x"]
    assert _col(clean.impute_median(nans), "x") == [1.0, 2.0, 3.0, 2.5, 2.5, 100.0]
    capped = _col(clean.cap_iqr(nans, ["x"]), "x")
    assert capped[3] is None and capped[4] is None and capped[5] < 100.0
    kept = _col(clean.clamp(nans, "x", 2, 50), "x")
    assert kept[:3] == [2.0, 2.0, 3.0] and math.isnan(kept[3]) and kept[4] is None and kept[5] == 50.0
    assert clean.iqr_report(nans, ["x"]).first()["n_outliers"] == 1
    assert sel.count_outside(nans, "x", 0, 50).first()["n_outside"] == 1


def test_nan_is_missing_in_profiles_and_features(nans):
    assert profile.mean_rate(nans, "x").first()["rate"] == 26.5
    e = profile.extremes(nans, ["x"]).first()
    assert (e["min_value"], e["max_value"]) == (1.0, 100.0)
    assert _col(feat.flag_ge_quantile(nans, "x", 0.5, "f"), "f") == [0, 0, 1, 0, 0, 1]
    assert _col(feat.flag_gt(nans, "x", 2, "f"), "f") == [0, 0, 1, 0, 0, 1]
    assert _col(feat.flag_le_quantile(nans, "x", 0.5, "f"), "f") == [1, 1, 0, 0, 0, 0]
    assert _col(feat.safe_ratio(nans, "customer_id", "x", "r"), "r")[3:5] == [0.0, 0.0]
    assert _col(feat.scale_by_max(nans, "x", "s"), "s")[:4] == [0.01, 0.02, 0.03, None]
    tier = _col(feat.minmax_mean(nans, ["x"], "t"), "t")
    assert tier[0] == 0.0 and tier[5] == 1.0 and tier[3] is None


def test_folds_keep_every_row_with_many_classes_and_null(spark):
    df = spark.range(4000).select(F.col("id").alias("customer_id"), F.nullif(F.col("id") % 70, F.lit(0)).alias("churned"))
    got = sp.assign_folds(df, k=5)
    assert got.count() == 4000 and got.select("customer_id").distinct().count() == 4000
    sizes = got.groupBy("churned", "fold").count().groupBy("churned").agg(F.max("count") - F.min("count")).collect()
    assert len(sizes) == 70 and max(s[1] for s in sizes) <= 1


def test_duplicate_keys_do_not_multiply(spark):
    df = spark.range(400).select((F.col("id") % 200).alias("customer_id"), (F.col("id") % 70).alias("churned"))
    assert sp.assign_folds(df, k=5).count() == 400


def test_null_keys_are_an_error(spark):
    df = spark.range(100).select(F.when(F.col("id") > 5, F.col("id")).alias("customer_id"), (F.col("id") % 2).alias("churned"))
    for f in (sp.random_split, sp.stratified_split, sp.assign_folds):
        with pytest.raises(ValueError, match="NULL"):
            f(df)


def test_leakage_is_found(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train"), (None, "train"), (None, "test")], "customer_id long, split string")
    with pytest.raises(ValueError, match="leakage"):
        sp.leakage_check(df)
    assert sp.leakage_check(df, fail=False).first()["n_overlap"] == 1


def _train(spark, n=1500):
    u = lambda s: (F.xxhash64(F.lit(s), "id") % 1000 + 1000) / 2000
    df = spark.range(n).select(F.col("id").alias("customer_id"), u(1).alias("a"), u(2).alias("b"), u(3).alias("c"))
    return df.withColumn("churned", (F.col("a") + 0.6 * F.col("c") > 0.8).cast("int")).cache()


SMALL = {"max_depth": 3, "n_estimators": 8, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}


def test_same_model_for_any_input_layout(spark):
    df, sums = _train(spark), []
    for n in (1, 4, 9):
        model, _, _, _ = mdl.train(df.repartition(n), "churned", SMALL, folds=0, partitions=3)
        sums.append(mdl.score(model, df, ["customer_id"]).agg(F.sum("probability_1")).first()[0])
    assert max(sums) - min(sums) < 1e-9
    df.unpersist()


def test_parameter_names(spark):
    p = mdl.spark_params({**SMALL, "objective": "binary:logistic", "eval_metric": "logloss", "early_stopping_rounds": 50, "maxBins": 64})
    assert p == {"maxDepth": 3, "maxIter": 8, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "seed": 42,
                 "validationIndicatorCol": mdl.VALID, "maxBins": 64}
    with pytest.raises(ValueError, match="unknown"):
        mdl.gbt("churned", {"max_deepness": 3})
    with pytest.raises(ValueError, match="objective"):
        mdl.gbt("churned", {"objective": "reg:squarederror"})


def test_early_stopping_shortens_a_fit(spark):
    noise = _train(spark).withColumn("churned", (F.xxhash64(F.lit(9), "customer_id") % 2 == 0).cast("int"))
    params = {**SMALL, "n_estimators": 40, "learning_rate": 0.5}
    trees = [mdl.train(noise, "churned", {**params, "early_stopping_rounds": r}, folds=0)[0].stages[-1].getNumTrees for r in (0, 10)]
    assert trees[0] == 40 > trees[1]


def test_nothing_stays_persisted(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    df = _train(spark, 300)
    model, feats, rec, _ = mdl.train(df, "churned", {**SMALL, "n_estimators": 3}, folds=2, source="x:v1", mode="local")
    _, ev_rec = mdl.evaluate(model, df, feats, generate_shap=False)
    df.unpersist()
    gc.collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    r, e = rec.first(), ev_rec.first()
    assert r["data_source"] == "x:v1" and r["mode"] == "local" and r["recorded_at"] is not None
    assert list(e["attribution"]) == [] and e["attribution_sample_size"] == 0


def _files(folder):
    return sum(len(f) for _, _, f in os.walk(folder.removeprefix("file:")))


def test_checkpoint_files_go(spark):
    folder = shared_dir(spark)

    def settle(most):
        for _ in range(40):
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            if _files(folder) <= most:
                break
            time.sleep(0.5)
        return _files(folder)

    settle(0)
    before = _files(folder)
    df = spark.range(2000).select(F.col("id").alias("customer_id"), (F.col("id") % 2).alias("churned"))
    out = sp.stratified_split(df)
    assert out.where("split = 'test'").count() == 400
    del out
    assert settle(before) <= before


def test_curve_and_histogram_plans(spark, monkeypatch):
    scored = spark.range(5000).select(F.col("id").alias("item_id"), (F.col("id") % 3 == 0).cast("int").alias("label"),
                                      ((F.col("id") * 37 % 1009) / 1009).alias("score"))
    whole = ev.roc_curve(scored).collect()
    monkeypatch.setattr(ev, "CURVE_BLOCK", 7)
    assert sorted(map(tuple, ev.roc_curve(scored).collect())) == sorted(map(tuple, whole))
    hist = ev.score_histogram(scored)
    assert sum(r["n"] for r in hist.collect()) == 5000
    plan = hist._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1      # the grid with the counts; scored rows are only aggregated
