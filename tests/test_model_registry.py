import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import model as mdl
from cairn.session import shared_dir
from cairn.sources import models as mstore, registry as reg

SMALL = dict(maxIter=5, maxDepth=2, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)


def _train_frame(spark, n=300):
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        a, b = rnd.random(), rnd.random()
        rows.append((i, int(a + 0.3 * rnd.random() > 0.7), a, b, a > 0.5))
    return spark.createDataFrame(rows, "customer_id long, churned int, a double, b double, flag boolean")


def test_train_score_importance_attribution(spark):
    df = _train_frame(spark)
    model, feats, rec, cv = mdl.train(df, "churned", SMALL, folds=3)
    assert feats == ["a", "b", "flag"]
    scored = mdl.score(model, df, ["customer_id", "churned"])
    p = scored.agg(F.min("probability_1"), F.max("probability_1")).first()
    assert 0.0 <= p[0] <= p[1] <= 1.0
    imp = mdl.importance(model, feats, None).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert cv.count() == 3
    r = rec.first()
    assert r["feature_count"] == 3 and len(r["cv_scores"]) == 5 and r["training_samples"] == 300
    att = mdl.permutation_attribution(model, df, feats, "customer_id", 50, 1).collect()
    assert {x["feature"] for x in att} == set(feats)
    _, erec = mdl.evaluate(model, df, feats, attribution_rows=20)
    er = erec.first()
    assert er["test_samples"] == 300
    assert er["attribution_error"] is None and {a["feature"] for a in er["attribution"]} == set(feats)
    assert er["attribution_sample_size"] == 20


def test_registry_versions_and_model_roundtrip(spark):
    root = shared_dir(spark, "test-registry")
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "customer_id long, x double")
    for v in ("v1", "v9", "v10", "beta"):
        reg.register_view(df.withColumn("x", F.col("x") + len(v)), root, "feat", ["customer_id"], v)
    r = reg.registry(spark, root)
    assert reg.latest_version(r, "feat") == "v10"
    assert reg.resolve_version(r, "feat", None) == "v1"
    assert reg.resolve_version(r, "feat", "current", defaults={"feat": "v9"}) == "v9"
    assert reg.read_view(spark, root, "feat", "latest").count() == 2
    assert reg.find_view(r, ["nope", "feat"]) == "feat"
    with pytest.raises(ValueError, match="duplicate"):
        reg.register_view(df.union(df), root, "dup", ["customer_id"], "v1")
    with pytest.raises(ValueError, match="NULL"):
        reg.register_view(spark.createDataFrame([(None, 1.0), (None, 2.0)], "customer_id long, x double"),
                          root, "nul", ["customer_id"], "v1")
    assert reg.check_keys(df, ["customer_id"]) == 2
    with pytest.raises(KeyError):
        reg.describe_view(r, "nope")
    model = mdl.fit_gbt(_train_frame(spark), ["a", "b"], "churned", SMALL)
    mstore.save_model(model, root, "m", "v2")
    loaded = mstore.load_model(spark, root, "m", "latest")
    assert len(loaded.stages) == 2
