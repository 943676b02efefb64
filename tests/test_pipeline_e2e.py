"""End to end, as the reference's own tests do: all six steps run and every output exists."""

from pyspark.sql import functions as F

from cairn.plans import pipeline
from cairn.session import shared_dir
from cairn.sources import models as mstore, registry as reg
from conftest import SF_SMALL

SMALL = dict(maxIter=5, maxDepth=3, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)


def test_pipeline_runs_and_registers_outputs(spark):
    root = shared_dir(spark, "t-e2e")
    out = pipeline.run(spark, SF_SMALL, root, SMALL, folds=2)
    names = {r["name"] for r in reg.list_views(reg.registry(spark, root), "view").collect()}
    assert names == {"customer_transactions", "customer_demographics", "preprocessed_customer_features",
                     "engineered_customer_features", "train_customer_features", "test_customer_features"}
    r = reg.registry(spark, root)
    n_tr = r.where(F.col("name") == "train_customer_features").first()["n_rows"]
    n_te = r.where(F.col("name") == "test_customer_features").first()["n_rows"]
    n_all = r.where(F.col("name") == "engineered_customer_features").first()["n_rows"]
    assert n_tr + n_te == n_all and n_te == -(-n_all * 2 // 10)
    assert len(mstore.load_model(spark, root, "gbt_churn_model", "latest").stages) == 2
    assert {m["metric"] for m in out["metrics"].collect()} >= {"accuracy", "roc_auc", "f1_score"}
    assert spark.read.parquet(f"{root}/predictions/gbt_churn_model/v1").count() == n_te
    assert out["coverage"].first()["coverage"] == 1.0
    assert out["leakage"].first()["n_overlap"] == 0
    steps = {r["step"] for r in spark.read.json(f"{root}/_runs").collect()}
    assert steps == {"generate", "preprocess", "engineer", "split", "train", "evaluate"}
    trained, judged = (reg.read_records(spark, root, k).collect() for k in ("training", "evaluation"))
    assert len(trained) == len(judged) == 1
    assert trained[0].asDict(True) == out["training"].first().asDict(True) and judged[0].asDict(True) == out["evaluation"].first().asDict(True)
    made = next(r for r in spark.read.json(f"{root}/_runs").collect() if r["step"] == "generate")["stats"]
    assert made["n_rows"] == r.where(F.col("name") == "customer_transactions").first()["n_rows"] and made["n_columns"] == 5
    assert 0 < made["target_rate"] < 1
    eng = reg.read_view(spark, root, "engineered_customer_features", "v1")
    assert not [c for c, t in eng.dtypes if t in ("string", "date")]


def test_pipeline_takes_inputs_and_other_names(spark):
    from cairn.sources import generate as gen
    parts = gen.split_vertical(gen.generate_customers(spark, n=300, positive_rate=0.3, seed=1))
    trans = parts["transactions"].withColumnRenamed("customer_id", "who").withColumnRenamed("churned", "left_us")
    demo = parts["demographics"].withColumnRenamed("customer_id", "who")
    params = {"max_depth": 2, "n_estimators": 3, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}
    out = pipeline.run(spark, None, shared_dir(spark, "t-e2e"), params, folds=2, inputs=(trans, demo), key="who",
                       target="left_us", stratify="is_high_support", generate_shap=False, as_of="2024-01-01")
    r = out["training"].first()
    assert r["target_column"] == "left_us" and "who" not in r["feature_columns"] and "left_us" not in r["feature_columns"]
    assert out["evaluation"].first()["test_samples"] == 60
