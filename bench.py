"""Headline-query benchmark.

Runs the pipeline's headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric", "value" (sum of per-query medians, sec), "unit", "queries", "sf", ...}.

Each query is fully materialised with the ``noop`` sink (every row computed,
nothing collected).  One warm-up run, then the median of ``$BENCH_RUNS``
timed runs (default 3).  Model training uses TEST_PARAMS
(50 trees, depth 4, 3-fold CV + final fit).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cairn.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    memory = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = get_session(f"local[{cpus}]", int(cpus), app_name="cairn-bench",
                        extra={"spark.driver.memory": memory})
    from cairn.operators import evaluate as ev, model as mdl, split as sp
    from cairn.plans import pipeline, queries as q
    from cairn.sources import views

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    def preprocess_engineer():
        sink(pipeline.engineer(pipeline.preprocessed_view(spark, sf_dir)))

    def flagship():
        sink(q.QUERIES["flagship_region_churn"](spark, sf_dir))

    def split_checks():
        s = sp.stratified_split(pipeline.engineer(pipeline.preprocessed_view(spark, sf_dir)))
        s = s.persist()
        sink(s)
        for r in (sp.balance_report(s), sp.drift_report(s), sp.leakage_check(s), sp.split_summary(s),
                  sp.assign_folds(s.select("customer_id", "churned"))):
            sink(r)
        s.unpersist()

    def evaluation_curves():
        sc = views.labelled_scores(spark, sf_dir)
        c = ev.confusion(sc).first().asDict()
        conf = spark.createDataFrame([c], "tn long, fp long, fn long, tp long")
        curve = ev.score_curve(sc)          # one running sum serves AUC, ROC and PR
        for r in (ev.metrics_from_confusion(conf), ev.class_report_from_confusion(conf),
                  ev.roc_auc(sc, curve=curve), ev.roc_curve(sc, curve=curve), ev.pr_curve(sc, curve=curve),
                  ev.score_histogram(sc), ev.sample_rows(sc, "item_id")):
            sink(r)

    def train_evaluate():
        s = sp.stratified_split(pipeline.engineer(pipeline.preprocessed_view(spark, sf_dir))).persist()
        tr, te = sp.train_test(s)
        model, feats, rec, cv = mdl.train(tr, "churned", mdl.TEST_PARAMS, mdl.TEST_FOLDS)
        sink(rec)
        _, erec = mdl.evaluate(model, te, feats)
        sink(erec)
        s.unpersist()

    benches = {"preprocess_engineer": preprocess_engineer, "flagship_region_churn": flagship,
               "split_and_checks": split_checks, "evaluation_curves": evaluation_curves,
               "train_cv_evaluate": train_evaluate}
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    results = {}
    for name, fn in benches.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        times = []
        for _ in range(runs):
            t = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t)
        results[name] = round(statistics.median(times), 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "master": f"local[{cpus}]", "cores": int(cpus), "driver_memory": memory,
                      "shuffle_partitions": int(cpus), "runs": runs, "stat": "median after 1 warm-up"}))


if __name__ == "__main__":
    main()
