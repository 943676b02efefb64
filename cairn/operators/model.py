"""Assembly, gradient-boosted trees, cross-validation,
importance, attribution and the one-row training / evaluation records.

Parameters in the common names train the second-order booster of ``boost.py``
(all folds and the final fit grow together); Spark's names train its
``GBTClassifier``.  Either is a stage of a ``PipelineModel``.  Metrics reuse
the evaluation operators, grouped by fold so k folds cost one metrics pass.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairn.functions.columns import hash_order, hash_uniform, r6
from cairn.operators import boost, evaluate as ev
from cairn.operators.ranking import global_rank, running_sum
from cairn.operators.select import NON_FEATURES
from cairn.operators.split import assign_folds
from cairn.operators.treeshap import tree_shap_attribution

# Model settings of the pipeline and of the library. TEST_PARAMS are the smaller trees and folds that the
# registered queries and the bench train, with the pipeline's subsampling.
PIPELINE_PARAMS = {"objective": "binary:logistic", "eval_metric": "auc", "max_depth": 6, "learning_rate": 0.1, "n_estimators": 100,
                   "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}
DEFAULT_PARAMS = {**PIPELINE_PARAMS, "eval_metric": "logloss", "n_estimators": 200}
TEST_PARAMS = {**PIPELINE_PARAMS, "n_estimators": 50, "max_depth": 4}
SPARK_PARAMS = dict(maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
PIPELINE_FOLDS, TEST_FOLDS = 5, 3
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
# The common names that Spark's GBT has an equal for.
PARAM_NAMES = {"max_depth": "maxDepth", "n_estimators": "maxIter", "learning_rate": "stepSize", "subsample": "subsamplingRate",
               "colsample_bytree": "featureSubsetStrategy", "random_state": "seed", "max_bins": "maxBins",
               "min_child_weight": "minInstancesPerNode"}
IMPLIED = {"objective": "binary:logistic", "eval_metric": "logloss"}    # what the classifier optimises anyway
EARLY_STOPPING = "early_stopping_rounds"
VALIDATION_SHARE = 0.1      # rows held out of a fit that may stop early
VALID = "__valid"


def spark_params(params: dict | None = None) -> dict:
    """Arguments of Spark's GBT from its own or the common parameter names; an unknown name or another objective raises.

    ``early_stopping_rounds`` (a positive number) switches early stopping on:
    boosting ends as soon as the loss of held-out rows no longer improves,
    however large the number, as Spark keeps no patience."""
    out, known = {}, {p.name for p in GBTClassifier().params}
    for name, value in (SPARK_PARAMS if params is None else params).items():
        to = PARAM_NAMES.get(name, name)
        if name == EARLY_STOPPING:
            if value:
                out["validationIndicatorCol"] = VALID
        elif name in IMPLIED:
            if value != IMPLIED[name]:
                raise ValueError(f"{name}={value!r}: only {IMPLIED[name]!r} is supported")
        elif to in known:
            out[to] = str(value) if to == "featureSubsetStrategy" else value
        else:
            raise ValueError(f"unknown model parameter {name!r}")
    return out


def training_frame(df: DataFrame, key: str, cols: list[str], partitions: int | None = None, seed: int = 42,
                   params: dict | None = None) -> DataFrame:
    """Rows in an order that does not depend on how the input was partitioned: dealt to
    ``partitions`` (default: the session's shuffle partitions) by a hash of the key and sorted in each.
    Bagging draws per partition and position, so the same count gives the same model; tree induction
    reads every partition once per level, so the count is chosen for the cluster's cores.
    With early stopping, a seeded hash of the key marks the validation rows."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.select(*cols)
    if "validationIndicatorCol" in spark_params(params):
        out = out.withColumn(VALID, hash_uniform(seed, key, "valid") < VALIDATION_SHARE)
    return out.repartition(n, F.col(key)).sortWithinPartitions(key, *[c for c in cols if c != key])


def second_order(params: dict | None) -> bool:
    """Whether parameters ask for the second-order booster: none of Spark's own names among them."""
    return not set(params or {}) & {p.name for p in GBTClassifier().params}


def model_features(df: DataFrame, target: str = "churned", exclude=NON_FEATURES + ("split", "fold")) -> list[str]:
    """P1 for training: every column except key, target and bookkeeping columns."""
    ex = set(exclude) | {target}
    return [c for c in df.columns if c not in ex]


def assembler(features: list[str], out: str = "features", missing: str = "error") -> VectorAssembler:
    """M1: dense feature vector; an invalid (NULL/NaN) value is an error (C6 runs first), or NaN with ``missing="keep"``."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=missing)


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return assembler(features, out).transform(df)


def gbt(target: str = "churned", params: dict | None = None) -> GBTClassifier:
    return GBTClassifier(labelCol=target, featuresCol="features", predictionCol="prediction", **spark_params(params))


def fit_gbt(df: DataFrame, features: list[str], target: str = "churned", params: dict | None = None) -> PipelineModel:
    """M2: assembler + gradient-boosted trees as one ``PipelineModel`` (see ``training_frame`` for its rows)."""
    valid = [VALID] if "validationIndicatorCol" in spark_params(params) else []
    train = df.select(*features, F.col(target).cast("double").alias(target), *valid)
    return Pipeline(stages=[assembler(features), gbt(target, params)]).fit(train)


def fit_boosted(df: DataFrame, features: list[str], target: str, key: str, fits: list[boost.Fit], rung=None) -> list[PipelineModel]:
    """M2: the second-order booster for every fit at once over one binned frame, as ``PipelineModel``s in their order."""
    cuts = boost.quantile_cuts(df, features, max(f.params.max_bins for f in fits))
    grown = boost.fit_many(df, features, target, key, fits, cuts, fits[0].params.random_state, rung)
    return [PipelineModel(stages=[assembler(features, missing="keep"), boost.model_of(f, cuts)]) for f in grown]


def score(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """M5: class at the 0.5 threshold (``prediction`` int) and positive-class
    probability (``probability_1``); input columns are kept."""
    out = model.transform(df)
    keep = df.columns if keep is None else keep
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability_1"))


def _auc_by_group(scored: DataFrame, label: str, prob: str, group: list[str]) -> DataFrame:
    """Exact ROC AUC per group via the distributed running sum over the score histogram."""
    y = F.col(label).cast("long")
    h = scored.groupBy(*group, prob).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    rs = running_sum(h, [F.col(prob).asc()], {"cneg": "neg"}, group)
    return rs.df.groupBy(*group).agg(
        F.when((F.sum("pos") > 0) & (F.sum("neg") > 0),
               F.sum(F.col("pos").cast("double") * (F.col("cneg") - 0.5 * F.col("neg")))
               / (F.sum("pos").cast("double") * F.sum("neg"))).alias("roc_auc"))


def metrics_by_group(scored: DataFrame, label: str = "churned", pred: str = "prediction",
                     prob: str = "probability_1", group: list[str] | None = None) -> DataFrame:
    """M6 (and per-fold M4): accuracy, precision, recall, F1, ROC AUC per group."""
    group = list(group or [])
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = scored.groupBy(*group).agg(
        F.count_if((y == 0) & (p == 0)).cast("double").alias("tn"), F.count_if((y == 0) & (p == 1)).cast("double").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("double").alias("fn"), F.count_if((y == 1) & (p == 1)).cast("double").alias("tp"))
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    m = c.select(*group, ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
                 ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"))
    auc = _auc_by_group(scored, label, prob, group)
    if not group:   # both sides are single-row aggregates: join them on a constant key
        m, auc, group = m.withColumn("__one", F.lit(1)), auc.withColumn("__one", F.lit(1)), ["__one"]
        return m.join(auc, group, "left").select(*[r6(k).alias(k) for k in METRICS])
    out = m.join(auc, group, "left")
    return out.select(*group, *[r6(k).alias(k) for k in METRICS])


def training_metrics(scored: DataFrame, label: str = "churned") -> DataFrame:
    """M6: the five training metrics as one row."""
    return metrics_by_group(scored, label)


def _fit_fold(folded: DataFrame, i: int, features, target, params, key) -> DataFrame:
    m = fit_gbt(folded.where(F.col("fold") != i), features, target, params)
    return score(m, folded.where(F.col("fold") == i), [key, target, "fold"])


def _fit_all(folded: DataFrame, features, target, params, key, k: int, final: bool, parallelism: int | None):
    """(final model or None, its seconds, held-out scores per fold)."""
    t0 = time.time()
    if second_order(params):
        p = boost.BoostParams.of(params)
        models = fit_boosted(folded, features, target, key, [boost.Fit(p, i) for i in range(k)] + [boost.Fit(p)] * final)
        parts = [score(models[i], folded.where(F.col("fold") == i), [key, target, "fold"]) for i in range(k)]
        return models[k] if final else None, time.time() - t0, parts

    def final_fit():
        m = fit_gbt(folded, features, target, params)
        return m, time.time() - t0

    # the final fit and the k fold fits are independent: run them as concurrent jobs
    with ThreadPoolExecutor(max_workers=_parallelism(folded.sparkSession, k + final, parallelism)) as pool:
        last = pool.submit(final_fit) if final else None
        fold_parts = [pool.submit(_fit_fold, folded, i, features, target, params, key) for i in range(k)]
        model, secs = last.result() if last else (None, 0.0)
        return model, secs, [f.result() for f in fold_parts]


def _fold_metrics(parts: list[DataFrame], target: str) -> DataFrame:
    held_out = parts[0]
    for p in parts[1:]:
        held_out = held_out.unionByName(p)
    held_out = held_out.persist(StorageLevel.MEMORY_AND_DISK)
    found = metrics_by_group(held_out, target, group=["fold"])
    out = held_out.sparkSession.createDataFrame(found.collect(), found.schema)     # one row per fold
    held_out.unpersist()
    return out


def _parallelism(spark: SparkSession, jobs: int, asked: int | None) -> int:
    """GBT fits that run at once: as asked, else two cores a fit."""
    return max(1, min(jobs, asked or spark.sparkContext.defaultParallelism // 2))


def _folded(df, features, target, k, key, seed, partitions, params) -> DataFrame:
    """The one persisted frame that all fits read, with a fold column where there are folds."""
    base = df.select(key, target, *features)
    if k:
        base = assign_folds(base, key, target, k, seed)
    if second_order(params):        # the same model for any layout
        return base.persist(StorageLevel.MEMORY_AND_DISK)
    return training_frame(base, key, base.columns, partitions, seed, params).persist(StorageLevel.MEMORY_AND_DISK)


def cross_validate(df: DataFrame, features: list[str], target: str = "churned", params: dict | None = None,
                   k: int = PIPELINE_FOLDS, key: str = "customer_id", seed: int = 42,
                   parallelism: int | None = None, partitions: int | None = None) -> DataFrame:
    """M4: stratified k-fold CV - k fits (one per fold, all metrics from it),
    then one grouped metrics pass over the union of held-out predictions.
    The fits grow together, or with Spark's GBT run as concurrent jobs.
    Returns (fold, accuracy, precision, recall, f1_score, roc_auc)."""
    params = PIPELINE_PARAMS if params is None else params
    folded = _folded(df, features, target, k, key, seed, partitions, params)
    _, _, parts = _fit_all(folded, features, target, params, key, k, False, parallelism)
    out = _fold_metrics(parts, target)
    folded.unpersist()
    return out


def grid_search(df: DataFrame, features: list[str], grid: dict[str, list], params: dict | None = None, target: str = "churned",
                k: int = PIPELINE_FOLDS, key: str = "customer_id", seed: int = 42, rungs: list[int] | None = None, keep: float = 0.5) -> DataFrame:
    """M4 with a parameter grid: every combination of ``grid`` over ``params``, k folds each, all grown together.

    ``rungs`` are numbers of rounds after which only the share ``keep`` of the combinations goes on (at least one), those with the
    best mean of ``eval_metric`` over the folds (ties: the earlier combination); the others keep what they have grown.  Returns a row per
    combination and fold: cell, params (JSON of the grid's names), fold, rounds, dropped_at (the rung, or NULL), and the five metrics.
    A combination that no rung drops has the metrics of ``cross_validate`` with its parameters and ``max_bins``."""
    params = dict(PIPELINE_PARAMS if params is None else params)
    if "max_bins" in grid or "early_stopping_rounds" in grid:
        raise ValueError("max_bins and early_stopping_rounds are the same for all combinations")
    cells = [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]
    specs = [boost.BoostParams.of({**params, **c}) for c in cells]
    fits = [boost.Fit(p, i, watch="fold") for p in specs for i in range(k)]
    better = -1 if boost.HIGHER_IS_BETTER[specs[0].eval_metric] else 1
    dropped: dict[int, int] = {}

    def rung(step: int, _):
        if step not in (rungs or []):
            return
        going = [c for c in range(len(cells)) if c not in dropped]
        means = {c: [f.history[-1][1] for f in fits[c * k:(c + 1) * k]] for c in going}
        known = {c: sum(m) / k for c, m in means.items() if None not in m}
        order = sorted(going, key=lambda c: (c not in known, better * known.get(c, 0.0), c))
        for c in order[max(1, int(len(going) * keep)):]:
            dropped[c] = step
            for f in fits[c * k:(c + 1) * k]:
                f.done = True

    folded = assign_folds(df.select(key, target, *features), key, target, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    models = fit_boosted(folded, features, target, key, fits, rung)
    held_out = boost.margins_by_fold(folded.where(F.col("fold").between(0, k - 1)), features, [m.stages[-1] for m in models], k)
    p = 1 / (1 + F.exp(-F.col("margin")))
    scored = (held_out.select("fold", target, F.posexplode("margins").alias("cell", "margin"))
              .select("cell", "fold", target, (p > 0.5).cast("int").alias("prediction"), p.alias("probability_1"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    found = {(r["cell"], r["fold"]): r for r in metrics_by_group(scored, target, group=["cell", "fold"]).collect()}     # a row per fit
    scored.unpersist()
    folded.unpersist()
    rows = [(c, json.dumps(cells[c], sort_keys=True), i, len(fits[c * k + i].trees), dropped.get(c), *[found[c, i][m] if (c, i) in found else None for m in METRICS])
            for c in range(len(cells)) for i in range(k)]
    return df.sparkSession.createDataFrame(rows, "cell int, params string, fold int, rounds int, dropped_at int, " + ", ".join(f"{m} double" for m in METRICS))


def cv_summary(folds: DataFrame) -> DataFrame:
    """M4 summary: (metric, mean, std (population), scores ordered by fold)."""
    long = folds.select("fold", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v"))
                                                   for m in METRICS])).alias("s")).select("fold", "s.*")
    return long.groupBy("metric").agg(
        r6(F.avg("v")).alias("mean"), r6(F.stddev_pop("v")).alias("std"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "v"))), lambda s: s["v"]).alias("scores"))


def importance(model: PipelineModel, features: list[str], k: int | None = 10) -> DataFrame:
    """M7: (feature, importance) sorted descending (ties by name), top k.
    Shares that sum to 1: mean gain of a feature's splits, or with Spark's GBT its own measure."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), F.col("feature"))
    return df.limit(k) if k else df


def permutation_attribution(model: PipelineModel, df: DataFrame, features: list[str], key: str = "customer_id",
                            n: int | None = None, seed: int = 42) -> DataFrame:
    """Permutation attribution (a model-agnostic companion to E11's tree SHAP in
    ``treeshap.py``): mean |p - p_permuted| per feature over all rows, or over a seeded sample of ``n``.

    For each feature the rows are scored once more with that column taken
    from another row (pairing by two seeded hash orders: distributed ranks
    and a join).  All permuted copies are unioned and scored in one transform."""
    rows = df.select(key, *features)
    rows = rows if n is None else ev.sample_rows(rows, key, n, seed)
    base = global_rank(rows, [hash_order(seed, key), F.col(key)], out="__r").df.persist(StorageLevel.MEMORY_AND_DISK)
    permuted = None
    for f in features:
        donors = global_rank(base.select(key, F.col(f).alias("__v")),
                             [hash_order(seed + 1, F.concat(F.lit(f + ":"), F.col(key).cast("string"))), F.col(key)], out="__r").df
        perm = base.join(donors.select("__r", "__v"), "__r").select(
            F.lit(f).alias("__feature"), key, *[F.col("__v").alias(c) if c == f else F.col(c) for c in features])
        permuted = perm if permuted is None else permuted.unionByName(perm)
    p0 = score(model, base.select(key, *features), [key]).select(key, F.col("probability_1").alias("p0"))
    pp = score(model, permuted, ["__feature", key]).select("__feature", key, F.col("probability_1").alias("pp"))
    att = pp.join(p0, key).groupBy(F.col("__feature").alias("feature")) \
        .agg(r6(F.avg(F.abs(F.col("pp") - F.col("p0")))).alias("attribution")) \
        .orderBy(F.col("attribution").desc(), F.col("feature"))
    out = df.sparkSession.createDataFrame(att.collect(), "feature string, attribution double")     # one row per feature
    base.unpersist()
    return out


RECORD_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("model_version", T.StringType()),
    T.StructField("model_type", T.StringType()), T.StructField("training_samples", T.LongType()),
    T.StructField("feature_count", T.IntegerType()), T.StructField("target_column", T.StringType()),
    T.StructField("training_time_seconds", T.DoubleType()),
    T.StructField("hyperparameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("cv_folds", T.IntegerType()),
    T.StructField("cv_scores", T.ArrayType(T.StructType([
        T.StructField("metric", T.StringType()), T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()), T.StructField("scores", T.ArrayType(T.DoubleType()))]))),
    T.StructField("training_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("top_features", T.ArrayType(T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]))),
    T.StructField("recorded_at", T.TimestampType()), T.StructField("data_source", T.StringType()),
    T.StructField("mode", T.StringType()),
])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def training_record(spark, name: str, version: str, n_train: int, features: list[str], target: str,
                    seconds: float, params: dict, folds: int, cv: DataFrame | None, metrics: DataFrame,
                    top: DataFrame, source: str | None = None, mode: str = "cluster", kind: str = "BoostedTreesModel") -> DataFrame:
    """M8: one-row nested record of the training run (all inputs already small)."""
    cv_rows = [] if cv is None else [(r["metric"], r["mean"], r["std"], list(r["scores"])) for r in cv.collect()]
    m = metrics.first().asDict()
    row = (name, version, kind, int(n_train), len(features), target, float(seconds),
           {k: str(v) for k, v in params.items()}, int(folds), cv_rows, {k: m[k] for k in METRICS},
           list(features), [(r["feature"], r["importance"]) for r in top.collect()], _now(), source, mode)
    return spark.createDataFrame([row], RECORD_SCHEMA)


def train(df: DataFrame, target: str = "churned", params: dict | None = None, folds: int = PIPELINE_FOLDS,
          key: str = "customer_id", name: str = "gbt_churn_model", version: str = "v1", seed: int = 42,
          parallelism: int | None = None, partitions: int | None = None, source: str | None = None,
          mode: str = "cluster"):
    """Train step: CV, final fit, training metrics, importance, record.
    Returns (model, features, record DataFrame, cv fold table); nothing stays persisted."""
    features = model_features(df, target, exclude=(*NON_FEATURES, "split", "fold", key))
    k = folds if folds and folds > 1 else 0
    params = PIPELINE_PARAMS if params is None else params
    folded = _folded(df, features, target, k, key, seed, partitions, params)
    n = folded.count()
    model, secs, parts = _fit_all(folded, features, target, params, key, k, True, parallelism)
    cv = _fold_metrics(parts, target) if k else None
    metrics = training_metrics(score(model, folded, [key, target]), target)
    rec = training_record(df.sparkSession, name, version, n, features, target, secs,
                          dict(params), folds or 0, cv_summary(cv) if cv is not None else None, metrics,
                          importance(model, features, 10), source, mode, type(model.stages[-1]).__name__)
    folded.unpersist()
    return model, features, rec, cv


EVAL_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType()), T.StructField("model_version", T.StringType()),
    T.StructField("test_samples", T.LongType()), T.StructField("feature_count", T.IntegerType()),
    T.StructField("performance_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("confusion_matrix", T.MapType(T.StringType(), T.LongType())),
    T.StructField("classification_report", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()), T.StructField("f1_score", T.DoubleType()),
        T.StructField("support", T.LongType())]))),
    T.StructField("attribution", T.ArrayType(T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("attribution", T.DoubleType())]))),
    T.StructField("attribution_error", T.StringType()),
    T.StructField("attribution_sample_size", T.IntegerType()),
    T.StructField("prediction_time_seconds", T.DoubleType()),
    T.StructField("feature_columns", T.ArrayType(T.StringType())),
    T.StructField("recorded_at", T.TimestampType()), T.StructField("data_source", T.StringType()),
    T.StructField("mode", T.StringType()),
])


def evaluate(model: PipelineModel, test: DataFrame, features: list[str], target: str = "churned",
             key: str = "customer_id", name: str = "gbt_churn_model", version: str = "v1",
             attribution_rows: int = 100, seed: int = 42, generate_shap: bool = True, source: str | None = None,
             mode: str = "cluster"):
    """Evaluate step: scores, E1-E13 and the E14 record (without attribution when ``generate_shap`` is off).
    Returns (scored DataFrame, record DataFrame); the scores are computed anew where they are read again."""
    t0 = time.time()
    result = score(model, test, [key, target])
    scored = result.persist(StorageLevel.MEMORY_AND_DISK)
    n = scored.count()
    secs = time.time() - t0
    s = scored.select(F.col(target).alias("label"), "prediction", F.col("probability_1").alias("score"))
    spark = test.sparkSession
    # E1 once; E2-E4 and E6 derive from its four counts without another pass
    conf = ev.confusion(s).first().asDict()
    c = spark.createDataFrame([conf], "tn long, fp long, fn long, tp long")
    basic = ev.metrics_from_confusion(c).first().asDict()
    rep = [tuple(r) for r in ev.class_report_from_confusion(c).collect()]

    def attribution():
        if not generate_shap:
            return [], None
        try:
            return [tuple(r) for r in tree_shap_attribution(model, test, features, key,
                                                            attribution_rows, seed).collect()], None
        except Exception as e:  # attribution failure becomes part of the record
            return [], str(e)

    with ThreadPoolExecutor(max_workers=2) as pool:   # independent jobs: AUC and attribution
        auc = pool.submit(lambda: ev.roc_auc(s).first()["roc_auc"])  # noqa: B023
        att_f = pool.submit(attribution)
        basic["roc_auc"] = auc.result()
        att, err = att_f.result()
    row = (name, version, int(n), len(features), {k: (None if v is None else float(v)) for k, v in basic.items()},
           {k: int(v) for k, v in conf.items()}, rep, att, err, int(min(attribution_rows, n)) if generate_shap else 0, float(secs),
           list(features), _now(), source, mode)
    scored.unpersist()
    return result, test.sparkSession.createDataFrame([row], EVAL_SCHEMA)
