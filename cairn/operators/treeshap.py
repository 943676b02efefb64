"""Exact path-dependent tree SHAP values for a fitted GBT pipeline.

The reference explains its booster with tree SHAP on a sample of at most 100
test rows and ranks features by mean |SHAP|.  Here the same values are computed
as a Spark job:

* The model's node table (what ``model.write()`` stores: per node the
  prediction, the training row count used as cover, children and split) is read
  back with Spark.  Its size is bounded by the model parameters
  (trees x 2^(depth+1) nodes), not by the data, and is checked before it is
  collected.  Root-to-leaf paths are built once on the driver, where the model
  already lives, and broadcast like any model that scores rows.
* Rows stay distributed: ``mapInPandas`` computes every row's SHAP vector,
  vectorised over rows and leaves with numpy, then mean |SHAP| per feature is
  a Spark aggregation.

Method: the path-dependent value function v(S) is a sum over leaves of
``v_leaf * prod_j (o_j if j in S else z_j)`` over the distinct features j on
the leaf's path, where ``z_j`` is the product of cover ratios of the splits on
j and ``o_j`` says whether the row satisfies all of them.  The Shapley value of
one leaf's product game has a closed form through the coefficients of
``prod_{j != i} (z_j + o_j t)`` (the path decomposition published for GPU tree
SHAP, Mitchell et al. 2022).  The full product is built once per leaf and each
slot's factor divided out, so a leaf costs O(d^2) per row with d <= depth.

The second-order booster's trees (``boost.py``) go the same way with their own
margins, hessian covers and directions for missing values.

Values are in log-odds: Spark's GBT margin F gives P(y=1) = 1 / (1 + exp(-2F)),
so log-odds = 2F, and the base value plus a row's SHAP values sum to it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairn.functions.columns import r6
from cairn.operators.boost import BoostedTreesModel
from cairn.session import shared_dir

# The task-side kernel travels with the task (pickled by value), so Python
# workers need only numpy and pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Upper bound on model nodes collected to the driver; a 1000-tree depth-10
# model has about 2M nodes.  Beyond it the model itself is the problem.
MAX_MODEL_NODES = 4_000_000
# Working memory per numpy block inside a task: about 6 arrays of rows x leaves x (d + 1) doubles.
BLOCK_BYTES = 64 << 20
LOGIT_SCALE = 2.0        # Spark's logistic loss is on 2F


def _gbt_stage(model):
    stage = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not hasattr(stage, "treeWeights"):
        raise TypeError("tree SHAP needs a fitted GBT model as the last pipeline stage")
    return stage


def _node_table(stage, spark: SparkSession | None = None) -> pd.DataFrame:
    """The model's nodes as written by Spark ML persistence, read back with Spark."""
    spark = spark or SparkSession.getActiveSession()
    path = shared_dir(spark, "cairn-treeshap-model")
    stage.write().overwrite().save(path)
    nodes = (spark.read.parquet(path + "/data")
             .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount",
                     "nodeData.leftChild", "nodeData.rightChild",
                     F.col("nodeData.split.featureIndex").alias("feature"),
                     F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
                     F.col("nodeData.split.numCategories").alias("num_categories")))
    rows = nodes.limit(MAX_MODEL_NODES + 1).toPandas()
    if len(rows) > MAX_MODEL_NODES:
        raise ValueError(f"model has more than {MAX_MODEL_NODES} nodes")
    if (rows["num_categories"] >= 0).any():
        raise ValueError("categorical splits are not supported (features are assembled as continuous)")
    return rows


def _booster_leaves(stage) -> Iterator[tuple[float, dict]]:
    """(value, slots) of every leaf of the second-order booster, whose nodes are on the driver; covers are hessian sums."""
    for _, t in stage.nodes.groupby("tree"):
        by_id = {int(r.node): r for r in t.itertuples(index=False)}
        stack = [(0, {})]
        while stack:
            nid, slots = stack.pop()
            n = by_id[nid]
            if n.feature < 0:
                yield float(n.value), slots
                continue
            for child, go_left in ((2 * nid + 1, True), (2 * nid + 2, False)):
                ratio = float(by_id[child].cover) / float(n.cover) if n.cover > 0 else 0.0
                lo, hi, z, blank = slots.get(int(n.feature), (-math.inf, math.inf, 1.0, True))
                bounds = (lo, min(hi, n.cut)) if go_left else (max(lo, n.cut), hi)
                stack.append((child, {**slots, int(n.feature): (*bounds, z * ratio, blank and bool(n.missing_left) == go_left)}))


def leaf_paths(model, spark: SparkSession | None = None) -> tuple[dict, float]:
    """Root-to-leaf paths grouped by the number d of distinct features on them.

    Returns ({d: dict(value (L,), feat (L,d), lo (L,d), hi (L,d), z (L,d), blank (L,d))},
    base value).  A row satisfies slot j when lo < x[feat] <= hi, or where x[feat] is missing and blank holds."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(last, BoostedTreesModel):
        groups, base = {}, last.base
        for v, slots in _booster_leaves(last):
            base += v * math.prod(s[2] for s in slots.values())
            if slots:
                groups.setdefault(len(slots), []).append((v, slots))
        return _grouped(groups), base
    stage = _gbt_stage(model)
    weights = list(stage.treeWeights)
    nodes = _node_table(stage, spark)
    groups: dict[int, list] = {}
    base = 0.0
    for tree_id, t in nodes.groupby("treeID"):
        by_id = {int(r.id): r for r in t.itertuples(index=False)}
        w = float(weights[int(tree_id)]) * LOGIT_SCALE
        stack = [(0, {})]          # (node id, {feature: [lo, hi, z]})
        while stack:
            nid, slots = stack.pop()
            n = by_id[nid]
            if n.leftChild < 0:
                v = w * float(n.prediction)
                base += v * math.prod(s[2] for s in slots.values())
                if slots:
                    groups.setdefault(len(slots), []).append((v, slots))
                continue
            cover = float(n.rawCount)
            f, thr = int(n.feature), float(n.threshold)
            for child, go_left in ((int(n.leftChild), True), (int(n.rightChild), False)):
                ratio = float(by_id[child].rawCount) / cover if cover > 0 else 0.0
                lo, hi, z, _ = slots.get(f, (-math.inf, math.inf, 1.0, False))
                s = dict(slots)
                s[f] = (lo, min(hi, thr), z * ratio, False) if go_left else (max(lo, thr), hi, z * ratio, False)
                stack.append((child, s))
    return _grouped(groups), base


def _grouped(groups: dict[int, list]) -> dict:
    out = {}
    for d, leaves in groups.items():
        feats = [sorted(s) for _, s in leaves]
        out[d] = dict(value=np.array([v for v, _ in leaves]),
                      feat=np.array(feats, dtype=np.int64),
                      lo=np.array([[s[f][0] for f in fs] for (_, s), fs in zip(leaves, feats)]),
                      hi=np.array([[s[f][1] for f in fs] for (_, s), fs in zip(leaves, feats)]),
                      z=np.array([[s[f][2] for f in fs] for (_, s), fs in zip(leaves, feats)]),
                      blank=np.array([[s[f][3] for f in fs] for (_, s), fs in zip(leaves, feats)]))
    return out


def _shapley_weights(d: int) -> np.ndarray:
    """w_k = k! (d-k-1)! / d! for coalitions of size k = 0..d-1."""
    return np.array([math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)])


def shap_block(x: np.ndarray, paths: dict, n_features: int) -> np.ndarray:
    """SHAP values (rows, features) for a block of rows ``x`` (rows, features).

    Per leaf: the coefficients of P(t) = prod_j (z_j + o_j t) once, then for
    each slot i the quotient P / (z_i + o_i t) by synthetic division (downward,
    multiplying errors by z_i <= 1; a constant divisor when o_i = 0), so a
    leaf costs O(d^2) per row."""
    phi = np.zeros((x.shape[0], n_features))
    for d, g in paths.items():
        xo = x[:, g["feat"]]                                         # (R, L, d)
        o = np.where(np.isnan(xo), g.get("blank", False), (xo > g["lo"]) & (xo <= g["hi"]))
        o = np.ascontiguousarray(o.transpose(2, 0, 1), dtype=np.float64)
        z, w, v = g["z"].T, _shapley_weights(d), g["value"]          # z: (d, L); o: (d, R, L)
        p = np.zeros((d + 1,) + o.shape[1:])                         # coefficient planes, degree first
        p[0] = 1.0
        for j in range(d):                       # multiply by (z_j + o_j t); degree is j before
            top = p[:j + 1] * o[j]
            p[:j + 1] *= z[j]
            p[1:j + 2] += top
        pw = np.tensordot(w, p[:d], axes=1)      # sum_k w_k p_k, shared by every o_i = 0 quotient
        onehot = np.zeros((len(v), n_features))
        leaves = np.arange(len(v))
        for i in range(d):
            zi, oi = z[i], o[i]
            q = p[d].copy()                      # o_i = 1: divide by (z_i + t), top coefficient down
            s1 = w[d - 1] * q
            for k in range(d - 1, 0, -1):
                q = p[k] - zi * q
                s1 += w[k - 1] * q
            s0 = pw / np.where(zi > 0, zi, 1.0)  # o_i = 0: divide by the constant z_i
            contrib = v * (oi - zi) * np.where(oi > 0, s1, s0)      # (R, L)
            onehot[:] = 0.0
            onehot[leaves, g["feat"][:, i]] = 1.0
            phi += contrib @ onehot
    return phi


def rows_per_block(paths: dict, budget: int = BLOCK_BYTES) -> int:
    """Rows per numpy block so the block's arrays stay within ``budget`` bytes."""
    per_row = max((len(g["value"]) * (d + 1) for d, g in paths.items()), default=1) * 8 * 6
    return max(1, budget // per_row)


def shap_values(model, df: DataFrame, features: list[str], key: str = "customer_id") -> DataFrame:
    """(key, base_value, shap array<double> in ``features`` order) for every row of ``df``."""
    spark = df.sparkSession
    paths, base = leaf_paths(model, spark)
    bc = spark.sparkContext.broadcast(paths)
    nf = len(features)
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("base_value", T.DoubleType()),
                           T.StructField("shap", T.ArrayType(T.DoubleType()))])

    step = rows_per_block(paths)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = bc.value
        for b in batches:
            x = b[features].to_numpy(dtype=np.float64)
            for s in range(0, len(b), step):
                phi = shap_block(x[s:s + step], p, nf)
                yield pd.DataFrame({key: b[key].iloc[s:s + step].to_numpy(),
                                    "base_value": base, "shap": list(phi)})

    rows = df.select(key, *[F.col(f).cast("double").alias(f) for f in features])
    return rows.mapInPandas(run, schema)


def shap_attribution(model, df: DataFrame, features: list[str], key: str = "customer_id") -> DataFrame:
    """(feature, attribution = mean |SHAP|) over the rows of ``df``, ranked
    descending with ties by name; every feature is listed."""
    names = F.array(*[F.lit(f) for f in features])
    long = shap_values(model, df, features, key).select(F.posexplode("shap").alias("i", "v"))
    return (long.groupBy("i").agg(r6(F.avg(F.abs("v"))).alias("attribution"))
                .select(F.element_at(names, F.col("i") + 1).alias("feature"), "attribution")
                .orderBy(F.col("attribution").desc(), F.col("feature")))


def tree_shap_attribution(model, df: DataFrame, features: list[str], key: str = "customer_id",
                          n: int = 100, seed: int = 42) -> DataFrame:
    """E11 as in the reference: mean |SHAP| on a seeded sample of at most n rows."""
    from cairn.operators.evaluate import sample_rows
    return shap_attribution(model, sample_rows(df.select(key, *features), key, n, seed), features, key)
