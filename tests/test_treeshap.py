import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cairn.operators import model as mdl, treeshap as ts

PARAMS = dict(maxIter=6, maxDepth=3, stepSize=0.3, subsamplingRate=0.8, featureSubsetStrategy="all", seed=7)
FEATS = ["a", "b", "c", "d"]


def _frame(spark, n=400):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        a, b, c, d = rnd.random(), rnd.random(), rnd.randint(0, 4), rnd.random()
        y = int(a + 0.5 * b + 0.1 * c + 0.4 * rnd.random() > 1.0)
        rows.append((i, y, a, b, float(c), d))
    return spark.createDataFrame(rows, "customer_id long, churned int, a double, b double, c double, d double")


@pytest.fixture(scope="module")
def fitted(spark):
    df = _frame(spark)
    return df, mdl.fit_gbt(df, FEATS, "churned", PARAMS)


def test_values_add_up_to_the_margin(fitted):
    df, model = fitted
    vals = ts.shap_values(model, df, FEATS, "customer_id")
    raw = model.transform(df).select("customer_id", (vector_to_array("rawPrediction")[1] * 2).alias("logit"))
    got = vals.join(raw, "customer_id").select(
        (F.col("base_value") + F.aggregate("shap", F.lit(0.0), lambda s, v: s + v) - F.col("logit")).alias("gap"))
    assert got.count() == df.count()
    assert got.agg(F.max(F.abs("gap"))).first()[0] < 1e-9


def _brute_force(model, x: list[float]) -> list[float]:
    """Shapley values of v(S) = sum over trees of the path-dependent expectation,
    by enumerating every subset (independent of the leaf-path formula)."""
    stage = model.stages[-1]
    nodes = ts._node_table(stage)
    trees = {t: {int(r.id): r for r in g.itertuples(index=False)} for t, g in nodes.groupby("treeID")}

    def expect(tree, nid, s):
        n = tree[nid]
        if n.leftChild < 0:
            return float(n.prediction)
        left, right = tree[int(n.leftChild)], tree[int(n.rightChild)]
        if int(n.feature) in s:
            nxt = left if x[int(n.feature)] <= n.threshold else right
            return expect(tree, int(nxt.id), s)
        return (left.rawCount * expect(tree, int(left.id), s)
                + right.rawCount * expect(tree, int(right.id), s)) / n.rawCount

    def v(s):
        return sum(2 * w * expect(trees[t], 0, s) for t, w in enumerate(stage.treeWeights))

    m = len(x)
    phi = [0.0] * m
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            wk = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
            for s in itertools.combinations(others, k):
                phi[i] += wk * (v(set(s) | {i}) - v(set(s)))
    return phi


def test_matches_brute_force_shapley(fitted):
    df, model = fitted
    sample = df.orderBy("customer_id").limit(5)
    got = {r["customer_id"]: r["shap"] for r in ts.shap_values(model, sample, FEATS, "customer_id").collect()}
    for r in sample.collect():
        want = _brute_force(model, [r[f] for f in FEATS])
        assert np.allclose(got[r["customer_id"]], want, atol=1e-9)


def test_attribution_ranks_every_feature(fitted):
    df, model = fitted
    att = ts.tree_shap_attribution(model, df, FEATS, "customer_id", 50, 1).collect()
    assert sorted(r["feature"] for r in att) == sorted(FEATS)
    vals = [r["attribution"] for r in att]
    assert vals == sorted(vals, reverse=True) and all(v >= 0 for v in vals)
    # the informative features outrank the pure-noise one
    assert att[-1]["feature"] == "d" or vals[-1] == vals[FEATS.index("d")]


def test_single_row_block_matches_batched(fitted):
    _, model = fitted
    paths, _ = ts.leaf_paths(model)
    x = np.array([[0.2, 0.9, 3.0, 0.5], [0.8, 0.1, 0.0, 0.3], [0.5, 0.5, 2.0, 0.9]])
    whole = ts.shap_block(x, paths, 4)
    for k in range(3):
        assert np.allclose(ts.shap_block(x[k:k + 1], paths, 4), whole[k:k + 1])


def _random_paths(rnd: random.Random, n_features: int, n_leaves: int, max_d: int) -> dict:
    groups: dict = {}
    for _ in range(n_leaves):
        d = rnd.randint(1, max_d)
        feats = sorted(rnd.sample(range(n_features), d))
        lo = [rnd.choice([-math.inf, rnd.random() * 0.5]) for _ in feats]
        hi = [rnd.choice([math.inf, 0.5 + rnd.random() * 0.5]) for _ in feats]
        z = [rnd.uniform(0.05, 1.0) for _ in feats]
        groups.setdefault(d, []).append((rnd.uniform(-2, 2), feats, lo, hi, z))
    return {d: dict(value=np.array([g[0] for g in gs]), feat=np.array([g[1] for g in gs], dtype=np.int64),
                    lo=np.array([g[2] for g in gs]), hi=np.array([g[3] for g in gs]),
                    z=np.array([g[4] for g in gs])) for d, gs in groups.items()}


def _value(paths: dict, x, s: set) -> float:
    total = 0.0
    for g in paths.values():
        for v, fs, lo, hi, z in zip(g["value"], g["feat"], g["lo"], g["hi"], g["z"]):
            prod = 1.0
            for f, a, b, zz in zip(fs, lo, hi, z):
                prod *= float(a < x[f] <= b) if f in s else zz
            total += v * prod
    return total


@pytest.mark.parametrize("seed", range(6))
def test_leaf_path_formula_is_exact_shapley(seed):
    """Paths with up to 6 distinct features (depth-6 trees): the closed form
    equals Shapley values enumerated over every subset."""
    rnd = random.Random(seed)
    m = 7
    paths = _random_paths(rnd, m, 12, 6)
    x = np.array([[rnd.random() for _ in range(m)] for _ in range(3)])
    got = ts.shap_block(x, paths, m)
    for r in range(len(x)):
        want = np.zeros(m)
        for i in range(m):
            others = [j for j in range(m) if j != i]
            for k in range(m):
                wk = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                for s in itertools.combinations(others, k):
                    want[i] += wk * (_value(paths, x[r], set(s) | {i}) - _value(paths, x[r], set(s)))
        assert np.allclose(got[r], want, atol=1e-10)
        # efficiency: values add up to v(all) - v(empty)
        assert got[r].sum() == pytest.approx(_value(paths, x[r], set(range(m))) - _value(paths, x[r], set()))


def test_block_size_respects_budget():
    paths = _random_paths(random.Random(1), 10, 500, 6)
    n = ts.rows_per_block(paths, budget=1 << 20)
    per_row = max(len(g["value"]) * (d + 1) for d, g in paths.items()) * 8 * 6
    assert n >= 1 and (n * per_row <= 1 << 20 or n == 1)
