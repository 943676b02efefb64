"""The second-order booster against a plain recursive version, and what its parameters promise."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cairn.operators import boost, model as mdl, treeshap as ts
from cairn.session import shared_dir

FEATS = ["a", "b", "c"]


def frame(spark, n=500, seed=3, parts=2):
    """Label from a and from whether b is missing; c is noise with few values."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = r.random(), r.choice([None, r.random(), r.random()]), float(r.randrange(4))
        p = 0.15 + 0.5 * (a > 0.6) + 0.3 * (b is None) * (a < 0.8)
        rows.append((i, int(r.random() < p), a, math.nan if b is None and i % 2 else b, c))
    return spark.createDataFrame(rows, "customer_id long, churned int, a double, b double, c double").repartition(parts)


def fitted(spark, df, **params):
    cuts = boost.quantile_cuts(df, FEATS, params.get("max_bins", 32))
    fit, = boost.fit_many(df, FEATS, "churned", "customer_id", [boost.Fit(boost.BoostParams.of({"max_bins": 32, **params}))], cuts)
    return fit, cuts


def brute(df, cuts, rounds, depth, lr=0.3, lam=1.0, mcw=1.0, gamma=0.0):
    """[nested (feature, cut, missing_left, left, right) or leaf value], and the margins, by recursion over index sets."""
    rows = sorted(df.collect())
    x = np.array([[np.nan if v is None else v for v in r[2:]] for r in rows], float)
    y = np.array([r[1] for r in rows], float)
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    trees = []

    def grow(idx, g, h, level):
        sg, sh = g[idx].sum(), h[idx].sum()
        best = (max(gamma, boost.LEAST_GAIN), None)
        if level < depth:
            for f, cut in ((f, c) for f in range(x.shape[1]) for c in cuts[f]):
                for miss in (False, True):
                    left = np.where(np.isnan(x[idx, f]), miss, x[idx, f] <= cut)
                    gl, hl = g[idx][left].sum(), h[idx][left].sum()
                    gr, hr = sg - gl, sh - hl
                    if hl >= mcw and hr >= mcw:
                        gain = gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - sg ** 2 / (sh + lam)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut, miss, idx[left], idx[~left]))
        if best[1] is None:
            value = -sg / (sh + lam) * lr
            margin[idx] += value
            return value
        f, cut, miss, left, right = best[1]
        return f, cut, miss, grow(left, g, h, level + 1), grow(right, g, h, level + 1)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.rint(v * boost.GRID) / boost.GRID for v in (p - y, p * (1 - p)))
        trees.append(grow(np.arange(len(y)), g, h, 0))
    return trees, margin


def nested(tree, cuts, node=0):
    f = int(tree["feature"][node])
    if f < 0:
        return float(tree["value"][node])
    return f, cuts[f][tree["bin"][node]], bool(tree["left"][node]), nested(tree, cuts, 2 * node + 1), nested(tree, cuts, 2 * node + 2)


def close(a, b):
    if isinstance(a, tuple) != isinstance(b, tuple):
        return False
    if not isinstance(a, tuple):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a[:3] == b[:3] and close(a[3], b[3]) and close(a[4], b[4])


@pytest.mark.parametrize("params,named", [({}, {}), ({"reg_lambda": 7.5}, {"lam": 7.5}), ({"min_child_weight": 12}, {"mcw": 12}),
                                          ({"gamma": 2.0}, {"gamma": 2.0})])
def test_trees_as_by_recursion(spark, params, named):
    df = frame(spark).cache()
    fit, cuts = fitted(spark, df, n_estimators=3, max_depth=3, **params)
    trees, margin = brute(df, cuts, 3, 3, **named)
    assert all(close(nested(t, cuts), want) for t, want in zip(fit.trees, trees, strict=True))
    scored = mdl.score(PipelineModel(stages=[mdl.assembler(FEATS, missing="keep"), boost.model_of(fit, cuts)]), df, ["customer_id"])
    got = {r["customer_id"]: r["probability_1"] for r in scored.collect()}
    assert all(math.isclose(got[i], 1 / (1 + math.exp(-m)), rel_tol=1e-9) for i, m in enumerate(margin))
    losses = [loss for loss, _ in fit.history]
    assert losses == sorted(losses, reverse=True)
    df.unpersist()


def test_regularisation_changes_the_model(spark):
    df = frame(spark).cache()
    size = lambda **p: max(abs(v) for t in fitted(spark, df, n_estimators=1, max_depth=3, **p)[0].trees for v in t["value"])
    assert size(reg_lambda=50) < size() / 2
    some = fitted(spark, df, n_estimators=30, max_depth=2, colsample_bytree=0.34)[0]
    assert all(len({f for f in t["feature"].tolist() if f >= 0}) <= 1 for t in some.trees)
    assert len({tuple(t["feature"].tolist()) for t in some.trees}) > 1, "each tree draws its own features"
    df.unpersist()


def test_same_model_for_any_layout_and_merge(spark, monkeypatch):
    df = frame(spark)
    make = lambda d: [boost.node_table(*x).to_csv() for x in [fitted(spark, d, n_estimators=5, max_depth=3, subsample=0.7, colsample_bytree=0.7)]]
    first = make(df)
    assert first == make(df.repartition(1)) == make(df.repartition(7).orderBy("c"))
    monkeypatch.setattr(boost, "DRIVER_BYTES", 0)
    monkeypatch.setattr(boost, "BLOCK_ROWS", 50)
    assert first == make(df)


def test_long_fits_cut_their_lineage(spark, monkeypatch):
    df = frame(spark, 200)
    whole = boost.node_table(*fitted(spark, df, n_estimators=9, max_depth=2)).to_csv()
    monkeypatch.setattr(boost, "CHECKPOINT_ROUNDS", 2)
    assert boost.node_table(*fitted(spark, df, n_estimators=9, max_depth=2)).to_csv() == whole


@pytest.mark.parametrize("metric", ["logloss", "error", "auc"])
def test_patience(spark, metric):
    """A longer patience never ends earlier; the model is cut back to the best round."""
    df = frame(spark, 1500, 5).cache()
    rounds = {}
    for patience in (1, 5, 0):
        fit, _ = fitted(spark, df, n_estimators=40, max_depth=2, learning_rate=0.8, early_stopping_rounds=patience, eval_metric=metric)
        rounds[patience] = len(fit.history)
        if patience:
            better = max if boost.HIGHER_IS_BETTER[metric] else min
            seen = [m for _, m in fit.history]
            assert seen[fit.best - 1] == better(seen) and len(fit.trees) == fit.best
            assert len(seen) == 40 or len(seen) - fit.best == patience
    assert rounds[1] < rounds[5] < rounds[0] == 40
    df.unpersist()


def test_validation_metrics(spark):
    """The held-out tenth and its metrics, once more from scored rows."""
    df = frame(spark, 1200, 8).cache()
    from cairn.functions.columns import hash_uniform
    for metric in ("logloss", "error", "auc"):
        fit, cuts = fitted(spark, df, n_estimators=4, max_depth=2, early_stopping_rounds=50, eval_metric=metric)
        fit.trees = fit.trees[:len(fit.history)]
        if len(fit.trees) < 4:      # cut back: compare the best round
            want = fit.history[fit.best - 1][1]
        else:
            want = fit.history[-1][1]
        model = PipelineModel(stages=[mdl.assembler(FEATS, missing="keep"), boost.model_of(fit, cuts)])
        held = mdl.score(model, df.where(hash_uniform(42, "customer_id", "valid") < boost.VALIDATION_SHARE), ["churned"]).toPandas()
        p, y = held["probability_1"].to_numpy(), held["churned"].to_numpy()
        figures = {"logloss": -np.mean(np.where(y > 0, np.log(p), np.log(1 - p))), "error": np.mean((p > 0.5) != y),
                   "auc": np.mean([(a > b) + 0.5 * (a == b) for a in p[y > 0] for b in p[y == 0]])}
        assert math.isclose(want, figures[metric], abs_tol=1e-3 if metric == "auc" else 1e-6)
    df.unpersist()


def test_the_pipelines_own_parameters_train(spark):
    own = {"objective": "binary:logistic", "eval_metric": "auc", "max_depth": 6, "learning_rate": 0.1, "n_estimators": 10,
           "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42}
    df = frame(spark)
    model, feats, rec, cv = mdl.train(df, "churned", own, folds=2)
    r = rec.first()
    assert r["model_type"] == "BoostedTreesModel" and r["hyperparameters"]["eval_metric"] == "auc" and cv.count() == 2
    assert r["training_metrics"]["roc_auc"] > 0.75
    for bad in ({"max_deepness": 3}, {"objective": "reg:squarederror"}, {"eval_metric": "rmse"}):
        with pytest.raises(ValueError):
            boost.BoostParams.of(bad)


def test_save_and_load(spark):
    df = frame(spark)
    model, _, _, _ = mdl.train(df, "churned", {"n_estimators": 4, "max_depth": 2}, folds=0)
    path = shared_dir(spark, "boosted")
    model.write().save(path)
    again = PipelineModel.load(path)
    assert again.stages[-1].getNumTrees == 4 and again.stages[-1].featureImportances == model.stages[-1].featureImportances
    both = [sorted(map(tuple, mdl.score(m, df, ["customer_id"]).collect())) for m in (model, again)]
    assert both[0] == both[1]


def test_degenerate_inputs(spark):
    df = frame(spark, 40)
    for rows, rate in ((df.withColumn("churned", F.lit(1)), 1 - 1e-6), (df.limit(0), 0.5)):
        fit, cuts = fitted(spark, rows, n_estimators=3)
        assert not fit.trees and math.isclose(1 / (1 + math.exp(-fit.base)), rate, rel_tol=1e-9)
        scored = mdl.score(PipelineModel(stages=[mdl.assembler(FEATS, missing="keep"), boost.model_of(fit, cuts)]), df, ["customer_id"])
        assert {round(r["probability_1"], 9) for r in scored.collect()} == {round(rate, 9)}
    blank = df.withColumn("c", F.lit(None).cast("double"))
    assert len(fitted(spark, blank, n_estimators=2)[0].trees) == 2


def test_a_grid_cell_is_a_cross_validation(spark):
    df = frame(spark).cache()
    base = {"n_estimators": 6, "max_depth": 2, "max_bins": 32, "random_state": 1}
    grid = {"learning_rate": [0.05, 0.4], "max_depth": [1, 3]}
    found = mdl.grid_search(df, FEATS, grid, base, k=2).collect()
    assert len(found) == 8 and {r["dropped_at"] for r in found} == {None}
    for c, (lr, depth) in enumerate(itertools.product(*grid.values())):
        cv = {r["fold"]: r for r in mdl.cross_validate(df, FEATS, "churned", {**base, "learning_rate": lr, "max_depth": depth}, 2).collect()}
        for r in found:
            if r["cell"] == c:
                assert all(r[m] == cv[r["fold"]][m] for m in mdl.METRICS)
    df.unpersist()


def test_rungs_drop_the_worse_half(spark):
    df = frame(spark).cache()
    base = {"n_estimators": 8, "max_depth": 2, "max_bins": 32}
    found = mdl.grid_search(df, FEATS, {"learning_rate": [0.001, 0.3, 0.002, 0.2]}, base, k=2, rungs=[2, 4]).collect()
    by_cell = {c: {(r["rounds"], r["dropped_at"]) for r in found if r["cell"] == c} for c in range(4)}
    assert by_cell[0] == by_cell[2] == {(2, 2)}, "the slowest learners go first"
    assert sorted(by_cell[1] | by_cell[3], key=str) == [(4, 4), (8, None)]
    assert all(r["roc_auc"] is not None for r in found)
    with pytest.raises(ValueError):
        mdl.grid_search(df, FEATS, {"max_bins": [8, 16]}, base, k=2)
    df.unpersist()


def test_shap_with_missing_values_is_exact(spark):
    """Against the Shapley formula over all subsets, with path-dependent expectations."""
    df = frame(spark, 300)
    fit, cuts = fitted(spark, df, n_estimators=3, max_depth=3)
    model = boost.model_of(fit, cuts)
    paths, base = ts.leaf_paths(model)
    r = random.Random(2)
    x = np.array([[r.random(), r.choice([math.nan, r.random()]), float(r.randrange(4))] for _ in range(40)])
    got = ts.shap_block(x, paths, 3)
    trees = boost._compact(model.nodes)
    covers = [dict(zip(t["node"], t["cover"])) for _, t in model.nodes.groupby("tree", sort=True)]

    def value(row, known):
        total = model.base
        for t, cover in zip(trees, covers):
            def walk(n):
                f = t["feature"][n]
                if f < 0:
                    return t["value"][n]
                if f in known:
                    left = t["missing_left"][n] if math.isnan(row[f]) else row[f] <= t["cut"][n]
                    return walk(2 * n + 2 - int(left))
                return (cover[2 * n + 1] * walk(2 * n + 1) + cover[2 * n + 2] * walk(2 * n + 2)) / cover[n]
            total += walk(0)
        return total

    assert math.isclose(base, value(x[0], set()), rel_tol=1e-6)
    for row, phi in zip(x, got):
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = sum(math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value(row, {*s, i}) - value(row, set(s)))
                       for n in range(3) for s in itertools.combinations(others, n))
            assert math.isclose(phi[i], want, rel_tol=1e-5, abs_tol=1e-6)


def test_stumps_query_without_arrow_conversion(spark):
    """Without Arrow the types of a pandas frame are inferred wider, and an array takes no bigint position."""
    from cairn.plans import queries
    from conftest import SF_SMALL
    name = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "false")
        plain = queries.QUERIES["m2_boosted_stumps"](spark, SF_SMALL)
        assert plain.schema["feature"].dataType.simpleString() == "string"
        rows = sorted(map(tuple, plain.collect()))
        spark.conf.set(name, "true")
        again = queries.QUERIES["m2_boosted_stumps"](spark, SF_SMALL)
        assert again.schema == plain.schema and sorted(map(tuple, again.collect())) == rows
    finally:
        spark.conf.set(name, before)


def test_the_driver_gets_cuts_and_no_sums(spark, monkeypatch):
    """What a level sends to the driver depends neither on the bins nor on the partitions."""
    df = frame(spark, 3000).repartition(12).cache()
    sent = []
    real = boost._answers

    def watched(state, asked, scored, missing):
        noted, found = real(state, asked, scored, missing)
        sent.append((state.getNumPartitions(), [x.shape for x in found], [len(x) for x in noted]))
        return noted, found
    monkeypatch.setattr(boost, "_answers", watched)
    monkeypatch.setattr(boost, "ROWS_PER_PARTITION", 1000)
    fitted(spark, df, n_estimators=2, max_depth=3, max_bins=256, eval_metric="auc")
    assert [shapes for _, shapes, _ in sent] == [[(3, 1, 7)], [(3, 2, 7)], [(3, 4, 7)]] * 2 + [[]]
    assert all(n == 3 for _, _, noted in sent for n in noted) and sum(len(noted) for _, _, noted in sent) == 2
    assert max(n for n, _, _ in sent) <= max(spark.sparkContext.defaultParallelism, 3), "partitions go with the rows"
    df.unpersist()


def test_best_cuts_against_all_cuts():
    r = np.random.default_rng(4)
    for n_cuts, lam, least in ((1, 0.0, 0.0), (5, 1.0, 1.0), (7, 2.0, 3.0), (7, 1.0, 100.0)):
        sums = np.stack([r.integers(-3, 4, (4, 8)), r.integers(0, 3, (4, 8))]) * boost.GRID
        got = boost._best_cuts(sums, n_cuts, lam, least)
        for n, (g, h) in enumerate(zip(*(sums / boost.GRID))):
            want = -math.inf
            for cut, miss in itertools.product(range(n_cuts), (0, 1)):
                gl, hl = (x[:cut + 1].sum() + miss * x[-1] for x in (g, h))
                gr, hr = g.sum() - gl, h.sum() - hl
                if hl >= least and hr >= least and hl > 0 and hr > 0:
                    gain = gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - g.sum() ** 2 / (h.sum() + lam)
                    if gain > want:
                        want, at = gain, (cut, miss, gl, hl)
            assert got[n, 0] == pytest.approx(want) and tuple(got[n, 5:]) == (g.sum(), h.sum())
            if want > -math.inf:
                assert tuple(got[n, 1:5]) == pytest.approx(at)


def test_margins_by_fold_are_the_models_own(spark):
    df = frame(spark, 200).withColumn("fold", F.col("customer_id").cast("int") % 2)
    cuts = boost.quantile_cuts(df, FEATS, 32)
    fits = [boost.Fit(boost.BoostParams.of({"n_estimators": 2, "max_depth": 2, "learning_rate": lr, "max_bins": 32}), i) for lr in (0.1, 0.5) for i in (0, 1)]
    models = [boost.model_of(f, cuts) for f in boost.fit_many(df, FEATS, "churned", "customer_id", fits, cuts)]
    for row in boost.margins_by_fold(df, FEATS, models, 2).collect():
        x = np.array([[np.nan if row[f] is None else row[f] for f in FEATS]], float)
        for c, m in enumerate(row["margins"]):
            own = models[2 * c + row["fold"]]
            assert m == boost.margins_of(x, boost._compact(own.nodes), own.base)[0]
