"""M2: second-order boosted trees for a binary target, many models at once.

All models of a call (folds, the final fit, the cells of a grid) grow
together over one frame of binned rows: a job per level sums gradients and
hessians per (model, node, feature, bin), a task per model and feature gets
those sums and finds the best cut of each node, and the driver, which holds
the trees, picks among the features.  Rows never move after they are binned;
what comes back is seven numbers per (model, node, feature).

Gradients are rounded to multiples of 2^-24 and summed as integers, and rows
are drawn by a hash of their key, so a model is the same however the rows
are partitioned.  A missing value (NULL or NaN) goes the way that its node learnt.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from cairn.functions.columns import hash_uniform
from cairn.session import shared_dir

# The task-side functions travel with the task, so Python workers need numpy and pyarrow only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRID = 1 << 24              # gradients, hessians and losses are multiples of 1 / GRID
BLOCK_ROWS = 1 << 16
DRIVER_BYTES = 64 << 20     # counts by partition that come to the driver one by one; more are merged on the way
ROWS_PER_PARTITION = 1 << 20    # binned rows of a partition, beyond a partition a core; each sends its sums once a level
CHECKPOINT_ROUNDS = 20
AUC_BINS = 1 << 16          # the validation AUC is that of probabilities rounded to this many steps
VALIDATION_SHARE = 0.1      # of the rows that a fit with early stopping learns from, held out by a hash of the key
LEAST_GAIN = 1e-6
HIGHER_IS_BETTER = {"logloss": False, "error": False, "auc": True}


@dataclass(frozen=True)
class BoostParams:
    """Names and meaning as in gradient boosting libraries; the defaults are theirs too."""
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0              # rows a tree sees
    colsample_bytree: float = 1.0       # features a tree sees
    min_child_weight: float = 1.0       # least hessian sum of a child
    reg_lambda: float = 1.0             # L2 on leaf values
    gamma: float = 0.0                  # least gain of a split
    max_bins: int = 256
    random_state: int = 0
    scale_pos_weight: float = 1.0
    objective: str = "binary:logistic"
    eval_metric: str = "logloss"        # logloss, error or auc; what early stopping watches
    early_stopping_rounds: int = 0      # rounds without improvement after which boosting ends; 0: never

    def __post_init__(self):
        if self.objective != "binary:logistic":
            raise ValueError(f"objective={self.objective!r}: only 'binary:logistic' is supported")
        if self.eval_metric not in HIGHER_IS_BETTER:
            raise ValueError(f"eval_metric={self.eval_metric!r}: one of {sorted(HIGHER_IS_BETTER)}")

    @classmethod
    def of(cls, params: dict | None) -> "BoostParams":
        known = {f.name: f.type for f in fields(cls)}
        unknown = sorted(set(params or {}) - set(known))
        if unknown:
            raise ValueError(f"unknown model parameter {unknown[0]!r}")
        kinds = {"int": int, "float": float, "str": str}
        return cls(**{k: kinds[known[k]](v or 0 if k == "early_stopping_rounds" else v) for k, v in (params or {}).items()})


@dataclass
class Fit:
    """One model to grow: its parameters, the fold it leaves out, and what it has grown so far."""
    params: BoostParams
    fold: int | None = None
    watch: str = "valid"                    # rows that the metric is taken on: "valid" (held out) or "fold" (left out)
    trees: list = field(default_factory=list)
    base: float = 0.0
    history: list = field(default_factory=list)     # (training loss, metric) after each round
    best: int = 0                           # rounds of the best metric
    done: bool = False


def empty_tree(depth: int) -> dict:
    n = (1 << depth + 1) - 1
    return {"feature": np.full(n, -1, np.int32), "bin": np.zeros(n, np.int32), "left": np.zeros(n, bool), "value": np.zeros(n),
            "cover": np.zeros(n), "gain": np.zeros(n)}


def _hash_uniform(ids: np.ndarray, seed: int, step: int) -> np.ndarray:
    h = ids.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed * 1_000_003 + step + 1)) % (1 << 64))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return (h ^ (h >> np.uint64(31))) / 2.0 ** 64


def _place(bins: np.ndarray, tree: dict, missing: int) -> np.ndarray:
    """The node of every row in a tree as far as it is grown."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while True:
        f = tree["feature"][node[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        if not len(rows):
            return node
        at = node[rows]
        b = bins[rows, f]
        left = np.where(b == missing, tree["left"][at], b <= tree["bin"][at])
        node[rows] = 2 * at + 2 - left


def _drawn(block: dict, fit: dict) -> np.ndarray:
    rows = np.ones(len(block["y"]), bool) if fit["fold"] is None else block["fold"] != fit["fold"]
    return rows & ~block["valid"] if fit["stops"] else rows


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-margin))


def _sums(block: dict, margins: np.ndarray, fits: list[dict], missing: int) -> list[np.ndarray]:
    """Per open model the integer sums (2, nodes, features, bins) of gradients and hessians at its present level."""
    out = []
    for fit in fits:
        rows = _drawn(block, fit)
        if fit["subsample"] < 1:
            rows &= _hash_uniform(block["id"], fit["seed"], fit["round"]) < fit["subsample"]
        at = np.flatnonzero(rows)
        bins = block["bins"][at]
        node = _place(bins, fit["tree"], missing) - ((1 << fit["level"]) - 1)
        here = node >= 0                    # rows in leaves above this level are done
        at, node, bins = at[here], node[here], bins[here][:, fit["features"]]
        y, p = block["y"][at], _probability(margins[fit["slot"], at])
        weight = np.where(y > 0, fit["positive"], 1.0)
        width, n = missing + 1, len(fit["features"])
        cells = ((node[:, None] * n + np.arange(n)) * width + bins).ravel()
        size = (n * width) << fit["level"]
        both = [np.bincount(cells, np.repeat(np.rint(v * GRID), n), size)
                for v in (weight * (p - y), np.maximum(weight * p * (1 - p), 1e-16))]
        out.append(np.stack(both).astype(np.int64).reshape(2, 1 << fit["level"], n, width))
    return out


def _scored(block: dict, margins: np.ndarray, fits: list[dict]) -> list[np.ndarray]:
    """Per model the integer sums: rows and loss of what it learns from, then the sums of its metric on what it watches."""
    out = []
    for fit in fits:
        p = np.clip(_probability(margins[fit["slot"]]), 1e-15, 1 - 1e-15)
        y = block["y"]
        loss = np.rint(-np.where(y > 0, np.log(p), np.log(1 - p)) * GRID).astype(np.int64)
        mine = _drawn(block, fit)
        seen = (block["fold"] == fit["fold"]) if fit["watch"] == "fold" else ~mine if fit["fold"] is None else block["valid"] & (block["fold"] != fit["fold"])
        if fit["metric"] == "auc":
            step = np.minimum((p[seen] * AUC_BINS).astype(np.int64), AUC_BINS - 1)
            what = np.bincount(step * 2 + y[seen].astype(np.int64), minlength=2 * AUC_BINS)
        else:
            what = np.array([seen.sum(), loss[seen].sum() if fit["metric"] == "logloss" else ((p > 0.5) != (y > 0))[seen].sum()])
        out.append(np.concatenate([[mine.sum(), loss[mine].sum()], what]).astype(np.int64))
    return out


def _metric(name: str, what: np.ndarray) -> float | None:
    """The metric from its sums; nothing where it isn't defined."""
    if name == "auc":
        neg, pos = what[0::2].astype(float), what[1::2].astype(float)
        if not pos.sum() or not neg.sum():
            return None
        return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum()))
    if not what[0]:
        return None
    return float(what[1] / what[0] / (GRID if name == "logloss" else 1))


def _advance(block: dict, margins: np.ndarray, grown: list[tuple[int, dict]], missing: int) -> np.ndarray:
    if grown:
        margins = margins.copy()
        for slot, tree in grown:
            margins[slot] += tree["value"][_place(block["bins"], tree, missing)]
    return margins


def _added(a: list, b: list) -> list:
    return [x + y for x, y in zip(a, b, strict=True)]


def _merged(parts):
    """The sum over the blocks of a partition, if it has any."""
    total = None
    for b in parts:
        total = b if total is None else _added(total, b)
    return [] if total is None else [total]


def _collected(parts, size: int, n_parts: int) -> list[np.ndarray] | None:
    """Sums over all blocks: partition by partition, merged on the way where the driver would hold too much."""
    rdd = parts.mapPartitions(_merged)
    if size * n_parts > DRIVER_BYTES:
        return rdd.treeReduce(_added) if not rdd.isEmpty() else None
    return next(iter(_merged(rdd.collect())), None)


def _answers(state, asked: list[dict], scored: list[dict], missing: int) -> tuple[list, list]:
    """One job over all blocks: per scored model (rows, loss, metric), and per asked model the best cuts (features, nodes, 7).

    A partition sends the sums of each model and feature to one task, which adds them up and answers."""
    first = np.cumsum([len(scored)] + [len(f["features"]) for f in asked]).tolist()     # the keys of a model's features

    def parts(states):
        for total in _merged(_scored(*s, scored) + _sums(*s, asked, missing) for s in states):
            yield from enumerate(total[:len(scored)])
            for at, sums in zip(first, total[len(scored):]):
                for j in range(sums.shape[2]):
                    yield at + j, np.ascontiguousarray(sums[:, :, j])

    def answer(key, sums):
        if key < len(scored):
            return int(sums[0]), int(sums[1]), _metric(scored[key]["metric"], sums[2:])
        i = next(i for i in range(len(asked)) if key < first[i + 1])
        return _best_cuts(sums, asked[i]["cuts"][key - first[i]], asked[i]["lambda"], asked[i]["least"])

    tasks = max(1, min(first[-1], state.context.defaultParallelism))
    found = (state.mapPartitions(parts).reduceByKey(np.add, tasks, lambda key: key)
             .map(lambda kv: (kv[0], answer(*kv))).collectAsMap())
    return ([found[i] for i in range(len(scored))],
            [np.stack([found[k] for k in range(a, b)]) for a, b in zip(first, first[1:])])


def quantile_cuts(df: DataFrame, features: list[str], max_bins: int = 256, accuracy: int = 100_000) -> list[np.ndarray]:
    """Per feature the distinct values at ``max_bins`` - 1 even quantiles and the largest, by one pass of mergeable sketches."""
    at = [i / max_bins for i in range(1, max_bins)] + [1.0]
    cols = [F.col(f"`{f}`").cast("double") for f in features]
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(c), c), at, accuracy) for c in cols]).first()
    return [np.unique(np.array([x for x in (q or []) if x is not None], float)) for q in row]


def _blocks(df: DataFrame, features: list[str], target: str, key: str, cuts: list[np.ndarray], seed: int):
    """An RDD of blocks of binned rows, read from a checkpoint."""
    missing = max(max((len(c) for c in cuts), default=0), 1)
    dtype = np.uint8 if missing < 256 else np.uint16
    fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
    rows = df.select(F.xxhash64(key).alias("id"), F.col(target).cast("double").alias("y"), fold.alias("fold"),
                     (hash_uniform(seed, key, "valid") < VALIDATION_SHARE).alias("valid"),
                     *[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])

    def pack(batches):
        for batch in batches:
            for start in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                bins = np.empty((len(part), len(cuts)), dtype)
                for i, c in enumerate(cuts):
                    x = part.column(4 + i).to_numpy(zero_copy_only=False).astype(float)
                    bins[:, i] = np.where(np.isnan(x), missing, np.searchsorted(c, x, side="left")).astype(dtype)
                cols = [part.column(i).to_numpy(zero_copy_only=False).astype(t) for i, t in enumerate(("<i8", "<f8", "<i4", "?"))]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64())] + [pa.array([x.tobytes()], pa.binary()) for x in (*cols, bins)],
                                                 names=["n", "id", "y", "fold", "valid", "bins"])

    shared_dir(df.sparkSession)
    packed = rows.mapInArrow(pack, "n long, id binary, y binary, fold binary, valid binary, bins binary").checkpoint()
    n_rows = packed.agg(F.sum("n")).first()[0] or 0

    def decode(r):
        block = {c: np.frombuffer(r[c], t) for c, t in (("id", "<i8"), ("y", "<f8"), ("fold", "<i4"), ("valid", "?"))}
        return block | {"bins": np.frombuffer(r["bins"], dtype).reshape(r["n"], len(cuts))}

    # Sums are sent by partition, so their number goes with the rows and not with the files that these came from.
    partitions = max(df.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_PARTITION))
    return packed.rdd.coalesce(partitions).map(decode), missing


def _best_cuts(sums: np.ndarray, n_cuts: int, lam: float, least: float) -> np.ndarray:
    """Per node of a level the best cut on one feature, from its integer sums (2, nodes, bins).

    (gain, cut, missing left, G and H left of it, G and H of the node).  Gain is G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda)
    - G^2 / (H + lambda), -inf without a cut; of equal gains the lowest cut counts, missing values right before left."""
    g, h = sums.astype(float) / GRID
    width = g.shape[1] - 1
    total_g, total_h = g.sum(1), h.sum(1)
    allowed = np.arange(width) < n_cuts
    gains, lefts = [], []
    for with_missing in (False, True):
        gl, hl = (np.cumsum(x[:, :width], 1) + (x[:, width:] if with_missing else 0) for x in (g, h))
        gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
        ok = allowed & (hl >= least) & (hr >= least) & (hl > 0) & (hr > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl ** 2 / (hl + lam) + gr ** 2 / (hr + lam) - (total_g ** 2 / (total_h + lam))[:, None]
        gains.append(np.where(ok, gain, -np.inf))
        lefts.append((gl, hl))
    gains = np.stack(gains, 2).reshape(len(g), -1)      # nodes, (cuts, missing direction)
    best, rows = gains.argmax(1), np.arange(len(g))
    gl, hl = (np.stack([left[i] for left in lefts], 2).reshape(len(g), -1)[rows, best] for i in (0, 1))
    return np.stack([gains[rows, best], best // 2, best % 2, gl, hl, total_g, total_h], 1)


def _splits(found: np.ndarray, tree: dict, level: int, features: np.ndarray, p: BoostParams) -> bool:
    """Grow one level of a tree from the best cuts (features, nodes, 7); whether any node split.  Of equal gains the first feature counts."""
    first = (1 << level) - 1
    grew = False
    for n in range(found.shape[1]):
        node = first + n
        if level and (tree["feature"][(node - 1) // 2] < 0):
            continue
        if not level:
            tree["cover"][0], tree["value"][0] = found[0, 0, 6], _leaf(found[0, 0, 5], found[0, 0, 6], p)
        f = int(np.argmax(found[:, n, 0]))
        gain, cut, direction, gl, hl, total_g, total_h = found[f, n]
        if not gain > max(p.gamma, LEAST_GAIN):
            continue
        grew = True
        tree["feature"][node], tree["bin"][node], tree["left"][node], tree["gain"][node] = features[f], cut, bool(direction), gain
        for child, cg, ch in ((2 * node + 1, gl, hl), (2 * node + 2, total_g - gl, total_h - hl)):
            tree["cover"][child], tree["value"][child] = ch, _leaf(cg, ch, p)
    return grew


def _leaf(g: float, h: float, p: BoostParams) -> float:
    return float(-g / (h + p.reg_lambda) * p.learning_rate) if h + p.reg_lambda > 0 else 0.0


def fit_many(df: DataFrame, features: list[str], target: str, key: str, fits: list[Fit], cuts: list[np.ndarray] | None = None,
             seed: int = 42, rung=None) -> list[Fit]:
    """Grow all ``fits`` over ``df`` (with a ``fold`` column where fits leave folds out).

    ``rung(round, fits)`` is called after each round's metrics and may set ``done``.  A fit with early
    stopping is cut back to its best round.  A target without both
    classes, or no rows, gives models that answer the base rate."""
    if not fits:
        return fits
    cuts = cuts or quantile_cuts(df, features, max(f.params.max_bins for f in fits))
    blocks, missing = _blocks(df, features, target, key, cuts, seed)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    sizes = np.array([len(c) for c in cuts])

    def told(fit: Fit, slot: int, **more) -> dict:
        p = fit.params
        return {"slot": slot, "fold": fit.fold, "stops": p.early_stopping_rounds > 0, "watch": fit.watch, "metric": p.eval_metric,
                "subsample": p.subsample, "seed": p.random_state, "positive": p.scale_pos_weight, **more}

    every = [told(f, i) for i, f in enumerate(fits)]
    rates = _collected(blocks.map(lambda b: [np.array([m.sum(), b["y"][m].sum()]) for m in (_drawn(b, f) for f in every)]), 16 * len(fits),
                       blocks.getNumPartitions())
    for i, fit in enumerate(fits):
        n, positive = (rates[i] if rates else (0, 0))
        rate = min(max(positive / n, 1e-6), 1 - 1e-6) if n else 0.5
        fit.base = math.log(rate / (1 - rate))
        fit.done = not 0 < positive < n
    bases = np.array([f.base for f in fits])
    state = blocks.map(lambda b: (b, np.repeat(bases[:, None], len(b["y"]), 1))).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[tuple[int, dict]] = []
    for step in range(max(f.params.n_estimators for f in fits) + 1):
        if grown:
            new = state.map(lambda s, grown=grown: (s[0], _advance(*s, grown, missing))).persist(StorageLevel.MEMORY_AND_DISK)
            if step % CHECKPOINT_ROUNDS == 0:
                new.checkpoint()
        else:
            new = state
        # One job has the metrics of the last round and the sums of the new trees' roots.
        rows = [told(fits[i], i) for i, _ in grown]
        open_fits = [i for i, f in enumerate(fits) if not f.done and step < f.params.n_estimators]
        trees, chosen = {}, {}
        for i in open_fits:
            p = fits[i].params
            trees[i] = empty_tree(p.max_depth)
            n = max(1, int(p.colsample_bytree * len(features)))
            chosen[i] = np.sort(np.random.default_rng((p.random_state, step)).permutation(len(features))[:n])
        for level in range(max((fits[i].params.max_depth for i in open_fits), default=1)):
            at = [i for i in open_fits if level < fits[i].params.max_depth and (not level or trees[i]["grew"])]
            asked = [told(fits[i], i, round=step, level=level, features=chosen[i], tree=trees[i], cuts=sizes[chosen[i]],
                          **{"lambda": fits[i].params.reg_lambda, "least": fits[i].params.min_child_weight}) for i in at]
            scored = rows if not level else []
            if not asked and not scored:
                break
            noted, found = _answers(new, asked, scored, missing)
            if not level:
                if new is not state:
                    state.unpersist()
                    state = new
                for (i, _), what in zip(grown, noted, strict=False):
                    _note(fits[i], *what)
                if rung and grown:
                    rung(step, fits)
                open_fits = [i for i in open_fits if not fits[i].done]
            for i, best in zip(at, found, strict=True):
                trees[i]["grew"] = not fits[i].done and _splits(best, trees[i], level, chosen[i], fits[i].params)
        grown = [(i, trees[i]) for i in open_fits]
        for i, tree in grown:
            tree.pop("grew", None)
            fits[i].trees.append(tree)
        if not grown:
            break
    for fit in fits:
        if fit.params.early_stopping_rounds and fit.best:
            fit.trees = fit.trees[:fit.best]
    state.unpersist()
    blocks.unpersist()
    return fits


def _note(fit: Fit, n: int, loss: int, metric: float | None) -> None:
    """Keep a round's figures, and end a fit whose metric has not improved for as many rounds as it is patient."""
    p = fit.params
    fit.history.append((loss / n / GRID if n else None, metric))
    if not p.early_stopping_rounds or metric is None:
        return
    sign = 1 if HIGHER_IS_BETTER[p.eval_metric] else -1
    if not fit.best or sign * metric > sign * fit.history[fit.best - 1][1]:
        fit.best = len(fit.history)
    elif len(fit.history) - fit.best >= p.early_stopping_rounds:
        fit.done = True


# --- the fitted model ---------------------------------------------------------

NODES = ("tree", "node", "feature", "cut", "missing_left", "value", "cover", "gain")
NODE_SCHEMA = "tree int, node int, feature int, cut double, missing_left boolean, value double, cover double, gain double"


def node_table(fit: Fit, cuts: list[np.ndarray]) -> pd.DataFrame:
    """A row per node that rows can reach; feature -1 is a leaf."""
    rows = []
    for t, tree in enumerate(fit.trees):
        live = [0]
        while live:
            n = live.pop()
            f = int(tree["feature"][n])
            rows.append((t, n, f, float(cuts[f][tree["bin"][n]]) if f >= 0 else 0.0, bool(tree["left"][n]), float(tree["value"][n]),
                         float(tree["cover"][n]), float(tree["gain"][n])))
            if f >= 0:
                live += [2 * n + 2, 2 * n + 1]
    return pd.DataFrame(rows, columns=NODES).astype({"tree": "int32", "node": "int32", "feature": "int32"}) if rows else pd.DataFrame(
        {c: pd.Series(dtype=t) for c, t in zip(NODES, ("int32", "int32", "int32", "float64", "bool", "float64", "float64", "float64"), strict=True)})


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark, {"base": self.instance.base, "numFeatures": self.instance.numFeatures})
        spark.createDataFrame(self.instance.nodes, NODE_SCHEMA).write.parquet(path + "/data")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        nodes = self.sparkSession.read.parquet(path + "/data").toPandas().sort_values(["tree", "node"], ignore_index=True)
        model = BoostedTreesModel(nodes=nodes, base=meta["base"], numFeatures=meta["numFeatures"])
        model._resetUid(meta["uid"])
        return model


class BoostedTreesModel(Model, MLWritable, MLReadable):
    """Adds probability (vector) and prediction (at 0.5) from the ``features`` vector; NaN is a missing value."""

    @keyword_only
    def __init__(self, *, nodes: pd.DataFrame, base: float, numFeatures: int):
        super().__init__()
        self.nodes, self.base, self.numFeatures = nodes, float(base), int(numFeatures)

    @property
    def getNumTrees(self) -> int:
        return int(self.nodes["tree"].nunique())

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of the splits on each feature, as shares of their sum."""
        splits = self.nodes[self.nodes["feature"] >= 0].groupby("feature")["gain"].mean()
        out = np.zeros(self.numFeatures)
        out[splits.index.to_numpy()] = splits.to_numpy()
        return DenseVector(out / out.sum() if out.sum() else out)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, base = _compact(self.nodes), self.base

        @F.pandas_udf("double")
        def margin(features: pd.Series) -> pd.Series:
            return pd.Series(margins_of(np.stack(features.to_numpy()) if len(features) else np.empty((0, 1)), trees, base))

        p = 1 / (1 + F.exp(-F.col("__margin")))
        return (df.withColumn("__margin", margin(vector_to_array("features")))
                .withColumn("probability", array_to_vector(F.array(1 - p, p)))
                .withColumn("prediction", (p > 0.5).cast("double")).drop("__margin"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def _compact(nodes: pd.DataFrame) -> list[dict]:
    out = []
    for _, t in nodes.groupby("tree", sort=True):
        size = int(t["node"].max()) + 1
        tree = {"feature": np.full(size, -1, np.int64), "cut": np.zeros(size), "missing_left": np.zeros(size, bool), "value": np.zeros(size)}
        for c, x in tree.items():
            x[t["node"].to_numpy()] = t[c].to_numpy()
        out.append(tree)
    return out


def margins_of(x: np.ndarray, trees: list[dict], base: float) -> np.ndarray:
    """base + the leaf values of every row; rows walk a tree together, a level at a time."""
    out = np.full(len(x), base)
    for t in trees:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows):
            f = t["feature"][node[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            at, v = node[rows], x[rows, f]
            node[rows] = 2 * at + 2 - np.where(np.isnan(v), t["missing_left"][at], v <= t["cut"][at])
        out += t["value"][node]
    return out


def margins_by_fold(df: DataFrame, features: list[str], models: list[BoostedTreesModel], k: int, out: str = "margins") -> DataFrame:
    """``df``, whose ``fold`` is 0 to k - 1, with one margin per k models: that of the model that left the row's fold out.

    All models score a batch of rows while it is there, so the rows are read once however many models there are."""
    compact = [(_compact(m.nodes), m.base) for m in models]

    @F.pandas_udf("array<double>")
    def margins(rows: pd.DataFrame) -> pd.Series:
        fold, x = rows["fold"].to_numpy(), rows.drop(columns="fold").to_numpy(float)
        got = np.empty((len(x), len(compact) // k))
        for i in range(k):
            here = fold == i
            for c in range(got.shape[1]):
                got[here, c] = margins_of(x[here], *compact[c * k + i])
        return pd.Series(list(got))

    return df.withColumn(out, margins(F.struct("fold", *[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)])))


def model_of(fit: Fit, cuts: list[np.ndarray]) -> BoostedTreesModel:
    return BoostedTreesModel(nodes=node_table(fit, cuts), base=fit.base, numFeatures=len(cuts))
