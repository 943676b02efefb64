"""Seeded, partition-independent splits and folds with checks.

Row choice is by the seeded hash ``md5('<seed>:<key>')``, so the same seed
gives the same split for any partitioning (and an SQL engine can reproduce
it).  The test set of each class is everything up to that class's k-th
hash - a selection found with the distributed rank, then applied as a
plain filter expression: the wide rows are never shuffled.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame, Window, functions as F

from cairn.functions.columns import hash_order, numeric_columns, r6
from cairn.operators.ranking import kth_rows, kth_rows_multi
from cairn.operators.select import NON_FEATURES

log = logging.getLogger(__name__)

# Split labels, defaults and check thresholds.
TRAIN, TEST = "train", "test"
SEED = 42
MAX_CLASSES = 10_000
BALANCE_WARN = 0.02
DRIFT_WARN, DRIFT_OK, DRIFT_FEATURES = 0.10, 0.05, 5


def class_quotas(counts: dict, n_test: int) -> dict:
    """Largest-remainder allocation of n_test seats over classes
    (floor of the proportional share, leftovers by largest remainder, ties by class value)."""
    n = sum(counts.values())
    share = {c: k * n_test / n for c, k in counts.items()}
    quota = {c: math.floor(s) for c, s in share.items()}
    left = n_test - sum(quota.values())
    order = sorted(counts, key=lambda c: (-(share[c] - quota[c]), (c is None, c)))
    for c in order[:left]:
        quota[c] += 1
    return quota


def controlled_quotas(counts: dict[tuple, int], n_test: int) -> dict[tuple, int]:
    """Seats per stratum (first value, rest) so that every stratum, every first value, every rest and the whole get their
    proportional share rounded down or up, and the whole exactly ``n_test``.

    Of all such roundings the one whose rounded-up strata have the largest remainders in sum; of equal sums the one that rounds
    up the earlier strata in the order of their values.  A cheapest flow from first values through strata to rests finds it."""
    n = sum(counts.values())
    order = sorted(counts, key=lambda c: [(v is None, v) for v in c])
    quota = {c: counts[c] * n_test // n for c in order}
    rest = {c: counts[c] * n_test % n for c in order}
    m = len(order)

    def margin(side: int) -> dict:
        """{value: (least, most)} of the seats still to give."""
        total: dict = {}
        for c in order:
            v = c[0] if side == 0 else c[1:]
            k, floors = total.get(v, (0, 0))
            total[v] = k + counts[c], floors + quota[c]
        return {v: (k * n_test // n - f, -(-k * n_test // n) - f) for v, (k, f) in total.items()}

    edges: list[list] = []          # to, capacity, cost; the reverse edge follows
    at: dict = {}

    def node(name) -> int:
        return at.setdefault(name, len(at))

    def edge(x: int, y: int, capacity: int, cost: int) -> None:
        edges.append([x, y, capacity, cost])
        edges.append([y, x, 0, -cost])

    source, sink = node("source"), node("sink")
    must = -(n + 1) * (m + 1) << (m + 1)        # more than all strata are worth
    for side, sign in ((0, 1), (1, -1)):
        for v, (least, most) in margin(side).items():
            x, y = (source, node((0, v))) if side == 0 else (node((1, v)), sink)
            edge(x, y, least, must)
            edge(x, y, most - least, 0)
    first = len(edges)
    cells = [c for c in order if rest[c]]
    for c in cells:
        edge(node((0, c[0])), node((1, c[1:])), 1, -((rest[c] << m) + (1 << (m - 1 - order.index(c)))))
    for _ in range(n_test - sum(quota.values())):
        far, via = {source: 0}, {}
        changed = True
        while changed:
            changed = False
            for i, (x, y, capacity, cost) in enumerate(edges):
                if capacity and x in far and (y not in far or far[x] + cost < far[y]):
                    far[y], via[y], changed = far[x] + cost, i, True
        y = sink
        while y != source:
            i = via[y]
            edges[i][2] -= 1
            edges[i ^ 1][2] += 1
            y = edges[i][0]
    for k, c in enumerate(cells):
        quota[c] += 1 - edges[first + 2 * k][2]
    return quota


def merge_rare(counts: dict[tuple, int], least: int = 2) -> dict[tuple, tuple]:
    """{rare stratum: stratum it joins}: one with fewer than ``least`` rows joins the largest other with the same first value (ties:
    the first in order), or the largest of all where there is none."""
    order = sorted(counts, key=lambda c: [(v is None, v) for v in c])
    common = [c for c in order if counts[c] >= least]
    out = {}
    for c in order:
        if counts[c] < least and common:
            near = [x for x in common if x[0] == c[0]] or common
            out[c] = max(near, key=lambda x: (counts[x], -order.index(x)))
    return out


def _class_counts(df: DataFrame, target: str, max_classes: int = MAX_CLASSES) -> dict:
    rows = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{target}: more than {max_classes} classes to stratify on; raise max_classes")
    return {r[target]: r["n"] for r in rows}


def _require_keys(df: DataFrame, key: str) -> None:
    """Rows are chosen by their key's hash, so a NULL key has no place in the order."""
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"NULL in split key {key}")


LITERAL_CUTS = 64   # up to this many classes the cuts are literals; beyond, a broadcast join


def _split_by_quota(df: DataFrame, key: str, quotas: dict, seed: int, target: str | None, out: str) -> DataFrame:
    h = hash_order(seed, key)
    keyed = df.select(F.col(key), *([F.col(target)] if target else []), h.alias("__h"))
    group = [target] if target else []
    cut = kth_rows(keyed, [F.col("__h"), F.col(key)], quotas, group)
    kt = dict(df.dtypes)[key]
    row_key = F.struct(h.alias("h"), F.col(key).alias("k"))
    if len(cut) > LITERAL_CUTS:
        # one row per class, bounded by MAX_CLASSES (checked when counting classes)
        tt = dict(df.dtypes)[target]
        cuts = df.sparkSession.createDataFrame([(g[0], r["__h"], r[key]) for g, r in cut.items()],
                                               f"`{target}` {tt}, __ch string, __ck {kt}")
        j = df.join(F.broadcast(cuts), df[target].eqNullSafe(cuts[target]), "left")
        le = row_key <= F.struct(F.col("__ch").alias("h"), F.col("__ck").alias("k"))
        return j.select(*[df[c] for c in df.columns],
                        F.when(F.coalesce(le, F.lit(False)), F.lit(TEST)).otherwise(F.lit(TRAIN)).alias(out))
    cond = F.lit(False)
    for g, r in cut.items():
        le = row_key <= F.struct(F.lit(r["__h"]).alias("h"), F.lit(r[key]).cast(kt).alias("k"))
        cond = cond | ((F.col(target).eqNullSafe(F.lit(g[0])) & le) if target else le)
    return df.withColumn(out, F.when(cond, F.lit(TEST)).otherwise(F.lit(TRAIN)))


def random_split(df: DataFrame, key: str = "customer_id", test_size: float = 0.2,
                 seed: int = SEED, out: str = "split") -> DataFrame:
    """ceil(n * test_size) rows go to test, chosen by seeded hash."""
    _require_keys(df, key)
    n = df.count()
    return _split_by_quota(df, key, {(): math.ceil(n * test_size)}, seed, None, out)


def stratified_split(df: DataFrame, key: str = "customer_id", target: str = "churned",
                     test_size: float = 0.2, seed: int = SEED, out: str = "split",
                     max_classes: int = MAX_CLASSES) -> DataFrame:
    """T1 (+T3 fallback): class shares kept by largest remainder; a class with
    fewer than 2 rows (or too few rows for one seat per class) falls back to
    a random split with a warning.  NULL is a class of its own; a NULL key raises.
    Class counts and cuts are held by the driver, so ``max_classes`` bounds them."""
    _require_keys(df, key)
    counts = _class_counts(df, target, max_classes)
    n = sum(counts.values())
    n_test = math.ceil(n * test_size)
    if not counts or min(counts.values()) < 2 or n_test < len(counts) or n - n_test < len(counts):
        log.warning("stratification impossible for %s; falling back to a random split", target)
        return random_split(df, key, test_size, seed, out)
    quotas = class_quotas(counts, n_test)
    return _split_by_quota(df, key, {(c,): q for c, q in quotas.items()}, seed, target, out)


def stratified_split_by(df: DataFrame, key: str = "customer_id", targets: list[str] | str = "churned", test_size: float = 0.2, seed: int = SEED,
                        out: str = "split", max_classes: int = MAX_CLASSES) -> DataFrame:
    """T1 on one or several columns.  The strata are the value combinations; ``controlled_quotas`` keeps the shares jointly, of the
    first column, and of the combinations of the others, each within one row.  Rare strata are merged (``merge_rare``).

    One column, a single row of some class or too few seats do as ``stratified_split`` does.  NULL is a value of its own; a
    NULL key raises.  The driver holds a count and a cut per stratum, at most ``max_classes``."""
    targets = [targets] if isinstance(targets, str) else list(targets)
    if len(targets) == 1:
        return stratified_split(df, key, targets[0], test_size, seed, out, max_classes)
    _require_keys(df, key)
    rows = df.groupBy(*targets).agg(F.count(F.lit(1)).alias("n")).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{targets}: more than {max_classes} strata; raise max_classes")
    counts = {tuple(r[t] for t in targets): r["n"] for r in rows}
    n, merged = sum(counts.values()), merge_rare(counts)
    n_test = math.ceil(n * test_size)
    for c, to in merged.items():
        counts[to] += counts.pop(c)
    if len(counts) < 2 or min(counts.values()) < 2 or n_test < len(counts) or n - n_test < len(counts):
        log.warning("stratification impossible for %s; falling back to a random split", targets)
        return random_split(df, key, test_size, seed, out)
    name = {c: i for i, c in enumerate(sorted(counts, key=lambda c: [(v is None, v) for v in c]))}
    types = dict(df.dtypes)
    table = df.sparkSession.createDataFrame([(*c, name[merged.get(c, c)]) for c in [*counts, *merged]],
                                            ", ".join([*(f"__t{i} {types[t]}" for i, t in enumerate(targets)), "__stratum int"]))
    same = [df[t].eqNullSafe(table[f"__t{i}"]) for i, t in enumerate(targets)]
    labelled = df.join(F.broadcast(table), same).select(*[df[c] for c in df.columns], "__stratum")      # a row per stratum, counted above
    quotas = controlled_quotas(counts, n_test)
    return _split_by_quota(labelled, key, {(name[c],): q for c, q in quotas.items()}, seed, "__stratum", out).drop("__stratum")


def train_test(df: DataFrame, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col(split_col) == TRAIN).drop(split_col),
            df.where(F.col(split_col) == TEST).drop(split_col))


def assign_folds(df: DataFrame, key: str = "customer_id", target: str = "churned", k: int = 5,
                 seed: int = SEED, out: str = "fold", max_classes: int = MAX_CLASSES) -> DataFrame:
    """M3: stratified k folds.  Within each class, rows in seeded-hash order
    are cut into k contiguous blocks: fold = ceil(rank * k / n_class) - 1, so
    each class's fold sizes differ by at most one.

    Only the k - 1 cut rows per class are selected (distributed rank on the
    narrow (class, hash, key) projection); the fold is then a projection on
    the wide rows, which are never shuffled.  Up to LITERAL_CUTS cuts they
    are literals, beyond that a broadcast table of one row per class
    (``max_classes`` at most).  NULL is a class of its own; a NULL key raises."""
    _require_keys(df, key)
    counts = _class_counts(df, target, max_classes)
    cuts = {(c,): [math.floor(i * n / k) for i in range(1, k)] for c, n in counts.items()}
    h = hash_order(seed, key)
    keyed = df.select(F.col(key), F.col(target), h.alias("__h"))
    kt = dict(df.dtypes)[key]
    row_key = F.struct(h.alias("h"), F.col(key).alias("k"))
    sel = kth_rows_multi(keyed, [F.col("__h"), F.col(key)], cuts, [target])
    if sum(len(v) for v in cuts.values()) > 4 * LITERAL_CUTS:
        tt = dict(df.dtypes)[target]
        rows = [(c[0], [(sel[(c, p)]["__h"], sel[(c, p)][key]) for p in positions if p > 0])
                for c, positions in cuts.items()]
        table = df.sparkSession.createDataFrame(rows, f"`{target}` {tt}, __cuts array<struct<h: string, k: {kt}>>")
        j = df.join(F.broadcast(table), df[target].eqNullSafe(table[target]), "left")
        above = F.size(F.filter("__cuts", lambda x: row_key > x))
        return j.select(*[df[c] for c in df.columns], above.cast("int").alias(out))
    fold = F.lit(0)
    for c, positions in cuts.items():
        above = [(row_key > F.struct(F.lit(sel[(c, p)]["__h"]).alias("h"),
                                     F.lit(sel[(c, p)][key]).cast(kt).alias("k"))).cast("int")
                 for p in positions if p > 0]
        if above:
            fold = F.when(F.col(target).eqNullSafe(F.lit(c[0])), sum(above[1:], above[0])).otherwise(fold)
    return df.withColumn(out, fold.cast("int"))


def balance_report(df: DataFrame, target: str = "churned", split_col: str = "split",
                   warn: float = BALANCE_WARN) -> DataFrame:
    """T4: target rate per split, absolute difference, warn flag (one pass, no shuffle)."""
    y = F.col(target).cast("double")
    s = F.col(split_col)
    agg = df.agg(F.avg(F.when(s == TRAIN, y)).alias("tr"), F.avg(F.when(s == TEST, y)).alias("te"),
                 F.avg(y).alias("al"))
    d = F.abs(F.col("tr") - F.col("te"))
    return agg.select(r6("tr").alias("train_rate"), r6("te").alias("test_rate"), r6("al").alias("overall_rate"),
                      r6(d).alias("rate_diff"), (d > warn).alias("warn"))


def drift_features(df: DataFrame, target: str = "churned", n: int = DRIFT_FEATURES,
                   exclude=NON_FEATURES + ("split", "fold")) -> list[str]:
    """The first n numeric, non-boolean feature columns."""
    return numeric_columns(df, exclude=set(exclude) | {target})[:n]


def drift_report(df: DataFrame, cols: list[str] | None = None, split_col: str = "split",
                 target: str = "churned", warn: float = DRIFT_WARN) -> DataFrame:
    """T5: (feature, train_mean, test_mean, relative_diff, warn); relative
    difference is NULL where the train mean is 0 (skipped, as in the checks)."""
    cols = drift_features(df, target) if cols is None else cols
    s = F.col(split_col)
    agg = df.agg(*[F.struct(F.lit(c).alias("feature"),
                            F.avg(F.when(s == TRAIN, F.col(c).cast("double"))).alias("train_mean"),
                            F.avg(F.when(s == TEST, F.col(c).cast("double"))).alias("test_mean")).alias(f"__d{i}")
                   for i, c in enumerate(cols)])
    long = agg.select(F.explode(F.array(*[F.col(f"__d{i}") for i in range(len(cols))])).alias("d")).select("d.*")
    rel = F.when(F.col("train_mean") != 0,
                 F.abs(F.col("train_mean") - F.col("test_mean")) / F.abs(F.col("train_mean")))
    return long.select("feature", r6("train_mean").alias("train_mean"), r6("test_mean").alias("test_mean"),
                       r6(rel).alias("relative_diff"), F.coalesce(rel > warn, F.lit(False)).alias("warn"))


def drift_summary(report: DataFrame, ok: float = DRIFT_OK) -> DataFrame:
    """T5 summary: average relative difference over checked features and the 'consistent' flag."""
    return report.agg(r6(F.avg("relative_diff")).alias("avg_relative_diff"),
                      F.count("relative_diff").alias("n_checked")) \
        .withColumn("consistent", F.col("avg_relative_diff") < ok)


def leakage_check(df: DataFrame, key: str = "customer_id", split_col: str = "split",
                  fail: bool = True) -> DataFrame:
    """Keys present in both splits as a one-row report (n_overlap, leakage);
    raises when ``fail`` and any exist.  One grouped pass: two flags per key."""
    per_key = (df.where(F.col(key).isNotNull()).groupBy(key)
               .agg(F.max((F.col(split_col) == TRAIN).cast("int")).alias("a"),
                    F.max((F.col(split_col) == TEST).cast("int")).alias("b")))
    rep = per_key.agg(F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("n_overlap"))
    if fail:
        n = rep.first()["n_overlap"]
        if n > 0:
            raise ValueError("data leakage detected: same keys in train and test")
        rep = df.sparkSession.createDataFrame([(n,)], "n_overlap long")
    return rep.withColumn("leakage", F.col("n_overlap") > 0)


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """(split, n, share)."""
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())      # over the per-split counts: one row per split value
    return counts.select(split_col, "n", r6(F.col("n") / total).alias("share"))
