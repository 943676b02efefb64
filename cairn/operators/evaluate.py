"""Evaluation of a (label, prediction, score) frame.

All metrics are aggregates over the scored rows; curves and AUC use the
per-score histogram (pre-aggregated, so a hot score value is one row) and
the distributed running sum - no global single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cairn.functions.columns import hash_order, r6
from cairn.operators.ranking import running_sum

# Histogram bin count, sample size and default seed.
HIST_BINS = 30
SAMPLE_ROWS = 100
SEED = 42
MAX_CLASSES = 1000          # default bound of the classes whose score ranges are held as literals
CURVE_BLOCK = 100_000       # neighbouring curve points that one window group holds


def _ratio(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Tn, fp, fn, tp in one pass (zeros when a class is absent)."""
    y, p = F.col(label), F.col(pred)
    return scored.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                      F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def basic_metrics(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1, specificity, FPR, FNR (zero denominators -> 0)."""
    return metrics_from_confusion(confusion(scored, label, pred))


def metrics_from_confusion(c: DataFrame) -> DataFrame:
    """E2-E4 from a one-row (tn, fp, fn, tp) frame."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return c.select(
        r6(_ratio(tp + tn, tp + tn + fp + fn)).alias("accuracy"),
        r6(prec).alias("precision"), r6(rec).alias("recall"),
        r6(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
        r6(_ratio(tn, tn + fp)).alias("specificity"),
        r6(_ratio(fp, fp + tn)).alias("false_positive_rate"),
        r6(_ratio(fn, fn + tp)).alias("false_negative_rate"))


def score_histogram_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg) per distinct score: map-side combined before the shuffle."""
    y = F.col(label).cast("long")
    return scored.groupBy(score).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def score_curve(scored: DataFrame, label: str = "label", score: str = "score"):
    """(score, pos, neg, tps, fps) per distinct score in descending order, with
    P and N: the one distributed running sum behind E5, E7 and E8."""
    h = score_histogram_counts(scored, label, score)
    rs = running_sum(h, [F.col(score).desc()], {"tps": "pos", "fps": "neg", "idx": None})
    P = sum(t[0] for t in rs.totals.values())
    N = sum(t[1] for t in rs.totals.values())
    return rs.df, P, N


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", curve=None) -> DataFrame:
    """E5: exact ROC AUC; tied scores count one half.  Each negative at score s
    beats the positives above it and ties half of those at s:
    sum_s neg_s * (tps_s - pos_s / 2) / (P * N)."""
    pts, P, N = score_curve(scored, label, score) if curve is None else curve
    agg = pts.agg(F.sum(F.col("neg").cast("double") * (F.col("tps") - 0.5 * F.col("pos"))).alias("s"))
    auc = F.col("s") / F.lit(float(P) * float(N)) if P and N else F.lit(None).cast("double")
    return agg.select(r6(auc).alias("roc_auc"))


def _drop_collinear(pts: DataFrame) -> DataFrame:
    """Keep the first and last points and every point where the curve bends
    (second difference of fps or tps non-zero).

    Points are dealt to blocks of CURVE_BLOCK neighbours, the points at a
    block's edges to the next block too, and lag and lead run inside a
    block: one shuffle, and no window over the whole curve."""
    own = F.floor(F.col("idx") / CURVE_BLOCK)
    at = F.col("idx") % CURVE_BLOCK
    blocks = F.when(at == 0, F.array(own, own - 1)).when(at == CURVE_BLOCK - 1, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = pts.withColumn("__own", own).withColumn("__block", F.explode(blocks))
    w = Window.partitionBy("__block").orderBy("idx")
    for c in ("tps", "fps"):
        dealt = dealt.withColumn(f"__{c}", F.lead(c).over(w) - 2 * F.col(c) + F.lag(c).over(w))
    ends = F.col("__tps").isNull()      # no neighbour on one side: the first or last point
    bend = (F.col("__tps") != 0) | (F.col("__fps") != 0)
    return dealt.where((F.col("__own") == F.col("__block")) & (ends | bend)).select(*pts.columns)


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score", curve=None,
              drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score (collinear
    intermediate points dropped by default), plus the origin at +inf."""
    pts, P, N = score_curve(scored, label, score) if curve is None else curve
    if drop_intermediate:
        pts = _drop_collinear(pts)
    spark = scored.sparkSession
    origin = spark.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    body = pts.select(F.col(score).cast("double").alias("threshold"),
                      (F.col("fps") / F.lit(float(N)) if N else F.lit(None).cast("double")).alias("fpr"),
                      (F.col("tps") / F.lit(float(P)) if P else F.lit(None).cast("double")).alias("tpr"))
    return origin.unionByName(body).select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score", curve=None) -> DataFrame:
    """(threshold, precision, recall) per distinct score, the final
    (precision 1, recall 0) point without threshold, and the positive-rate baseline."""
    pts, P, N = score_curve(scored, label, score) if curve is None else curve
    spark = scored.sparkSession
    base = float(P) / (P + N) if (P + N) else None
    recall = F.col("tps") / F.lit(float(P)) if P else F.lit(1.0)
    body = pts.select(F.col(score).cast("double").alias("threshold"),
                      _ratio(F.col("tps").cast("double"), F.col("tps") + F.col("fps")).alias("precision"),
                      recall.alias("recall"))
    end = spark.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return body.unionByName(end).select("threshold", r6("precision").alias("precision"),
                                        r6("recall").alias("recall"), r6(F.lit(base)).alias("baseline"))


def score_histogram(scored: DataFrame, label: str = "label", score: str = "score",
                    bins: int = HIST_BINS, max_classes: int = MAX_CLASSES) -> DataFrame:
    """Per class, ``bins`` equal-width bins over that class's own min..max
    (last bin closed; a constant class is centred as NumPy does), empty bins included.
    The driver holds a row per class, so more than ``max_classes`` raise."""
    s = F.col(score).cast("double")
    found = scored.groupBy(label).agg(F.min(s).alias("mn"), F.max(s).alias("mx")).where(F.col(label).isNotNull())
    rows = found.limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label}: more than {max_classes} classes; raise max_classes")
    # the ranges are literals on the scored rows, which then only feed a partial aggregate
    ranges = [(r[label], *((r["mn"], r["mx"]) if r["mx"] is not None and r["mx"] > r["mn"]
                           else (None, None) if r["mn"] is None else (r["mn"] - 0.5, r["mx"] + 0.5))) for r in rows]
    b = F.lit(None).cast("int")
    for y, lo, hi in ranges:
        if lo is not None:
            b = F.when(F.col(label) == F.lit(y), F.least(F.floor((s - F.lit(lo)) * F.lit(float(bins) / (hi - lo))),
                                                         F.lit(bins - 1)).cast("int")).otherwise(b)
    counts = scored.groupBy(label, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    rng = scored.sparkSession.createDataFrame(ranges, f"`{label}` {dict(scored.dtypes)[label]}, lo double, hi double")
    grid = rng.select(label, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return grid.join(counts, [label, "bin"], "left").select(
        label, "bin", r6(F.col("lo") + F.col("bin") * w).alias("bin_start"),
        r6(F.col("lo") + (F.col("bin") + 1) * w).alias("bin_end"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def class_report(scored: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision/recall/F1/support, then accuracy, macro and weighted averages."""
    return class_report_from_confusion(confusion(scored, label, pred))


def class_report_from_confusion(c: DataFrame) -> DataFrame:
    """E6 from a one-row (tn, fp, fn, tp) frame."""
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1 = _ratio(2 * p1 * r1, p1 + r1)
    f0 = _ratio(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    rows = F.array(
        F.struct(F.lit("0").alias("label"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("1").alias("label"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _ratio(tp + tn, n).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), _ratio(p0 * s0 + p1 * s1, n).alias("precision"),
                 _ratio(r0 * s0 + r1 * s1, n).alias("recall"), _ratio(f0 * s0 + f1 * s1, n).alias("f1_score"),
                 n.alias("support")))
    return c.select(F.explode(rows).alias("r")).select(
        "r.label", r6("r.precision").alias("precision"), r6("r.recall").alias("recall"),
        r6("r.f1_score").alias("f1_score"), F.col("r.support").cast("long").alias("support"))


def sample_rows(df: DataFrame, key: str, n: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """At most n rows without replacement, chosen by seeded hash order
    (TakeOrdered: n rows per partition, then merged)."""
    return df.orderBy(hash_order(seed, key), F.col(key)).limit(n)


def predictions(scored: DataFrame, key: str | None = "customer_id", label: str = "churned",
                pred: str = "prediction", prob: str = "probability_1",
                names=("actual_churn", "predicted_churn", "churn_probability", "correct_prediction")) -> DataFrame:
    """[key], actual, predicted, probability, correctness flag."""
    a, p, pr, ok = names
    cols = ([F.col(key)] if key else []) + [
        F.col(label).cast("int").alias(a), F.col(pred).cast("int").alias(p),
        F.col(prob).cast("double").alias(pr), (F.col(label).cast("int") == F.col(pred).cast("int")).alias(ok)]
    return scored.select(*cols)


def predicted_rate(scored: DataFrame, pred: str = "prediction") -> DataFrame:
    """Share of positive predictions."""
    return scored.agg(F.count(F.lit(1)).alias("n"), r6(F.avg(F.col(pred).cast("double"))).alias("predicted_rate"))
