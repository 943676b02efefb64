"""DuckDB SQL of second-order boosting with trees of depth one, over the train and test rows of ``esplit``.

``chain`` grows any number of models side by side, a few CTEs a round:
gradients on the 2^-24 grid, running sums over the bins, the best cut by
gain, and new margins.  It shares nothing with the Spark side but the
definition of the method.
"""

from __future__ import annotations

GRID = 16777216.0


def chain(features: list[str], models: list[tuple], rounds: int, max_bins: int) -> list[str]:
    """CTE blocks ending in ``best`` (m, round, f, b, cut, gain, ...) and ``scores`` (m, customer_id, split, fold, y, margin, prob).

    ``models`` are (m, fold left out or -1, learning rate, lambda[, rounds]); a split needs hessian sums of 1."""
    plain = [c.strip('"') for c in features]
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in features)
    index = "CASE name " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(plain)) + " END"
    quantiles = "[" + ", ".join(repr(i / max_bins) for i in range(1, max_bins)) + ", 1.0]"
    values = ", ".join(f"({m}, {fold}, CAST({lr} AS DOUBLE), CAST({lam} AS DOUBLE), {(rest or [rounds])[0]})" for m, fold, lr, lam, *rest in models)
    blocks = [f"""models AS (SELECT * FROM (VALUES {values}) t(m, left_out, lr, lam, n_rounds)),
folds AS (SELECT customer_id, CAST(ceil(row_number() OVER (PARTITION BY churned ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)), customer_id)
            * 3 / count(*) OVER (PARTITION BY churned)) - 1 AS INTEGER) AS fold FROM esplit WHERE split = 'train'),
everyone AS (SELECT e.customer_id, e.split, e.churned AS y, coalesce(fold, -2) AS fold FROM esplit e LEFT JOIN folds USING (customer_id)),
lx AS (SELECT customer_id, split, {index} AS f, value AS x FROM (
  UNPIVOT (SELECT customer_id, split, {doubles} FROM esplit) ON {", ".join(features)} INTO NAME name VALUE value)),
cuts AS (SELECT f, cut, row_number() OVER (PARTITION BY f ORDER BY cut) - 1 AS b FROM (
  SELECT DISTINCT f, unnest(quantile_disc(x, {quantiles})) AS cut FROM lx WHERE split = 'train' GROUP BY f)),
lb AS (SELECT customer_id, lx.f, count(cut) AS b FROM lx LEFT JOIN cuts ON cuts.f = lx.f AND cut < x GROUP BY customer_id, lx.f),
learn AS (SELECT m, customer_id, y, lr, lam FROM models, everyone WHERE split = 'train' AND fold <> left_out),
bases AS (SELECT m, ln(avg(y) / (1 - avg(y))) AS base FROM learn GROUP BY m),
mg0 AS (SELECT m, customer_id, base AS margin FROM bases, everyone)"""]
    for t in range(1, rounds + 1):
        blocks.append(f"""gh{t} AS (SELECT m, customer_id, round((p - y) * {GRID}) / {GRID} AS g, round(p * (1 - p) * {GRID}) / {GRID} AS h
  FROM (SELECT m, customer_id, y, 1 / (1 + exp(-margin)) AS p FROM learn JOIN mg{t - 1} USING (m, customer_id))),
sums{t} AS (SELECT m, f, b, sum(g) AS g, sum(h) AS h FROM gh{t} JOIN lb USING (customer_id) GROUP BY m, f, b),
run{t} AS (SELECT m, f, b, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY m, f) AS ga, sum(h) OVER (PARTITION BY m, f) AS ha
  FROM sums{t} WINDOW w AS (PARTITION BY m, f ORDER BY b)),
best{t} AS (SELECT m, f, b, gl, hl, ga - gl AS gr, ha - hl AS hr,
    gl * gl / (hl + lam) + (ga - gl) * (ga - gl) / (ha - hl + lam) - ga * ga / (ha + lam) AS gain,
    -gl / (hl + lam) * lr AS vl, -(ga - gl) / (ha - hl + lam) * lr AS vr
  FROM run{t} JOIN models USING (m) WHERE hl >= 1 AND ha - hl >= 1 AND n_rounds >= {t}
  QUALIFY row_number() OVER (PARTITION BY m ORDER BY gain DESC, f, b) = 1 AND gain > 1e-6),
mg{t} AS (SELECT mg.m, mg.customer_id, margin + coalesce(CASE WHEN lb.b <= s.b THEN vl ELSE vr END, 0) AS margin
  FROM mg{t - 1} mg LEFT JOIN best{t} s ON s.m = mg.m LEFT JOIN lb ON lb.customer_id = mg.customer_id AND lb.f = s.f)""")
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(plain))
    every = " UNION ALL ".join(f"SELECT {t} AS round, * FROM best{t}" for t in range(1, rounds + 1))
    blocks.append(f"""feature_names AS (SELECT * FROM (VALUES {names}) t(f, feature)),
best AS (SELECT x.*, feature, cut FROM ({every}) x JOIN feature_names USING (f) JOIN cuts USING (f, b)),
scores AS (SELECT m, customer_id, split, fold, y, margin, 1 / (1 + exp(-margin)) AS prob FROM mg{rounds} JOIN everyone USING (customer_id))""")
    return blocks


def metrics(where: str, group: str) -> list[str]:
    """CTE ``found``: the five metrics (and the confusion counts) of ``scores`` rows that satisfy ``where``, per ``group``."""
    return [f"""judged AS (SELECT {group}, y, prob, CAST(prob > 0.5 AS INTEGER) AS p FROM scores JOIN models USING (m) WHERE {where}),
counted AS (SELECT {group}, CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) AS tp FROM judged GROUP BY {group}),
by_score AS (SELECT {group}, prob, sum(y) AS pos, sum(1 - y) AS neg FROM judged GROUP BY {group}, prob),
below AS (SELECT {group}, pos, neg, sum(neg) OVER (PARTITION BY {group} ORDER BY prob) - neg AS under FROM by_score),
areas AS (SELECT {group}, sum(pos * (under + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM below GROUP BY {group}),
found AS (SELECT *, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
    round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
    round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_score, round(auc, 6) AS roc_auc,
    round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6) AS specificity,
    round(CASE WHEN tn + fp > 0 THEN fp / (tn + fp) ELSE 0 END, 6) AS false_positive_rate,
    round(CASE WHEN tp + fn > 0 THEN fn / (tp + fn) ELSE 0 END, 6) AS false_negative_rate
  FROM counted JOIN areas USING ({group}))"""]
