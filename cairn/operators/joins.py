"""Keyed joins, join coverage and key-overlap (leakage) checks."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, functions as F

from cairn.functions.columns import r6

log = logging.getLogger(__name__)


def join_inner(a: DataFrame, b: DataFrame, on: str | list[str] = "customer_id",
               suffixes: tuple[str, str] = ("_trans", "_demo"), null_safe: bool = False,
               how: str = "inner") -> DataFrame:
    """Equi-join on key columns; overlapping non-key columns get the suffixes
    (only those that collide).  Duplicate keys multiply rows.  With
    ``null_safe`` NULL keys match each other (pandas merge semantics).
    The engine picks broadcast or sort-merge from the sizes (AQE)."""
    keys = [on] if isinstance(on, str) else list(on)
    clash = (set(a.columns) & set(b.columns)) - set(keys)
    a2 = a.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c) for c in a.columns])
    b2 = b.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c) for c in b.columns])
    if not null_safe:
        return a2.join(b2, keys, how)
    bk = b2.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in b2.columns])
    cond = [a2[k].eqNullSafe(bk[f"__r_{k}"]) for k in keys]
    j = a2.join(bk, cond, how)
    return j.select(*[F.coalesce(a2[k], bk[f"__r_{k}"]).alias(k) for k in keys],
                    *[a2[c] for c in a2.columns if c not in keys],
                    *[bk[c] for c in bk.columns if not c.startswith("__r_")])


def join_coverage(left: DataFrame, joined: DataFrame, key: str = "customer_id",
                  warn_below: float = 0.95) -> DataFrame:
    """Distinct joined keys / distinct left keys, with the warning flag.

    Both distinct counts are exact; partial aggregation on the key runs
    map-side before the shuffle."""
    lk = left.agg(F.count_distinct(key).alias("left_keys"), F.lit(None).cast("long").alias("joined_keys"))
    jk = joined.agg(F.lit(None).cast("long").alias("left_keys"), F.count_distinct(key).alias("joined_keys"))
    cov = lk.unionByName(jk).agg(F.max("left_keys").alias("left_keys"), F.max("joined_keys").alias("joined_keys"))
    rate = F.when(F.col("left_keys") > 0, F.col("joined_keys") / F.col("left_keys")).otherwise(F.lit(0.0))
    return cov.select("left_keys", "joined_keys", r6(rate).alias("coverage"),
                      (rate < warn_below).alias("warn"))


def key_overlap(a: DataFrame, b: DataFrame, key: str = "customer_id", fail: bool = True) -> DataFrame:
    """Distinct keys present in both frames.  With ``fail`` a non-empty
    overlap raises ``ValueError`` (the guard fetches at most one row)."""
    overlap = a.select(key).where(F.col(key).isNotNull()).distinct() \
        .join(b.select(key), key, "left_semi")
    if fail and overlap.limit(1).count() > 0:
        raise ValueError(f"key overlap on {key}: same keys in both frames (data leakage)")
    return overlap


def key_overlap_report(a: DataFrame, b: DataFrame, key: str = "customer_id") -> DataFrame:
    """J3/T6 as a one-row report: (n_overlap, leakage)."""
    ov = key_overlap(a, b, key, fail=False)
    return ov.agg(F.count(F.lit(1)).alias("n_overlap")).withColumn("leakage", F.col("n_overlap") > 0)


# How many frequent keys a side's sketch reports, and how many it tracks while it is merged; both bound what the driver holds.
HOT_KEYS, TRACKED_KEYS = 64, 4096


def hot_keys(df: DataFrame, keys: list[str], most: int | None = None) -> dict[int, int]:
    """{key hash: rows} of the keys with more than ``most`` rows (default: a shuffle partition's fair share), from one
    mergeable frequent-items sketch.  The estimates are at most 1 / TRACKED_KEYS of the rows too high."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = df.select(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED_KEYS})").alias("top")).first()
    limit = max(1, r["n"] // partitions) if most is None else most
    return {x["item"]: x["count"] for x in r["top"] or [] if x["count"] > limit}


def join_skewed(a: DataFrame, b: DataFrame, on: str | list[str] = "customer_id", suffixes: tuple[str, str] = ("_trans", "_demo"),
                null_safe: bool = False, rows_per_part: int | None = None, seed: int = 42) -> DataFrame:
    """J1 where a key, on either side or both, may hold a large share of the rows; the same rows as ``join_inner``.

    Sketches of both sides find the hot keys.  A hot key's rows are dealt to parts of about ``rows_per_part`` rows (default: a
    shuffle partition's fair share of the side) and copied to every part of the other side, so each pair meets in exactly
    one cell and no task gets the whole key.  All other rows are shuffled once, as in a plain join."""
    keys = [on] if isinstance(on, str) else list(on)
    partitions = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def parts(df: DataFrame) -> dict[int, int]:
        most = rows_per_part or max(1, df.count() // partitions)
        return {h: -(-n // most) for h, n in hot_keys(df, keys, most).items()}

    of_a, of_b = parts(a), parts(b)
    if not of_a and not of_b:
        return join_inner(a, b, on, suffixes, null_safe)

    def dealt(df: DataFrame, mine: dict, other: dict, names: tuple[str, str], salt: int) -> DataFrame:
        def count(of: dict):
            if not of:
                return F.lit(1)
            return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in of.items() for x in p]), F.xxhash64(*keys)), F.lit(1))
        own, copies = names
        return (df.withColumn(own, F.floor(F.rand(seed + salt) * count(mine)).cast("int"))
                .withColumn(copies, F.explode(F.sequence(F.lit(0), count(other).cast("int") - 1))))

    cells = ("__cell_a", "__cell_b")
    joined = join_inner(dealt(a, of_a, of_b, cells, 0), dealt(b, of_b, of_a, cells[::-1], 1), [*keys, *cells], suffixes, null_safe)
    return joined.drop(*cells)
