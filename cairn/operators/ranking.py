"""Distributed running sums and ranks (no single-partition global window).

A global ``Window.orderBy`` moves every row into one task.  Instead:

1. range-partition on (group, order) keys: partitions are balanced and
   ordered, and a ``tiebreak`` column splits runs of equal keys;
2. per (partition, group) running sums with a window partitioned by the
   partition id (bounded: one range partition per window group);
3. per (partition, group) totals - at most partitions x groups numbers -
   are collected, turned into exclusive prefix offsets and broadcast back.

The result is exact and independent of how the input was partitioned.
"""

from __future__ import annotations

from itertools import groupby

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from cairn.session import shared_dir

# Size check for the offset table (partitions x groups): up to this many rows
# it is collected and broadcast; beyond it the offsets are computed with a
# window per group over the totals and joined back without broadcast.
BROADCAST_OFFSET_ROWS = 100_000


class RunningSum:
    """``df``: input rows plus the running-sum columns; ``totals``: group tuple ->
    tuple of per-group weight totals (computed on first use in the wide case)."""

    def __init__(self, df: DataFrame, totals: dict | None = None, totals_df: DataFrame | None = None,
                 group_by=(), names=()):
        self.df, self._totals, self._totals_df = df, totals, totals_df
        self._group_by, self._names = list(group_by), list(names)

    @property
    def totals(self) -> dict:
        if self._totals is None:
            rows = self._totals_df.collect()
            self._totals = {tuple(r[g] for g in self._group_by): tuple(r[n] for n in self._names) for r in rows}
        return self._totals


def _sort_key(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_sum(df: DataFrame, order_by: list, weights: dict[str, object] | None = None,
                group_by: list[str] | None = None, num_partitions: int | None = None,
                storage: StorageLevel | None = None) -> RunningSum:
    """Inclusive running sums of ``weights`` ({out_name: column or None for 1})
    in ``order_by`` order within ``group_by`` groups.

    ``order_by`` must make the order total (add a unique key as the last
    item) so results do not depend on scheduling.

    The range-partitioned input is read twice (totals, then sums), so it is
    checkpointed to the shared ``spark.checkpoint.dir`` (lineage cut, no
    executor memory held, survives executor loss); pass a ``storage`` level
    to persist instead.
    """
    group_by = list(group_by or [])
    weights = weights or {"_rank": None}
    spark = df.sparkSession
    wcols = {k: (F.lit(1).cast("long") if v is None else (F.col(v) if isinstance(v, str) else v))
             for k, v in weights.items()}
    tmp = {k: f"__w_{i}" for i, k in enumerate(wcols)}
    keyed = df.select("*", *[c.alias(tmp[k]) for k, c in wcols.items()])
    keys = [F.col(g) for g in group_by] + [_sort_key(c) for c in order_by]
    # without an explicit count AQE may coalesce the ranges; coalescing merges only
    # neighbouring ranges, so partition-id order stays the key order
    ranged = (keyed.repartitionByRange(num_partitions, *keys) if num_partitions else keyed.repartitionByRange(*keys)) \
        .withColumn("__pid", F.spark_partition_id())
    if storage is None:
        shared_dir(spark)
        held = ranged.persist(StorageLevel.MEMORY_AND_DISK)   # computed once, then written
        ranged = held.checkpoint(eager=True)
        held.unpersist()
    else:
        ranged = ranged.persist(storage)
    # per (partition, group) totals: at most partitions x groups rows
    tot = ranged.groupBy("__pid", *group_by).agg(*[F.sum(tmp[k]).alias(tmp[k]) for k in wcols])
    w = (Window.partitionBy("__pid", *group_by).orderBy(*[_sort_key(c) for c in order_by])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(tmp[k]).over(w).alias(f"__l_{k}") for k in wcols])
    tot_rows = tot.limit(BROADCAST_OFFSET_ROWS + 1).collect()
    if len(tot_rows) <= BROADCAST_OFFSET_ROWS:
        off_df, totals = _driver_offsets(spark, tot_rows, group_by, wcols, tmp, df, keyed)
        off_df = F.broadcast(off_df)
        totals_df = None
    else:
        # wide case: exclusive prefix over partitions, per group (<= partitions rows per window group)
        wo = Window.partitionBy(*group_by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
        off_df = tot.select("__pid", *group_by, *[F.coalesce(F.sum(tmp[k]).over(wo), F.lit(0)).alias(f"__o_{i}")
                                                  for i, k in enumerate(wcols)])
        totals, totals_df = None, tot.groupBy(*group_by).agg(*[F.sum(tmp[k]).alias(k) for k in wcols])
    # null-safe join on group keys (a NULL group is still a group)
    cond = [local["__pid"] == off_df["__pid"]] + [local[g].eqNullSafe(off_df[g]) for g in group_by]
    joined = local.join(off_df, cond, "inner")
    out = joined.select(*[local[c] for c in df.columns],
                        *[(local[f"__l_{k}"] + off_df[f"__o_{i}"]).alias(k)
                          for i, k in enumerate(wcols)])
    return RunningSum(out, totals, totals_df, group_by, list(wcols))


def _driver_offsets(spark, tot_rows, group_by, wcols, tmp, df, keyed):
    gkey = lambda r: tuple(r[g] for g in group_by)
    tot_rows = sorted(tot_rows, key=lambda r: (tuple((v is None, v) for v in gkey(r)), r["__pid"]))
    offsets, totals = [], {}
    for g, rows in groupby(tot_rows, key=gkey):
        acc = [0] * len(wcols)
        for r in rows:
            offsets.append((r["__pid"], *g, *acc))
            acc = [a + (r[tmp[k]] or 0) for a, k in zip(acc, wcols)]
        totals[g] = tuple(acc)
    off_schema = ", ".join(["__pid int"] + [f"`{g}` {dict(df.dtypes)[g]}" for g in group_by]
                           + [f"`__o_{i}` {dict(keyed.dtypes)[tmp[k]]}" for i, k in enumerate(wcols)])
    return spark.createDataFrame(offsets, off_schema), totals


def global_rank(df: DataFrame, order_by: list, group_by: list[str] | None = None,
                out: str = "rank", num_partitions: int | None = None) -> RunningSum:
    """1-based row number in ``order_by`` order within each group (total order required)."""
    return running_sum(df, order_by, {out: None}, group_by, num_partitions)


def dense_rank_values(df: DataFrame, col: str, out: str = "rank",
                      order=None, num_partitions: int | None = None) -> DataFrame:
    """(value, 0-based dense rank) for the distinct values of ``col``; NULL excluded.

    ``order`` is the sort expression (defaults to the column itself).
    """
    distinct = df.select(F.col(col)).where(F.col(col).isNotNull()).distinct()
    rs = global_rank(distinct, [order if order is not None else F.col(col)], out=out,
                     num_partitions=num_partitions)
    return rs.df.select(col, (F.col(out) - 1).alias(out))


def kth_rows(df: DataFrame, order_by: list, ks: dict, group_by: list[str] | None = None,
             num_partitions: int | None = None) -> dict:
    """The row at 1-based position k of each group: {group tuple: Row} (selection).

    ``ks`` maps a group tuple to k; groups not in ``ks`` or with k = 0 are skipped.
    """
    group_by = list(group_by or [])
    rs = global_rank(df, order_by, group_by, out="__k", num_partitions=num_partitions)
    want = [(g, k) for g, k in ks.items() if k and k > 0]
    if not want:
        return {}
    spark = df.sparkSession
    schema = ", ".join([f"`{g}` {dict(df.dtypes)[g]}" for g in group_by] + ["__want long"])
    targets = spark.createDataFrame([(*g, int(k)) for g, k in want], schema)
    cond = [rs.df["__k"] == targets["__want"]] + [rs.df[g].eqNullSafe(targets[g]) for g in group_by]
    rows = rs.df.join(F.broadcast(targets), cond, "inner").select(rs.df["*"]).collect()
    return {tuple(r[g] for g in group_by): r for r in rows}


def kth_rows_multi(df: DataFrame, order_by: list, ks: dict, group_by: list[str] | None = None,
                   num_partitions: int | None = None) -> dict:
    """Several selections per group: ``ks`` maps a group tuple to a list of
    1-based positions; returns {(group tuple, k): Row}."""
    group_by = list(group_by or [])
    want = [(g, int(k)) for g, kl in ks.items() for k in kl if k and k > 0]
    if not want:
        return {}
    rs = global_rank(df, order_by, group_by, out="__k", num_partitions=num_partitions)
    schema = ", ".join([f"`{g}` {dict(df.dtypes)[g]}" for g in group_by] + ["__want long"])
    targets = df.sparkSession.createDataFrame([(*g, k) for g, k in want], schema)
    cond = [rs.df["__k"] == targets["__want"]] + [rs.df[g].eqNullSafe(targets[g]) for g in group_by]
    rows = rs.df.join(F.broadcast(targets), cond, "inner").select(rs.df["*"]).collect()
    return {(tuple(r[g] for g in group_by), r["__k"]): r for r in rows}
