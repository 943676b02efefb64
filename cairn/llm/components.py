"""Connected components as Spark jobs, and how intermediate tables are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from cairn.session import shared_dir


def kept(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of ``spark.checkpoint.dir``: a lost executor costs nothing that came before."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


PART_ROWS = 25_000          # rows of up to 100 bytes that make a partition where the row count is known


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in no more partitions than its counted rows need: each task of a stage costs time, files and log, however little it holds."""
    return df.coalesce(max(1, -(-rows // PART_ROWS)))


def kept_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """``kept``, in as many partitions as its rows need, and their number, counted while they are written."""
    seen = Observation()
    out = kept(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    rows = seen.get["rows"]
    return sized(out, rows), rows


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node reachable; nodes are those of the edges.

    Alternates the large-star and small-star steps, each a grouped minimum
    (partial aggregation) and a join, until the edges no longer change, so
    hubs of any degree are handled.  Null ends and loops are ignored; an
    empty input gives an empty result.  A round has at most twice the edges
    of the one before, so their count gives it its partitions.
    """
    e, rows = kept_sized(edges.where(F.col(a) != F.col(b))
                         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(e)
    while True:
        most = 2 * rows
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sized(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), most)
        large = sized(sized(both.where(F.col("v") > F.col("u")).join(low, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")), most).distinct(), most)
        low = sized(large.groupBy("u").agg(F.min("v").alias("m")), most)
        small = sized(large.join(low, "u")
                      .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                      .select("x.u", "x.v").where(F.col("u") != F.col("v")), most)
        e, rows = kept_sized(sized(small.distinct(), most))
        mark, before = _mark(e), mark
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        sized(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct(), rows))


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def shared_folder(spark, name: str) -> str:
    """A new folder for a table under the shared folder of ``spark.checkpoint.dir``."""
    return shared_dir(spark, name)
