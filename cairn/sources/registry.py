"""Versioned feature views, the registry table, run records and metric logs.

Layout under a root folder (the shared folder on a cluster):

- ``views/<name>/<v>-<id>/``      one registered version's data, Parquet, with its own schema
- ``_registry/``                  one row per registration (kind, name, version, path); a default
                                  version is a row of kind ``default`` whose entity is the kind it is for
- ``_claims/``                    an empty file per registration number
- ``_runs/``                      run records (JSON lines)
- ``_records/<kind>/``            training and evaluation records, as they are
- ``_metrics/``                   logged metrics, long form

A version is read from the folder of its last registration, so versions may
differ in columns and types.  The last is the one with the highest number,
which a registration claims by creating a file that must not exist yet; clocks
decide nothing.  The registry is a small DataFrame queried with ordinary
filters and aggregates.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from cairn.sources.tables import normalise_nan

REGISTRY_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("entity", T.StringType()),
    T.StructField("join_keys", T.ArrayType(T.StringType())), T.StructField("timestamp_col", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("path", T.StringType()), T.StructField("registered_at", T.TimestampType()),
    T.StructField("seq", T.LongType()), T.StructField("buckets", T.IntegerType()),
    T.StructField("stats", T.MapType(T.StringType(), T.DoubleType())),
])
# Version keywords and the global default version.
CURRENT, LATEST, GLOBAL_DEFAULT = "current", "latest", "v1"
DEFAULT = "default"         # kind of the registry rows that name a default version


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry table (empty frame when there is no registry folder yet; any other failure is raised).

    A row counts once, also while a compaction has it in two files."""
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).option("recursiveFileLookup", "true").parquet(_p(root, "_registry"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return rows.dropDuplicates(["seq", "kind", "name", "version", "registered_at"])


def _last(col: str | Column) -> Column:
    """The value of the last registration."""
    return F.max_by(col, F.struct(F.coalesce(F.col("seq"), F.lit(0)), F.col("registered_at")))


def _folder(spark: SparkSession, path: str):
    """(file system, folder) of a path, for the few metadata files that the driver handles itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _create_new(fs, path) -> bool:
    """Create an empty file; False if there is one.  Exclusive on HDFS and on local and mounted folders."""
    if fs.getUri().getScheme() == "file":       # Hadoop's local file system looks first and creates then
        try:
            os.close(os.open(path.toUri().getPath(), os.O_CREAT | os.O_EXCL))
            return True
        except FileExistsError:
            return False
    try:
        fs.create(path, False).close()
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(path):
            return False
        raise


def claim_number(spark: SparkSession, root: str) -> int:
    """The next registration number, which nobody else gets: one more than the highest claimed, tried until a claim succeeds."""
    fs, folder = _folder(spark, _p(root, "_claims"))
    fs.mkdirs(folder)
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    n = max((int(x) for x in names if x.isdigit()), default=0)
    while True:
        n += 1
        if _create_new(fs, spark._jvm.org.apache.hadoop.fs.Path(folder, str(n))):
            return n


def _append_registry(spark, root, row: tuple, buckets: int | None = None, stats: dict | None = None) -> int:
    seq = claim_number(spark, root)
    whole = (*row, _now(), seq, buckets, stats)
    # a folder of its own: writers that share one would clear each other's unfinished files
    spark.createDataFrame([whole], REGISTRY_SCHEMA).coalesce(1).write.parquet(_p(root, "_registry", str(seq)))
    return seq


def compact_registry(spark: SparkSession, root: str) -> int:
    """Write the registry's rows into one file and delete the folders that held them; returns how many went.

    Readers in between see rows twice and count them once; folders that registrations add meanwhile stay.  A reader that
    listed a folder before it went fails and may read again."""
    fs, folder = _folder(spark, _p(root, "_registry"))
    old = [s.getPath() for s in fs.listStatus(folder) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))] if fs.exists(folder) else []
    if len(old) < 2:
        return 0
    rows = spark.read.schema(REGISTRY_SCHEMA).parquet(*[p.toString() for p in old])
    rows.dropDuplicates(["seq", "kind", "name", "version", "registered_at"]).coalesce(1).write.parquet(
        _p(root, "_registry", f"compact-{uuid.uuid4().hex[:12]}"))
    for p in old:
        fs.delete(p, True)
    return len(old)


def check_keys(df: DataFrame, keys: list[str]) -> int:
    """Entity keys must be non-NULL and unique.  One pass: rows per key value
    (partially aggregated map-side, so a hot key collapses before the shuffle),
    then one global aggregate.  Returns the row count."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    r = per_key.agg(F.sum("c").alias("n"), F.max("c").alias("max_c"),
                    F.count_if(any_null).alias("null_keys")).first()
    if r["null_keys"]:
        raise ValueError(f"NULL in entity key {keys}")
    if (r["max_c"] or 0) > 1:
        raise ValueError(f"duplicate entity key {keys}")
    return int(r["n"] or 0)


def register_view(df: DataFrame, root: str, name: str, keys: list[str], version: str,
                  timestamp_col: str | None = None, desc: str = "", entity: str = "customer",
                  validate: bool = True, observe: list[Column] | None = None, buckets: int | None = None) -> str:
    """Write ``df`` as version ``version`` of view ``name``, check the keys of what
    was written, and only then publish it with a registry row.

    Each registration has a folder of its own, so a failed one leaves the
    published version as it was, and readers of an older one are not disturbed.

    ``observe`` are named aggregates that the write job itself measures (``view_stats`` has them afterwards).  With
    ``buckets`` the rows lie in as many buckets, sorted by the keys, so that joins of views with the same
    count on those keys need no shuffle."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = [c for c in keys + ([timestamp_col] if timestamp_col else []) if c not in df.columns]
    if missing:
        raise ValueError(f"register_view: missing column(s) {missing}")
    path = _p(root, "views", quote(name, safe=""), f"{quote(version, safe='')}-{uuid.uuid4().hex[:12]}")
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c for c in observe or []])
    if buckets:
        table = _table_name(path)
        counted.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")        # the files stay; readers name them again
    else:
        counted.write.parquet(path)
    figures = seen.get
    if validate:
        check_keys(spark.read.schema(df.schema).parquet(path), keys)
    stats = {k: float(v) for k, v in figures.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
    _append_registry(spark, root, ("view", name, version, entity, keys, timestamp_col, desc, int(figures["n_rows"]), path), buckets, stats)
    return version


def _table_name(path: str) -> str:
    return "cairn_view_" + path.rsplit("-", 1)[1]


def view_stats(spark: SparkSession, root: str, name: str, version: str) -> dict:
    """The figures that were measured while a version was written."""
    rows = registry(spark, root).where((F.col("kind") == "view") & (F.col("name") == name) & (F.col("version") == version))
    return rows.agg(_last("stats").alias("s")).first()["s"] or {}


def version_number(col: str = "version"):
    """Numeric part of 'v<digits>' (unparsable -> 0), for numeric ordering (v10 > v9)."""
    num = F.regexp_extract(F.col(col), r"^v(\d+)$", 1)
    return F.when(num == "", F.lit(0)).otherwise(num.cast("long"))


def latest_versions(reg: DataFrame, kind: str | None = None) -> DataFrame:
    """S6 for every name: (kind, name, latest_version, n_versions)."""
    r = reg.where(F.col("kind") != DEFAULT) if kind is None else reg.where(F.col("kind") == kind)
    return r.groupBy("kind", "name").agg(
        F.max_by("version", F.struct(version_number().alias("n"), F.col("version"))).alias("latest_version"),
        F.count_distinct("version").alias("n_versions"))


def latest_version(reg: DataFrame, name: str, kind: str = "view", default: str = GLOBAL_DEFAULT) -> str:
    """Highest version of ``name`` in numeric order; nothing registered -> default."""
    row = latest_versions(reg.where(F.col("name") == name), kind).first()
    return row["latest_version"] if row else default


def set_default_version(spark: SparkSession, root: str, name: str, version: str, kind: str = "view") -> None:
    """Store the version that None and 'current' mean for ``name``; the last one stored holds."""
    _append_registry(spark, root, (DEFAULT, name, version, kind, None, None, None, None, None))


def stored_default(reg: DataFrame, name: str, kind: str = "view") -> str | None:
    row = (reg.where((F.col("kind") == DEFAULT) & (F.col("entity") == kind) & (F.col("name") == name))
           .agg(_last("version").alias("v")).first())
    return row["v"]


def resolve_version(reg: DataFrame, name: str, version: str | None = None, kind: str = "view",
                    defaults: dict | None = None, global_default: str = GLOBAL_DEFAULT) -> str:
    """None or 'current' -> the default of the name (given, else stored, else global);
    'latest' -> highest registered; anything else is taken literally.
    A name that has neither a registration nor a default raises ``KeyError``."""
    default = (defaults or {}).get(name) or stored_default(reg, name, kind)
    if default is None and reg.where((F.col("kind") == kind) & (F.col("name") == name)).isEmpty():
        raise KeyError(f"{kind} '{name}' is not registered")
    if version is None or version == CURRENT:
        return default or global_default
    if version == LATEST:
        return latest_version(reg, name, kind, default or global_default)
    return version


def read_view(spark: SparkSession, root: str, name: str, version: str | None = None,
              defaults: dict | None = None) -> DataFrame:
    """S3: one version of a view with its own schema, NaN as NULL; a version that
    is not registered raises ``KeyError``."""
    reg = registry(spark, root)
    v = resolve_version(reg, name, version, "view", defaults)
    row = (reg.where((F.col("kind") == "view") & (F.col("name") == name) & (F.col("version") == v))
           .agg(_last(F.struct("path", "buckets", "join_keys")).alias("r")).first()["r"])
    if row is None:
        raise KeyError(f"view '{name}' has no version '{v}'")
    if not row["buckets"]:
        return normalise_nan(spark.read.parquet(row["path"]))
    # The catalogue tells the planner of the buckets; the table is only a name for the files.
    table, keys = _table_name(row["path"]), ", ".join(f"`{k}`" for k in row["join_keys"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(row["path"]).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {row['buckets']} BUCKETS LOCATION '{row['path']}'")
    return normalise_nan(spark.table(table))


def find_view(reg: DataFrame, candidates: list[str], kind: str = "view", required: bool = True) -> str | None:
    """The first candidate name (in the given order) that is registered."""
    spark = reg.sparkSession
    cand = spark.createDataFrame([(i, c) for i, c in enumerate(candidates)], "rank int, name string")
    hit = (cand.join(reg.where(F.col("kind") == kind).select("name").distinct(), "name")
               .withColumn("__rn", F.row_number().over(Window.orderBy("rank")))   # bounded: candidates only
               .where(F.col("__rn") == 1).first())
    if hit is None and required:
        raise ValueError(f"none of {candidates} is registered")
    return hit["name"] if hit else None


def list_views(reg: DataFrame, kind: str | None = "view") -> DataFrame:
    """(kind, name, latest_version, n_versions, description, n_rows of the latest)."""
    lat = latest_versions(reg, kind)
    last = reg.join(lat.select("kind", "name", F.col("latest_version").alias("version")), ["kind", "name", "version"])
    info = last.groupBy("kind", "name").agg(_last("description").alias("description"), _last("n_rows").alias("n_rows"))
    return lat.join(info, ["kind", "name"], "left")


def describe_view(reg: DataFrame, name: str, kind: str = "view") -> dict:
    """Info for one name; a missing name raises."""
    rows = list_views(reg, kind).where(F.col("name") == name).collect()
    if not rows:
        raise KeyError(f"{kind} '{name}' is not registered")
    return rows[0].asDict()


RUN_SCHEMA = T.StructType([
    T.StructField("step", T.StringType()), T.StructField("recorded_at", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("stats", T.MapType(T.StringType(), T.DoubleType())),
])


def run_record(spark: SparkSession, step: str, params: dict, stats: DataFrame | dict) -> DataFrame:
    """One-row record (step, time, params as JSON strings, numeric stats).
    ``stats`` may be a one-row DataFrame (its numeric columns are taken)."""
    if isinstance(stats, DataFrame):
        r = stats.first().asDict()
        stats = {k: float(v) for k, v in r.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
    row = (step, _now(),
           {k: json.dumps(v, default=str) for k, v in params.items()}, {k: float(v) for k, v in stats.items()})
    return spark.createDataFrame([row], RUN_SCHEMA)


def write_run_record(rec: DataFrame, root: str) -> str:
    path = _p(root, "_runs")
    rec.coalesce(1).write.mode("append").json(path)
    return path


def write_record(rec: DataFrame, root: str, kind: str) -> str:
    """Append a training or evaluation record."""
    path = _p(root, "_records", kind)
    rec.coalesce(1).write.mode("append").parquet(path)
    return path


def read_records(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.parquet(_p(root, "_records", kind))


def log_metrics(metrics: DataFrame, root: str, model: str, version: str) -> DataFrame:
    """Append metrics (a one-row wide frame, or long (metric, value)) as
    (model, version, metric, value, logged_at) rows; returns the appended rows."""
    if set(metrics.columns) >= {"metric", "value"}:
        long = metrics.select("metric", F.col("value").cast("double"))
    else:
        num = [f.name for f in metrics.schema.fields if isinstance(f.dataType, T.NumericType)]
        long = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"),
                                                           F.col(c).cast("double").alias("value")) for c in num]))
                              .alias("m")).select("m.*")
    out = long.select(F.lit(model).alias("model"), F.lit(version).alias("version"), "metric", "value",
                      F.current_timestamp().alias("logged_at"))
    out.write.mode("append").parquet(_p(root, "_metrics"))
    return out


def read_metrics(spark: SparkSession, root: str, model: str | None = None) -> DataFrame:
    m = spark.read.parquet(_p(root, "_metrics"))
    return m if model is None else m.where(F.col("model") == model)
