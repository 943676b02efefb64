"""Table reads and writes (Parquet by default, CSV/JSON on request)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cairn.functions.columns import clean_double

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def normalise_nan(df: DataFrame) -> DataFrame:
    """NaN -> NULL on float columns, so aggregates skip them as pandas does."""
    cols = [clean_double(f.name).cast(f.dataType).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else f.name
            for f in df.schema.fields]
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, header: bool = True,
               nan_to_null: bool = True) -> DataFrame:
    """Read a table.  CSV honours a header and an explicit schema (inference
    only when no schema is given, as a convenience for small files)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", str(header).lower())
        if schema is None:
            r = r.option("inferSchema", "true")
    df = r.format(fmt).load(path)
    return normalise_nan(df) if nan_to_null else df


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line): every line of the text files with its number in the file, from 1.

    A file may be read in several parts: lines are counted per part, parts are added up in the order of their place, and a
    line's number is its place in the part after those.  A quoted line break ends a line all the same."""
    start = F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), start.alias("start"), F.col("value").alias("line"),
                                         F.monotonically_increasing_id().alias("at"))
    part = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)     # a row per part of a file
    part = part.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return lines.join(part, ["file", "start"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "line")


# Types that a column of text may have, the narrowest first.
INFERRED = ("boolean", "bigint", "double", "date", "timestamp_ntz")


def _typed(col: str, kind: str):
    """The value as a type, NULL where it is not one; numbers and booleans only as CSV writes them."""
    c = F.col(f"`{col}`")
    shape = {"boolean": r"^(?i:true|false)$", "bigint": r"^[+-]?[0-9]+$", "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^(?i:nan|[+-]?inf(inity)?)$",
             "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}.get(kind)
    return F.when(c.rlike(shape), c.try_cast(kind)) if shape else c.try_cast(kind)


def infer_types(text: DataFrame, cols: list[str]) -> dict[str, str]:
    """Per column of text the first of INFERRED that every value has, over the whole table in one pass; ``string`` where none fits or
    all are NULL."""
    counts = [F.count(f"`{c}`").alias(f"{i}_n") for i, c in enumerate(cols)]
    counts += [F.count(_typed(c, k)).alias(f"{i}_{k}") for i, c in enumerate(cols) for k in INFERRED]
    r = text.agg(*counts).first().asDict()
    return {c: next((k for k in INFERRED if r[f"{i}_n"] and r[f"{i}_{k}"] == r[f"{i}_n"]), "string") for i, c in enumerate(cols)}


def read_csv_checked(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",",
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of CSV files, each with a header or, with a schema, all without.

    A line is bad if it has another number of fields than there are columns, or a value that its column's type doesn't allow; an empty
    value is NULL, an empty line nothing.  Bad rows are (file, line_no, line, reason), the reason naming
    the first fault.  Without ``schema`` the types are those that all values of well-formed lines have (``infer_types``).  Every file's
    header must be the same, else ``ValueError``.  NaN becomes NULL."""
    lines = csv_lines(spark, path)
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in wanted.fields] if wanted is not None else None
    if header:
        heads = [r["line"] for r in lines.where("line_no = 1").select("line").distinct().limit(2).collect()]
        if len(heads) != 1:
            raise ValueError(f"{path}: {'files differ in their header' if heads else 'no header'}")
        found = spark.createDataFrame([(heads[0],)], "line string").select(_fields("line", sep).alias("x")).first()["x"]
        if names not in (None, found):
            raise ValueError(f"{path}: header {found} is not that of the schema")
        names = found
    elif names is None:
        raise ValueError("files without a header need a schema")
    body = lines.where((F.col("line_no") > int(header)) & (F.trim("line") != "")).withColumn("x", _fields("line", sep))
    n = F.size("x")
    value = [F.when(n == len(names), F.nullif(F.get("x", F.lit(i)), F.lit(""))).alias(c) for i, c in enumerate(names)]
    text = body.select("file", "line_no", "line", n.alias("__n"), *value)
    kinds = ({f.name: f.dataType.simpleString() for f in wanted.fields} if wanted is not None
             else infer_types(text.where(F.col("__n") == len(names)), names))
    faults = [F.when(F.col(f"`{c}`").isNotNull() & _typed(c, k).isNull(), F.concat(F.lit(f"{c}: "), F.col(f"`{c}`"), F.lit(f" is no {k}")))
              for c, k in kinds.items() if k != "string"]
    reason = F.coalesce(F.when(F.col("__n") != len(names), F.concat(F.col("__n").cast("string"), F.lit(f" fields, not {len(names)}"))), *faults)
    judged = text.withColumn("reason", reason)
    good = judged.where("reason is null").select(*[_typed(c, k).alias(c) if k != "string" else F.col(f"`{c}`") for c, k in kinds.items()])
    return normalise_nan(good), judged.where("reason is not null").select("file", "line_no", "line", "reason")


def _fields(line: str, sep: str):
    """The fields of a line; quotes around a field go, doubled ones inside stay single."""
    quoted = '"(?:[^"]|"")*"'
    found = F.regexp_extract_all(F.concat(F.lit(sep), F.col(line)), F.lit(f"{_literal(sep)}({quoted}|[^{_literal(sep)}]*)"), F.lit(1))
    return F.transform(found, lambda x: F.when(x.startswith('"') & x.endswith('"') & (F.length(x) > 1),
                                               F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))


def _literal(sep: str) -> str:
    return sep if sep.isalnum() else "\\" + sep


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, header: bool = True) -> str:
    """Write a table; CSV gets a header row and no index (there is none)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables at ``{sf_dir}/{name}.parquet``."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
