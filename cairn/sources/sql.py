"""Parameterised SQL over registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, params: dict | None = None,
            tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run ``sql`` with named parameters (``:name`` markers, bound as literals,
    never spliced into the text) over the given tables; errors raise.  The
    caller's temporary views of the same names are as before afterwards."""
    tables = tables or {}
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    before = {name: spark.table(name) for name in tables if name.lower() in views}
    register_tables(spark, tables)
    try:
        return spark.sql(sql, args=params or None)      # resolved here, so the names may go
    finally:
        for name in tables:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)
