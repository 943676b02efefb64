"""Every registered query with an SQL oracle must match it (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF_SMALL), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "churn_rate" in df.columns


def test_oracle_keys_are_queries():
    assert set(SQL) <= set(entry.queries())


def test_every_core_query_has_an_oracle():
    from cairn.plans import oracle, queries
    assert set(queries.QUERIES) == set(oracle.SQL)


def test_versions_keep_their_own_schema(spark, tmp_path):
    from cairn.sources import registry as reg
    root = str(tmp_path / "r")
    a = spark.createDataFrame([(1, 2.0), (2, float("nan"))], "customer_id long, a double")
    b = spark.createDataFrame([(1, "x", True)], "customer_id long, a string, extra boolean")
    reg.register_view(a, root, "v", ["customer_id"], "v1")
    reg.register_view(b, root, "v", ["customer_id"], "odd name/2")
    assert sorted(map(tuple, reg.read_view(spark, root, "v", "v1").collect())) == [(1, 2.0), (2, None)]
    assert [tuple(r) for r in reg.read_view(spark, root, "v", "odd name/2").collect()] == [(1, "x", True)]


def test_a_failed_registration_leaves_the_published_version(spark, tmp_path):
    from cairn.sources import registry as reg
    root = str(tmp_path / "r")
    reg.register_view(spark.createDataFrame([(1,)], "customer_id long"), root, "v", ["customer_id"], "v1")
    with pytest.raises(ValueError):
        reg.register_view(spark.createDataFrame([(1,), (1,)], "customer_id long"), root, "v", ["customer_id"], "v1")
    assert reg.read_view(spark, root, "v", "v1").count() == 1


def test_registry_defaults_and_errors(spark, tmp_path):
    from cairn.sources import registry as reg
    root = str(tmp_path / "r")
    for version in ("v1", "v2"):
        reg.register_view(spark.createDataFrame([(1,)], "customer_id long"), root, "v", ["customer_id"], version)
    reg.set_default_version(spark, root, "v", "v2")
    r = reg.registry(spark, root)
    assert reg.resolve_version(r, "v") == reg.resolve_version(r, "v", "current") == "v2"
    assert reg.resolve_version(r, "v", "v1") == "v1"
    for version in (None, "latest", "v1"):
        with pytest.raises(KeyError):
            reg.resolve_version(r, "nope", version)
    with pytest.raises(KeyError):
        reg.read_view(spark, root, "v", "v3")
    (tmp_path / "bad" / "_registry").mkdir(parents=True)
    (tmp_path / "bad" / "_registry" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        reg.registry(spark, str(tmp_path / "bad")).collect()


def test_sql_leaves_the_callers_views(spark):
    from cairn.sources.sql import run_sql
    spark.range(3).createOrReplaceTempView("orders")
    got = run_sql(spark, "SELECT count(*) AS n FROM orders", tables={"orders": spark.range(5)})
    assert got.first()["n"] == 5 and spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")
