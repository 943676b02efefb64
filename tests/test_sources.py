from pyspark.sql import functions as F

from cairn.session import shared_dir
from cairn.sources import generate as gen, registry as reg, sql as sqlsrc
from cairn.sources.tables import read_table, write_table


def test_csv_roundtrip_with_schema(spark):
    df = spark.createDataFrame([(1, 2.5, "a"), (2, None, "b")], "id long, x double, s string")
    path = shared_dir(spark, "t-csv")
    write_table(df, path, "csv")
    back = read_table(spark, path, "csv", schema="id long, x double, s string")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, 2.5, "a"), (2, None, "b")]


def test_nan_normalised_at_read(spark):
    df = spark.createDataFrame([(1, float("nan"))], "id long, x double")
    path = shared_dir(spark, "t-nan")
    write_table(df, path)
    assert read_table(spark, path).first()["x"] is None


def test_run_record_and_metric_log(spark):
    stats = spark.createDataFrame([(10, 0.25, "x")], "n_rows long, rate double, s string")
    rec = reg.run_record(spark, "preprocess", {"as_of": "2001-08-01", "cols": ["a"]}, stats).first()
    assert rec["stats"] == {"n_rows": 10.0, "rate": 0.25} and rec["params"]["cols"] == '["a"]'
    root = shared_dir(spark, "t-metrics")
    reg.log_metrics(spark.createDataFrame([(0.9, 0.8)], "accuracy double, f1 double"), root, "m", "v3")
    got = {r["metric"]: r["value"] for r in reg.read_metrics(spark, root, "m").collect()}
    assert got == {"accuracy": 0.9, "f1": 0.8}


def test_run_sql_binds_parameters(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0)], "id long, v double")
    out = sqlsrc.run_sql(spark, "SELECT id FROM t WHERE v > :lo", {"lo": 10.0}, {"t": df}).collect()
    assert [r["id"] for r in out] == [2]


def test_generation_is_partition_independent(spark):
    a = gen.generate_customers(spark, 2000, 0.12, 7)
    b = gen.generate_customers(spark, keys=spark.range(2000).repartition(9), positive_rate=0.12, seed=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    r = gen.positive_rate(a).first()
    assert r["n"] == 2000 and 0.08 < r["positive_rate"] < 0.16
    assert {x["region"] for x in a.select("region").distinct().collect()} == set(gen.REGIONS)
    parts = gen.split_vertical(a)
    assert set(parts) == {"transactions", "demographics"} and "age" in parts["demographics"].columns
    d = a.agg(F.min("account_created_date"), F.max("account_created_date")).first()
    assert d[0] >= "2020-01-01" and d[1] < "2024-01-01"
