import pytest
from pyspark.sql import functions as F

from cairn.operators import clean, features as feat, joins, select as sel


def test_impute_median_int_becomes_double(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 3), (5, 4)], "customer_id long, x long")
    out = clean.impute_median(df)
    assert dict(out.dtypes)["x"] == "double"
    assert {r["customer_id"]: r["x"] for r in out.collect()}[3] == 2.5
    assert dict(out.dtypes)["customer_id"] == "bigint"


def test_cap_iqr_keeps_null(spark):
    df = spark.createDataFrame([(i, float(v) if v is not None else None)
                                for i, v in enumerate([1, 2, 3, 4, 100, None])], "id long, x double")
    out = {r["id"]: r["x"] for r in clean.cap_iqr(df, ["x"]).collect()}
    assert out[5] is None and out[4] == pytest.approx(4 + 1.5 * 2)


def test_finite_or_replaces_nan_inf_null(spark):
    df = spark.createDataFrame([(1, float("inf"), None), (2, float("nan"), 3), (3, 2.0, 4)], "id long, x double, n long")
    out = {r["id"]: (r["x"], r["n"]) for r in clean.finite_or(df, exclude=("id",)).collect()}
    assert out == {1: (0.0, 0), 2: (0.0, 3), 3: (2.0, 4)}


def test_bucket_edges_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 0.5, 1.0, 1.01, 3.0, 5.0, 5.5, None]], "y double")
    got = [r["b"] for r in feat.bucketize(df, "y", out="b").collect()]
    assert got == [None, None, "New", "New", "Young", "Young", "Mature", "Veteran", None]


def test_one_hot_sorted_null_all_false(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "r string")
    out = feat.one_hot(df, "r", "region")
    assert out.columns == ["r", "region_a", "region_b"]
    assert [tuple(x)[1:] for x in out.collect()] == [(False, True), (True, False), (False, False)]
    with pytest.raises(ValueError):
        feat.one_hot(df, "r", max_categories=1)


def test_date_parse_and_failures(spark):
    df = spark.createDataFrame([("2020-01-05",), ("garbage",), (None,)], "d string")
    assert feat.date_parse_failures(df, "d").first()["n_unparsable"] == 1
    out = feat.account_age(df, "d", "2021-01-05").collect()
    assert out[0]["account_age_days"] == 366 and out[0]["account_age_bucket"] == "Young"
    assert out[1]["d"] is None and out[1]["account_age_bucket"] is None


def test_ratio_scale_minmax_constant(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0, 0), (2, 20.0, 4.0, 0)], "id long, s double, n double, t long")
    r = feat.safe_ratio(df, "s", "n", "q").orderBy("id").collect()
    assert [x["q"] for x in r] == [0.0, 5.0]
    assert [x["sr"] for x in feat.scale_by_max(df, "t", "sr").collect()] == [0.0, 0.0]
    mm = feat.minmax_mean(df, ["s", "t"], "m").orderBy("id").collect()
    assert [x["m"] for x in mm] == [0.0, 0.5]


def test_join_suffixes_only_on_collision_and_null_safe(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (None, 2.0, "y")], "customer_id long, v double, s string")
    b = spark.createDataFrame([(1, 5.0), (None, 6.0)], "customer_id long, v double")
    j = joins.join_inner(a, b)
    assert sorted(j.columns) == ["customer_id", "s", "v_demo", "v_trans"] and j.count() == 1
    assert joins.join_inner(a, b, null_safe=True).count() == 2
    with pytest.raises(ValueError):
        joins.key_overlap(a, b)


def test_select_helpers(spark):
    df = spark.createDataFrame([(1, 0, "a", True)], "customer_id long, churned int, s string, f boolean")
    assert sel.feature_columns(df) == ["s", "f"]
    assert sel.drop_non_numeric(df).columns == ["customer_id", "churned", "f"]
    with pytest.raises(ValueError):
        sel.require_columns(df, ["missing"])
    assert sel.set_where(df, "churned", F.col("s") == "a", 1).first()["churned"] == 1
