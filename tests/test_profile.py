import numpy as np
import pytest

from cairn.operators import profile


def test_quantiles_match_numpy_linear(spark):
    vals = [3.0, 1.0, None, float("nan"), 7.5, 7.5, 2.0, 10.0, 4.25]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    clean = [v for v in vals if v is not None and not np.isnan(v)]
    got = profile.quantile_values(df, ["x"], [0.25, 0.5, 0.75, 0.0, 1.0])
    for p in (0.25, 0.5, 0.75, 0.0, 1.0):
        assert got[("x", p)] == pytest.approx(np.quantile(clean, p))


def test_quantiles_all_null_and_constant(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, 5.0)], "id long, a double, b double")
    got = profile.quantile_values(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] is None and got[("b", 0.5)] == 5.0


def test_quantiles_skewed_value(spark):
    rows = [(i, 1.0 if i % 3 == 0 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x double")
    got = profile.quantile_values(df, ["x"], [0.1, 0.5, 0.9])
    xs = [r[1] for r in rows]
    for p in (0.1, 0.5, 0.9):
        assert got[("x", p)] == pytest.approx(np.quantile(xs, p))


def test_modes_ties_smallest_and_default(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)],
                               "s string, t string")
    assert profile.mode_values(df, ["s", "t"]) == {"s": "a", "t": "Unknown"}


def test_null_summary_counts_nan(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, float("nan"), None), (3, 1.0, "y")], "id long, x double, s string")
    got = {r["column"]: (r["null_count"], r["null_share"]) for r in profile.null_summary(df).collect()}
    assert got == {"x": (2, round(2 / 3, 6)), "s": (1, round(1 / 3, 6))}


def test_inf_counts_and_summary(spark):
    df = spark.createDataFrame([(1, float("inf"), 0), (2, float("-inf"), 1), (3, float("nan"), 1)],
                               "id long, x double, churned int")
    r = {x["column"]: (x["n_inf"], x["n_nan"]) for x in profile.inf_counts(df, ["x"]).collect()}
    assert r == {"x": (2, 1)}
    s = profile.summary(df, "churned").first()
    assert s["n_rows"] == 3 and s["n_missing"] == 1 and s["n_columns"] == 3


def test_min_class_check(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(100)], "id long, y int")
    r = profile.min_class_check(df, "y", 0.2).first()
    assert (r["min_class_count"], r["required_min_count"], r["warn"]) == (3, 10, True)


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=40),
       st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_property(spark, vals, p):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, x double")
    clean = [v for v in vals if v is not None]
    got = profile.quantile_values(df, ["x"], [p])[("x", p)]
    if not clean:
        assert got is None
    else:
        assert got == pytest.approx(float(np.quantile(clean, p)), rel=1e-9, abs=1e-9)
