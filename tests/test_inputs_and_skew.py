"""Hot-key joins, splits on several columns, CSV with faults, generated labels."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import joins, model as mdl, split as sp
from cairn.sources import generate as gen, tables


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture
def plain_shuffles(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("null_safe", [False, True])
def test_skewed_join_equals_the_plain_one(spark, null_safe):
    a = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 200).alias("k"),
                                (F.col("id") % 5).alias("x"))
    b = spark.range(400).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 50 == 3, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    want = joins.join_inner(a, b, "k", null_safe=null_safe)
    got = joins.join_skewed(a, b, "k", null_safe=null_safe)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert rows_of(joins.join_skewed(b, a, "k", null_safe=null_safe, rows_per_part=5)) == rows_of(joins.join_inner(b, a, "k", null_safe=null_safe))
    empty = a.limit(0)
    assert joins.join_skewed(empty, b, "k").count() == 0 and joins.join_skewed(a, empty.select("k"), "k").count() == 0


def test_no_task_gets_the_whole_hot_key(spark, plain_shuffles):
    a = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    b = spark.range(40_000).select(F.col("id").alias("k")).unionByName(spark.range(3).select(F.lit(-1).cast("long").alias("k")))

    def sizes(j):
        return sorted(r["count"] for r in j.where("x is not null").groupBy(F.spark_partition_id()).count().collect())

    once = sizes(joins.join_skewed(a, b.distinct(), "k"))
    plain = sizes(joins.join_inner(a, b.distinct(), "k"))
    assert plain[-1] > 3 * plain[len(plain) // 2] and once[-1] <= 3 * once[len(once) // 2]
    assert sum(once) == sum(plain) == 40_000


def test_hot_keys_are_found_whatever_the_layout(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 4 == 0, 1).otherwise(F.col("id")).alias("k"))
    for n in (1, 7):
        found = joins.hot_keys(df.repartition(n), ["k"])
        assert len(found) == 1 and 1200 <= next(iter(found.values())) <= 1300


def brute_quotas(counts, n_test):
    n, order = sum(counts.values()), sorted(counts)
    best = None
    for up in itertools.product((0, 1), repeat=len(order)):
        seats = {c: counts[c] * n_test // n + u for c, u in zip(order, up)}
        if sum(seats.values()) != n_test or any(u and counts[c] * n_test % n == 0 for c, u in zip(order, up)):
            continue
        margins = [(sum(seats[c] for c in order if key(c) == v), sum(counts[c] for c in order if key(c) == v) * n_test)
                   for key in (lambda c: c[0], lambda c: c[1:]) for v in {key(c) for c in order}]
        if all(t // n <= s <= -(-t // n) for s, t in margins):
            score = (sum(counts[c] * n_test % n for c, u in zip(order, up) if u), up)
            best = max(best or (score, seats), (score, seats), key=lambda x: x[0])
    return best[1]


def test_controlled_quotas_as_by_trying_all():
    r = random.Random(4)
    for _ in range(60):
        cells = [(i, j) for i in range(r.randint(1, 3)) for j in range(r.randint(1, 4))]
        counts = {c: r.randint(2, 40) for c in cells if r.random() < 0.9} or {(0, 0): 5}
        n_test = r.randint(0, sum(counts.values()))
        assert sp.controlled_quotas(counts, n_test) == brute_quotas(counts, n_test)


def test_rare_strata_join_their_neighbour():
    counts = {("a", "x"): 9, ("a", "y"): 4, ("a", "z"): 1, ("b", "x"): 1, (None, "x"): 5}
    assert sp.merge_rare(counts) == {("a", "z"): ("a", "x"), ("b", "x"): ("a", "x")}


def test_split_on_several_columns(spark):
    r = random.Random(9)
    rows = [(i, r.random() < 0.3, r.choice(["n", "s", None]), r.choice([1, 2])) for i in range(400)] + [(1000, True, "odd", 1)]
    df = spark.createDataFrame(rows, "customer_id long, churned boolean, region string, tier int")
    out = sp.stratified_split_by(df, "customer_id", ["churned", "region", "tier"], 0.25, 3).cache()
    assert out.columns == [*df.columns, "split"] and out.count() == 401
    test = out.where("split = 'test'")
    assert test.count() == math.ceil(401 * 0.25)
    for cols in (["churned"], ["region", "tier"], ["churned", "region", "tier"]):
        every = {tuple(x[:-1]): x[-1] for x in df.groupBy(*cols).count().collect()}
        got = {tuple(x[:-1]): x[-1] for x in test.groupBy(*cols).count().collect()}
        for k, n in every.items():
            assert abs(got.get(k, 0) - n * 101 / 401) < 1 + ("odd" in k) or n < 3
    assert rows_of(sp.stratified_split_by(df.repartition(5), "customer_id", ["churned", "region", "tier"], 0.25, 3)) == rows_of(out)
    assert rows_of(sp.stratified_split_by(df, "customer_id", ["churned"], 0.25, 3)) == rows_of(sp.stratified_split(df, "customer_id", "churned", 0.25, 3))
    alone = df.limit(3).withColumn("region", F.col("customer_id").cast("string"))
    assert sp.stratified_split_by(alone, "customer_id", ["churned", "region"], 0.4).where("split = 'test'").count() == 2
    with pytest.raises(ValueError, match="strata"):
        sp.stratified_split_by(df, "customer_id", ["churned", "region"], max_classes=3)
    with pytest.raises(ValueError, match="NULL"):
        sp.stratified_split_by(df.withColumn("customer_id", F.lit(None).cast("long")), "customer_id", ["churned", "region"])


def test_csv_faults_with_line_numbers(spark, tmp_path):
    lines = ["id,name,x,day"]
    bad = {}
    for i in range(2, 3001):
        if i % 500 == 0:
            lines.append(f"{i},short")
            bad[i] = "2 fields, not 4"
        elif i % 700 == 1:
            lines.append(f"{i},a,word,2024-01-05")
            bad[i] = "x: word is no double"
        elif i % 900 == 2:
            lines.append(f"{i},a,1.5,2024-02-30")
            bad[i] = "day: 2024-02-30 is no date"
        elif i % 611 == 0:
            lines.append("")
        else:
            lines.append(f'{i},"a, ""b""",{i / 4},2024-01-05')
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)     # the file is read in several parts
    try:
        good, wrong = tables.read_csv_checked(spark, str(tmp_path), "id bigint, name string, x double, day date")
        assert tables.csv_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 1
        assert {r["line_no"]: r["reason"] for r in wrong.collect()} == bad
        assert all(r["file"].endswith("one.csv") and r["line"] == lines[r["line_no"] - 1] for r in wrong.collect())
        empty = sum(not x for x in lines)
        assert good.count() == len(lines) - 1 - len(bad) - empty
        r = good.where("id = 3").first()
        assert r["name"] == 'a, "b"' and r["x"] == 0.75 and str(r["day"]) == "2024-01-05"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_types_over_all_files(spark, tmp_path):
    """A column that is whole in one file and broken in another has the type of both."""
    (tmp_path / "a.csv").write_text("n,m,t,b,z\n1,1,2024-01-01,true,\n2,2,2024-01-02,FALSE,\n")
    (tmp_path / "b.csv").write_text("n,m,t,b,z\n3,2.5,2024-01-01 10:00:00,true,\n4\n5,NaN,2024-01-03,false,\n")
    good, bad = tables.read_csv_checked(spark, str(tmp_path))
    assert dict(good.dtypes) == {"n": "bigint", "m": "double", "t": "timestamp_ntz", "b": "boolean", "z": "string"}
    assert good.count() == 4 and good.where("m is null").count() == 1
    assert [(r["line_no"], r["reason"]) for r in bad.collect()] == [(3, "1 fields, not 5")]
    (tmp_path / "c.csv").write_text("n,q\n1,2\n")
    with pytest.raises(ValueError, match="differ"):
        tables.read_csv_checked(spark, str(tmp_path))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        tables.read_csv_checked(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="schema"):
        tables.read_csv_checked(spark, str(tmp_path / "a.csv"), header=False)
    with pytest.raises(ValueError, match="schema"):
        tables.read_csv_checked(spark, str(tmp_path / "a.csv"), "n bigint")


@pytest.mark.parametrize("rate", [0.0, 0.137, 1.0])
def test_the_rate_of_generated_labels_is_exact(spark, rate):
    df = gen.generate_labelled(spark, 1003, rate, 5)
    assert df.agg(F.sum("churned")).first()[0] == math.ceil(1003 * rate)
    assert rows_of(df) == rows_of(gen.generate_labelled(spark, keys=spark.range(1003).repartition(7), positive_rate=rate, seed=5))


def test_generated_labels_can_be_learnt(spark):
    df = gen.generate_labelled(spark, 4000, 0.2, 1).select("customer_id", "churned", "monthly_spend", "sessions_per_month", "support_tickets_last_month", "age")
    train, test = df.where("customer_id % 4 > 0"), df.where("customer_id % 4 = 0")
    model, feats, _, _ = mdl.train(train, "churned", {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.2}, folds=0)
    assert mdl.training_metrics(mdl.score(model, test, ["churned"])).first()["roc_auc"] > 0.7
    flat = gen.generate_customers(spark, 4000, 0.2, 1).select(*df.columns)
    blind, _, _, _ = mdl.train(flat.where("customer_id % 4 > 0"), "churned", {"n_estimators": 30, "max_depth": 3, "learning_rate": 0.2}, folds=0)
    assert mdl.training_metrics(mdl.score(blind, flat.where("customer_id % 4 = 0"), ["churned"])).first()["roc_auc"] < 0.6
