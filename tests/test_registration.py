"""Registration numbers, figures from the write job, bucketed views, models in folders of their own, the entry's guard."""

import json
import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cairn.operators import joins, model as mdl, profile
from cairn.sources import models as mstore, registry as reg
from conftest import ROOT


def frame(spark, n=200, add=0):
    return spark.range(n).select(F.col("id").alias("customer_id"), (F.col("id") * 2.0 + add).alias("x"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("y"), (F.col("id") % 2).cast("int").alias("churned"))


def test_numbers_are_claimed_once(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(16) as pool:
        got = list(pool.map(lambda _: reg.claim_number(spark, root), range(60)))
    assert sorted(got) == list(range(1, 61))


def test_concurrent_registrations_lose_nothing(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: reg.register_view(frame(spark, 10, i), root, "v", ["customer_id"], "v1", desc=str(i)), range(6)))
    rows = reg.registry(spark, root).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(1, 7)) and {r["description"] for r in rows} == set("012345")
    winner = rows[-1]["description"]
    assert reg.read_view(spark, root, "v", "v1").agg(F.min("x")).first()[0] == float(winner)
    assert reg.describe_view(reg.registry(spark, root), "v")["description"] == winner


def test_the_clock_decides_nothing(spark, tmp_path, monkeypatch):
    import datetime as dt
    root = str(tmp_path)
    reg.register_view(frame(spark, 5, 0), root, "v", ["customer_id"], "v1")

    monkeypatch.setattr(reg, "_now", lambda: dt.datetime(1999, 1, 1))
    reg.register_view(frame(spark, 5, 7), root, "v", ["customer_id"], "v1")
    reg.set_default_version(spark, root, "v", "v1")
    assert reg.read_view(spark, root, "v").agg(F.min("x")).first()[0] == 7.0


def test_compaction_keeps_every_row(spark, tmp_path):
    root = str(tmp_path)
    for v in ("v1", "v2", "v10"):
        reg.register_view(frame(spark, 5), root, "v", ["customer_id"], v, observe=[F.max("x").alias("top")])
    before = sorted(map(str, reg.registry(spark, root).collect()))
    assert reg.compact_registry(spark, root) == 3
    assert sorted(map(str, reg.registry(spark, root).collect())) == before
    assert len(os.listdir(tmp_path / "_registry")) == 1
    reg.register_view(frame(spark, 6), root, "v", ["customer_id"], "v10")
    assert reg.read_view(spark, root, "v", "latest").count() == 6 and reg.compact_registry(spark, str(tmp_path / "none")) == 0


def test_figures_come_from_the_write_job(spark, tmp_path):
    root, df = str(tmp_path), frame(spark)
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    once = df.mapInArrow(counted, df.schema)
    reg.register_view(once, root, "v", ["customer_id"], "v1", observe=profile.summary_aggregates(df, "churned"))
    assert scans.value == 200, "the source is read once"
    want = profile.summary(df, "churned").first().asDict()
    got = reg.view_stats(spark, root, "v", "v1")
    assert got == {k: float(want[k]) for k in ("n_rows", "n_missing", "target_rate")}


def test_joins_of_bucketed_views_need_no_shuffle(spark, tmp_path):
    root = str(tmp_path)
    a, b = frame(spark, 300), frame(spark, 400, 1).drop("churned")
    for name, df, n in (("a", a, 4), ("b", b, 4), ("c", b, 8), ("d", b, None)):
        reg.register_view(df, root, name, ["customer_id"], "v1", buckets=n)
    read = lambda n: reg.read_view(spark, root, n, "v1")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        want = sorted(map(tuple, joins.join_inner(a, b).collect()))
        for other in ("b", "c", "d"):
            j = joins.join_inner(read("a"), read(other))
            plan = j._jdf.queryExecution().executedPlan().toString()
            assert other != "b" or "Exchange" not in plan, plan
            assert sorted(map(tuple, j.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    reg.register_view(a.limit(3), root, "a", ["customer_id"], "v1")     # the same version again, without buckets
    assert read("a").count() == 3


def test_a_second_save_leaves_the_first_model(spark, tmp_path):
    root, df = str(tmp_path), frame(spark)
    one, two = (mdl.train(df, "churned", {"n_estimators": n, "max_depth": 2}, folds=0)[0] for n in (2, 3))
    first = mstore.save_model(one, root, "odd name/x", "v1")

    class Broken:
        def write(self):
            raise RuntimeError("no space")

    with pytest.raises(RuntimeError):
        mstore.save_model(Broken(), root, "odd name/x", "v1")
    assert mstore.load_model(spark, root, "odd name/x", "v1").stages[-1].getNumTrees == 2
    assert mstore.save_model(two, root, "odd name/x", "v1") != first
    assert mstore.load_model(spark, root, "odd name/x").stages[-1].getNumTrees == 3
    with pytest.raises(KeyError):
        mstore.load_model(spark, root, "odd name/x", "v7")


def test_entry_without_an_optional_dependency():
    """A package that the training-data operators need is missing: the other queries are still there."""
    code = ("import sys, json; sys.modules['ahocorasick'] = None; sys.modules['tokenizers'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); print(json.dumps([len(q), sorted(k for k in q if k.startswith('op'))]))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout
    from cairn.plans import queries
    n, ops = json.loads(out.strip().splitlines()[-1])
    assert n >= len(queries.QUERIES)
