import math
import random

import numpy as np
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from cairn.llm import hardneg as hn
from cairn.llm.oracle import SQL
from cairn.llm.queries import QUERIES

NAME = "op12_hard_negative_mining"
SCHEMA = "vec_id long, embedding array<double>, label int, id string, score double, slot int, other string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 0.5, 1, "y") for i, v, y in rows], SCHEMA).repartition(3)


def brute(rows, anchor, positives=5, negatives=10, low=30, high=90):
    ok = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows
          if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, y, v in ok:
        if not anchor(i):
            continue
        s = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in ok)
        for p, j, z in [t for t in s if t[2] == y and t[1] != i][:positives]:
            near = [t for t in s if t[2] != y and low * -p <= 100 * -t[0] <= high * -p][:negatives]
            out += [(i, j, r + 1, k, -p, -q) for r, (q, k, _) in enumerate(near)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def random_rows(n, dim, labels, seed, grid=None):
    r = random.Random(seed)
    value = (lambda: r.choice(grid)) if grid else (lambda: r.gauss(0.02, 0.1))
    return [(i, [value() for _ in range(dim)], r.choice(labels)) for i in range(n)]


@pytest.mark.parametrize("bits,dim", [(1, 8), (9, 64), (20, 24)])
def test_lookups_give_inner_products(bits, dim):
    r = np.random.default_rng(bits)
    a, c = (r.integers(-(1 << bits - 1), 1 << bits - 1, (n, dim), endpoint=False) for n in (7, 33))
    pa, pc = hn.pack_planes(a, bits), hn.pack_planes(c, bits)
    assert (hn.unpack_planes(pa) == a).all()
    assert (hn.scores(hn.subset_sums(hn.unpack_planes(pa), np.int64), pc) == c @ a.T).all()


def test_oracle_and_types(spark):
    ok, why = compare(QUERIES[NAME](spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), SQL[NAME])
    assert ok, why


def test_blocks_and_ties(spark, monkeypatch):
    """Few distinct values (many ties), small tiles and blocks, one label with half of the rows."""
    monkeypatch.setattr(hn, "TILE_ROWS", 16)
    monkeypatch.setattr(hn, "TILE_ANCHORS", 3)
    rows = random_rows(300, 11, [0, 0, 0, 1, 2], 5, [0.0, 0.25, 0.5])
    df = hn.hard_negatives(frame(spark, rows), F.col("id") % 10 == 0, anchors_per_block=7)
    assert got(df) == brute(rows, lambda i: i % 10 == 0)
    rows = random_rows(400, 16, list(range(10)), 6)
    assert got(hn.hard_negatives(frame(spark, rows), F.col("id") % 20 == 0, 3, 4, 10, 99)) == brute(rows, lambda i: i % 20 == 0, 3, 4, 10, 99)


def test_odd_rows(spark):
    rows = random_rows(60, 9, [0, 1], 7, [0.5, 0.25, -0.125]) + [
        (None, [0.5] * 9, 0), (100, None, 0), (101, [0.5] * 9, None), (102, [0.5, None] + [0.1] * 7, 1), (103, [math.nan] * 9, 1),
        (104, [math.inf] + [0.1] * 8, 0), (105, [], 0), (106, [0.5] * 4, 1), (200, [0.5] * 20, 0), (200, [0.5] * 20, 0),
        (200, [0.25] * 20, 1), (10, [0.5] * 9, 1)]
    want = brute([(i, None if v is None else v + [0.0] * (20 - len(v)), y) for i, v, y in rows], lambda i: i % 10 == 0)
    assert got(hn.hard_negatives(frame(spark, rows), F.col("id") % 10 == 0)) == want and want


def test_empty_and_without_anchors(spark):
    assert got(hn.hard_negatives(frame(spark, []), F.col("id") % 10 == 0)) == []
    assert got(hn.hard_negatives(frame(spark, [(1, [0.5], 0)]), F.col("id") % 10 == 0)) == []
    assert got(hn.hard_negatives(frame(spark, [(10, [], 0)]), F.col("id") % 10 == 0)) == []


def test_too_large_components_raise(spark):
    with pytest.raises(ValueError, match="63 bits"):
        hn.hard_negatives(frame(spark, [(10, [1e30], 0)]), F.col("id") % 10 == 0)
    rows = [(i, [1e5 * (i % 7), -3e4], i % 2) for i in range(20)]
    assert got(hn.hard_negatives(frame(spark, rows), F.col("id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)
