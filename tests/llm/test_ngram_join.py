import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_data import docs_of, documents, odd_rows  # noqa: F401
from hypothesis import given, settings, strategies as st

from cairn.llm import components, ngram_join as nj
from cairn.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k=4, percent=85):
    """{doc_id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def near_copies(seed, base_words=60, groups=6, copies=25, shared=25):
    """Groups of near copies at all distances, with a passage that half the texts share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(shared)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(base_words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 4])):
                text[r.randrange(len(text))] = word()
            if r.random() < 0.3:
                del text[r.randrange(len(text))]
            rows.append(text + (passage if r.random() < 0.5 else []))
    r.shuffle(rows)
    return [(i * 3, " ".join(t)) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_as_brute_force(spark, docs_of, seed):
    rows = near_copies(seed)
    assert got(nj.ngram_components(docs_of(rows))) == brute(rows)


def test_common_shingles_and_salt_as_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(nj, "COMMON_LEAST", 3)
    monkeypatch.setattr(nj, "SALT", 4)
    rows = near_copies(3)
    assert got(nj.ngram_components(docs_of(rows))) == brute(rows)
    assert got(nj.ngram_components(docs_of(rows), 5, 80)) == brute(rows, 5, 80)


def test_semi_join_without_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(nj, "BROADCAST_ROWS", 0)
    rows = near_copies(4, groups=2, copies=12)
    assert got(nj.ngram_components(docs_of(rows))) == brute(rows)


def test_odd_rows(spark, docs_of, odd_rows):
    out = nj.ngram_components(docs_of(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[4] == [(1, 4)] and by[5] == [(1, 4)] * 2 and by[None] == [(1, 4)]
    assert by[6] == [(1, 6)]
    assert by[7][0][1] == by[8][0][1] == 7 and by[7][0][0] > 5000
    assert sorted(by[9]) == sorted([(1, 9), (3, 9)])


def test_a_last_round_does_not_count_what_the_least_changed_copy_joins(spark, docs_of, monkeypatch):
    """Any two of these copies are apart; each is similar to the text that they were made from."""
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))] + [(c, " ".join(f"x{i}" if i > 4 and (i - 5) % 70 == 4 * c else w for i, w in enumerate(base))) for c in range(1, 18)]
    counted, links = [], nj._links

    def spy(docs, nodes, pairs, *more):
        counted.append(pairs.count())
        return links(docs, nodes, pairs, *more)

    monkeypatch.setattr(nj, "_links", spy)
    assert got(nj.ngram_components(docs_of(rows))) == brute(rows)
    assert counted[1:] == [0, 0]


def test_a_pair_counts_in_its_first_list_alone(spark, monkeypatch):
    """Lists in their order hold both sets, one of them, the other; sketches of every size know some of the first kind."""
    lists = {1: [(g * 7919 % 101, p) for p, g in enumerate(range(40)) if g % 3 != 1], 2: [(g * 7919 % 101, p) for p, g in enumerate(range(40)) if g % 3 != 2]}
    both = [g for g, _ in lists[1] if g in dict(lists[2])]
    df = spark.createDataFrame([(n, g, p) for n, x in lists.items() for g, p in x], "node long, gram long, pos long")
    for size, most in ((1, 14), (5, 14), (32, 1)):
        monkeypatch.setattr(nj, "SKETCH", size)
        earlier = {(r.node, r.gram): set(r.earlier) for r in nj._with_earlier(df).collect()}
        new = [g for g in both if not earlier[1, g] & earlier[2, g]]
        assert both[0] in new and len(new) <= most


def test_small_tables_take_few_partitions(spark):
    df, rows = components.kept_sized(spark.range(1000, numPartitions=40))
    assert rows == 1000 and df.rdd.getNumPartitions() == 1 and df.count() == 1000
    many = components.sized(spark.range(100_001, numPartitions=40), 100_001)
    assert many.rdd.getNumPartitions() == 5
    chain = spark.range(300).repartition(40).selectExpr("id a", "id + 1 b")
    found = connected_components(chain)
    assert found.rdd.getNumPartitions() <= 2 and found.where("label = 0").count() == 301


def test_empty_table(spark, docs_of):
    assert nj.ngram_components(docs_of([])).collect() == []


def test_one_of_each_group_stays(spark, docs_of, odd_rows):
    rows = near_copies(5, groups=3, copies=15)
    kept = nj.keep_representatives(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(rows, 5, 80).values()})
    odd = [r.doc_id for r in nj.keep_representatives(docs_of(odd_rows)).collect()]
    assert sorted(x for x in odd if x is not None) == [1, 2, 3, 4, 6, 7, 9, 10]


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 600 + i) for i in range(50)]
    up = {}

    def root(i):
        while up.get(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        p, q = sorted((root(a), root(b)))
        up[q] = p
    want = {i: root(i) for e in edges if e[0] != e[1] for i in e}
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {x.node: x.label for x in connected_components(df).collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=200), st.sets(st.integers(0, 2**64 - 1), max_size=200),
       st.sets(st.integers(0, 2**64 - 1), max_size=200))
def test_signature_never_understates_an_overlap(a, b, c):
    x, y = (np.array(sorted(s), np.uint64) for s in (a | c, b | c))
    differ = sum(int(u ^ v).bit_count() for u, v in zip(nj._signature(x).view(np.uint64).tolist(), nj._signature(y).view(np.uint64).tolist()))
    assert differ <= len((a | c) ^ (b | c))


def test_whole_table_has_links(spark):
    out = nj.ngram_components(documents(spark))
    assert out.count() == documents(spark).count() and out.where("component_id < doc_id").count() > 50
