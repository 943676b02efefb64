import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from llm_data import docs_of, documents, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from cairn.llm import pii

# The contract's patterns as they are written there.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute_seeds(text):
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], text) if valid(kind, m.group()))


def brute_bootstrap(texts, rounds=pii.ROUNDS):
    """The graph in plain dictionaries: {instance: kind} of all known ones."""
    stands, fits, known = defaultdict(set), defaultdict(int), {}
    for text in texts:
        found = pii.seeds(text)
        all_of = [(s, e, 1 << k, pii.instance(text[s:e], k), k) for s, k, e in found]
        all_of += [(*c, None) for c in pii._candidates(text, found)]
        for (_, _, f, key, k), patterns in zip(all_of, pii._context(text, [m[:2] for m in all_of])):
            if k is not None:
                known[key] = min(k, known.get(key, 9))
            for p in patterns:
                stands[p].add(key)
                fits[p, key] |= f
    score = dict.fromkeys(known, 1.0)
    kind, seen = dict(known), set(known)
    for _ in range(rounds):
        good = {}
        for p, keys in stands.items():
            total = sum(score[i] for i in keys if i in score)
            for k in range(4):
                of = sum(score[i] for i in keys if i in score and kind[i] == k)
                no = sum(1 for i in keys if i not in score and not fits[p, i] >> k & 1)
                if of >= pii.MIN_SUPPORT and of / (total + no + 1) >= pii.MIN_CONFIDENCE:
                    good[p] = (k, of / (total + no + 1))
        miss = defaultdict(lambda: 1.0)
        for p, (k, c) in good.items():
            for i in stands[p]:
                if i not in seen and fits[p, i] >> k & 1:
                    miss[i, k] *= 1 - c
        before = set(kind)
        score, kind = dict.fromkeys(known, 1.0), dict(known)
        for (i, k), m in sorted(miss.items(), key=lambda x: (x[1], x[0][1])):
            if 1 - m >= pii.MIN_SCORE and i not in kind:
                score[i], kind[i] = 1 - m, k
        if set(kind) == before:
            break
    return kind


def expected(rows):
    texts = [t or "" for _, t in rows]
    kind = brute_bootstrap(texts)
    out = []
    for (doc, _), text in zip(rows, texts):
        base = brute_seeds(text)
        added = [(s, kind[key], e) for s, e, f, key in pii._candidates(text, base) if key in kind and f >> kind[key] & 1]
        name = lambda spans: ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in sorted(spans))
        out.append((doc, *[sum(k == j for _, k, _ in base) for j in range(4)],
                    hashlib.sha256(name(base).encode()).hexdigest(), name(base + added)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans").collect()), key=str)


def planted(seed=1):
    """Cued identifiers, some of them beyond the seed patterns, one chain of two hops, and numbers in clean contexts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(5))
    digits = lambda n: "".join(r.choice("123456789") for _ in range(n))
    rows = []
    for i in range(14):
        rows.append(f"{word()} {word()} call me on +1 555 {digits(7)} {word()} {word()}")
        rows.append(f"{word()} my mail is {word()}@{word()}.org {word()} order {digits(9)} {word()}")
    rows += [f"{word()} call me on 555-{digits(3)}-{digits(4)} {word()}" for _ in range(6)]
    rows.append(f"{word()} my mail is jane (at) host (dot) net and more")
    far = [f"777{digits(7)}" for _ in range(9)]
    rows += [f"{word()} call me on {x} {word()}" for x in far]
    rows += [f"{word()} desk extension {x} {word()}" for x in far]
    rows.append(f"{word()} desk extension 4443332221 {word()}")        # known only in the second round
    rows += [f"{word()} order {digits(10)} {word()}" for _ in range(5)]
    return list(enumerate(rows))


def test_base_on_given_documents(spark):
    for r in documents(spark).collect():
        assert pii.seeds(r.text or "") == brute_seeds(r.text or "")


@given(st.text("ab@.%_- +()0123459\n", max_size=70))
@settings(max_examples=1500, deadline=None)
def test_base_equals_the_contract_patterns(text):
    assert pii.seeds(text) == brute_seeds(text)


def test_discovery_against_brute_force(spark, docs_of):  # noqa: F811
    rows = planted()
    found = got(pii.find_pii(docs_of(rows)))
    assert found == expected(rows)
    spans = {r[0]: r[6] for r in found}
    text = dict(rows)
    new = {text[d][int(s.split(":")[1]):int(s.split(":")[2])]: s.split(":")[0] for d, x in spans.items() for s in x.split(",") if s}
    assert new["jane (at) host (dot) net"] == "email" and new["4443332221"] == "phone"
    assert sum(s.startswith("555-") for s in new) == 6
    assert not any("order" in t and "phone" in spans[d] for d, t in rows), "numbers in other contexts stay"


def test_one_round_reaches_less(spark, docs_of):  # noqa: F811
    rows = planted()
    one = {r[0]: r[6] for r in got(pii.find_pii(docs_of(rows), rounds=1))}
    hop = next(i for i, t in rows if "4443332221" in t)
    assert one[hop] == "" and any(r[0] == hop and r[6] for r in got(pii.find_pii(docs_of(rows))))


def test_mixed_contexts_are_refused(spark):
    edges = [("the _", f"n:{i}", 12) for i in range(20)] + [("pay _", f"n:{i}", 4) for i in range(6)] + [("pay _", "o:x", 0)]
    known = [(f"n:{i}", pii.CARD if i < 10 else pii.PHONE, 1.0) for i in range(20)]
    df = pii.pattern_scores(spark.createDataFrame(edges, "pattern string, instance string, fits int"),
                            spark.createDataFrame(known, "instance string, kind int, score double"), min_confidence=0.7)
    row, = df.collect()
    assert (row.pattern, row.kind) == ("pay _", pii.CARD) and math.isclose(row.confidence, 6 / 8)


def test_given_documents_and_odd_rows(spark, docs_of, odd_rows):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in documents(spark, "/root/testdata/sf0.001").collect()] + odd_rows
    assert got(pii.find_pii(docs_of(rows))) == expected(rows)
    assert got(pii.find_pii(docs_of([]))) == []
    r = pii.find_pii(docs_of([(1, None), (2, "")])).collect()
    assert {(x.n_email, x.spans, x.base_sha256) for x in r} == {(0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("piece", ["a", "a@", "1", "1.", "1 ", "+1", "+1 ", "a.", "a at ", "(at)", "0:", "1.1.1.1 ", "((", "x1", " dot "])
def test_long_texts_take_linear_time(piece):
    times = []
    for n in (10_000, 80_000):
        text = "1@ (at) " + piece * (n // len(piece))
        t = time.perf_counter()
        found = pii.seeds(text)
        pii._context(text, [c[:2] for c in pii._candidates(text, found)])
        times.append(time.perf_counter() - t)
    assert times[1] < 16 * times[0] + 0.2
